"""Embedding whitening by a weighted multiplicity covariance.

Entries become whole numbers, so that equal vectors are equal exactly. Rows with the same vector
are grouped, and the covariance is fitted on each distinct vector once, weighted by one or by
its number of rows: whole sums first, then products of the centred vectors, a block of rows at a
time, summed over all tasks. Each distinct vector is whitened once, and the rows get the result
of theirs by a join.

Only sums leave the tasks: as many numbers as the square of the dimensions, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm.common import list_array, table
from lakegate.plans.staging import stage

#: A vector with more than one row in so many of all is dealt over as many lanes for the join.
LANES = 64
_HOT_SHARE = 1024
_LIMIT = float(1 << 55)
_ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """x = floor(scale * entry) + shift; ``weigh`` fits on rows ("counts") or distinct vectors ("one")."""

    components: int = 16
    scale: int = 64
    shift: int = 1_000_000
    weigh: str = "one"


@dataclass(frozen=True)
class Moments:
    """``weight`` and ``sums`` are exact; ``covariance`` has the weight as its divisor."""

    weight: int
    sums: list[int]
    covariance: np.ndarray

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as the nearest whole numbers and what is left of it."""
        whole = [(2 * s + self.weight) // (2 * self.weight) for s in self.sums]
        rest = [float(Fraction(s - w * self.weight, self.weight)) for s, w in zip(self.sums, whole)]
        return np.array(whole, np.int64), np.array(rest)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted sums of a task: dim, s; dimension -1 holds the weight."""
    total: list[int] | None = None
    weight = 0
    for block in _blocks(batches):
        x, w = _matrix(block.column("x")), block.column("w").to_numpy()
        weight += int(w.sum())
        if float(np.abs(x).max(initial=0)) * float(w.sum()) >= _LIMIT:
            x, w = x.astype(object), w.astype(object)
        own = [int(s) for s in (x * w[:, None]).sum(axis=0)]
        total = own if total is None else [a + b for a, b in zip(total, own)]
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *range(len(total))], pa.int32()),
                pa.array([weight, *total], pa.decimal128(38, 0)),
            ],
            names=["dim", "s"],
        )


def _multiplier(whole: np.ndarray, rest: np.ndarray):
    """Weighted products of the centred vectors of a task: i, j, v."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(whole)
        products = np.zeros((size, size))
        for block in _blocks(batches):
            centred = (_matrix(block.column("x")) - whole).astype(np.float64) - rest
            products += (centred * block.column("w").to_numpy()[:, None]).T @ centred
        i, j = np.divmod(np.arange(size * size, dtype=np.int32), np.int32(size))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(products.reshape(-1))], names=["i", "j", "v"])

    return multiply


def _products(frame: DataFrame, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    found = frame.mapInArrow(_multiplier(whole, rest), "i int, j int, v double")
    found = found.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    products = np.zeros((len(whole), len(whole)))
    products[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return (products + products.T) / 2


def moments(frame: DataFrame) -> Moments | None:
    """Of the vectors ``x`` (whole numbers, of one size) with weights ``w``; None of no rows."""
    sums = frame.mapInArrow(_summer, "dim int, s decimal(38, 0)").groupBy("dim").agg(F.sum("s").alias("s")).collect()
    if not sums:
        return None
    held = {r["dim"]: int(r["s"]) for r in sums}
    weight = held.pop(-1)
    first = Moments(weight, [held[i] for i in range(len(held))], np.empty(0))
    return Moments(weight, first.sums, _products(frame, *first.near()) / weight)


def components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (as columns), at most ``count``, those without variance left out."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:count]
    values, vectors = values[order], vectors[:, order]
    some = values > max(float(np.trace(covariance)), 0.0) * len(covariance) * 1e-14
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1, 1)
    return values[some], vectors[:, some]


def _whitener(fitted: Moments, projection: np.ndarray):
    """Each vector with its exact deviation (null if no long holds it) and its whitened components."""
    whole, rest = fitted.near()
    left = [s - int(w) * fitted.weight for s, w in zip(fitted.sums, whole)]

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            apart = _matrix(block.column("x")) - whole
            largest = float(np.abs(apart).max(initial=0) + 1) * fitted.weight
            kind = np.int64 if largest * largest * len(whole) < _LIMIT else object
            exact = apart.astype(kind) * fitted.weight - np.array(left, kind)
            squares = (exact * exact).sum(axis=1).tolist()
            out = (apart.astype(np.float64) - rest) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("x"),
                    block.column("w"),
                    pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                    list_array([out.shape[1]] * len(out), pa.array(out.reshape(-1))),
                ],
                names=["x", "w", "deviation", "whitened"],
            )

    return whiten


def _identity_error(whitened: DataFrame, count: int, weight: int) -> float:
    """The largest entry by which the covariance of the whitened vectors differs from the identity."""
    slim = whitened.select(F.col("whitened").alias("x"), "w")
    entry = slim.select("w", F.posexplode("x").alias("at", "z"))
    means = entry.groupBy("at").agg((F.sum(F.col("z") * F.col("w")) / weight).alias("mean")).collect()
    mean = np.zeros(count)
    for r in means:
        mean[r["at"]] = r["mean"]
    covariance = _products(slim, mean, np.zeros(count)) / weight
    return float(np.abs(covariance - np.eye(count)).max())


def _usable(vector: Column) -> Column:
    """Not null, and every entry finite and small enough for a long."""
    fine = F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < _LIMIT, F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def whiten(rows: DataFrame, settings: Settings = Settings(), vector: str = "embedding") -> DataFrame:
    """vec_id, components, n, deviation, whitened, explained, identity_error of each usable row.

    ``whitened`` and ``explained`` are arrays over the components, which are as many as wanted or
    as have variance; ``n`` is the weight of the fit, ``deviation`` the exact sum over the
    dimensions of (n x - S)^2 with S the sums of the fit, null where no long holds it. Rows whose
    vector is null, empty, or has null or non-finite entries are left out, and so are entries
    beyond 2^55 in scale, which no long holds, and vectors not of the commonest size (of two as
    common, the longer). Rows that repeat, also in their id, and rows without id each get their
    result. Empty tables, and vectors that are all alike, give no components: no rows in the
    first case, empty arrays in the second. Only ``vec_id`` and the vector are read.
    """
    spark = rows.sparkSession
    entries = F.transform("_v", lambda v: F.floor(v.cast("double") * settings.scale) + F.lit(settings.shift).cast("long"))
    limit = F.transform(F.col(vector), lambda v: v.cast("double") * settings.scale)
    clean = rows.select("vec_id", F.col(vector).alias("_v"), limit.alias("_scaled")).where(_usable(F.col("_scaled")))
    clean = clean.select("vec_id", entries.alias("x"))
    common = clean.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = (
        "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    )
    if common is None:
        return spark.createDataFrame([], schema)
    clean = clean.where(F.size("x") == common["size"])

    distinct = stage(clean.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "distinct-vectors")
    weight = F.col("rows") if settings.weigh == "counts" else F.lit(1).cast("long")
    weighed = distinct.select("x", weight.alias("w"))
    fitted = moments(weighed)
    values, vectors = components(fitted.covariance, settings.components)
    trace = float(np.trace(fitted.covariance))
    whitened = weighed.mapInArrow(
        _whitener(fitted, vectors / np.sqrt(values)), "x array<long>, w long, deviation long, whitened array<double>"
    )
    whitened = stage(whitened, "whitened-vectors")
    error = _identity_error(whitened, len(values), fitted.weight) if len(values) else 0.0

    # At most _HOT_SHARE vectors have that many rows; theirs are dealt over lanes.
    hot = distinct.where(F.col("rows") > max(common["count"] // _HOT_SHARE, 1)).select(F.col("x").alias("_hot"))
    lanes = F.when(F.col("_hot").isNotNull(), F.lit(LANES)).otherwise(F.lit(1))

    def marked(frame: DataFrame) -> DataFrame:
        return frame.join(F.broadcast(hot), F.col("x") == F.col("_hot"), "left")

    own = marked(clean).select("vec_id", "x", F.pmod(F.xxhash64(F.monotonically_increasing_id()), lanes).alias("lane"))
    theirs = marked(whitened.select("x", "deviation", "whitened")).select(
        "x", "deviation", "whitened", F.explode(F.sequence(F.lit(0).cast("long"), lanes.cast("long") - 1)).alias("lane")
    )
    return own.join(theirs, ["x", "lane"]).select(
        "vec_id",
        F.lit(fitted.weight).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*(F.lit(float(v / trace)) for v in values)).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding in its first sixteen whitened components."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "held")
    return found.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("held.whitened").alias("whitened"),
        F.col("held.explained").alias("explained"),
        "identity_error",
    )


QUERIES = {"op13_whitening": (op13_whitening, None)}
