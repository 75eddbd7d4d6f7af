"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by learned rotations: principal axes, turned until the signs of
the turned vectors lose as little as possible. A code is split into substrings, each with an
index from value to rows. By the pigeonhole principle a code within Hamming radius r of the
query's is near in some substring: if substring j is probed up to distance t(j) and the
t(j) + 1 add up to r + 1, no code within the radius is missed. Which substrings are probed how
far is chosen per query, by the rows that the index holds at each distance. The vectors
found are then ranked by exact cosines.

Rows are dealt into blocks, each moved once and indexed once. Queries visit every block in a
stream behind its rows, so a task holds one block and one batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm.common import table

#: Rotations and radius are learned on at most so many vectors, taken in hash order of the id.
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 256
BITS = 256
SUBSTRING_BITS = 16
#: The radius holds this share of the true neighbours in the sample.
COVERED = 0.985
#: Rows with one index; a batch of queries is copied to every block, so blocks are large.
DATA_BLOCK = 32768
#: With few rows, blocks are smaller, down to so many rows, until every core has one.
LEAST_BLOCK = 2048

_ONES = np.bitwise_count(np.arange(1 << SUBSTRING_BITS, dtype=np.uint32)).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    turn: np.ndarray  # dimensions x BITS
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one row per vector."""
        bits = (_unit(x) - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1).view(np.uint16)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rotations(x: np.ndarray, bits: int, rng: np.random.Generator, steps: int = 25) -> np.ndarray:
    """Iterative quantisation from several random starts, side by side, up to ``bits`` columns."""
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    axes = axes[:bits].T
    flat, parts = x @ axes, []
    while sum(p.shape[1] for p in parts) < bits:
        size = axes.shape[1]
        turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
        for _ in range(steps):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        parts.append(axes @ turn)
    return np.concatenate(parts, axis=1)[:, :bits]


def fit(x: np.ndarray, k: int, seed: int = 0) -> Model:
    """Rotations of the sample ``x``, and the radius that covers its own nearest neighbours."""
    rng = np.random.default_rng(seed)
    unit = _unit(x)
    mean = unit.mean(axis=0)
    turn = _rotations(unit - mean, BITS, rng)
    model = Model(mean, turn, BITS // 4)
    if len(x) <= k:
        return Model(mean, turn, BITS)
    own = np.linspace(0, len(x) - 1, min(SAMPLE_QUERIES, len(x))).astype(int)
    near = unit[own] @ unit.T
    near[np.arange(len(own)), own] = -2
    best = np.argsort(-near, axis=1)[:, :k]
    codes = model.codes(x)
    apart = _ONES[codes[own][:, None, :] ^ codes[best]].sum(axis=2, dtype=np.int64)
    return Model(mean, turn, int(np.quantile(apart, COVERED)))


def usable(vector: Column, size: int | None = None) -> Column:
    """Not null, not zero, no null or non-finite component (and of the given size)."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)
    return F.coalesce(fine if size is None else fine & (F.size(vector) == size), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


class MultiIndex:
    """The substring indexes of one block of rows."""

    def __init__(self, codes: np.ndarray):
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        self.tables = []
        for column in codes.T:
            values, group = np.unique(column, return_inverse=True)
            order = np.argsort(group, kind="stable")
            self.tables.append((values, order, np.bincount(group, minlength=len(values))))

    @staticmethod
    def reaches(held: np.ndarray, radius: int) -> np.ndarray:
        """How far to probe each substring, -1 for not at all: the cheapest by ``held``.

        ``held`` counts the rows of each substring's index at each distance. Every step of
        one substring by one costs the rows there; ``radius`` + 1 steps miss nothing.
        """
        # A step counts as dear as the dearest before it: then no step is taken before those.
        dear = np.maximum.accumulate(held, axis=1)
        steps = np.argsort(dear, axis=None, kind="stable")[: radius + 1] // held.shape[1]
        return np.bincount(steps, minlength=len(held)) - 1

    def visited(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of the rows that probing reads: all within ``radius``, and others."""
        apart = [_ONES[values ^ part] for part, (values, _, _) in zip(code, self.tables)]
        held = np.array(
            [
                np.bincount(far, weights=counts, minlength=SUBSTRING_BITS + 1)
                for far, (_, _, counts) in zip(apart, self.tables)
            ]
        )
        seen = np.zeros(len(self.words), bool)
        for far, reach, (_, order, counts) in zip(apart, self.reaches(held, radius), self.tables):
            seen[order[np.repeat(far <= reach, counts)]] = True
        return np.flatnonzero(seen)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of all rows whose code is within ``radius`` of ``code``."""
        rows = self.visited(code, radius)
        apart = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1)
        return rows[apart <= radius]


class _Block:
    """The rows of one block with their index."""

    def __init__(self, model: Model, ids: np.ndarray, x: np.ndarray):
        # One vector per id: the first by its components.
        order = np.lexsort((*x.T[::-1], ids))
        ids, x = ids[order], x[order]
        first = np.concatenate(([True], ids[1:] != ids[:-1]))
        self.ids, self.x = ids[first], x[first]
        self.model, self.index = model, MultiIndex(model.codes(self.x))
        self.lengths = np.sqrt((self.x * self.x).sum(axis=1))

    def nearest(self, query_id: int, query: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the ``k`` nearest within the radius, which grows until there are ``k``."""
        radius, wanted = self.model.radius, min(k, len(self.ids) - int(query_id in self.ids))
        while True:
            near = self.index.within(code, radius)
            near = near[self.ids[near] != query_id]
            if len(near) >= wanted or radius >= BITS:
                break
            radius = min(BITS, radius + SUBSTRING_BITS)
        dots = (self.x[near] * query).sum(axis=1)
        scores = dots / (self.lengths[near] * np.sqrt((query * query).sum()))
        best = np.lexsort((self.ids[near], -scores))[:k]
        return self.ids[near][best], scores[best]


def _searcher(model: Model, size: int, k: int):
    def search_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one block, sorted: first those to index, then the queries by id."""
        ids, vectors, block, last = [], [], None, None
        for batch in batches:
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            own, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"), size)
            if not asks.all():
                if block is not None:
                    raise ValueError("a row to index came after a query")
                ids.append(own[~asks])
                vectors.append(x[~asks])
            if not asks.any() or not ids:
                continue
            if block is None:
                block = _Block(model, np.concatenate(ids), np.concatenate(vectors))
                vectors.clear()
            found: tuple[list, list, list] = ([], [], [])
            asked = x[asks]
            for query_id, query, code in zip(own[asks], asked, model.codes(asked)):
                if query_id == last:  # a repeated id: its first vector has been searched
                    continue
                last = query_id
                near, scores = block.nearest(query_id, query, code, k)
                found[0].extend([query_id] * len(near))
                found[1].extend(near)
                found[2].extend(scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                names=["query_id", "vec_id", "score"],
            )

    return search_block


def search(base: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row of ``queries``.

    ``score`` is the cosine in double precision; ties go to the smaller ``vec_id``; a row with
    the query's id is no answer. Null, zero, and non-finite vectors, those with null
    components, those not of the commonest size in the sample, and rows without id take no
    part. Of rows that repeat an id the first by its components counts. A query with fewer
    than ``k`` other rows gets them all; empty tables give no rows.
    """

    def clean(frame: DataFrame, size: int | None = None) -> DataFrame:
        rows = frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
        return rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"), size))

    sample = clean(base).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    if not sample:
        empty = clean(base).where("false")
        return empty.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    sizes = [len(r["vector"]) for r in sample]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    model = fit(np.array([r["vector"] for r in sample if len(r["vector"]) == size], float), k)
    rows, asked = clean(base, size), clean(queries, size)
    held = max(rows.count(), 1)
    cores = base.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-held // DATA_BLOCK), min(cores, -(-held // LEAST_BLOCK)))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    both = rows.select("vec_id", "vector", dealt.alias("block"), F.lit(False).alias("asks")).union(
        asked.select("vec_id", "vector", every.alias("block"), F.lit(True).alias("asks"))
    )
    # Sorted so that a block's rows come before its queries, and equal query ids together.
    streams = both.repartition(blocks, "block").sortWithinPartitions("block", "asks", "vec_id", "vector")
    found = streams.groupBy("block").applyInArrow(
        _searcher(model, size, k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % 50 == 0))


QUERIES = {"op6_ann": (op6_ann, None)}
