"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over its bins, and so has every chosen pair of features.
Boosting goes round the features in a cycle and adds a shallow tree of one feature at a time
to its table; the pairs that explain most of what is left get tables in the same way. A score
is the sum of one table entry per feature and pair: vectorised additions over bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.llm.common import bytes_of, fold, giving_back, rows_at_most, table

#: At most so many labelled rows are fitted on, taken in hash order of the id.
SAMPLE_ROWS = 20_000
KEEP = 0.7

FEATURES = (
    "log_words",
    "letters_per_word",
    "upper_share",
    "punctuation_share",
    "symbol_share",
    "digit_share",
    "non_ascii_share",
    "white_share",
    "distinct_words",
    "repeated_neighbours",
    "commonest_word",
    "words_per_line",
    "repeated_lines",
    "short_words",
    "words_with_symbols",
    "upper_words",
)

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", np.uint8)
_SYMBOL = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)
_LAST_SYMBOLS = tuple(bytes([c]) for c in b"#$%&*+/<=>@[\\]^_`{|}~!?")


def features(text: bytes) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    size = len(text)
    if not size:
        return [0.0] * len(FEATURES)
    bins = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    # The second byte of a Latin capital such as É is below 0xA0, that of é is not.
    upper, lower = bins[_UPPER].sum(), bins[_LOWER].sum()
    high = bins[128:].sum()
    words = text.split()
    count = len(words)
    distinct: dict[bytes, int] = {}
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = upper + lower + high
    some = max(count, 1)
    return [
        float(np.log1p(count)),
        letters / some,
        upper / max(upper + lower, 1),
        bins[_PUNCTUATION].sum() / size,
        bins[_SYMBOL].sum() / size,
        bins[_DIGIT].sum() / size,
        high / size,
        bins[_SPACE].sum() / size,
        len(distinct) / some,
        sum(map(eq, words, words[1:])) / some,
        max(distinct.values(), default=0) / some,
        count / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(n for w, n in distinct.items() if len(w) < 4) / some,
        sum(n for w, n in distinct.items() if w.endswith(_LAST_SYMBOLS)) / some,
        sum(n for w, n in distinct.items() if len(w) > 1 and w.isupper()) / some,
    ]


@dataclass
class Additive:
    """Bin edges per feature, coarse edges for pairs, and the learned tables."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of features."""
        total = np.full(len(x), self.intercept)
        for i, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, i], side="right")]
        if self.pairs:
            rough = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.coarse)]
            for (i, j), values in zip(self.pairs, self.pair_tables):
                total += values[rough[i], rough[j]]
        return 1 / (1 + np.exp(-total))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """The gain and place of the best cut of bins with gradients ``g`` and hessians ``h``."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    all_g, all_h = g.sum(), h.sum()
    gains = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge)
    at = int(np.argmax(gains))
    return float(gains[at] - all_g**2 / (all_h + ridge)), at + 1


def _stump_values(g: np.ndarray, h: np.ndarray, ridge: float, leaves: int = 3) -> np.ndarray:
    """A tree of at most ``leaves`` leaves over the bins of one feature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b], ridge), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    values = np.empty(len(g))
    for a, b in parts:
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return values


def _cross_values(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """A tree over two features, the best row cut with a column cut on each side. Gain and values."""

    def cuts(row: int) -> tuple[float, list[int]]:
        sides = [_best_cut(g[r].sum(0), h[r].sum(0), ridge) for r in (slice(0, row), slice(row, None))]
        whole = sum(
            g[r].sum() ** 2 / (h[r].sum() + ridge) for r in (slice(0, row), slice(row, None))
        )
        return whole + sum(gain for gain, _ in sides), [at for _, at in sides]

    values = np.zeros_like(g)
    if len(g) < 2:
        return 0.0, values
    gain, columns, row = max((*cuts(row), row) for row in range(1, len(g)))
    for rows, column in zip((slice(0, row), slice(row, None)), columns):
        for part in (slice(0, column), slice(column, None)):
            values[rows, part] = g[rows, part].sum() / (h[rows, part].sum() + ridge)
    return gain - g.sum() ** 2 / (h.sum() + ridge), values


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 60,
    rate: float = 0.15,
    bins: int = 48,
    pair_bins: int = 8,
    pairs: int = 8,
    pair_rounds: int = 20,
    ridge: float = 2.0,
) -> Additive:
    """Cyclic boosting of the logistic loss. Without rows nothing speaks against a text: score near 1."""
    prior = min((y.sum() + 1) / (len(y) + 1), 0.999)
    model = Additive(float(np.log(prior / (1 - prior))))
    if len(np.unique(y)) < 2:
        return model
    width = x.shape[1]
    model.edges = [_edges(x[:, i], bins) for i in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, (place, values) in enumerate(zip(binned, model.tables)):
            g, h = slopes()
            step = rate * _stump_values(
                np.bincount(place, g, len(values)), np.bincount(place, h, len(values)), ridge
            )
            values += step
            total += step[place]
    model.coarse = [_edges(x[:, i], pair_bins) for i in range(width)]
    rough = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.coarse)]

    def grid(i: int, j: int, weights: np.ndarray) -> np.ndarray:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        flat = np.bincount(rough[i] * shape[1] + rough[j], weights, shape[0] * shape[1])
        return flat.reshape(shape)

    g, h = slopes()
    gains = {(i, j): _cross_values(grid(i, j, g), grid(i, j, h), ridge)[0] for i, j in combinations(range(width), 2)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:pairs]
    model.pair_tables = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), values in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = rate * _cross_values(grid(i, j, g), grid(i, j, h), ridge)[1]
            values += step
            total += step[rough[i], rough[j]]
    return model


@giving_back
def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_at_most(batches, 1024):
        rows = [features(t) for t in bytes_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("label"), pa.array(rows, pa.list_(pa.float64()))],
            names=["_id", "label", "x"],
        )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold.

    ``labels`` has doc_id and quality; rows with a null in either are left out. Only texts
    are features. The sample is the first rows by hash of the id, so it is the same again: a
    label given twice counts once, and of documents that share an id the one with the least
    features counts.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(fold(F.col("doc_id")) != 2).select(
        F.col("doc_id").alias("_id"), (F.col("quality") > 0).cast("int").alias("label")
    )
    sample = known.distinct().orderBy(F.xxhash64("_id"), "_id", "label").limit(sample_rows)
    # The sample has at most sample_rows rows of two numbers.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("_id", "label", "text")
    kind = labels.schema["doc_id"].dataType.simpleString()
    featured = chosen.mapInArrow(_featured, f"_id {kind}, label int, x array<double>")
    rows = featured.groupBy("_id", "label").agg(F.min("x").alias("x")).collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    y = np.array([r["label"] for r in rows], float)
    order = np.lexsort((y, *x.T))
    return fit(x[order], y[order])


def _scorer(model: Additive):
    @giving_back
    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_at_most(batches, 1024):
            texts = bytes_of(pc.struct_field(batch.column("row"), "text"))
            x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(model.score(x))], names=["row", "score"]
            )

    return score_rows


def scored(docs: DataFrame, model: Additive, keep: float = KEEP) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), ``score`` and ``predicted``, for every row.

    Whole texts are scored; null counts as empty, and an empty text has the features 0. Only
    ``text`` is read, other columns are carried along. An empty table gives no rows.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    found = rows.mapInArrow(_scorer(model), schema)
    return found.withColumn("predicted", (F.col("score") >= keep).cast("int"))


def accepted(docs: DataFrame, model: Additive, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with their own columns."""
    return scored(docs, model, keep).where("predicted = 1").select("row.*")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        (fold(F.col("row.doc_id")) == 2).alias("held_out"),
        "score",
        "predicted",
    )


QUERIES = {"op7_quality": (op7_quality, None)}
