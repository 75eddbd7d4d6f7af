"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of so many words, and a window is the set of its word shingles.
All shingles of the items are counted over the documents, which orders them by rarity. A window
that shares enough shingles with a stretch of a document must share one of its rarest ones, its
prefix: with all of them wanted, the single rarest. Only these prefix shingles are joined with
the documents. The place of the shingle in the window and in the document bounds where the
window can lie, the document's length bounds it too, and the words around are then compared.

Documents are read twice, and nothing of them is shuffled but the hits of prefix shingles, with
the few words around. Tasks tell what may hit by a bitmap of fixed size, whatever the number of
items; the join itself is Spark's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm.common import list_array, table
from lakegate.llm.words import Filter, Words, byte_kinds, chained, parts, words
from lakegate.plans.staging import stage

#: Words are runs of ASCII letters, digits and all characters beyond ASCII.
KINDS = byte_kinds(bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)))
_ROWS = 8192


@dataclass(frozen=True)
class Settings:
    """``window`` words are compared at a time, as shingles of ``shingle`` words.

    ``containment`` is the least share of a window's distinct shingles that a stretch of as many
    words of a document must hold; at 1 the words must be the same in the same order.
    """

    window: int = 10
    shingle: int = 5
    containment: float = 1.0

    def wanted(self, shingles: int) -> int:
        return max(1, math.ceil(self.containment * shingles - 1e-9))


def _windows(settings: Settings):
    """The windows of items: item_id, unit (its words), size, shingles in order."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = words(batch.column("text"), KINDS)
            hashes = found.hashes()
            ids = batch.column("item_id").to_pylist()
            ends = np.cumsum(found.counts())
            rows: list[tuple] = []
            for item, begin, end in zip(ids, np.concatenate(([0], ends[:-1])), ends):
                size = min(settings.window, int(end - begin))
                width = min(settings.shingle, size)
                shingles = chained(hashes[begin:end], width) if size else hashes[:0]
                for at in range(int(begin), int(end) - size + 1) if size else ():
                    own = shingles[at - begin : at - begin + size - width + 1]
                    rows.append((item, found.spelled(at, at + size), size, own))
                    if len(rows) == _ROWS:
                        yield _unit_rows(rows)
                        rows = []
            yield _unit_rows(rows)

    return make


def _unit_rows(rows: list[tuple]) -> pa.RecordBatch:
    flat = np.concatenate([r[3] for r in rows]) if rows else np.empty(0, np.uint64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.string()),
            pa.array([r[1] for r in rows], pa.binary()).cast(pa.string()),
            pa.array([r[2] for r in rows], pa.int32()),
            list_array([len(r[3]) for r in rows], pa.array(flat.view(np.int64))),
        ],
        names=["item_id", "unit", "size", "shingles"],
    )


def _hits(found: Words, hashes: np.ndarray, widths: list[int], wanted: Filter):
    """(width, places, shingles) of the shingles in texts that may be wanted."""
    for width in widths:
        shingles = chained(hashes, width)
        count = len(shingles)
        whole = found.text[:count] == found.text[width - 1 : width - 1 + count]
        at = np.flatnonzero(wanted.has(shingles) & whole)
        yield width, at, shingles[at]


def _counter(widths: list[int], wanted: Filter):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = words(batch.column("text"), KINDS)
            hits = [h for _, _, h in _hits(found, found.hashes(), widths, wanted)]
            keys, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *hits]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"]
            )

    return count


_SCAN = "row long, doc_id long, n_words long, at long, key long, before int, context string"


def _scanner(widths: list[int], wanted: Filter, reach: int):
    """One row per document with null ``at``, and one per hit, with ``reach`` words on either side."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in parts(batches):
            found = words(batch.column("text"), KINDS)
            ids = batch.column("doc_id").to_pylist()
            counts = found.counts()
            ends = np.cumsum(counts)
            begins = ends - counts
            rows = [(row + i, ids[i], int(n), None, None, None, None) for i, n in enumerate(counts)]
            for width, places, keys in _hits(found, found.hashes(), widths, wanted):
                for at, key in zip(places.tolist(), keys.view(np.int64).tolist()):
                    if len(rows) >= _ROWS:
                        yield _scan_rows(rows)
                        rows = []
                    i = int(found.text[at])
                    low, high = max(at - reach, int(begins[i])), min(at + width + reach, int(ends[i]))
                    where = (at - int(begins[i]), key, at - low, found.spelled(low, high))
                    rows.append((row + i, ids[i], int(counts[i]), *where))
            yield _scan_rows(rows)
            row += batch.num_rows

    return scan


def _scan_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)]
    columns[-1] = columns[-1].cast(pa.string())
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SCAN.split(", ")])


def _verifier(settings: Settings):
    """The places where a window really lies: row, unit, start, size."""

    def distinct(text: list[str], width: int) -> set[tuple[str, ...]]:
        return {tuple(text[i : i + width]) for i in range(len(text) - width + 1)}

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("row", "n_words", "at", "before", "context", "unit", "size", "pos")
        for batch in batches:
            out: list[tuple] = []
            for row, n, at, before, context, unit, size, pos in zip(*(batch.column(c).to_pylist() for c in names)):
                around, own = context.split(" "), unit.split(" ")
                width = min(settings.shingle, size)
                shingles = distinct(own, width)
                need = settings.wanted(len(shingles))
                slack = len(own) - width + 1 - need if settings.containment < 1 else 0
                for start in range(max(at - pos - slack, 0), min(at - pos + slack, n - size) + 1):
                    low = start - (at - before)
                    there = around[low : low + size] if low >= 0 else []
                    if len(there) < size:
                        continue
                    if there == own if settings.containment >= 1 else len(distinct(there, width) & shingles) >= need:
                        out.append((row, unit, start, size))
            columns = zip(*out) if out else [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["row", "unit", "start", "size"]
            )

    return verify


def contamination(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, spans.

    ``items`` holds the distinct ids, as text and sorted, of the items of which a window lies in
    the document; ``spans`` the stretches of words that such windows cover, as (first, end) with
    the end exclusive, apart from each other; ``n_hit`` the words in them. An item of fewer words
    than a window is one window, one without words none. Windows of an item without ``item_id``
    cover words, but no item is named for them. Null and empty texts have no words. Rows that
    repeat, also in their id, and rows without one are documents of their own. Empty tables on
    either side give documents without hits, or no rows. Only ``doc_id``, ``text`` and
    ``item_id`` are read; other columns may have any name.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = items.mapInArrow(_windows(settings), "item_id string, unit string, size int, shingles array<long>")
    windows = stage(windows, "item-windows")
    units = windows.groupBy("unit").agg(F.first("size").alias("size"), F.first("shingles").alias("shingles"))
    shingles = units.select(
        "unit", "size", F.size("shingles").alias("places"), F.posexplode("shingles").alias("pos", "key")
    )
    least = F.least(F.col("size"), F.lit(settings.shingle))
    widths = sorted(r["width"] for r in units.select(least.alias("width")).distinct().collect())

    # How often each shingle of the items stands in the documents: the fewer, the better.
    counts = docs.select("text").mapInArrow(_counter(widths, Filter.of(shingles, F.col("key"))), "key long, n long")
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"))
    sets = shingles.groupBy("unit", "size", "key").agg(F.min("pos").alias("pos"))
    known = sets.join(counts, "key", "left").select(
        "unit", "size", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "pos").alias("token")
    )
    ordered = known.groupBy("unit", "size").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    wanted = F.greatest(F.ceil(F.lit(settings.containment) * F.size("tokens") - 1e-9).cast("int"), F.lit(1))
    # All but as many as may be absent, and one more: one of them is there, or too few are.
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - wanted + 1)
    tokens = ordered.select("unit", "size", F.explode(prefix).alias("token"))
    # A set may stand in another order or more than once; the same words stand at one place only.
    tokens = stage(tokens.select("unit", "size", "token.key", "token.pos"), "prefix-shingles")

    scanned = docs.mapInArrow(_scanner(widths, Filter.of(tokens, F.col("key")), 2 * settings.window), _SCAN)
    scanned = stage(scanned, "shingle-hits")
    hits = scanned.where(F.col("at").isNotNull())
    slack = F.lit(0 if settings.containment >= 1 else settings.window)
    start = F.col("at") - F.col("pos")
    bounds = (start + slack >= 0) & (start - slack + F.col("size") <= F.col("n_words"))
    candidates = hits.join(tokens, "key").where(bounds)
    candidates = candidates.select("row", "n_words", "at", "before", "context", "unit", "size", "pos")
    found = candidates.mapInArrow(_verifier(settings), "row long, unit string, start long, size int")
    found = stage(found, "window-occurrences")

    named = windows.where(F.col("item_id").isNotNull()).select("unit", "item_id").distinct()
    named = found.select("row", "unit").distinct().join(named, "unit")
    named = named.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    spans = _spans(found.select("row", "start", (F.col("start") + F.col("size")).alias("end")).distinct())
    rows = scanned.where(F.col("at").isNull()).select("row", "doc_id", "n_words")
    return rows.join(spans, "row", "left").join(named, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:long,end:long>>")).alias("spans"),
    )


def _spans(stretches: DataFrame) -> DataFrame:
    """The union of the stretches (start, end) of each row."""
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = stretches.withColumn("_new", F.coalesce(F.col("start") > before, F.lit(True)).cast("long"))
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = begins.withColumn("_island", island).groupBy("row", "_island").agg(
        F.min("start").alias("first"), F.max("end").alias("end")
    )
    return whole.groupBy("row").agg(
        F.sum(F.col("end") - F.col("first")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"),
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it holds ten words in a row of."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT item_id, least(10, len(words)) AS size,
         unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1),
           lambda i: array_to_string(words[i : i + least(10, len(words)) - 1], ' '))) AS w
  FROM b WHERE len(words) > 0
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size
), hits AS (
  SELECT p.id, p.i, p.size, w.item_id
  FROM places p JOIN windows w ON w.size = p.size AND array_to_string(p.words[p.i : p.i + p.size - 1], ' ') = w.w
), hit_words AS (
  SELECT id, count(DISTINCT word) AS n_hit
  FROM (SELECT id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY id
), found AS (
  SELECT id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (id) LEFT JOIN found USING (id)
"""

QUERIES = {"op11_decontamination": (op11_decontamination, SQL)}
