"""Near-dedup by circulant MinHash, banding and exact Jaccard verification.

Every signature coordinate comes from two permutations of the 32-bit integers: the first is
applied once to the shingles, the second after a circular shift by the coordinate's number.
Documents with the same shingle set are one class with one representative. Classes that
share a band are candidates; links are confirmed on full shingle sets, and components follow.

No group is expanded into pairs of rows. First every class of a bucket is compared with the bucket's
smallest one. Components then show which buckets still hold several; there all are compared with
another leader, a few times over, and what then still meets is compared in blocks, component
against component, where two blocks share a bucket. Every link between classes that share a bucket
is so either found or lies inside a component already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.llm.common import bytes_of, giving_back, list_array, mix64, rows_at_most, table
from lakegate.llm.components import components
from lakegate.plans.staging import stage


@dataclass(frozen=True)
class Settings:
    """``percent``: least Jaccard similarity of a link, in hundredths.

    ``bands`` and ``rows`` must make a miss at that similarity unlikely: with s = percent/100
    it is (1 - s^rows)^bands, 5e-7 for the defaults and 2e-7 for those of ``op9``.
    """

    words: int = 5
    percent: int = 80
    bands: int = 48
    rows: int = 6


OP9 = Settings(words=3, percent=85, bands=48, rows=8)

#: Blocks of nodes that are compared two by two hold about so many rows and shingles.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 500_000

#: So often a mixed bucket gets another leader before its blocks are compared.
LEADER_TURNS = 2

_CACHED_WORDS = 150_000
_ROWS = 256


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _CACHED_WORDS:
            self[word] = value
        return value


_WORDS = _WordHashes()


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z are lower-cased, ASCII only.

    A text with fewer words is one shingle, one without words has none.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    width = min(words, len(each))
    count = len(each) - width + 1
    hashed = mix64(each[:count] + np.uint64(width))
    for i in range(1, width):
        hashed = mix64(hashed + each[i : i + count])
    return np.unique(hashed)


def _permuted(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit integers."""
    x = (x ^ (x >> np.uint32(17))) * np.uint32(0xED5AD4BB)
    x = (x ^ (x >> np.uint32(11))) * np.uint32(0xAC4C1B51)
    return x ^ (x >> np.uint32(15))


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least of pi(sigma(x) + k) over the shingles."""
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    start = _permuted((hashes >> np.uint64(32)).astype(np.uint32))
    shift = np.arange(size, dtype=np.uint32)
    rows = min(_ROWS, len(start))
    space = np.empty((2, rows, size), np.uint32)
    for at in range(0, len(start), rows):
        part = start[at : at + rows, None]
        x, shifted = space[0, : len(part)], space[1, : len(part)]
        np.add(part, shift, out=x)
        # The second permutation, in place.
        for bits, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(x, np.uint32(bits), out=shifted)
            np.bitwise_xor(x, shifted, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.minimum(least, x.min(axis=0), out=least)
    return least


def _bands(least: np.ndarray, settings: Settings) -> np.ndarray:
    """One hash per band, of the band's number and its coordinates."""
    parts = least.reshape(settings.bands, settings.rows).astype(np.uint64)
    hashed = np.arange(1, settings.bands + 1, dtype=np.uint64)
    for column in parts.T:
        hashed = mix64(hashed + column)
    return hashed.view(np.int64)


def _signer(settings: Settings):
    @giving_back
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_at_most(batches, 1024):
            sizes, classes, lengths, bands = [], [], [], []
            for text in bytes_of(batch.column("text")):
                found = shingles(text, settings.words)
                sizes.append(len(found))
                classes.append(blake2b(found, digest_size=16).digest() if len(found) else None)
                lengths.append(settings.bands if len(found) else 0)
                if len(found):
                    least = signature(found, settings.bands * settings.rows)
                    bands.append(_bands(least, settings))
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    list_array(lengths, pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "class", "bands"],
            )

    return sign


def _set_maker(words: int):
    @giving_back
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_at_most(batches, 256):
            sets = [shingles(t, words).view(np.int64) for t in bytes_of(batch.column("text"))]
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), list_array([len(s) for s in sets], pa.array(flat))],
                names=["doc_id", "shingles"],
            )

    return make


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    either = F.size("_a") + F.size("_b") - both
    similar = 100 * both >= settings.percent * either
    return pairs.join(left, "a").join(right, "b").where(similar).select("a", "b")


def _block_comparer(settings: Settings):
    """Links between two blocks of nodes, as few as join their components."""

    def compare(rows: pa.Table) -> pa.Table:
        node, root = rows["node"].to_numpy(), rows["root"].to_numpy()
        second = rows["second"].to_numpy(zero_copy_only=False)
        values = rows["shingles"].combine_chunks()
        values = values if isinstance(values, pa.ListArray) else values.chunk(0)
        sizes = np.diff(values.offsets.to_numpy())
        _, flat = np.unique(values.flatten().to_numpy(), return_inverse=True)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
        if not len(right):  # a block against itself
            right = left
        order = np.concatenate([flat[starts[i] : starts[i + 1]] for i in right])
        begin = np.concatenate(([0], np.cumsum(sizes[right])))[:-1]
        present = np.zeros(flat.max() + 1, np.int64)
        now = {int(r): int(r) for r in root}

        def home(r: int) -> int:
            while now[r] != r:
                now[r] = now[now[r]]
                r = now[r]
            return r

        found: list[tuple[int, int]] = []
        for i in left:
            own = flat[starts[i] : starts[i + 1]]
            present[own] = 1
            both = np.add.reduceat(present[order], begin)
            present[own] = 0
            either = sizes[i] + sizes[right] - both
            similar = (100 * both >= settings.percent * either) & (root[right] != root[i])
            for j in right[similar]:
                x, y = home(int(root[i])), home(int(root[j]))
                if x != y:
                    now[max(x, y)] = min(x, y)
                    found.append((int(node[i]), int(node[j])))
        return pa.table(
            {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
        )

    return compare


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, node, root, low) of the buckets with several components, ``low`` the least root."""
    labelled = members.join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root")
    )
    several = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("_high"))
    mixed = labelled.join(several.where("low < _high").drop("_high"), "bucket")
    return stage(mixed.select("bucket", "node", "root", "low").distinct(), "mixed-buckets")


def _with_leader(mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each bucket's leader of this turn and its nodes of other components.

    The leader is the node with the least hash, so buckets of the same nodes have the same one.
    """
    first = F.min_by(F.struct("node", "root"), F.xxhash64("node", F.lit(turn))).alias("_leader")
    paired = mixed.join(mixed.groupBy("bucket").agg(first), "bucket").where("root <> _leader.root")
    a, b = F.greatest("node", "_leader.node"), F.least("node", "_leader.node")
    return paired.select(a.alias("a"), b.alias("b")).distinct()


def _dealt(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root, block, whole): nodes in blocks of bounded rows and shingles.

    Components that meet in a bucket form a family; blocks are cut inside families. A large
    component has blocks of its own, named by ``whole``. All other nodes stay with those of
    their largest bucket, so that few blocks share one.
    """
    family = components(mixed.select(F.col("root").alias("a"), F.col("low").alias("b")).distinct())
    family = family.select(F.col("node").alias("_root"), F.col("root").alias("_family"))
    held = mixed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_held"))
    homes = mixed.join(held, "bucket").groupBy("node", "root").agg(
        F.max(F.struct("_held", "bucket")).getField("bucket").alias("home")
    )
    sized = sets.select(F.col("doc_id").alias("_node"), F.size("shingles").alias("size"))
    pool = homes.join(family, F.col("root") == F.col("_root"), "left").join(
        sized, F.col("node") == F.col("_node")
    )
    pool = stage(pool.select("node", "root", F.coalesce("_family", "root").alias("family"), "home", "size"), "families")

    load = (F.count(F.lit(1)).alias("rows"), F.sum("size").alias("load"))
    blocks_of = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("load") / BLOCK_SHINGLES)).cast("int")

    def large(rows: DataFrame, name: str, label: str) -> DataFrame:
        return rows.groupBy(name).agg(*load).where(blocks_of > 1).select(F.col(name).alias(label))

    rows = pool.join(large(pool, "root", "whole"), F.col("root") == F.col("whole"), "left")
    others = rows.where(F.col("whole").isNull())
    rows = rows.join(large(others, "home", "_wide"), F.col("home") == F.col("_wide"), "left")
    unit = F.when(F.col("whole").isNotNull(), F.xxhash64(F.lit("component"), "whole")).otherwise(
        F.when(F.col("_wide").isNotNull(), F.xxhash64(F.lit("bucket"), "_wide"))
    )
    rows = rows.withColumn("unit", unit)
    units = rows.groupBy("family", "unit").agg(*load).select(
        F.col("family").alias("_family"), F.col("unit").alias("_unit"), blocks_of.alias("blocks")
    )
    same = (F.col("family") == F.col("_family")) & F.col("unit").eqNullSafe(F.col("_unit"))
    key = F.when(F.col("unit").isNull(), F.xxhash64("home")).otherwise(F.xxhash64("node"))
    block = F.xxhash64("family", "unit", F.pmod(key, F.col("blocks")))
    return stage(rows.join(units, same).select("node", "root", block.alias("block"), "whole"), "blocks")


def _block_pairs(mixed: DataFrame, dealt: DataFrame) -> DataFrame:
    """(block, block2) that share a mixed bucket, a block with itself too, unless of one component."""
    ours = mixed.select("bucket", "node").join(dealt, "node").select("bucket", "block", "whole").distinct()
    ours = stage(ours, "bucket-blocks")
    other = ours.select("bucket", F.col("block").alias("block2"), F.col("whole").alias("_whole"))
    apart = F.coalesce(F.col("whole") != F.col("_whole"), F.lit(True))
    pairs = ours.join(other, "bucket").where((F.col("block") <= F.col("block2")) & apart)
    return pairs.select("block", "block2").distinct()


def _linked_across(mixed: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between components that share a bucket, enough to join those that belong together.

    Blocks of nodes are compared two by two where they share a mixed bucket, except those of one
    component. Only links that join components leave a comparison. What is compared, and
    the copies of sets that are read, grow with the square of the blocks (of 256 rows each) of one
    bucket in which components remain apart after all leaders; nothing grows so with a family.
    """
    dealt = _dealt(mixed, sets)
    pairs = _block_pairs(mixed, dealt).withColumn("pair", F.xxhash64("block", "block2"))
    pairs = stage(pairs, "block-pairs")
    first = dealt.join(pairs, "block").select("node", "root", "pair", F.lit(False).alias("second"))
    second = dealt.join(
        pairs.where("block <> block2").select(F.col("block2").alias("block"), "pair"), "block"
    ).select("node", "root", "pair", F.lit(True).alias("second"))
    loaded = first.union(second).join(sets, F.col("node") == F.col("doc_id"))
    loaded = loaded.select("pair", "node", "root", "second", "shingles")
    return loaded.groupBy("pair").applyInArrow(_block_comparer(settings), "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest ``doc_id`` reachable over links, itself included; the row
    that bears it is kept. Null and empty texts, and texts of white space, have no shingles and
    are linked with nothing. Rows that repeat a ``doc_id`` are one document. A row without
    ``doc_id`` is linked with nothing, has a null component and is kept. An empty table gives
    an empty result. Only ``doc_id`` and ``text`` are read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("class", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    signed = stage(docs.mapInArrow(_signer(settings), schema), "signatures")
    usable = signed.where(F.col("doc_id").isNotNull() & F.col("class").isNotNull())
    classes = stage(usable.groupBy("class").agg(F.min("doc_id").alias("node")), "classes")
    nodes = usable.join(
        classes.withColumnRenamed("class", "_class"),
        (F.col("doc_id") == F.col("node")) & (F.col("class") == F.col("_class")),
    ).select("node", "n_shingles", "bands")

    # Only buckets with two members or more go on: few rows, for most texts are like no other.
    slim = nodes.select("node", F.explode("bands").alias("bucket"))
    leaders = slim.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("_most"))
    leaders = leaders.where("leader < _most").drop("_most")
    members = stage(slim.join(leaders, "bucket"), "members")
    ids = members.select(F.col("node").alias("_id")).distinct()
    texts = docs.join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    sets = texts.mapInArrow(_set_maker(settings.words), "doc_id long, shingles array<long>")
    sets = stage(sets, "shingles")

    stars = members.where("node > leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    stars = stage(stars.distinct(), "pairs")
    links = stage(_confirmed(stars, sets, settings), "links")
    roots = components(links)

    mixed = _mixed(members, roots)
    for turn in range(LEADER_TURNS):
        pairs = stage(_with_leader(mixed, turn), "pairs")
        more = stage(_confirmed(pairs, sets, settings), "links")
        if more.isEmpty():
            break
        links = links.union(more)
        roots = components(links)
        mixed = _mixed(mixed.select("bucket", "node"), roots)
    more = stage(_linked_across(mixed, sets, settings), "links")
    if not more.isEmpty():
        roots = components(links.union(more))

    homes = classes.join(roots, "node", "left").select(
        F.col("class").alias("_class"), F.coalesce("root", "node").alias("_home")
    )
    # One document may have several classes if its id repeats: they are one node.
    found = signed.join(homes, F.col("class") == F.col("_class"), "left")
    return found.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_home", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id."""
    gone = near_duplicates(docs, settings).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shingle count and component."""
    return near_duplicates(table(spark, sf_dir, "documents"), OP9)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
         lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE
           WHEN len(words) = 0 THEN []
           WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 1),
                               lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
         END)) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * k >= 85 * (p.n + q.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
), home AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, h.component_id, d.doc_id = h.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN home h USING (doc_id)
"""

QUERIES = {"op9_minhash_near_dedup": (op9_minhash_near_dedup, SQL)}
