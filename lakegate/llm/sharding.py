"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, DataFrame functions only.

The ring has 65,536 cells. Every shard owns arcs that start at its virtual nodes; a row's cell
comes from a hash of its id. Loads are bounded so tightly that row counts of shards differ by
one at most: rows of an arc beyond the room of its shard go on clockwise to the next virtual
node whose shard has room. How many rows of each arc go where is planned from the arcs' row
counts alone (one number per arc), so rows find their place in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm.common import table

CELLS = 1 << 16
VIRTUAL_NODES = 16
SHARDS = 8


def virtual_nodes(shards: int, replicas: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. A taken cell is left to its first owner."""
    owner: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(replicas):
            owner.setdefault(crc32(f"shard {shard} node {replica}".encode()) % CELLS, shard)
    return sorted(owner.items())


def cell_of(key: Column) -> Column:
    """The ring cell of a key: the first four hex digits of its MD5."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int")


@dataclass(frozen=True)
class Share:
    """Rows ``first`` to ``end`` (exclusive) of an arc's order go to ``shard`` from ``slot`` on."""

    arc: int
    first: int
    end: int
    shard: int
    slot: int


def place(nodes: list[tuple[int, int]], counts: Mapping[int, int], shards: int) -> list[Share]:
    """Fill the shards from the arcs, clockwise, to counts at most one apart.

    An arc's rows first go to its own shard as far as there is room. Then what is left of each
    arc, in ring order, goes on clockwise to the next virtual node whose shard has room.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out: list[Share] = []
    taken = {arc: 0 for arc in range(len(nodes))}

    def put(arc: int, shard: int) -> None:
        rows = min(counts.get(arc, 0) - taken[arc], room[shard] - used[shard])
        if rows > 0:
            out.append(Share(arc, taken[arc], taken[arc] + rows, shard, used[shard]))
            taken[arc] += rows
            used[shard] += rows

    for arc, (_, shard) in enumerate(nodes):
        put(arc, shard)
    for arc in range(len(nodes)):
        for step in range(1, len(nodes)):
            if taken[arc] == counts.get(arc, 0):
                break
            put(arc, nodes[(arc + step) % len(nodes)][1])
    return out


def _values(spark: SparkSession, columns: str, rows: list[tuple[int, ...]]) -> DataFrame:
    """A few rows of whole numbers as a table."""
    names = columns.split()
    if not rows:
        return spark.range(0).select(*(F.col("id").alias(n) for n in names))
    written = ", ".join("(" + ", ".join(f"{v}L" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {written} AS t({', '.join(names)})")


def shard(docs: DataFrame, shards: int = SHARDS, replicas: int = VIRTUAL_NODES) -> DataFrame:
    """The rows of ``docs`` with ``shard``, ``slot`` (0, 1, ... in the shard) and ``cell``.

    Row counts of shards differ by at most one. A null ``doc_id`` is a key like the empty
    text; rows that repeat share a cell and are placed each. An empty table gives no rows.
    Columns of ``docs`` with the names of the three are replaced. ``docs`` is read twice: pass
    a table or a slim projection of one.
    """
    spark = docs.sparkSession
    nodes = virtual_nodes(shards, replicas)
    # One row per virtual node, and per cell of the ring: both are fixed by the ring alone.
    starts = [cell for cell, _ in nodes]
    ends = [*starts[1:], starts[0] + CELLS]
    arcs = _values(spark, "arc first end", [(a, *ends_of) for a, ends_of in enumerate(zip(starts, ends))])
    at = F.explode(F.sequence(F.col("first"), F.col("end") - 1)).alias("_at")
    ring = arcs.select("arc", at).select("arc", (F.col("_at") % CELLS).alias("_ring"), "_at")
    own = [c for c in docs.columns if c not in ("shard", "slot", "cell")]
    keyed = docs.select(*own).withColumn("cell", cell_of(F.col("doc_id")))
    sized = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("_rows"))
    # At most CELLS rows: each cell's arc and the rows before it in its arc.
    before = Window.partitionBy("arc").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    cells = sized.join(F.broadcast(ring), F.col("cell") == F.col("_ring")).select(
        F.col("cell").alias("_cell"), "arc", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    counts = {r["arc"]: r["rows"] for r in cells.groupBy("arc").agg(F.sum("_rows").alias("rows")).collect()}
    shares = place(nodes, counts, shards)
    plan = _values(
        spark, "_arc _first _end _shard _slot", [(s.arc, s.first, s.end, s.shard, s.slot) for s in shares]
    )
    inside = F.row_number().over(Window.partitionBy("cell").orderBy(F.col("doc_id"), F.xxhash64(*own))) - 1
    rows = keyed.withColumn("_inside", inside).join(cells, F.col("cell") == F.col("_cell"))
    rows = rows.withColumn("_rank", F.col("_before") + F.col("_inside"))
    placed = rows.join(
        F.broadcast(plan),
        (F.col("arc") == F.col("_arc")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")),
    )
    return placed.select(*own, F.col("_shard").cast("int").alias("shard"), (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"), "cell")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard; the law is that row counts are at most one apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op5_sharding": (op5_sharding, None)}
