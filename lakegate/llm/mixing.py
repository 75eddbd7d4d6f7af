"""Mixing sources to target weights by Pfair scheduling.

Weights are whole units of a period. Block j of a source with q of the period's Q units has
the release time floor(j Q / q) and the deadline ceil((j + 1) Q / q), in slots of one block.
Earliest deadline first among the released blocks meets every deadline, so at any slot a
source is less than one block away from its target. The schedule repeats after a period:
one period is laid out once, by one task that holds a row per source, and every block of the
corpus finds its slot in it, in parallel. A period has ``PERIOD`` slots, or eight times as many
as there are sources: every source, however small, has windows of its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm.common import ranked, table
from lakegate.plans.staging import stage

PERIOD = 1 << 16
BLOCK_ROWS = 16
MAX_SHARE = 1 / 3
_ROWS = 1 << 16


def units(weights: list[float], period: int = PERIOD) -> list[int]:
    """Weights as whole units that sum to ``period``, at least one each, by largest remainder."""
    spare = period - len(weights)
    if spare < 0:
        raise ValueError("more sources than slots in a period")
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*{w.denominator for w in exact})
    whole = [int(w * scale) for w in exact]
    total = sum(whole)
    parts = [divmod(w * spare, total) for w in whole]
    by_rest = sorted(range(len(weights)), key=lambda i: (-parts[i][1], i))
    out = [1 + p for p, _ in parts]
    for i in by_rest[: spare - sum(p for p, _ in parts)]:
        out[i] += 1
    return out


def one_period(share: list[int]) -> list[list[int]]:
    """For each source the slots of its blocks in one period of ``sum(share)`` slots."""
    period = sum(share)
    slots: list[list[int]] = [[] for _ in share]
    waiting = [(0, i, 0) for i in range(len(share))]  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    heapq.heapify(waiting)
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // share[i]), i, j))
        _, i, j = heapq.heappop(ready)
        slots[i].append(slot)
        if j + 1 < share[i]:
            heapq.heappush(waiting, ((j + 1) * period // share[i], i, j + 1))
    return slots


def capped(counts: list[int], max_share: float) -> tuple[list[float], list[bool]]:
    """Natural shares with none above ``max_share`` (or an equal share, if that is more); who was capped."""
    limit = max(max_share, 1 / len(counts))
    over: set[int] = set()
    while True:
        rest = sum(n for i, n in enumerate(counts) if i not in over)
        left = 1 - limit * len(over)
        more = {i for i, n in enumerate(counts) if i not in over and n * left > limit * rest * (1 + 1e-9)}
        if not more or len(over | more) == len(counts):
            weights = [limit if i in over else left * n / rest for i, n in enumerate(counts)]
            return weights, [i in over for i in range(len(counts))]
        over |= more


def lay_out(
    counts: Mapping[str, int],
    weights: Mapping[str, float] | None,
    max_share: float | None,
    block_rows: int,
    period: int,
) -> Iterator[tuple[str, int, list[int], int | None]]:
    """For each source its name, units, slots in a period, and the slot at which the mix ends for it (None: never).

    With ``weights`` the mix ends when the first source runs out. Without, weights are the
    sources' own shares, and each is in the mix to its last block. With ``max_share`` no weight
    is above it, and a source that had more is in the mix up to its share of the rows mixed.
    """
    names = sorted(n for n in counts if weights is None or weights.get(n, 0) > 0)
    if not names:
        return
    over = [False] * len(names)
    if weights is not None:
        wanted: list[float] = [float(weights[n]) for n in names]
    elif max_share is not None:
        wanted, over = capped([counts[n] for n in names], max_share)
    else:
        wanted = [counts[n] for n in names]
    share = units(wanted, max(period, 1 << (8 * len(names)).bit_length()))
    turn = sum(share)
    slots = one_period(share)

    def end(i: int, rows: float) -> int:
        block = math.ceil(rows / block_rows) - 1
        return block // share[i] * turn + slots[i][block % share[i]] + 1

    ends: list[int | None] = [None] * len(names)
    if weights is not None:
        ends = [min(end(i, counts[n]) for i, n in enumerate(names))] * len(names)
    elif any(over):
        # Small sources fill no whole blocks, so a capped one is cut by rows and not where they end.
        rows = sum(counts[n] for n, cut in zip(names, over) if not cut)
        left = sum(w for w, cut in zip(wanted, over) if not cut)
        ends = [end(i, wanted[i] / left * rows) if cut else None for i, cut in enumerate(over)]
    yield from zip(names, share, slots, ends)


_PERIOD = "named string, q long, ends long, turn long, k long, at long"


def _layout(weights: Mapping[str, float] | None, max_share: float | None, block_rows: int, period: int):
    """One period from the counts of all sources: a row per slot."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            counts.update(zip(batch.column("source").to_pylist(), batch.column("count").to_pylist()))
        laid = list(lay_out(counts, weights, max_share, block_rows, period))
        turn = sum(q for _, q, _, _ in laid)
        for name, q, slots, end in laid:
            for low in range(0, q, _ROWS):
                own = slots[low : low + _ROWS]
                of_source = ((name, pa.string()), (q, pa.int64()), (end, pa.int64()), (turn, pa.int64()))
                same = [pa.array([v] * len(own), kind) for v, kind in of_source]
                places = [pa.array(range(low, low + len(own)), pa.int64()), pa.array(own, pa.int64())]
                yield pa.RecordBatch.from_arrays([*same, *places], names=[c.split()[0] for c in _PERIOD.split(", ")])

    return lay


def schedule(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    max_share: float | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row of ``docs``: doc_id, source, block, slot, release, deadline, in_mix.

    ``block`` numbers the source's blocks of ``block_rows`` documents (in hash order of
    ``doc_id``), ``slot`` is the block's place in the mix; ``in_mix`` is false beyond the end of
    the mix. A null source is a source of its own, named by the empty text together with the
    sources so named. Weights are the sources' own shares, and all rows are in the mix, unless
    ``weights`` gives others: the mix ends when the first source runs out, and sources without a
    weight have null slots and are not in it. With ``max_share`` no source has a larger weight,
    and its surplus is not in the mix. Rows that repeat are scheduled each. An empty table gives
    no rows. Only ``doc_id`` and ``source`` are read.
    """
    slim = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    sizes = slim.groupBy("source").count()
    # One row per source: the schedule is one sequence, whoever lays it out.
    period = sizes.repartition(1).mapInArrow(_layout(weights, max_share, block_rows, PERIOD), _PERIOD)
    period = stage(period, "mix-period")
    shares = period.where("k = 0").select("named", "q", "ends", "turn")
    places = period.select(F.col("named").alias("_place"), "k", "at")
    rows = ranked(slim, "source", F.col("doc_id"), [F.xxhash64("doc_id"), F.col("doc_id")])
    rows = rows.withColumn("block", (F.col("rank") / block_rows).cast("long"))
    rows = rows.join(shares, F.col("source") == F.col("named"), "left").withColumn("_k", F.col("block") % F.col("q"))
    rows = rows.join(places, (F.col("source") == F.col("_place")) & (F.col("_k") == F.col("k")), "left")
    slot = F.expr("block div q * turn + at")
    return rows.select(
        "doc_id",
        "source",
        "block",
        slot.alias("slot"),
        F.expr("(block * turn) div q").alias("release"),
        F.expr("((block + 1) * turn + q - 1) div q").alias("deadline"),
        (slot.isNotNull() & F.coalesce(slot < F.col("ends"), F.lit(True))).alias("in_mix"),
    )


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, max_share: float | None = None
) -> DataFrame:
    """``docs`` in the order of their slots; without those beyond the end of the mix, if weights ask for it.

    Rows are told by ``doc_id``: rows that repeat one stand together, at the first of their slots,
    as do rows without one. An empty table stays empty; all columns are kept. Partitions are
    ranges of slots, in order, so written files hold the interleave.
    """
    planned = schedule(docs, weights, max_share).where("in_mix")
    slots = planned.groupBy(F.col("doc_id").alias("_id")).agg(F.min("slot").alias("_slot"))
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_own"))
    placed = own.join(slots, F.col("_own").eqNullSafe(F.col("_id")))
    ordered = placed.repartitionByRange("_slot", F.xxhash64("_own")).sortWithinPartitions("_slot", F.xxhash64("_own"))
    return ordered.select("_row.*")


def with_place(docs: DataFrame, name: str = "place") -> DataFrame:
    """``docs``, read from the files of a written :func:`mix`, with each row's place in the mix: 0, 1, ...

    Readers take files in an order of their own; the mix is in the number of a file and the row
    within it. No row moves: the rows of each file are counted, one row per file is summed up.
    Any other written Parquet folder is numbered in the same way, in the order it was written.
    """
    file = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).try_cast("long")
    part = F.regexp_extract(F.col("_metadata.file_name"), r"[.-]c(\d+)\.", 1).try_cast("long")
    named = F.struct(file.alias("file"), part.alias("part"), F.col("_metadata.file_path").alias("path"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.groupBy(named.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(F.col("_file.path").alias("_path"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    own = docs.select("*", F.col("_metadata.file_path").alias("_own"), F.col("_metadata.row_index").alias("_row"))
    placed = own.join(F.broadcast(starts), F.col("_own") == F.col("_path"))
    return placed.select(*docs.columns, (F.col("_start") + F.col("_row")).alias(name))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its place in a mix in which no source has more than a third."""
    return schedule(table(spark, sf_dir, "documents"), max_share=MAX_SHARE)


QUERIES = {"op4_mixing": (op4_mixing, None)}
