"""Exact dedup by content sort.

Sampled splitters range-partition the texts by their normalised bytes, each range is sorted
on disk by Spark, and neighbours are compared in full. The range key is the start of the
normalised bytes, then their SHA-256, then the id: equal texts are still adjacent, the
sampled splitters stay short whatever the texts' lengths, and a group with a third of all
rows is cut over many ranges. The two runs at the edges of each range are stitched together
afterwards (two rows per range).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.llm.common import WHITE, bytes_of, rows_at_most, table
from lakegate.plans.staging import stage

# The sampled splitters hold so many characters of text and of digest.
KEY_CHARACTERS = 24
DIGEST_CHARACTERS = 16
_REMOVED = b" \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def _compare_neighbours(carried: list[str], text_in_row: list[str] | None):
    """One range, sorted: number the runs of equal texts.

    The text is a field of ``_row`` or the column ``_text``. ``_run`` numbers runs within the range, ``_first`` marks a run's first row (the one to
    keep). A range's first and last run may go on in the next range.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, before = -1, (None, None)
        for batch in rows_at_most(batches, 2048):
            digests = batch.column("text_sha256").to_pylist()
            held = pc.struct_field(batch.column("_row"), text_in_row) if text_in_row else batch.column("_text")
            texts = [t.translate(None, _REMOVED) for t in bytes_of(held)]
            runs, first = np.empty(len(texts), np.int64), np.zeros(len(texts), bool)
            for i, now in enumerate(zip(digests, texts)):
                if now != before:
                    run, before, first[i] = run + 1, now, True
                runs[i] = run
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in carried),
                    batch.column("text_sha256"),
                    batch.column("_chars"),
                    pa.array(np.full(len(texts), part, np.int32)),
                    pa.array(runs),
                    pa.array(first),
                ],
                names=[*carried, "text_sha256", "_chars", "_part", "_run", "_first"],
            )

    return compare


def content_sort(
    docs: DataFrame, payload: list[str] | None = None, text_in: list[str] | None = None
) -> DataFrame:
    """Groups of equal normalised texts.

    Returns ``payload`` columns (default: all of ``docs``) of every row, with ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``. The row with the most code points in the
    original text stays, then the smallest ``doc_id``; a null ``doc_id`` comes last. Null text
    counts as empty, and all empty texts are one group. Rows that repeat in full are one
    group of which exactly one row is kept. An empty table gives an empty result. Columns of
    ``docs`` named like a result column are replaced by it. ``text_in`` says where in the
    payload the text is, so that it travels once; found by itself if a payload column.
    """
    results = ("keep_id", "group_size", "kept", "text_sha256")
    payload = [c for c in (docs.columns if payload is None else payload) if c not in results]
    text_in = text_in or (["text"] if "text" in payload else None)
    text = F.coalesce(F.col("text"), F.lit(""))
    # The payload travels in one column, so that no name of it can clash.
    keyed = docs.withColumn("_norm", normalised(F.col("text"))).select(
        F.struct(*payload).alias("_row") if payload else F.struct(F.lit(1).alias("_")).alias("_row"),
        F.col("doc_id").alias("_id"),
        *([] if text_in else [text.alias("_text")]),
        F.char_length(text).cast("long").alias("_chars"),
        F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
        F.substring(F.col("_norm"), 1, KEY_CHARACTERS).alias("_key"),
    )
    order = ["_key", "text_sha256", F.col("_chars").desc(), F.col("_id").asc_nulls_last()]
    ordered = (
        keyed.repartitionByRange(
            "_key", F.substring("text_sha256", 1, DIGEST_CHARACTERS), F.col("_id").asc_nulls_last()
        )
        .sortWithinPartitions(*order)
        .drop("_key")
    )
    carried = ["_row", "_id"]
    schema = T.StructType(
        [
            *(ordered.schema[c] for c in carried),
            T.StructField("text_sha256", T.StringType()),
            T.StructField("_chars", T.LongType()),
            T.StructField("_part", T.IntegerType()),
            T.StructField("_run", T.LongType()),
            T.StructField("_first", T.BooleanType()),
        ]
    )
    rows = stage(ordered.mapInArrow(_compare_neighbours(carried, text_in), schema), "content-sort")

    runs = rows.groupBy("_part", "_run").agg(
        F.count(F.lit(1)).alias("_size"),
        F.max(F.when(F.col("_first"), F.struct("_id", "_chars", "text_sha256"))).alias("_best"),
    )
    ends = rows.groupBy("_part").agg(F.max("_run").alias("_last"))
    edge = runs.join(ends, "_part").where((F.col("_run") == 0) | (F.col("_run") == F.col("_last")))
    # Two rows per range: the run's text decides which of them belong together.
    # The winner has the most code points, then the smallest id, then the first range.
    best = F.min(
        F.struct(
            (-F.col("_best._chars")).alias("less"),
            F.col("_best._id").isNull().alias("last"),
            F.col("_best._id").alias("id"),
            F.col("_part").alias("part"),
            F.col("_run").alias("run"),
        )
    )
    whole = edge.groupBy(F.col("_best.text_sha256").alias("_text")).agg(
        F.sum("_size").alias("_all"), best.alias("_top")
    )
    stitched = edge.join(whole, F.col("_best.text_sha256") == F.col("_text")).select(
        "_part", "_run", "_all", "_top"
    )
    groups = runs.join(stitched, ["_part", "_run"], "left").select(
        "_part",
        "_run",
        F.when(F.col("_top").isNull(), F.col("_best._id")).otherwise(F.col("_top.id")).alias("keep_id"),
        F.coalesce("_all", "_size").alias("group_size"),
        (
            F.col("_top").isNull()
            | ((F.col("_top.part") == F.col("_part")) & (F.col("_top.run") == F.col("_run")))
        ).alias("_here"),
    )
    return rows.join(groups, ["_part", "_run"]).select(
        *(F.col("_row")[c].alias(c) for c in payload),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("_first") & F.col("_here")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`content_sort` keeps, with their own columns."""
    marked = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text")
    return content_sort(marked, ["doc"], ["doc", "text"]).where("kept").select("doc.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its group that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort(docs, ["doc_id"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept,
       text_sha256
FROM d
WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

QUERIES = {"op8_exact_dedup": (op8_exact_dedup, SQL)}
