"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ASCII white space, [\x20\x09-\x0D].
WHITE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def bytes_of(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def list_array(lengths: Sequence[int], values: pa.Array) -> pa.ListArray:
    """A list column from the lengths of its rows and all their values in a row."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), values)


def rows_at_most(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that long texts do not pile up."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def giving_back(task: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """The same task; at its end, what Arrow has freed but kept goes back to the system.

    A Python worker outlives its task, and would hold that memory through all later steps.
    """

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ranked(frame: DataFrame, group: str, key: Column, order: list[Column], cells: int = 4096) -> DataFrame:
    """``frame`` with ``rank``: 0, 1, ... within each ``group`` (null is a group too).

    Rows are ranked by the hash cell of ``key``, then by ``order``. Only a cell is ever
    sorted as one, never a group, so that a group with a third of all rows is spread over
    ``cells`` tasks; the cells' row counts are summed first (at most groups x cells rows).
    ``frame`` is read twice: pass a table or a slim projection of one.
    """
    own = frame.withColumn("_cell", F.pmod(F.xxhash64(key), F.lit(cells)).cast("int"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        own.groupBy(group, "_cell")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col(group).alias("_group"),
            F.col("_cell").alias("_at"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)) - 1
    return (
        own.withColumn("_inside", inside)
        .join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_cell") == F.col("_at")))
        .withColumn("rank", (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_cell", "_inside", "_group", "_at", "_start")
    )
