"""Document sources: ``source_file, raw_text``, one row per source page."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.identifiers import RUN_ID_PATTERN, SOURCE_PREFIX
from lakegate.operators.landing import landing_path_columns

LANDING_TABLE_SCHEMA = (
    "path string, sha256 string, indicator string, page int, raw_text string, "
    "year string, month string, day string, run_id string"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path`` as one UTF-8 document.

    Partition directories are not turned into columns. Bytes that are not UTF-8
    become replacement characters. Spark lists no files of zero bytes, so there is no row for them.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        F.col("path").alias("source_file"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("raw_text"),
    )


def read_run_documents(spark: SparkSession, path: str, run_ids: Sequence[str]) -> DataFrame:
    """The landed files of the given runs; no other run's folder is listed or read."""
    # A run id that no run can have names no folder, and no pattern either.
    known = sorted(r for r in set(run_ids) if re.fullmatch(RUN_ID_PATTERN.replace(r"\z", r"\Z"), r))
    runs = "{" + ",".join(known) + "}"
    pattern = f"{path.rstrip('/')}/{SOURCE_PREFIX}/year=*/month=*/day=*/run_id={runs}"
    try:
        if known:
            return read_documents(spark, pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], "source_file string, raw_text string")


def only_runs(documents: DataFrame, run_ids: Sequence[str]) -> DataFrame:
    """Documents of the given runs, told by the ``run_id=`` part of their path."""
    columns = documents.columns
    return landing_path_columns(documents).filter(F.col("run_id").isin(*run_ids)).select(*columns)


def read_landing_table(spark: SparkSession, path: str) -> DataFrame:
    """The table written by :func:`lakegate.sinks.write_landing`.

    Filters on ``year, month, day, run_id`` prune partitions.
    """
    return spark.read.schema(LANDING_TABLE_SCHEMA).parquet(path)


def of_runs(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """Pages of the landing table whose run is among ``runs``, a frame of distinct keys.

    ``runs`` holds ``run_id`` and, if known, ``year, month, day``. The join is on partition
    columns alone: where ``runs`` is filtered, Spark prunes the partitions it reads by it.
    """
    keys = [name for name in ("year", "month", "day", "run_id") if name in runs.columns]
    return pages.join(runs.select(*keys), keys, "left_semi").select(*pages.columns)


def landed_documents(pages: DataFrame) -> DataFrame:
    """Rows of the landing table as documents."""
    return pages.select(F.col("path").alias("source_file"), "raw_text")
