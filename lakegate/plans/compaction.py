"""Very many small landed files into the landing table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.identifiers import SOURCE_PREFIX
from lakegate.operators.landing import (
    CONFLICT,
    CONTENT_DIFFERS,
    WRITTEN,
    LandingConflictError,
    disposition,
    landing_path_columns,
)
from lakegate.plans.staging import stage
from lakegate.sinks import WHOLE_TEXTS, append_landing
from lakegate.sources.documents import read_landing_table

#: What the disposition of a page depends on.
PAGE_KEY = ["path", "sha256", "page"]
#: A task reads so much, counting each file as that much more than it holds.
TASK_BYTES = 128 << 20
FILE_BYTES = 64 << 10
#: Folders of one level are listed by so many tasks; Spark starts up to 10,000, of milliseconds each.
LIST_TASKS = 64
#: For a landing table: the days of a month are listed by one job. A run's folder holds few files, so
#: that their list, which comes to the driver at once, stays small; landed files themselves are too many.
TABLE_IN_TURN = 12


def landing_path(file: Column, root: str = "landing") -> Column:
    """The landing path within a file's full path; NULL if there is none."""
    inside = F.regexp_extract(file, rf"{SOURCE_PREFIX}/year=.*$", 0)
    return F.when(inside != "", F.concat(F.lit(f"{root.rstrip('/')}/"), inside))


@contextmanager
def packed_scans(
    spark: SparkSession,
    task_bytes: int = TASK_BYTES,
    file_bytes: int = FILE_BYTES,
    in_turn: int | None = None,
) -> Iterator[None]:
    """Scans that start inside pack files into tasks by size; the session's settings come back after.

    Spark sorts the files by size and fills tasks one by one, but takes every file for 4 MB
    unless told otherwise: 32 files to a task, 600,000 tasks for 100 GB in files of 5 KB. Readers
    made inside also list their folders in two tasks a core, at most ``LIST_TASKS``, a level.
    Up to 32 folders of a level are listed in turn, each by a job of its own for what it holds;
    with ``in_turn`` up to so many, and of more, one job lists all that is below them.
    """
    wanted = {
        "spark.sql.files.maxPartitionBytes": task_bytes,
        "spark.sql.files.openCostInBytes": file_bytes,
        # Each task first reads the whole Hadoop configuration: more than two a core only cost time.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": min(
            LIST_TASKS, 2 * spark.sparkContext.defaultParallelism
        ),
    }
    if in_turn is not None:
        wanted["spark.sql.sources.parallelPartitionDiscovery.threshold"] = in_turn
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def file_pages(spark: SparkSession, folder: str, locate: Callable[[Column], Column] = landing_path) -> DataFrame:
    """Every file below ``folder`` as a page of the landing table.

    The checksum is over the file's bytes; in the text, bytes that are not UTF-8 become replacement
    characters. ``indicator`` is the stem in the file name, which tells no more. What is not
    named like a landed page has a NULL path.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    keyed = landing_path_columns(files.select(locate(F.col("path")).alias("path"), "content"), "path")
    return keyed.select(
        "path",
        F.sha2("content", 256).alias("sha256"),
        F.col("indicator_stem").alias("indicator"),
        "page",
        F.make_valid_utf8(F.col("content").cast("string")).alias("raw_text"),
        F.format_string("%04d", "year").alias("year"),
        F.format_string("%02d", "month").alias("month"),
        F.format_string("%02d", "day").alias("day"),
        "run_id",
    )


def compact_files(
    spark: SparkSession,
    folder: str,
    table: str,
    *,
    locate: Callable[[Column], Column] = landing_path,
    task_bytes: int = TASK_BYTES,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Land every file below ``folder`` in the landing table ``table``; the files stay.

    Files are read once, in tasks packed by size. A page that the table holds already is left
    out, so a compaction may be repeated; nothing is landed if a page differs from what its path
    holds (:class:`LandingConflictError`) or if a file is not named like a landed page
    (``ValueError``). Spark lists no files of zero bytes: they are not landed. A folder without
    files lands nothing.
    """
    with packed_scans(spark, task_bytes, file_bytes):
        pages = stage(file_pages(spark, folder, locate), "compacted-files", options=WHOLE_TEXTS)
        strange = pages.filter(F.col("run_id").isNull() | F.col("page").isNull()).count()
        if strange:
            raise ValueError(f"{strange} files below {folder} are not named like landed pages")
        try:
            with packed_scans(spark, task_bytes, file_bytes, TABLE_IN_TURN):
                landed = read_landing_table(spark, table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            landed = pages.limit(0)
        # Decided on keys and checksums alone; texts move once, and only those that are new.
        judged = stage(disposition(pages.select(*PAGE_KEY), landed, order_by="page"), "compacted-dispositions")
        is_new = F.col("disposition") == WRITTEN
        totals = judged.agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(is_new).alias("new"),
            F.min(F.when(F.col("disposition") == CONFLICT, F.col("path"))).alias("conflict"),
        ).first()
        if totals.conflict is not None:
            raise LandingConflictError(f"{CONTENT_DIFFERS}{totals.conflict}")
        if not totals.new:
            pages = pages.limit(0)
        elif totals.new < totals.pages:
            pages = pages.join(judged.filter(is_new), PAGE_KEY, "left_semi")
        append_landing(pages, table)
