"""Writers: run-isolated outputs, the landing table and run manifests."""

from __future__ import annotations

import time
from importlib.util import find_spec
from urllib.parse import urlparse

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.identifiers import manifest_bucket, manifest_folder, manifest_objects_folder
from lakegate.operators.curate import TransformResult
from lakegate.operators.landing import CONFLICT, CONTENT_DIFFERS, WRITTEN, LandingConflictError
from lakegate.operators.quality import DataQualityResult, result_json
from lakegate.plans.staging import stage
from lakegate.sinks.local import append_partitions, local_folder
from lakegate.sinks.objects import create_object
from lakegate.sources.tables import manifest_versions, read_manifest_objects

CREATE_ONLY = "errorifexists"
#: A local disk is written without checksum files (Parquet pages hold checksums of their own): two
#: processes a file and its folder, where Hadoop starts three otherwise. No other file system reads these.
LOCAL_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}
#: No two texts are alike, so that a dictionary of them is work for nothing.
WHOLE_TEXTS = {"parquet.enable.dictionary#raw_text": "false"}


def run_output_path(base: str, run_id: str) -> str:
    """Output folder of one run; readable from ``base`` as a partition column."""
    return f"{base.rstrip('/')}/run_id={run_id}"


def write_processed(
    processed: DataFrame,
    path: str,
    *,
    mode: str = CREATE_ONLY,
    partition_by: str = "observation_year",
) -> None:
    """Parquet by partition, in files of advisory size.

    ``rebalance`` brings the rows of a partition together, splits a partition
    value that holds more than a file's worth of rows and merges small ones, so
    a dominant year is written by many tasks and a rare one by a single file.
    """
    (
        processed.hint("rebalance", F.col(partition_by))
        .write.mode(mode)
        .partitionBy(partition_by)
        .parquet(path)
    )


def write_rejected(rejected: DataFrame, path: str, *, mode: str = CREATE_ONLY) -> None:
    """Rejected rows as line JSON."""
    rejected.write.mode(mode).json(path)


def write_transform_result(
    result: TransformResult, processed_path: str, rejected_path: str, *, mode: str = CREATE_ONLY
) -> None:
    write_processed(result.processed, processed_path, mode=mode)
    write_rejected(result.rejected, rejected_path, mode=mode)


def write_quality_result(spark: SparkSession, result: DataQualityResult, path: str) -> None:
    """One JSON object per run, created only if there is none: an existing result stays."""
    if not urlparse(path).path.strip("/"):
        raise ValueError(f"Expected a path below a bucket or folder, got {path!r}")
    create_object(spark, path, result_json(result), "A quality result")


def write_landing(pages: DataFrame, path: str) -> None:
    """Append the ``WRITTEN`` pages to the landing table.

    Nothing is written if any page conflicts with what its path already holds.
    """
    conflict = pages.filter(F.col("disposition") == CONFLICT).select("path").first()
    if conflict is not None:
        raise LandingConflictError(f"{CONTENT_DIFFERS}{conflict.path}")
    append_landing(pages.filter(F.col("disposition") == WRITTEN), path)


def append_landing(pages: DataFrame, path: str) -> None:
    """Append pages that are known to be new, as one file per run and day unless that is very large.

    On a local disk the tasks write the files, where pyarrow is installed.
    """
    layout = ["year", "month", "day", "run_id"]
    spark = pages.sparkSession
    rows = (
        pages.select("path", "sha256", "indicator", "page", "raw_text", *layout)
        .hint("rebalance", *[F.col(name) for name in layout])
    )
    default = spark._jsparkSession.sessionState().newHadoopConf().get("fs.defaultFS")
    folder = local_folder(path, default)
    if folder and find_spec("pyarrow"):
        append_partitions(rows, layout, folder, plain=["raw_text"])
    else:
        rows.write.mode("append").options(**LOCAL_FILES, **WHOLE_TEXTS).partitionBy(*layout).parquet(path)


def write_manifests(manifests: DataFrame, root: str) -> None:
    """A newer version of the manifest of each run in ``manifests``.

    Versions are appended, a file per bucket of run ids at most, and the newest of a run
    counts (see :func:`lakegate.sources.tables.read_manifests`).
    """
    _write_lines(manifests.withColumn("version", F.lit(_next_version())), root, "append")


def write_manifest_objects(objects: DataFrame, root: str) -> None:
    """A newer version of the object parts of each run in ``objects``."""
    _write_parts(objects.withColumn("version", F.lit(_next_version())), root, "append")


def compact_manifests(spark: SparkSession, root: str) -> None:
    """Leave the newest version of every run only, bucket by bucket.

    The newest versions are staged first; a bucket is then replaced as a whole. To be run while
    no ingest writes.
    """
    _write_lines(stage(manifest_versions(spark, root), "newest-manifests"), root, "overwrite")
    parts = read_manifest_objects(spark, root)
    if parts is not None:
        _write_parts(stage(parts, "newest-objects"), root, "overwrite")


def _next_version() -> int:
    """Later than all before it in this process, and as far as clocks agree in others."""
    global _LAST_VERSION
    _LAST_VERSION = max(time.time_ns(), _LAST_VERSION + 1)
    return _LAST_VERSION


def _write_lines(manifests: DataFrame, root: str, mode: str) -> None:
    bucket = manifest_bucket(F.col("run_id")).alias("bucket")
    line = F.to_json(F.struct(*manifests.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    lines = manifests.select(line.alias("value"), bucket)
    _by_bucket(lines, mode).text(manifest_folder(root))


def _write_parts(objects: DataFrame, root: str, mode: str) -> None:
    parts = objects.withColumn("bucket", manifest_bucket(F.col("run_id")))
    _by_bucket(parts, mode).parquet(manifest_objects_folder(root))


def _by_bucket(frame: DataFrame, mode: str) -> DataFrameWriter:
    writer = frame.hint("rebalance", F.col("bucket")).write.mode(mode)
    return writer.option("partitionOverwriteMode", "dynamic").partitionBy("bucket")


_LAST_VERSION = 0
