"""Readers for tables this package writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.identifiers import manifest_bucket, manifest_folder, manifest_objects_folder
from lakegate.functions.json_text import object_at
from lakegate.records import INDICATOR_OBSERVATIONS, RecordSpec

# Fields of a manifest.
MANIFEST_SCHEMA = (
    "run_id string, dataset string, status string, started_at timestamp, "
    "completed_at timestamp, country string, indicator string, start_page bigint, "
    "per_page bigint, config_fingerprint string, replayed boolean, pages_expected bigint, "
    "pages_landed bigint, record_count bigint, source_bytes bigint, "
    "error struct<type:string,message:string>"
)


def read_processed(
    spark: SparkSession, path: str, spec: RecordSpec = INDICATOR_OBSERVATIONS
) -> DataFrame:
    """A published processed table, its partition column back in place and typed."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in spec.processed_types.items())
    return spark.read.schema(schema).parquet(path).select(*spec.processed_columns)


def read_manifests(spark: SparkSession, manifest_root: str, runs: DataFrame | None = None) -> DataFrame:
    """The newest manifest of each run; an absent folder holds none.

    With ``runs`` (a frame with ``run_id``) only the buckets of those runs are read. A line that
    is not a JSON object fails the read.
    """
    return manifest_versions(spark, manifest_root, runs).drop("version")


def manifest_versions(spark: SparkSession, manifest_root: str, runs: DataFrame | None = None) -> DataFrame:
    """:func:`read_manifests` with the ``version`` each manifest was written under."""
    fields = f"{MANIFEST_SCHEMA}, version bigint"
    lines = _in_buckets(spark, "text", "value string, bucket string", manifest_folder(manifest_root), runs)
    if lines is None:
        return spark.createDataFrame([], fields)
    parsed = lines.select(F.col("_metadata.file_path").alias("file_path"), F.try_parse_json("value").alias("value"))
    checked = F.when(object_at(F.col("value")).isNotNull(), F.col("value")).otherwise(
        F.raise_error(
            F.concat(F.lit("Manifest must contain a JSON object: "), F.col("file_path"))
        ).cast("variant")
    )
    read = parsed.select(F.variant_get(checked, "$", f"struct<{_as_struct(fields)}>").alias("manifest"))
    newest = read.groupBy("manifest.run_id").agg(F.max_by("manifest", "manifest.version").alias("manifest"))
    return newest.select("manifest.*")


def read_manifest_objects(
    spark: SparkSession, manifest_root: str, runs: DataFrame | None = None
) -> DataFrame | None:
    """The newest object parts of each run: ``run_id, part, objects, version``; None if none was ever written."""
    entry = "struct<page:int,record_count:bigint,source_bytes:bigint,path:string,sha256:string,disposition:string>"
    schema = f"run_id string, part int, objects array<{entry}>, version bigint, bucket string"
    parts = _in_buckets(spark, "parquet", schema, manifest_objects_folder(manifest_root), runs)
    if parts is None:
        return None
    newest = parts.groupBy(F.col("run_id").alias("_run")).agg(F.max("version").alias("_newest"))
    kept = parts.join(newest, (F.col("run_id") == F.col("_run")) & (F.col("version") == F.col("_newest")))
    return kept.select("run_id", "part", "objects", "version")


def _in_buckets(
    spark: SparkSession, form: str, schema: str, folder: str, runs: DataFrame | None
) -> DataFrame | None:
    """The files of a store in the buckets of ``runs`` (at most sixteen), or in all; None if there is no store."""
    try:
        held = spark.read.schema(schema).format(form).load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if runs is None:
        return held
    wanted = runs.select(manifest_bucket(F.col("run_id")).alias("bucket")).distinct().collect()
    return held.where(F.col("bucket").isin([r["bucket"] for r in wanted]))


def _as_struct(schema: str) -> str:
    """DDL columns ``a int, b struct<..>`` as struct members ``a:int, b:struct<..>``."""
    return ", ".join(
        part if ":" in part.split(" ")[0] else part.replace(" ", ":", 1)
        for part in schema.split(", ")
    )
