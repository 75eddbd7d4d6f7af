"""Written intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import re
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
# For sessions whose cluster names no shared folder, such as a local test.
FALLBACK_SETTING = "lakegate.staging.dir"


def staging_root(spark: SparkSession) -> str:
    """The shared folder from the session; lost executors do not lose its tables.

    Without either setting the warehouse folder is used, which must then be one
    that all executors see: a local path is refused unless the master is local.
    """
    root = spark.conf.get(SHARED_FOLDER_SETTING, None) or spark.conf.get(FALLBACK_SETTING, None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if warehouse.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(
            f"{SHARED_FOLDER_SETTING} (or {FALLBACK_SETTING}) must name a folder shared by "
            "all executors"
        )
    return f"{warehouse}/_staging"


def stage(
    frame: DataFrame, name: str, partition_by: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Write ``frame`` once (with writer ``options``) and read it back: later actions scan the columns they need."""
    spark = frame.sparkSession
    path = f"{staging_root(spark)}/lakegate/{name}-{uuid4().hex}"
    writer = frame.write.mode("errorifexists").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
