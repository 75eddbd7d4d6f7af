"""Partitions that tasks write on a local disk: the folders and rows of Spark's own writer, all or none."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakegate.sinks import LOCAL_FILES
from lakegate.sinks.local import append_partitions, local_folder

LAYOUT = ["day", "run_id"]
RUNS = ["plain-1_a", "with space", "a=b", "50%", "[x]{y}", "q?*:", "quote'\"#", "back\\slash^", "\u00e9", "a.b,c;d&e", "", None]


def pages(spark, copies=3):
    rows = [(f"p{n}", n, "\u00e9\n" * (n % 4), f"{n % 2:02d}", run) for n, run in enumerate(RUNS * copies)]
    return spark.createDataFrame([*rows, (None, None, None, "00", "nulls")], "path string, page int, raw_text string, day string, run_id string")


def folders(top):
    return {str(f.parent.relative_to(top)) for f in top.rglob("*.parquet")}


def test_folders_and_rows_are_those_of_spark(spark, tmp_path):
    ours, theirs, schema = tmp_path / "ours", tmp_path / "theirs", pages(spark).schema
    append_partitions(pages(spark), LAYOUT, str(ours), plain=["raw_text"])
    pages(spark).write.options(**LOCAL_FILES).partitionBy(*LAYOUT).parquet(str(theirs))
    assert folders(ours) == folders(theirs)
    mine, other = (spark.read.schema(schema).parquet(str(top)) for top in (ours, theirs))
    assert mine.exceptAll(other).count() == other.exceptAll(mine).count() == 0
    assert mine.count() == 3 * len(RUNS) + 1
    append_partitions(pages(spark).limit(5), LAYOUT, str(ours))
    assert spark.read.schema(schema).parquet(str(ours)).count() == 3 * len(RUNS) + 6
    assert not [f for f in ours.rglob("*") if f.name.startswith((".", "_temporary"))]


def test_a_partition_of_a_task_is_one_file_however_many_batches(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("path"), F.lit("01").alias("day"), F.lit("r").alias("run_id"))
    append_partitions(rows.coalesce(1), LAYOUT, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "t")).select("path").distinct().count() == 2000


def test_a_failure_leaves_nothing(spark, tmp_path):
    broken = F.when(F.col("page") == 30, F.raise_error(F.lit("broken"))).otherwise(F.col("path"))
    with pytest.raises(PySparkException, match="broken"):
        append_partitions(pages(spark).repartition(4).withColumn("path", broken), LAYOUT, str(tmp_path / "t"))
    assert not list((tmp_path / "t").iterdir())


@pytest.mark.parametrize(
    ("path", "default", "folder"),
    [
        ("/a/b/", "file:///", "/a/b"),
        ("file:/a", "hdfs://n", "/a"),
        ("file:///a b", "file:///", "/a b"),
        ("/a", "hdfs://n", None),
        ("s3a://b/c", "file:///", None),
        ("viewfs://store/in", "file:///", None),
        ("relative/a", "file:///", None),
        ("file://host/a", "file:///", None),
    ],
)
def test_local_folders(path, default, folder):
    assert local_folder(path, default) == folder
