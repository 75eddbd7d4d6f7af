"""The manifest store, run pruning, the result object and missing page ranges."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from lakegate.functions.identifiers import manifest_bucket
from lakegate.operators.reconcile import missing_page_ranges
from lakegate.operators.runs import run_manifests
from lakegate.sinks import compact_manifests, write_landing, write_manifest_objects, write_manifests
from lakegate.sources.documents import of_runs, read_landing_table
from lakegate.sources.tables import read_manifest_objects, read_manifests


def manifests(spark, runs, error=None):
    rows = [(r, "2024-03-01 10:00:00.123456", "AA", "X.Y", 1, 10, "f", False, error) for r in runs]
    frame = spark.createDataFrame(
        rows,
        "run_id string, started string, country string, indicator string, start_page bigint, per_page bigint, "
        "config_fingerprint string, replayed boolean, error_type string",
    )
    frame = frame.select(
        "*",
        F.to_timestamp("started").alias("started_at"),
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.col("error_type").alias("error_message"),
    )
    objects = spark.createDataFrame(
        [], "run_id string, page bigint, total_pages bigint, record_count bigint, source_bytes bigint"
    )
    return run_manifests(frame, objects)


def test_newest_manifest_counts_and_only_its_bucket_is_read(spark, tmp_path):
    root = str(tmp_path)
    runs = [f"run-{i}" for i in range(200)]
    write_manifests(manifests(spark, runs), root)
    written = list((tmp_path / "world_bank").glob("bucket=*/part-*"))
    assert len(written) <= 16 < len(runs)
    write_manifests(manifests(spark, runs[:3], error="Broken"), root)
    found = {r.run_id: r for r in read_manifests(spark, root).collect()}
    assert set(found) == set(runs)
    assert [found[r].status for r in runs[:4]] == ["FAILED"] * 3 + ["RUNNING"]
    assert found["run-0"].error.type == "Broken" and found["run-9"].error is None
    assert found["run-9"].started_at.microsecond == 123456

    chosen = spark.createDataFrame([("run-5",), ("run-5",)], "run_id string")
    one = read_manifests(spark, root, chosen)
    (bucket,) = {r[0] for r in chosen.select(manifest_bucket(F.col("run_id"))).collect()}
    assert "run-5" in {r.run_id for r in one.collect()}
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()
    assert 0 < one.count() < len(runs) and bucket in "0123456789abcdef"


def test_compaction_keeps_the_newest_versions_and_nothing_else(spark, tmp_path):
    root = str(tmp_path)
    for error in (None, "First", "Second"):
        write_manifests(manifests(spark, ["a", "b", "c"] if error is None else ["a"], error=error), root)
    entry = "struct<page:int,record_count:bigint,source_bytes:bigint,path:string,sha256:string,disposition:string>"
    for parts in ([("a", 0, [(1, 1, 1, "p", "s", "WRITTEN")]), ("a", 1, [])], [("a", 0, [(2, 1, 1, "q", "t", "EXISTING")])]):
        write_manifest_objects(spark.createDataFrame(parts, f"run_id string, part int, objects array<{entry}>"), root)
    before = sorted(map(str, read_manifests(spark, root).collect()))
    assert [(r.part, r.objects[0].page) for r in read_manifest_objects(spark, root).collect()] == [(0, 2)]
    compact_manifests(spark, root)
    assert sorted(map(str, read_manifests(spark, root).collect())) == before
    assert [(r.part, r.objects[0].page) for r in read_manifest_objects(spark, root).collect()] == [(0, 2)]
    lines = [x for f in (tmp_path / "world_bank").glob("bucket=*/part-*") for x in f.read_text().splitlines()]
    assert sorted(json.loads(x)["run_id"] for x in lines) == ["a", "b", "c"]
    write_manifests(manifests(spark, ["b"], error="Later"), root)
    assert {r.run_id: r.status for r in read_manifests(spark, root).collect()}["b"] == "FAILED"


def test_an_absent_store_holds_nothing(spark, tmp_path):
    assert read_manifests(spark, str(tmp_path / "none")).count() == 0
    assert read_manifest_objects(spark, str(tmp_path / "none")) is None


def test_pages_of_chosen_runs_prune_the_landing_table(spark, tmp_path):
    pages = spark.range(40).select(
        F.concat(F.lit("p"), "id").alias("path"),
        F.lit("s").alias("sha256"),
        F.lit("X").alias("indicator"),
        F.col("id").cast("int").alias("page"),
        F.lit("[]").alias("raw_text"),
        F.lit("2024").alias("year"),
        F.lit("01").alias("month"),
        F.format_string("%02d", F.col("id") % 3 + 1).alias("day"),
        F.concat(F.lit("r"), F.col("id") % 8).alias("run_id"),
        F.lit("WRITTEN").alias("disposition"),
    )
    write_landing(pages, str(tmp_path / "landing"))
    spark.range(8).select(F.concat(F.lit("r"), "id").alias("run_id"), F.col("id").alias("n")).write.parquet(
        str(tmp_path / "runs")
    )
    chosen = spark.read.parquet(str(tmp_path / "runs")).filter(F.col("n") == 5).select("run_id")
    found = of_runs(read_landing_table(spark, str(tmp_path / "landing")), chosen)
    assert {r.page for r in found.collect()} == {5, 13, 21, 29, 37}
    assert "dynamicpruning" in found._jdf.queryExecution().toString()


def test_ranges_of_missing_pages(spark, monkeypatch):
    rng = random.Random(3)
    runs, landed, expected = [], [], []
    for run in range(30):
        start, end = rng.randrange(3), rng.randrange(40)
        there = {p for p in range(-2, 45) if rng.random() < rng.choice([0.1, 0.5, 0.95])} if run % 7 else set()
        runs.append((f"r{run}", start, end))
        landed += [(f"r{run}", p) for p in there for _ in range(1 + p % 2)]
        gone = [p for p in range(start, end + 1) if p not in there]
        for p in gone:
            if p - 1 not in gone:
                expected.append((f"r{run}", p, next(q for q in range(p, end + 1) if q + 1 not in gone)))
    runs_frame = spark.createDataFrame(runs, "run_id string, start_page int, pages_expected int")
    landed_frame = spark.createDataFrame(landed, "run_id string, page int")
    for span in (1 << 20, 4):
        monkeypatch.setattr("lakegate.operators.reconcile.PAGE_SPAN", span)
        found = missing_page_ranges(runs_frame, landed_frame).collect()
        assert sorted(tuple(r) for r in found) == sorted(expected)
    vast = spark.createDataFrame([("v", 1, 2_000_000_000)], "run_id string, start_page int, pages_expected int")
    assert [tuple(r) for r in missing_page_ranges(vast, landed_frame).collect()] == [("v", 1, 2_000_000_000)]


def test_result_object_is_one_file_and_stays(spark, tmp_path):
    from lakegate.operators.quality import DataQualityResult
    from lakegate.sinks import write_quality_result

    class Held(DataQualityResult):
        def to_dict(self):
            return {"b": 1, "a": "é"}

    result = Held.__new__(Held)
    path = tmp_path / "q/run_id=x/result.json"
    write_quality_result(spark, result, str(path))
    assert path.read_text(encoding="utf-8") == json.dumps({"b": 1, "a": "é"}, indent=2, sort_keys=True)
    with pytest.raises(FileExistsError):
        write_quality_result(spark, result, str(path))
