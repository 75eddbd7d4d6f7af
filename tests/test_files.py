"""Files of single documents: written whole by any file system, listed in few tasks."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakegate.plans.compaction import LIST_TASKS, packed_scans
from lakegate.sources.documents import read_documents
from workloads import landing
from workloads.fixtures import indicator_documents, write_files
from workloads.landing import scan_documents

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("remote", [False, True], ids=["local", "remote"])
def test_a_file_per_row_whole_and_named_by_its_columns(spark, tmp_path, remote):
    folder = f"file://{tmp_path}/with space"
    if remote:
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.files.link./out", tmp_path.as_uri())
        folder = "viewfs://files/out/written"
    texts = {page: "é\n" * (page % 3) + str(page % 5) * (page % 4) for page in range(70)}
    frame = spark.createDataFrame([(p, f"b{p // 10}", t) for p, t in texts.items()], "page long, block string, raw_text string")
    write_files(frame.repartition(3), ["block", "page"], folder)
    read = read_documents(spark, folder).select(F.regexp_extract("source_file", r"/block=b(\d)/page=(\d+)[./]", 2), "raw_text")
    assert {(int(page), text) for page, text in read.collect()} == {(p, t + "\n") for p, t in texts.items()}
    assert read.count() == 70
    if not remote:
        assert len([f for f in tmp_path.rglob("*") if f.is_dir()]) == 8  # no folder for a document
        assert not [f for f in tmp_path.rglob(".*")]


def test_documents_are_not_written_by_hadoop_on_a_local_disk(spark):
    """Each file and folder costs Hadoop processes there, and each folder a listing."""
    staging = spark.conf.get("lakegate.staging.dir", None) or spark.conf.get("spark.checkpoint.dir")
    scanned = scan_documents(spark, SF_DIR)
    assert scanned.count() == scanned.select("page").distinct().count() == 40
    newest = max(Path(staging.removeprefix("file://")).glob("lakegate-queries/documents-*"), key=lambda p: p.stat().st_mtime)
    files = [f for f in newest.rglob("*") if f.is_file()]
    assert len(files) == 40 and {f.parent.parent for f in files} == {newest}


def test_many_folders_are_listed_in_few_tasks(spark, tmp_path):
    for folder in range(3 * LIST_TASKS):
        (tmp_path / f"f{folder}").mkdir()
        (tmp_path / f"f{folder}" / "page").write_text("x")
    tracker = spark.sparkContext.statusTracker()
    seen = set(tracker.getJobIdsForGroup(None))
    with packed_scans(spark):
        documents = read_documents(spark, str(tmp_path))
    tasks = [
        tracker.getStageInfo(stage).numTasks
        for job in set(tracker.getJobIdsForGroup(None)) - seen
        for stage in tracker.getJobInfo(job).stageIds
    ]
    assert tasks and max(tasks) <= LIST_TASKS
    assert documents.count() == 3 * LIST_TASKS


def test_a_round_trip_parses_its_documents_once(spark, monkeypatch):
    made = indicator_documents(spark, SF_DIR).select("source_file", "raw_text").collect()
    passed = spark.sparkContext.accumulator(0)

    def count(text):
        passed.add(1)
        return text

    counted = F.udf(count, "string").asNondeterministic()
    documents = spark.createDataFrame(made).withColumn("raw_text", counted("raw_text"))
    monkeypatch.setattr(landing, "indicator_documents", lambda *_: documents)
    assert landing.processed_roundtrip(spark, SF_DIR).count() > 0
    assert passed.value == len(made) == 40
