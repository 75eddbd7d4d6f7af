"""Small files into the landing table: tasks by size, repeats, conflicts, odd files."""

from __future__ import annotations

import hashlib

import pytest

from lakegate.operators.landing import LandingConflictError
from lakegate.plans import compaction
from lakegate.plans.compaction import LIST_TASKS, TABLE_IN_TURN, compact_files, file_pages, packed_scans
from lakegate.sources.documents import read_landing_table


def put(folder, run, page, content):
    place = folder / f"world_bank/year=2033/month=07/day=04/run_id={run}"
    place.mkdir(parents=True, exist_ok=True)
    (place / f"np_tst_two_page_{page:05d}.json").write_bytes(content)


def held(spark, table):
    return {(r.path, r.sha256, r.raw_text, r.page, r.indicator) for r in read_landing_table(spark, table).collect()}


def test_files_are_packed_into_tasks_by_size(spark, tmp_path):
    for page in range(400):
        put(tmp_path, f"r{page % 3}", page + 1, b"[%d]" % page)
    put(tmp_path, "large", 1, b" " * 300_000)
    put(tmp_path, "large", 2, b" " * 300_000)

    def loads():
        """Files and bytes of each task of a scan."""
        scan = file_pages(spark, str(tmp_path)).rdd.glom().collect()
        return [(len(task), sum(len(r.raw_text) for r in task)) for task in scan if task]

    settings = {name: spark.conf.get(name) for name in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    with packed_scans(spark, task_bytes=200_000, file_bytes=1_000):
        packed = loads()
    assert settings == {name: spark.conf.get(name) for name in settings}
    assert sum(files for files, _ in packed) == 402
    # 400 files count for about 1,003 bytes each, and no file of text is cut.
    assert len(packed) <= 402 * 1_003 // 200_000 + 1 + 4
    assert sorted(size for _, size in packed)[-2:] == [300_000, 300_000]
    assert max(files for files, _ in packed) <= 200
    with packed_scans(spark, task_bytes=20_000, file_bytes=1_000):
        assert len(loads()) >= 20


def test_compaction_is_whole_and_may_be_repeated(spark, tmp_path):
    files, table = tmp_path / "files", str(tmp_path / "table")
    for run in ("a", "b"):
        for page in (1, 2, 100_001):
            put(files, run, page, f"[{run}{page}é\n]".encode())
    put(files, "b", 3, b"\xff[]")
    put(files, "b", 4, b"")  # Spark lists no empty files
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    compact_files(spark, str(files), table)
    found = held(spark, table)
    place = "landing/world_bank/year=2033/month=07/day=04/run_id="
    expected = {
        (f"{place}{run}/np_tst_two_page_{page:05d}.json", f"[{run}{page}é\n]".encode(), f"[{run}{page}é\n]", page)
        for run in ("a", "b")
        for page in (1, 2, 100_001)
    }
    expected.add((f"{place}b/np_tst_two_page_00003.json", b"\xff[]", "�[]", 3))
    assert found == {(p, hashlib.sha256(b).hexdigest(), t, n, "np_tst_two") for p, b, t, n in expected}
    put(files, "c", 1, b"later")
    compact_files(spark, str(files), table)
    again = held(spark, table)
    assert found < again and len(again) == len(found) + 1
    assert read_landing_table(spark, table).count() == len(again)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_changed_and_strange_files_land_nothing(spark, tmp_path):
    files, table = tmp_path / "files", str(tmp_path / "table")
    put(files, "a", 1, b"one")
    compact_files(spark, str(files), table)
    put(files, "a", 1, b"two")
    put(files, "a", 2, b"new")
    with pytest.raises(LandingConflictError, match="page_00001"):
        compact_files(spark, str(files), table)
    (files / "readme.txt").write_text("no page")
    with pytest.raises(ValueError, match="1 files"):
        compact_files(spark, str(files), table)
    assert read_landing_table(spark, table).count() == 1


def test_only_new_texts_are_moved(spark, tmp_path, monkeypatch):
    """All pages new: no join; some: the new ones alone; none: nothing is read again."""
    files, table = tmp_path / "files", str(tmp_path / "table")
    plans = []

    def append(pages, path):
        plans.append(pages._jdf.queryExecution().optimizedPlan().toString())
        written(pages, path)

    written = compaction.append_landing
    monkeypatch.setattr(compaction, "append_landing", append)
    for page in range(1, 6):
        put(files, f"r{page % 2}", page, b"[%d]" % page)
    compact_files(spark, str(files), table)
    put(files, "late", 1, b"later")
    compact_files(spark, str(files), table)
    compact_files(spark, str(files), table)
    whole, some, none = plans
    assert "Join" not in whole and "parquet" in whole
    assert "Join LeftSemi" in some
    assert none.startswith("LocalRelation <empty>")
    assert len(held(spark, table)) == read_landing_table(spark, table).count() == 6


def test_a_run_is_one_file_without_a_checksum_file(spark, tmp_path):
    """Each file beside it, and its permissions, cost a process on a local disk."""
    files, table = tmp_path / "files", tmp_path / "table"
    for page in range(1, 13):
        put(files, f"r{page % 3}", page, b"[%d]" % page)
    compact_files(spark, str(files), str(table))
    runs = sorted(table.glob("year=2033/month=07/day=04/run_id=*"))
    assert [[f.suffix for f in run.iterdir()] for run in runs] == [[".parquet"]] * 3
    assert len(held(spark, str(table))) == 12


def test_a_level_of_folders_is_listed_in_two_tasks_a_core(spark, tmp_path):
    days, runs = TABLE_IN_TURN + 1, 40
    for day in range(days):
        for run in range(runs):
            place = tmp_path / f"day={day:02d}/run_id={run}"
            place.mkdir(parents=True)
            (place / "page").write_text("x")
    tracker = spark.sparkContext.statusTracker()

    def tasks(in_turn):
        """Tasks of every job that lists."""
        seen = set(tracker.getJobIdsForGroup(None))
        with packed_scans(spark, in_turn=in_turn):
            assert file_pages(spark, str(tmp_path)).count() == days * runs
            jobs = set(tracker.getJobIdsForGroup(None)) - seen
        stages = [tracker.getStageInfo(s) for job in jobs for s in tracker.getJobInfo(job).stageIds]
        return [s.numTasks for s in stages if s and s.name.startswith("load")]

    cores = spark.sparkContext.defaultParallelism
    assert tasks(None) == [min(2 * cores, LIST_TASKS)] * days
    assert len(tasks(TABLE_IN_TURN)) == 1
