from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakegate import DataQualityFailure, run_curation, run_ingest, run_output_path
from lakegate import transform_documents, write_quality_result, write_transform_result
from lakegate.operators.curate import classify_documents, select_processed
from lakegate.operators.landing import page_contract
from lakegate.operators.quality import (
    INDICATOR_QUALITY_POLICY,
    classified_quality_metrics,
    quality_metrics,
    row_metrics,
)
from lakegate.operators.runs import admit_runs
from lakegate.plans.curation import stage_classified
from lakegate.plans.staging import stage
from lakegate.sources.documents import (
    landed_documents,
    read_documents,
    read_landing_table,
    read_run_documents,
)
from lakegate.sources.tables import read_manifests, read_processed
from tests.conftest import SAMPLE, document, record, without


def usa(year, **overrides):
    return record(countryiso3code="USA", date=str(year), **overrides)


def bases(tmp_path):
    return {f"{kind}_base": str(tmp_path / kind) for kind in ("processed", "rejected", "quality")}


def quality_json(tmp_path, run_id):
    return json.loads((tmp_path / f"quality/run_id={run_id}/result.json").read_text(encoding="utf-8"))


def test_processed_rows_pass_one_exchange_without_their_texts(documents):
    twice = documents(("a", document(usa(2023), usa(2023), 7)), ("b", document(usa(2023))))
    processed = transform_documents(twice).processed
    assert processed.count() == 1
    text = plan(processed)
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text
    below = text[text.index("Exchange hashpartitioning") :].splitlines()
    keys = below[0]
    assert all(name in keys for name in ("country_iso3_code", "indicator_id", "observation_year"))
    # The partial aggregate, directly under the exchange, has met every row of a task; neither
    # it nor its sort holds a record's text.
    assert "partial_min_by" in below[1] and "raw_record" not in "".join(below[1:4])
    assert "Generate inline" in below[4] or "Generate inline" in below[3]


def test_run_output_path():
    assert run_output_path("s3://b/processed/", "jr_1") == "s3://b/processed/run_id=jr_1"


@pytest.mark.parametrize("path", ["", "/", "s3://bucket-only", "s3://bucket-only/"])
def test_quality_result_needs_a_path_below_a_bucket(spark, path):
    with pytest.raises(ValueError, match="Expected a path below a bucket"):
        write_quality_result(spark, None, path)


def test_round_trip_from_files(spark, tmp_path):
    landing = tmp_path / "landing" / "deep"
    landing.mkdir(parents=True)
    (landing / "page-1.json").write_text(document(record(date="2024"), 7), encoding="utf-8")
    result = transform_documents(read_documents(spark, str(tmp_path / "landing")))
    write_transform_result(result, str(tmp_path / "p"), str(tmp_path / "r"))
    row = read_processed(spark, str(tmp_path / "p")).first()
    assert (row.country_iso3_code, row.observation_year) == (SAMPLE["country_iso3_code"], 2024)
    assert list((tmp_path / "p").glob("observation_year=2024"))
    assert spark.read.json(str(tmp_path / "r")).first().rejection_reason == "RECORD_NOT_OBJECT"
    with pytest.raises(AnalysisException):
        write_transform_result(result, str(tmp_path / "p"), str(tmp_path / "r"))


def test_passing_run_publishes(spark, documents, tmp_path):
    frame = documents(("a", document(usa(2023), usa(2024), total=2)))
    outcome = run_curation(spark, frame, run_id="ok", **bases(tmp_path))
    assert outcome.quality.status == "PASS"
    assert read_processed(spark, outcome.processed_path).count() == 2
    assert spark.read.text(outcome.rejected_path).count() == 0
    written = quality_json(tmp_path, "ok")
    assert written["status"] == "PASS" and written["expected_row_count"] == 2
    assert [r["status"] for r in written["rules"]] == ["PASS"] * 8
    # Evidence and outputs are create-only.
    with pytest.raises(FileExistsError, match="A quality result exists already"):
        run_curation(spark, frame, run_id="ok", **bases(tmp_path))
    assert quality_json(tmp_path, "ok") == written


def test_failing_run_writes_evidence_and_rejects_only(spark, documents, tmp_path):
    frame = documents(("a", document(usa(2024), usa(2024), total=2)))
    with pytest.raises(DataQualityFailure, match="Data quality failed for run bad"):
        run_curation(spark, frame, run_id="bad", **bases(tmp_path))
    assert quality_json(tmp_path, "bad")["status"] == "FAIL"
    assert quality_json(tmp_path, "bad")["row_count_match"] is True
    assert not (tmp_path / "processed").exists()
    rejected = spark.read.json(str(tmp_path / "rejected/run_id=bad"))
    assert [r.rejection_reason for r in rejected.collect()] == ["DUPLICATE_BUSINESS_KEY"]


def test_all_landed_runs_are_scanned_unless_filtered(spark, tmp_path):
    for run in ("one", "two"):
        folder = tmp_path / f"landing/world_bank/year=2031/month=03/day=09/run_id={run}"
        folder.mkdir(parents=True)
        text = document(usa(2023), usa(2024), total=2)
        (folder / "sp_pop_totl_page_00001.json").write_text(text, encoding="utf-8")
    landing = str(tmp_path / "landing")
    with pytest.raises(DataQualityFailure):
        run_curation(spark, landing, run_id="all", **bases(tmp_path))
    both = quality_json(tmp_path, "all")
    assert (both["row_count"], both["duplicate_failures"], both["row_count_match"]) == (2, 2, False)
    one = run_curation(spark, landing, run_id="one", source_run_ids=["two"], **bases(tmp_path))
    assert one.quality.status == "PASS"


def test_a_scan_of_one_run_reads_its_files_only(spark, tmp_path):
    for run in ("one", "two"):
        folder = tmp_path / f"landing/world_bank/year=2031/month=03/day=09/run_id={run}"
        folder.mkdir(parents=True)
        (folder / "sp_pop_totl_page_00001.json").write_text(document(usa(2023)), encoding="utf-8")
    found = read_run_documents(spark, str(tmp_path / "landing"), ["two", "*", "absent"])
    assert [f.split("/")[-2] for f in found.inputFiles()] == ["run_id=two"]
    assert found.count() == 1
    assert read_run_documents(spark, str(tmp_path / "landing"), ["absent"]).count() == 0


def test_rules_over_both_sides_run_the_plan_once(documents):
    classified = classify_documents(documents(("a", document(usa(2023), usa(2023), 7))))
    metrics = classified_quality_metrics(classified, INDICATOR_QUALITY_POLICY, 3)
    row, apart = metrics.first().asDict(), transform_documents(documents(("a", document(usa(2023), usa(2023), 7))))
    both = quality_metrics(apart.processed, apart.rejected, INDICATOR_QUALITY_POLICY, 3).first().asDict()
    assert row == both and row["rejected_duplicates"] == 1
    assert plan(metrics).count("Window [row_number") == 2


def test_counts_without_duplicates_are_not_grouped(spark):
    frame = spark.range(10).select(F.col("id").alias("k"))
    config = replace(INDICATOR_QUALITY_POLICY, business_key=("k",), required_columns=("k",), allowed_values={})
    assert "hashpartitioning" not in plan(row_metrics(frame, config, duplicates=False))


def test_no_documents_at_all(spark, documents, tmp_path):
    with pytest.raises(DataQualityFailure):
        run_curation(spark, documents().limit(0), run_id="none", **bases(tmp_path))
    assert quality_json(tmp_path, "none")["expected_row_count"] is None


def test_pages_without_records_still_declare_a_total(spark, documents, tmp_path):
    policy = replace(INDICATOR_QUALITY_POLICY, minimum_row_count=0)
    frame = documents(("a", document(total=0)), ("b", document(total=0)))
    outcome = run_curation(spark, frame, run_id="empty", policy=policy, **bases(tmp_path))
    assert (outcome.quality.expected_row_count, outcome.quality.row_count) == (0, 0)
    assert read_processed(spark, outcome.processed_path).count() == 0


# ---------------------------------------------------------------------------
# Ingest


def ingest(spark, tmp_path, requests, pages, moment):
    frame = spark.createDataFrame(
        [(json.dumps(r), "host", moment, moment) for r in requests],
        "request_text string, default_run_id string, requested_at timestamp, finished_at timestamp",
    )
    fetched = spark.createDataFrame(pages, "run_id string, page int, raw_text string")
    return run_ingest(
        spark,
        frame,
        fetched,
        landing_path=str(tmp_path / "landing"),
        manifest_root=str(tmp_path / "manifests"),
    )


def page_text(page, pages, *records, **metadata):
    return document(*(records or (usa(2000 + page),)), page=page, pages=pages, **metadata)


FIRST, SECOND = datetime(2031, 3, 9, 7), datetime(2031, 3, 10, 7)


def test_ingest_lands_skips_resumes_and_refuses(spark, tmp_path):
    done = [("done", 1, page_text(1, 2)), ("done", 2, page_text(2, 2))]
    half = [("half", 1, page_text(1, 2))]
    requests = [{"run_id": "done"}, {"run_id": "half"}, {"run_id": "-bad"}]
    first = ingest(spark, tmp_path, requests, done + half, FIRST)
    assert {r.run_id: r.decision for r in first.decisions.collect()} == {"done": "NEW", "half": "NEW"}
    manifests = {r.run_id: r for r in read_manifests(spark, str(tmp_path / "manifests")).collect()}
    assert manifests["done"].status == "COMPLETED" and manifests["done"].pages_landed == 2
    assert manifests["half"].status == "FAILED"
    assert manifests["half"].error.message == "Page 2 was not returned"

    requests = [{"run_id": "done"}, {"run_id": "half"}, {"run_id": "done2", "country": "CAN"}]
    second = ingest(
        spark, tmp_path, requests, done + half + [("half", 2, page_text(2, 2))], SECOND
    )
    assert {r.run_id: r.decision for r in second.decisions.collect()} == {
        "done": "SKIP", "half": "RESUME", "done2": "NEW",
    }
    manifests = {r.run_id: r for r in read_manifests(spark, str(tmp_path / "manifests")).collect()}
    assert manifests["half"].status == "COMPLETED" and manifests["half"].replayed is True
    assert manifests["half"].started_at == FIRST and manifests["done"].completed_at == FIRST
    parts = {r.run_id: [o.disposition for o in r.objects] for r in second.objects.collect()}
    assert parts["half"] == ["EXISTING", "WRITTEN"]

    third = ingest(spark, tmp_path, [{"run_id": "done", "country": "CAN"}], done, SECOND)
    assert [r.decision for r in third.decisions.collect()] == ["CONFLICT"]
    landed = read_landing_table(spark, str(tmp_path / "landing"))
    assert landed.count() == 4
    assert landed.filter("day = '09'").count() == 4
    assert classify_documents(landed_documents(landed)).count() == 4


def test_repeated_requests_make_one_run(spark, tmp_path):
    outcome = ingest(
        spark, tmp_path, [{"run_id": "r"}] * 3, [("r", 1, page_text(1, 1))], FIRST
    )
    assert [r.decision for r in outcome.decisions.collect()] == ["NEW"] * 3
    assert [r.pages_landed for r in outcome.manifests.collect()] == [1]
    assert read_landing_table(spark, str(tmp_path / "landing")).count() == 1


def test_ingest_stops_a_run_at_its_first_broken_page(spark, tmp_path):
    pages = [
        ("contract", 1, page_text(1, 3)),
        ("contract", 2, page_text(2, 3, without("date"))),
        ("contract", 3, page_text(3, 3)),
        ("mismatch", 1, page_text(2, 3)),
        ("sound", 1, page_text(1, 1)),
    ]
    outcome = ingest(
        spark, tmp_path, [{"run_id": r} for r in ("contract", "mismatch", "sound")], pages, FIRST
    )
    rows = {r.run_id: r for r in outcome.manifests.collect()}
    assert {run: (r.status, r.pages_landed) for run, r in rows.items()} == {
        "contract": ("FAILED", 1),
        "mismatch": ("FAILED", 0),
        "sound": ("COMPLETED", 1),
    }
    assert rows["contract"].error.message == "Record 0 is missing required fields: date"
    assert rows["mismatch"].error.message == "Requested page 1, but the API returned page 2"
    assert read_landing_table(spark, str(tmp_path / "landing")).count() == 2


def test_ingest_refuses_changed_content_for_a_landed_page(spark, tmp_path):
    ingest(spark, tmp_path, [{"run_id": "r"}], [("r", 1, page_text(1, 2))], FIRST)
    changed = [("r", 1, page_text(1, 2, usa(1999))), ("r", 2, page_text(2, 2))]
    outcome = ingest(spark, tmp_path, [{"run_id": "r"}], changed, SECOND)
    row = outcome.manifests.first()
    assert (row.status, row.error.type, row.pages_landed) == ("FAILED", "LandingConflictError", 0)
    assert read_landing_table(spark, str(tmp_path / "landing")).count() == 1


def test_outcomes_of_runs(spark, tmp_path):
    pages = [
        ("whole", 1, page_text(1, 2)),
        ("whole", 2, page_text(2, 2)),
        ("whole", 2, page_text(2, 2)),
        ("over", 1, page_text(1, 1)),
        ("over", 2, page_text(2, 1)),
        ("text", 1, page_text("1", " 1_0 ", usa(2001))),
        ("two", 1, page_text(1, 1)),
        ("two", 1, page_text(1, 1, usa(1999))),
        ("broken", 1, "{"),
    ]
    names = ("whole", "over", "text", "two", "broken", "none")
    outcome = ingest(spark, tmp_path, [{"run_id": r} for r in names], pages, FIRST)
    rows = {r.run_id: r for r in outcome.manifests.collect()}
    assert {run: (r.status, r.pages_landed) for run, r in rows.items()} == {
        "whole": ("COMPLETED", 2), "over": ("COMPLETED", 1), "text": ("FAILED", 1),
        "two": ("FAILED", 0), "broken": ("FAILED", 0), "none": ("FAILED", 0),
    }
    assert rows["none"].error.message == "Page 1 was not returned"
    assert rows["text"].error.message == "Page 2 was not returned"
    assert rows["two"].error.type == "LandingConflictError"
    landed = read_landing_table(spark, str(tmp_path / "landing"))
    assert sorted((r.run_id, r.page) for r in landed.collect()) == [
        ("over", 1), ("text", 1), ("whole", 1), ("whole", 2),
    ]


def test_a_run_that_breaks_off_after_landing_resumes_where_it_was(spark, tmp_path, monkeypatch):
    from lakegate.plans import ingest as plan_module

    written = plan_module.write_landing

    def breaks(pages, path):
        written(pages, path)
        raise RuntimeError("lost")

    monkeypatch.setattr(plan_module, "write_landing", breaks)
    pages = [("r", 1, page_text(1, 2)), ("r", 2, page_text(2, 2))]
    with pytest.raises(RuntimeError, match="lost"):
        ingest(spark, tmp_path, [{"run_id": "r"}], pages, FIRST)
    (running,) = read_manifests(spark, str(tmp_path / "manifests")).collect()
    assert (running.status, running.started_at, running.pages_landed) == ("RUNNING", FIRST, 0)
    monkeypatch.undo()
    again = ingest(spark, tmp_path, [{"run_id": "r"}], pages, SECOND)
    assert [r.decision for r in again.decisions.collect()] == ["RESUME"]
    assert [[o.disposition for o in r.objects] for r in again.objects.collect()] == [["EXISTING"] * 2]
    landed = read_landing_table(spark, str(tmp_path / "landing"))
    assert landed.count() == landed.filter("day = '09'").count() == 2
    (done,) = read_manifests(spark, str(tmp_path / "manifests")).collect()
    assert (done.status, done.pages_landed, done.replayed) == ("COMPLETED", 2, True)


def test_manifest_files_must_hold_objects(spark, tmp_path):
    assert read_manifests(spark, str(tmp_path / "none")).count() == 0
    folder = tmp_path / "m/world_bank/bucket=0"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("[1]", encoding="utf-8")
    with pytest.raises(Exception, match="Manifest must contain a JSON object"):
        read_manifests(spark, str(tmp_path / "m")).collect()


# ---------------------------------------------------------------------------
# Shape of the plans


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_curation_stays_in_the_jvm_and_parses_once(documents):
    text = plan(select_processed(classify_documents(documents(("a", document(record()))))))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("from_json(") > 0 and "Python" not in text
    assert text.count("Exchange hashpartitioning") == 2
    # Nothing below the first shuffle carries the text of the record.
    assert "to_json" not in text


def test_staged_duplicates_move_no_record_text(documents):
    frame = documents(("b", document(usa(2023), usa(2023, value=9), 7)), ("a", document(usa(2023, value=5))))
    result, _ = stage_classified(frame.union(frame), "plan-test")
    assert [r.observation_value for r in result.processed.collect()] == [5.0]
    lost = [r.rejection_reason for r in result.rejected.collect()]
    assert sorted(lost) == ["DUPLICATE_BUSINESS_KEY"] * 5 + ["RECORD_NOT_OBJECT"] * 2
    for side in (result.processed, result.rejected):
        text = plan(side)
        assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_page_contract_does_not_shuffle(documents):
    assert "Exchange" not in plan(page_contract(documents(("a", document(record())))))


def test_hot_runs_are_split_by_adaptive_joins(spark):
    """A run with most of the rows is joined by several tasks on every run-keyed join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        run_id = F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 97))
        requests = spark.range(0, 40000, 1, 8).select(
            run_id.alias("run_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("config_fingerprint"),
            F.lit(FIRST).cast("timestamp").alias("requested_at"),
        )
        manifests = requests.select("run_id").distinct().select(
            "run_id",
            F.lit("f").alias("config_fingerprint"),
            F.lit("FAILED").alias("status"),
            F.lit(FIRST).cast("timestamp").alias("started_at"),
        )
        admitted = admit_runs(requests, stage(manifests, "known-runs"))
        assert admitted.count() == 40000
        final = admitted.select("run_id", "decision")
        final.collect()
        assert "skew=true" in plan(final)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_quality_counts_before_its_shuffle(spark):
    frame = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("schema"))
    config = replace(
        INDICATOR_QUALITY_POLICY, business_key=("k",), required_columns=("k",), allowed_values={}
    )
    text = plan(row_metrics(frame, config))
    assert "partial_count" in text and "Python" not in text


def test_no_local_checkpoints_or_collected_data_in_the_package():
    package = Path(__file__).resolve().parents[1] / "lakegate"
    source = "\n".join(p.read_text(encoding="utf-8") for p in package.rglob("*.py"))
    for forbidden in ("localCheckpoint", ".toPandas(", "crossJoin", ".rdd"):
        assert forbidden not in source
    # Outside the training-data operators, only the landing dates of a batch come to the driver.
    core = [p.read_text(encoding="utf-8") for p in package.rglob("*.py") if p.parent.name != "llm"]
    assert "\n".join(core).count(".collect()") == 1
