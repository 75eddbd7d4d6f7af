from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest

from lakegate.operators.runs import (
    RunDefaults,
    admit_runs,
    manifest_objects,
    run_manifests,
    run_summaries,
    validate_requests,
    with_fingerprint,
)

EARLY, LATE = datetime(2033, 1, 30, 4, 20), datetime(2033, 2, 2, 23, 5)


def validated(spark, *texts):
    frame = spark.createDataFrame(
        [(t, "host-1") for t in texts], "request_text string, default_run_id string"
    )
    return validate_requests(frame).collect()


@pytest.mark.parametrize(
    "request_value, message",
    [
        ([1, {"run_id": "a"}], "must be a JSON object"),
        (7, "must be a JSON object"),
        ({"speed": "x", "colour": 1}, "unsupported fields: colour, speed"),
        ({"speed": "x", "run_id": "-"}, "unsupported fields: speed"),
        ({"run_id": "-bad"}, "run_id must be"),
        ({"run_id": "a" * 65}, "run_id must be"),
        ({"run_id": "a\n"}, "run_id must be"),
        ({"run_id": 5}, "run_id must be"),
        ({"run_id": "a b", "country": 1}, "run_id must be"),
        ({"country": "P?Q=1"}, "country contains unsupported"),
        ({"country": "U"}, "country contains unsupported"),
        ({"country": None}, "country contains unsupported"),
        ({"country": 12345}, "country contains unsupported"),
        ({"indicator": "SP POP"}, "indicator contains unsupported"),
        ({"indicator": "SP.POP\n"}, "indicator contains unsupported"),
        ({"per_page": True}, "per_page must be a positive integer"),
        ({"per_page": "5"}, "per_page must be a positive integer"),
        ({"start_page": 0}, "start_page must be a positive integer"),
        ({"start_page": -1, "per_page": 0}, "start_page must be a positive integer"),
        ({"start_page": 2.0}, "start_page must be a positive integer"),
        ({"start_page": 2.5}, "start_page must be a positive integer"),
        ({"start_page": None}, "start_page must be a positive integer"),
    ],
)
def test_rejects_invalid_requests(spark, request_value, message):
    (row,) = validated(spark, json.dumps(request_value))
    assert message in row.request_error


def test_fills_defaults_and_keeps_overrides(spark):
    rows = validated(
        spark,
        "{}",
        None,
        "null",
        '{"run_id":""}',
        '{"run_id":null}',
        '{"run_id":"r_1-x","country":"PQR;ST","indicator":"A.1","start_page":2,"per_page":3}',
    )
    assert all(r.request_error is None for r in rows)
    for row in rows[:5]:
        assert (row.run_id, row.country, row.indicator) == ("host-1", "USA", "SP.POP.TOTL")
        assert (row.start_page, row.per_page) == (1, 25)
    last = rows[5]
    assert (last.run_id, last.country, last.indicator) == ("r_1-x", "PQR;ST", "A.1")
    assert (last.start_page, last.per_page) == (2, 3)


def test_defaults_must_be_positive():
    with pytest.raises(ValueError, match="per_page must be greater than zero"):
        RunDefaults(per_page=0)


def test_fingerprint_is_sha256_of_sorted_json(spark):
    settings = {"country": "USA", "indicator": "SP.POP.TOTL", "page": 1, "per_page": 25}
    frame = spark.createDataFrame(
        [("USA", "SP.POP.TOTL", 1, 25)],
        "country string, indicator string, start_page bigint, per_page bigint",
    )
    defaults = RunDefaults(api_base_url='https://example.test/v2?q="x"')
    expected = json.dumps({**settings, "api_base_url": defaults.api_base_url}, sort_keys=True)
    row = with_fingerprint(frame, defaults).first()
    assert row.config_fingerprint == hashlib.sha256(expected.encode()).hexdigest()


def test_admission(spark):
    requests = spark.createDataFrame(
        [(run, "f", LATE) for run in ("new", "done", "failed", "running", "other")],
        "run_id string, config_fingerprint string, requested_at timestamp",
    )
    manifests = spark.createDataFrame(
        [
            ("done", "f", "COMPLETED", EARLY),
            ("failed", "f", "FAILED", EARLY),
            ("running", "f", "RUNNING", EARLY),
            ("other", "g", "COMPLETED", EARLY),
        ],
        "run_id string, config_fingerprint string, status string, started_at timestamp",
    )
    rows = {r.run_id: r for r in admit_runs(requests, manifests).collect()}
    assert {run: r.decision for run, r in rows.items()} == {
        "new": "NEW",
        "done": "SKIP",
        "failed": "RESUME",
        "running": "RESUME",
        "other": "CONFLICT",
    }
    assert rows["new"].started_at == LATE and rows["new"].replayed is False
    assert rows["failed"].started_at == EARLY and rows["failed"].replayed is True


def test_requests_for_one_run_take_their_turns(spark):
    requests = spark.createDataFrame(
        [("n", "f", EARLY), ("n", "f", LATE), ("n", "g", LATE), ("k", "f", EARLY), ("k", "f", LATE)],
        "run_id string, config_fingerprint string, requested_at timestamp",
    )
    manifests = spark.createDataFrame(
        [("k", "f", "FAILED", EARLY)],
        "run_id string, config_fingerprint string, status string, started_at timestamp",
    )
    found = {
        (r.run_id, r.config_fingerprint, r.requested_at): (r.decision, r.replayed)
        for r in admit_runs(requests, manifests).collect()
    }
    assert found == {
        ("n", "f", EARLY): ("NEW", False),
        ("n", "f", LATE): ("SKIP", True),
        ("n", "g", LATE): ("CONFLICT", False),
        ("k", "f", EARLY): ("RESUME", True),
        ("k", "f", LATE): ("SKIP", True),
    }


RUN = (
    "run_id string, started_at timestamp, completed_at timestamp, country string, "
    "indicator string, start_page bigint, per_page bigint, config_fingerprint string, "
    "replayed boolean, error_type string, error_message string"
)
OBJECT = (
    "run_id string, page int, total_pages int, record_count bigint, source_bytes bigint, "
    "path string, sha256 string, disposition string"
)


def test_manifests_and_parts(spark):
    def run(run_id, completed, error=None):
        return (run_id, EARLY, completed, "USA", "I.X", 1, 1, "f", False, error, error)

    runs = spark.createDataFrame(
        [run("done", LATE), run("open", None), run("failed", LATE, "ApiResponseError"), run("empty", LATE)],
        RUN,
    )
    objects = spark.createDataFrame(
        [("done", p, 1000 + p, 1, 8, f"p{p}", "s", "WRITTEN") for p in (2, 1, 1500)]
        + [("open", 1, 9, 2, 5, "q", "s", "EXISTING")],
        OBJECT,
    )
    manifests = run_manifests(runs, objects)
    rows = {r.run_id: r for r in manifests.collect()}
    assert {run: r.status for run, r in rows.items()} == {
        "done": "COMPLETED", "open": "RUNNING", "failed": "FAILED", "empty": "COMPLETED",
    }
    done = rows["done"]
    assert (done.pages_expected, done.pages_landed) == (2500, 3)
    assert (done.record_count, done.source_bytes) == (3, 24)
    assert done.error is None and rows["failed"].error.type == "ApiResponseError"
    assert (rows["empty"].pages_landed, rows["empty"].pages_expected) == (0, None)

    parts = {(r.run_id, r.part): [o.page for o in r.objects] for r in manifest_objects(objects).collect()}
    assert parts == {("done", 0): [1, 2], ("done", 1): [1500], ("open", 0): [1]}

    summary = run_summaries(manifests, "s3://b/manifests/").filter("run_id = 'done'").first()
    assert (summary.pages, summary.records) == (3, 3)
    assert summary.manifest_uri == "s3://b/manifests/world_bank/run_id=done"
