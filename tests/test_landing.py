from __future__ import annotations

import hashlib
import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lakegate.operators.landing import (
    disposition,
    landing_path_columns,
    page_contract,
    with_checksum,
    with_landing_keys,
)
from lakegate.operators.reconcile import (
    PAGE_BLOCK,
    expected_pages,
    first_gaps,
    missing_pages,
    page_metrics,
    page_mismatches,
    within_run,
)
from lakegate.sources.documents import only_runs, read_documents, read_landing_table
from lakegate.sinks import write_landing
from lakegate.operators.landing import LandingConflictError
from tests.conftest import document, record, without


def pages(spark, *rows):
    """Rows of run_id, page, raw_text, landed at one fixed moment."""
    return spark.createDataFrame(
        [(r, "SP.POP.TOTL", p, t, datetime(2031, 3, 9, 23, 50, tzinfo=UTC)) for r, p, t in rows],
        "run_id string, indicator string, page int, raw_text string, ingested_at timestamp",
    )


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Auckland"])
def test_landing_key_uses_the_utc_date(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = with_landing_keys(pages(spark, ("lane-7", 1, "x")), "/root/").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.path == (
        "/root/world_bank/year=2031/month=03/day=09/run_id=lane-7/sp_pop_totl_page_00001.json"
    )


def test_page_numbers_wider_than_the_padding_are_kept(spark):
    row = with_landing_keys(pages(spark, ("r", 1234567, "x"))).first()
    assert row.path.endswith("_page_1234567.json")


def test_paths_read_back(spark):
    keyed = with_landing_keys(pages(spark, ("r-1", 42, "x"))).select("path")
    row = landing_path_columns(keyed, "path").first()
    assert (row.year, row.month, row.day) == (2031, 3, 9)
    assert (row.run_id, row.indicator_stem, row.page) == ("r-1", "sp_pop_totl", 42)
    other = keyed.select(F.lit("/tmp/other.json").alias("path"))
    assert landing_path_columns(other, "path").first().run_id is None


def test_checksum_is_over_exact_bytes(spark):
    text = '[{"é":1}]\n'
    row = with_checksum(pages(spark, ("r", 1, text))).first()
    assert row.sha256 == hashlib.sha256(text.encode("utf-8")).hexdigest()


def disposed(spark, incoming, landed=()):
    frame = disposition(
        spark.createDataFrame(list(incoming), "path string, sha256 string, arrival int"),
        spark.createDataFrame(list(landed), "path string, sha256 string"),
    )
    return {(r.path, r.arrival): r.disposition for r in frame.collect()}


def test_disposition_of_new_repeated_and_changed_pages(spark):
    found = disposed(
        spark,
        [("new", "a", 1), ("new", "a", 2), ("new", "b", 3), ("old", "a", 1), ("old", "b", 2)],
        [("old", "a"), ("elsewhere", "z")],
    )
    assert found == {
        ("new", 1): "WRITTEN",
        ("new", 2): "EXISTING",
        ("new", 3): "CONFLICT",
        ("old", 1): "EXISTING",
        ("old", 2): "CONFLICT",
    }


@pytest.mark.parametrize("lanes", [1, 5, 16384])
def test_disposition_equals_one_by_one_landing(spark, lanes):
    rng = random.Random(11)
    incoming, landed = [], {f"p{i}": "a" for i in range(20)}
    for i in range(2000):
        # A third of all copies are for one path.
        path = "hot" if rng.random() < 0.34 else f"p{rng.randrange(300)}"
        incoming.append((path, rng.choice("abc"), i))
    held, expected = dict(landed), {}
    for path, sha, arrival in incoming:
        if path not in held:
            held[path] = sha
            expected[(path, arrival)] = "WRITTEN"
        else:
            expected[(path, arrival)] = "EXISTING" if held[path] == sha else "CONFLICT"
    frame = disposition(
        spark.createDataFrame(incoming, "path string, sha256 string, arrival int"),
        spark.createDataFrame(list(landed.items()), "path string, sha256 string"),
        lanes=lanes,
    )
    assert {(r.path, r.arrival): r.disposition for r in frame.collect()} == expected


def test_disposition_of_a_hot_path(spark):
    incoming = [("hot", "a" if i % 10 else "b", i) for i in range(1, 2000)]
    found = disposed(spark, incoming + [("cold", "c", 1)])
    assert found[("hot", 1)] == "WRITTEN"
    assert sum(d == "EXISTING" for d in found.values()) == 1799
    assert sum(d == "CONFLICT" for d in found.values()) == 199


def test_landing_table_round_trip_and_conflict(spark, tmp_path):
    table = str(tmp_path / "landing")
    first = with_checksum(with_landing_keys(pages(spark, ("r", 1, "one"), ("s", 1, "two"))))
    write_landing(first.withColumn("disposition", F.lit("WRITTEN")), table)
    landed = read_landing_table(spark, table)
    assert {(r.run_id, r.raw_text) for r in landed.collect()} == {("r", "one"), ("s", "two")}

    again = with_checksum(with_landing_keys(pages(spark, ("r", 1, "changed"), ("r", 2, "new"))))
    again = disposition(again, landed, order_by="page")
    with pytest.raises(LandingConflictError, match="different content"):
        write_landing(again, table)
    # Nothing of the conflicting batch was written.
    assert read_landing_table(spark, table).count() == 2


def test_scan_reads_whole_files_and_filters_runs(spark, tmp_path):
    for run in ("a", "b"):
        folder = tmp_path / f"world_bank/year=2031/month=03/day=09/run_id={run}"
        folder.mkdir(parents=True)
        (folder / "sp_pop_totl_page_00001.json").write_text(f"[\n{run}é\n]", encoding="utf-8")
    (tmp_path / "bad.json").write_bytes(b"\xff[]")
    documents = read_documents(spark, str(tmp_path))
    assert documents.columns == ["source_file", "raw_text"]
    assert {r.raw_text for r in documents.collect()} == {"[\naé\n]", "[\nbé\n]", "�[]"}
    assert [r.raw_text for r in only_runs(documents, ["b"]).collect()] == ["[\nbé\n]"]


# ---------------------------------------------------------------------------
# Page contract

META = {"page": 1, "pages": 3, "per_page": 25, "total": 0}


def raw(meta, *records):
    return json.dumps([meta, list(records)])


CONTRACT = [
    (raw(META, record(), record(value=None), record(value=1.5)), None),
    (raw(META), None),
    ("nope", "World Bank API returned invalid JSON"),
    ("[{},[]] x", "World Bank API returned invalid JSON"),
    ('{"unexpected":"object"}', "Expected a two-item World Bank response array"),
    ("[{},[],[]]", "Expected a two-item World Bank response array"),
    ("[]", "Expected a two-item World Bank response array"),
    ("null", "Expected a two-item World Bank response array"),
    ("[[],[]]", "Expected response metadata to be an object"),
    ("[null,null]", "Expected response metadata to be an object"),
    (json.dumps([META, None]), "Expected response records to be an array"),
    (json.dumps([META, {}]), "Expected response records to be an array"),
    ('[{"page":1},[7]]', "Response metadata is missing fields: pages, per_page, total"),
    (raw({**META, "page": "x"}, 7), "Expected every response record to be an object"),
    (raw({**META, "page": "x", "pages": 0}), "Response metadata field page must be an integer"),
    (raw({**META, "pages": None}), "Response metadata field pages must be an integer"),
    (raw({**META, "pages": [1]}), "Response metadata field pages must be an integer"),
    (raw({**META, "pages": "1.5"}), "Response metadata field pages must be an integer"),
    (raw({**META, "pages": ""}), "Response metadata field pages must be an integer"),
    (raw({**META, "page": " +1_0 ", "pages": 2.9, "total": "-0"}), None),
    (raw({**META, "page": True, "total": False}), None),
    (raw({**META, "per_page": 0.9}), "Response metadata field per_page must be at least 1"),
    (raw({**META, "per_page": False}), "Response metadata field per_page must be at least 1"),
    (raw({**META, "per_page": "-3"}), "Response metadata field per_page must be at least 1"),
    (raw({**META, "total": -1}), "Response metadata field total must be at least 0"),
    (raw({**META, "total": -0.5}), None),
    (raw(META, without("countryiso3code")), "Record 0 is missing required fields: countryiso3code"),
    (raw(META, record(), {"value": 1}), "Record 1 is missing required fields: country, countryiso3code, date, indicator"),
    (raw(META, record(country="x")), "Record 0 field country must contain a string id"),
    (raw(META, record(country={"id": 5, "value": 5})), "Record 0 field country must contain a string id"),
    (raw(META, record(country={"id": "x"})), "Record 0 field country must contain a string value"),
    (raw(META, record(indicator={"id": None, "value": "v"})), "Record 0 field indicator must contain a string id"),
    (raw(META, record(indicator={"id": "i", "value": 1})), "Record 0 field indicator must contain a string value"),
    (raw(META, record(countryiso3code="")), "Record 0 field countryiso3code must be a non-empty string"),
    (raw(META, record(countryiso3code=None)), "Record 0 field countryiso3code must be a non-empty string"),
    (raw(META, record(date=2024)), "Record 0 field date must be a non-empty string"),
    (raw(META, record(value="1")), "Record 0 field value must be numeric or null"),
    (raw(META, record(value=True)), "Record 0 field value must be numeric or null"),
    (raw(META, record(value=[])), "Record 0 field value must be numeric or null"),
    (raw(META, record(), record(value="1"), record(date="")), "Record 1 field value must be numeric or null"),
]


def test_page_contract_reports_the_first_violation(spark):
    frame = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(CONTRACT)], "i int, raw_text string"
    )
    judged = page_contract(frame)
    assert judged.columns[:3] == ["i", "raw_text", "violation"]
    found = {CONTRACT[r.i][0]: r.violation for r in judged.collect()}
    assert found == dict(CONTRACT)


# ---------------------------------------------------------------------------
# Reconciliation


def test_page_metrics(documents):
    frame = documents(("a", document(record(), unit="é")), ("b", "{bad"), ("c", "[{},null]"))
    rows = {r.source_file: r for r in page_metrics(frame).collect()}
    assert (rows["a"].returned_page, rows["a"].total_pages, rows["a"].record_count) == (1, 1, 1)
    assert rows["a"].source_bytes == len(rows["a"].raw_text.encode("utf-8"))
    assert rows["b"].record_count == rows["c"].record_count == 0
    assert rows["b"].returned_page is None


def test_numbers_of_a_page_are_read_one_way(spark):
    def page(number):
        return f'[{{"page":{number},"pages":3000000000,"per_page":1,"total":0}},[]]'

    spelled = {"2.9": 2, "true": 1, '" 1_0 "': 10, "-3.5": -3, '"x"': None, "null": None, "9000000000": 9000000000}
    frame = spark.createDataFrame([(s, page(s)) for s in spelled], "s string, raw_text string")
    for read in (page_contract, page_metrics):
        rows = read(frame).collect()
        assert {r.s: r.returned_page for r in rows} == spelled
        assert {r.total_pages for r in rows} == {3000000000}
    garbage = spark.createDataFrame([("[{},[1]] x",)], "raw_text string")
    assert page_metrics(garbage).first().record_count == 0


def test_ends_and_gaps_follow_the_pages_there_are(spark):
    runs = {
        "whole": [(1, 2), (2, 2)],
        "over": [(1, 2), (2, 2), (3, 2), (4, 2)],
        "early": [(1, 1), (3, 3)],
        "gap": [(1, 4), (2, 4), (4, 4)],
        "short": [(1, 2_000_000_000)],
        "before": [(0, 1), (1, 3)],
        "none": [],
    }
    active = spark.createDataFrame([(r, 1) for r in runs], "run_id string, start_page bigint")
    rows = [(r, p, 1, n) for r, pages in runs.items() for p, n in pages]
    pages = spark.createDataFrame(rows, "run_id string, page bigint, start_page bigint, total_pages bigint")
    inside = within_run(pages, F.lit(True))
    found = {}
    for r in inside.collect():
        found.setdefault(r.run_id, []).append(r.page)
    assert {k: sorted(v) for k, v in found.items()} == {
        "whole": [1, 2], "over": [1, 2], "early": [1], "gap": [1, 2, 4], "short": [1], "before": [1],
    }
    gaps = {r.run_id: r.page for r in first_gaps(active, inside).collect()}
    assert gaps == {"gap": 3, "short": 2, "before": 2, "none": 1}


def test_a_path_landed_twice_answers_once(spark):
    incoming = spark.createDataFrame([("p", "a", 1), ("q", "a", 1)], "path string, sha256 string, arrival int")
    landed = spark.createDataFrame([("p", "a"), ("p", "a"), ("q", "a"), ("q", "b")], "path string, sha256 string")
    found = [(r.path, r.disposition) for r in disposition(incoming, landed).orderBy("path").collect()]
    assert found == [("p", "EXISTING"), ("q", "CONFLICT")]


def test_missing_pages_and_mismatches(spark):
    runs = spark.createDataFrame(
        [("a", 1, 4), ("b", 3, 3), ("c", 5, 4)], "run_id string, start_page int, pages_expected int"
    )
    landed = spark.createDataFrame(
        [("a", 1, 1), ("a", 3, 2), ("b", 3, 3)], "run_id string, page int, returned_page int"
    )
    assert {(r.run_id, r.page) for r in missing_pages(runs, landed).collect()} == {("a", 2), ("a", 4)}
    assert [(r.page, r.returned_page) for r in page_mismatches(landed).collect()] == [(3, 2)]


def test_long_runs_are_expanded_in_blocks(spark):
    end = 3 * PAGE_BLOCK + 7
    runs = spark.createDataFrame([("a", 2, end)], "run_id string, start_page int, pages_expected int")
    row = (
        expected_pages(runs)
        .agg(F.count("*").alias("n"), F.countDistinct("page").alias("d"), F.min("page").alias("a"), F.max("page").alias("b"))
        .first()
    )
    assert (row.n, row.d, row.a, row.b) == (end - 1, end - 1, 2, end)
