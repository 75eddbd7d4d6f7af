from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakegate.functions.json_text import with_page_parts
from lakegate.operators.parse import parse_documents
from tests.conftest import SAMPLE, document, record, without


def events(frame):
    rows = parse_documents(frame).orderBy("source_file", "source_record_index").collect()
    return [row.asDict() for row in rows]


def test_flattens_a_record(documents):
    (row,) = events(documents(("a", document(record()))))
    assert row["record_type"] == "candidate"
    assert row["rejection_reason"] is None
    assert row["source_record_index"] == 0
    assert {name: row[f"{name}_raw"] for name in SAMPLE} == {name: str(value) for name, value in SAMPLE.items()}
    assert row["schema_drift"] is False and row["schema_drift_fields"] == []
    assert row["raw_record"] == json.dumps(record(), separators=(",", ":"), sort_keys=True)


@pytest.mark.parametrize(
    "text",
    [
        "{bad-json",
        "",
        None,
        "[{},[]] x",
        "[{},[]]]",
        "1], [2",
        '1}, {"a":2',
        '1,"d":2',
        "[{},[]],",
        "﻿[{},[]]",
        "['a',[]]",
    ],
)
def test_rejects_text_that_is_not_one_json_value(documents, text):
    (row,) = events(documents(("a", text)))
    assert row["record_type"] == "rejected"
    assert row["rejection_reason"].startswith("MALFORMED_JSON:")
    assert row["source_record_index"] is None
    assert row["raw_record"] == text
    assert row["indicator_id_raw"] is None


@pytest.mark.parametrize(
    "text, canonical",
    [
        ("[{},null]", "[{},null]"),
        ("[{}]", "[{}]"),
        ("[{},[],1]", "[{},[],1]"),
        ("[{},[],null]", "[{},[],null]"),
        ('{"b": 1, "a": [2]}', '{"a":[2],"b":1}'),
        ('[1,{"0":1}]', '[1,{"0":1}]'),
        ("7", "7"),
        ("null", "null"),
        ('{"0":1,"1":[]}', '{"0":1,"1":[]}'),
        ("[]", "[]"),
    ],
)
def test_rejects_other_shapes(documents, text, canonical):
    (row,) = events(documents(("a", text)))
    assert row["rejection_reason"] == "INVALID_DOCUMENT_SHAPE"
    assert row["source_record_index"] is None
    assert row["raw_record"] == canonical


def test_empty_page_gives_no_rows(documents):
    empty = ("[{},[]]", "  [ null , [ ] ]  ", "[NaN,[]]")
    assert events(documents(*((str(i), text) for i, text in enumerate(empty)))) == []


def test_positions_count_every_element(documents):
    rows = events(documents(("a", document(7, record(), None, "x", []))))
    assert [r["source_record_index"] for r in rows] == [0, 1, 2, 3, 4]
    assert [r["rejection_reason"] for r in rows] == [
        "RECORD_NOT_OBJECT",
        None,
        "RECORD_NOT_OBJECT",
        "RECORD_NOT_OBJECT",
        "RECORD_NOT_OBJECT",
    ]
    assert [r["raw_record"] for r in rows if r["rejection_reason"]] == ["7", "null", '"x"', "[]"]


@pytest.mark.parametrize(
    "bad",
    [
        record(indicator="flat"),
        record(country=None),
        record(country=[{"id": "a"}]),
        without("country"),
        without("indicator", extra=1),
    ],
)
def test_rejects_missing_or_scalar_nested_objects(documents, bad):
    (row,) = events(documents(("a", document(bad))))
    assert row["rejection_reason"] == "INVALID_NESTED_OBJECT"
    # Drift is not looked for in a rejected record.
    assert row["schema_drift"] is False and row["schema_drift_fields"] == []


def test_empty_nested_objects_are_objects(documents):
    (row,) = events(documents(("a", document(record(indicator={}, country={})))))
    assert row["record_type"] == "candidate"
    assert row["indicator_id_raw"] is None and row["country_id_raw"] is None


def test_reports_drift_at_all_levels_sorted(documents):
    drifting = record(
        zz=1,
        aa=None,
        indicator={"id": "I", "value": "v", "source": 1},
        country={"id": "C", "value": "v", "é": 1},
    )
    (row,) = events(documents(("a", document(drifting))))
    assert row["schema_drift"] is True
    assert row["schema_drift_fields"] == ["country.é", "indicator.source", "record.aa", "record.zz"]


def test_drift_names_of_any_content(documents):
    names = ['a","b', '["', "\\", "x\ny", ""]
    (row,) = events(documents(("a", document(record(**{n: 1 for n in names})))))
    assert row["schema_drift_fields"] == sorted(f"record.{n}" for n in names)


def test_nested_values_become_compact_sorted_json(documents):
    odd = record(unit={"b": [1, 2], "a": None}, obs_status=[True], date=2024.5, value=True)
    (row,) = events(documents(("a", document(odd))))
    assert row["unit_raw"] == '{"a":null,"b":[1,2]}'
    assert row["observation_status_raw"] == "[true]"
    assert row["observation_year_raw"] == "2024.5"
    assert row["observation_value_raw"] == "true"


def test_last_of_duplicate_keys_wins(documents):
    text = '[{},[{"indicator":{"id":"a","id":"b"},"country":{},"date":"1","date":"2"}]]'
    (row,) = events(documents(("a", text)))
    assert row["indicator_id_raw"] == "b"
    assert row["observation_year_raw"] == "2"


def repeated(spark, head, body, times, tail):
    """One document made by Spark: a literal of this size would be folded into the plan."""
    frame = spark.range(1).select(F.lit(times).alias("n"), (F.col("id") + times).cast("int").alias("times"))
    text = F.concat(F.lit(head), F.repeat(F.lit(body), F.col("times")), F.lit(tail))
    return frame.select(F.lit("a").alias("source_file"), text.alias("raw_text"))


def test_a_document_larger_than_a_variant_keeps_its_records(spark):
    filler = "x" * 3_000_000
    body = json.dumps(record(unit=filler)) + ","
    frame = repeated(spark, "[{},[", body, 46, json.dumps(record()) + "]]")
    assert frame.select(F.octet_length("raw_text")).first()[0] > 128 * 1024 * 1024
    found = parse_documents(frame).groupBy("record_type").count().collect()
    assert [(r.record_type, r["count"]) for r in found] == [("candidate", 47)]
    trailing = frame.withColumn("raw_text", F.concat("raw_text", F.lit(" x")))
    reasons = parse_documents(trailing).select("rejection_reason").collect()
    assert [r.rejection_reason for r in reasons] == ["MALFORMED_JSON: text is not a single JSON value"]


def test_a_very_long_string_stays_in_its_record(spark):
    text = json.dumps(record(unit="@")).partition("@")
    frame = repeated(spark, "[{},[" + text[0], "x", 21_000_000, text[2] + "]]")
    row = parse_documents(frame).select("record_type", F.length("unit_raw").alias("n"), "country_id_raw").first()
    assert (row.record_type, row.n, row.country_id_raw) == ("candidate", 21_000_000, SAMPLE["country_id"])


def test_numbers_that_json_does_not_know_spoil_no_other_record(documents):
    text = document(record(value=float("nan")), record(date="2023"), 7, "text")
    rows = events(documents(("a", text)))
    assert [r["rejection_reason"] for r in rows] == [None, None, "RECORD_NOT_OBJECT", "RECORD_NOT_OBJECT"]
    assert rows[0]["observation_value_raw"] == "NaN"
    assert rows[1]["observation_value_raw"] == str(SAMPLE["observation_value"]) and rows[1]["observation_year_raw"] == "2023"


def test_a_neighbour_changes_no_record(documents):
    """Odd numbers, long texts and spelled-out JSON beside a record leave its row as it is."""
    own = [
        json.dumps(record()),
        json.dumps(json.dumps(record())),  # a string that spells an object
        '"[1]"', "7", "1e30", "null", "[1]", "{}", json.dumps(without("country")),
        json.dumps(record(value=0.1, extra="x")),
    ]
    neighbours = ["NaN", '{"a":NaN}', json.dumps(record(value=float("inf"))), json.dumps("y" * 100_000), '"]]"']
    plain = events(documents(("a", "[{}, [" + ", ".join(own) + "] ]")))
    for neighbour in neighbours:
        beside = events(documents(("a", "[{},[" + ",".join([*own, neighbour]) + "]]\n")))
        assert beside[: len(own)] == plain
    assert [r["rejection_reason"] for r in plain[:7]] == [None] + ["RECORD_NOT_OBJECT"] * 6


def test_parts_that_are_strings_are_no_page(documents):
    texts = ['[{},"[{}]"]', '["{}","[]"]', '"[{},[]]"', '[{},"[]]"]', '[{},[]],"d":[]', "[{},[]]}", "", " "]
    rows = events(*[documents(*((str(i), text) for i, text in enumerate(texts)))])
    reasons = {r["source_file"]: r["rejection_reason"].split(":")[0] for r in rows}
    shape, malformed = "INVALID_DOCUMENT_SHAPE", "MALFORMED_JSON"
    assert reasons == {**{str(i): shape for i in range(4)}, **{str(i): malformed for i in (4, 5, 6, 7)}}


def test_pages_read_in_parts_are_those_read_whole(documents):
    """What a document beyond the size of a variant goes through, on small ones."""
    records = [record(), json.dumps(record()), "[1]", 7, None, [], {}, without("country"), record(value=0.25, more=1)]
    texts = [document(*records), f" [ null , {json.dumps(records)} ] ", "[{},[]]", "[1,[{}]]", "[[],[1]]", '["{}","[]"]']
    texts += ['[{},"[{}]"]', '"[{},[]]"', "[{},{}]", "[{}]", "[{},[],[]]", "{}", "7", "null", "", "[{},[]] x", '[1],"d":[2]']
    frame = documents(*((str(i), text) for i, text in enumerate(texts)))
    parts = ["_is_json", "_is_pair", F.to_json("_metadata").alias("m"), F.col("_records").cast("array<string>").alias("r")]

    def opened(whole):
        rows = with_page_parts(frame, whole=whole).select("source_file", *parts).collect()
        of_pair = {r.source_file: (r.m if (r.m or "").startswith("{") else None, r.r) for r in rows if r._is_pair}
        return {r.source_file: (r._is_json, r._is_pair, of_pair.get(r.source_file)) for r in rows}

    assert opened(False) == opened(True)


def test_requires_document_columns(spark):
    frame = spark.createDataFrame([("a",)], "source_file string")
    with pytest.raises(ValueError, match=r"Documents DataFrame is missing columns: \['raw_text'\]"):
        parse_documents(frame)
