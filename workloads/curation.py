"""Parsing, normalising, validating, deduplicating and routing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.operators.curate import (
    classify_documents,
    mark_duplicates,
    normalize,
    select_processed,
    select_rejected,
    transform_documents,
    validate,
)
from lakegate.operators.parse import CANDIDATE, parse_documents
from lakegate.records import INDICATOR_OBSERVATIONS
from workloads.fixtures import (
    CANONICAL_RECORD,
    indicator_documents,
    table,
    with_both,
    with_documents,
    with_events,
)

MALFORMED = "MALFORMED_JSON: text is not a single JSON value"
RAW_COLUMNS = [f.raw_name for f in INDICATOR_OBSERVATIONS.fields]
TEXT_COLUMNS = [
    "indicator_id",
    "indicator_name",
    "country_id",
    "country_name",
    "country_iso3_code",
    "unit",
    "observation_status",
]
NUMBER_COLUMNS = ["observation_year", "observation_value", "decimal_places"]
ORIGIN = ["source_file", "source_record_index"]


def _joined_drift() -> F.Column:
    return F.array_join("schema_drift_fields", ",").alias("schema_drift_fields")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(indicator_documents(spark, sf_dir))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).filter(F.col("record_type") == CANDIDATE)


def flatten_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select(*ORIGIN, *RAW_COLUMNS)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select(*ORIGIN, "schema_drift", _joined_drift())


def _parser_rejects(reason: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = _events(spark, sf_dir).filter(F.col("rejection_reason").startswith(reason))
        return events.select(*ORIGIN, "rejection_reason", "raw_record")

    return query


def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_candidates(spark, sf_dir)).select(*ORIGIN, *TEXT_COLUMNS)


def cast_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_candidates(spark, sf_dir)).select(*ORIGIN, *NUMBER_COLUMNS)


def validation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        validate(_candidates(spark, sf_dir))
        .filter(F.col("rejection_reason").isNotNull())
        .select(*ORIGIN, "rejection_reason")
    )


def processed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = transform_documents(indicator_documents(spark, sf_dir)).processed
    return processed.withColumn("schema_drift_fields", _joined_drift())


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = transform_documents(indicator_documents(spark, sf_dir)).rejected
    return rejected.withColumn("schema_drift_fields", _joined_drift())


def rejection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = select_rejected(classify_documents(indicator_documents(spark, sf_dir)))
    return rejected.groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("rejected_rows"),
        F.count_if("schema_drift").alias("drift_rows"),
    )


def dedup_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = select_processed(classify_documents(indicator_documents(spark, sf_dir)))
    return processed.select(*INDICATOR_OBSERVATIONS.business_key, *ORIGIN, "observation_value")


def dedup_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = select_rejected(classify_documents(indicator_documents(spark, sf_dir)))
    return rejected.filter(F.col("rejection_reason") == "DUPLICATE_BUSINESS_KEY").select(
        *ORIGIN, "rejection_reason", "raw_record"
    )


def dedup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events under five keys, so that every key is a hot one."""
    spec = replace(INDICATOR_OBSERVATIONS, business_key=("event_type",))
    rows = table(spark, sf_dir, "events").select(
        "event_type",
        F.format_string("user-%08d", "user_id").alias("source_file"),
        F.col("event_id").cast("int").alias("source_record_index"),
        F.lit(None).cast("string").alias("rejection_reason"),
    )
    return mark_duplicates(rows, spec)


_RAW_VALUE = """CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 101 = 5 THEN 'not-a-number'
  WHEN event_id % 2 = 0 THEN rtrim(rtrim(CAST(value AS VARCHAR), '0'), '.')
  ELSE CAST(value AS VARCHAR) END"""
_RAW_DATE = """CASE WHEN event_id % 103 = 5 THEN NULL WHEN event_id % 107 = 5 THEN '20x4'
  ELSE CAST(1960 + event_id % 60 AS VARCHAR) || CASE WHEN event_id % 7 = 0 THEN '.0' ELSE '' END END"""
_IS_CANDIDATE = "(reason IS NULL OR reason NOT IN ('RECORD_NOT_OBJECT', 'INVALID_NESTED_OBJECT'))"
_DRIFT = "extra_fields"
# A record that is rejected before its fields are read reports no drift.
_REJECT_DRIFT = f"(has_extra AND {_IS_CANDIDATE})"
_DOCUMENT_REJECTS = f"""
  SELECT source_file, CAST(NULL AS INTEGER) AS source_record_index, '{MALFORMED}' AS rejection_reason,
         raw_text AS raw_record FROM docs WHERE page % 41 = 3
  UNION ALL
  SELECT source_file, CAST(NULL AS INTEGER), 'INVALID_DOCUMENT_SHAPE', raw_text
  FROM docs WHERE page % 43 = 3 AND page % 41 <> 3
"""
_RECORD_REJECTS = f"""
  SELECT source_file, idx AS source_record_index, final_reason AS rejection_reason,
         {CANONICAL_RECORD} AS raw_record FROM final WHERE final_reason IS NOT NULL
"""

QUERIES = {
    "flatten_records": (
        flatten_records,
        with_events(
            f"""SELECT source_file, idx AS source_record_index,
            CASE WHEN event_id % 139 = 5 THEN ' ' ELSE indicator_id END AS indicator_id_raw,
            indicator_name AS indicator_name_raw, lower(country_id) AS country_id_raw,
            country_name AS country_name_raw,
            CASE WHEN event_id % 109 = 5 THEN '  ' ELSE ' ' || lower(iso3) END AS country_iso3_code_raw,
            {_RAW_DATE} AS observation_year_raw, {_RAW_VALUE} AS observation_value_raw,
            ' people ' AS unit_raw, '' AS observation_status_raw,
            CASE WHEN event_id % 137 = 5 THEN 'x' ELSE '0' END AS decimal_places_raw
            FROM judged WHERE {_IS_CANDIDATE}"""
        ),
    ),
    "schema_drift": (
        schema_drift,
        with_events(
            f"""SELECT source_file, idx AS source_record_index, has_extra AS schema_drift,
            {_DRIFT} AS schema_drift_fields FROM judged WHERE {_IS_CANDIDATE}"""
        ),
    ),
    "reject_malformed": (
        _parser_rejects("MALFORMED_JSON"),
        with_documents(
            f"""SELECT source_file, CAST(NULL AS INTEGER) AS source_record_index,
            '{MALFORMED}' AS rejection_reason, raw_text AS raw_record
            FROM docs WHERE page % 41 = 3"""
        ),
    ),
    "reject_bad_shape": (
        _parser_rejects("INVALID_DOCUMENT_SHAPE"),
        with_documents(
            """SELECT source_file, CAST(NULL AS INTEGER) AS source_record_index,
            'INVALID_DOCUMENT_SHAPE' AS rejection_reason, '{"message":"err"}' AS raw_record
            FROM docs WHERE page % 43 = 3 AND page % 41 <> 3"""
        ),
    ),
    "reject_not_object": (
        _parser_rejects("RECORD_NOT_OBJECT"),
        with_events(
            """SELECT source_file, idx AS source_record_index, reason AS rejection_reason,
            '7' AS raw_record FROM judged WHERE reason = 'RECORD_NOT_OBJECT'"""
        ),
    ),
    "reject_nested": (
        _parser_rejects("INVALID_NESTED_OBJECT"),
        with_events(
            f"""SELECT source_file, idx AS source_record_index, reason AS rejection_reason,
            {CANONICAL_RECORD} AS raw_record FROM judged WHERE reason = 'INVALID_NESTED_OBJECT'"""
        ),
    ),
    "normalize_strings": (
        normalize_strings,
        with_events(
            f"""SELECT source_file, idx AS source_record_index, indicator_id, indicator_name,
            country_id, country_name, iso3 AS country_iso3_code, 'people' AS unit,
            '' AS observation_status FROM judged WHERE {_IS_CANDIDATE}"""
        ),
    ),
    "cast_fields": (
        cast_fields,
        with_events(
            f"""SELECT source_file, idx AS source_record_index, yr AS observation_year,
            val AS observation_value, CAST(dec AS INTEGER) AS decimal_places
            FROM judged WHERE {_IS_CANDIDATE}"""
        ),
    ),
    "validation_reasons": (
        validation_reasons,
        with_events(
            f"""SELECT source_file, idx AS source_record_index, reason AS rejection_reason
            FROM judged WHERE reason IS NOT NULL AND {_IS_CANDIDATE}"""
        ),
    ),
    "processed_rows": (
        processed_rows,
        with_events(
            f"""SELECT indicator_id, indicator_name, country_id, country_name,
            iso3 AS country_iso3_code, yr AS observation_year, val AS observation_value,
            'people' AS unit, '' AS observation_status, CAST(dec AS INTEGER) AS decimal_places,
            source_file, idx AS source_record_index, has_extra AS schema_drift,
            {_DRIFT} AS schema_drift_fields FROM final WHERE final_reason IS NULL"""
        ),
    ),
    "rejected_rows": (
        rejected_rows,
        with_both(
            f"""SELECT source_file, source_record_index, rejection_reason, raw_record,
            false AS schema_drift, '' AS schema_drift_fields FROM ({_DOCUMENT_REJECTS}) AS d
            UNION ALL
            SELECT source_file, idx, final_reason, {CANONICAL_RECORD}, {_REJECT_DRIFT},
            CASE WHEN {_REJECT_DRIFT} THEN {_DRIFT} ELSE '' END
            FROM final WHERE final_reason IS NOT NULL"""
        ),
    ),
    "rejection_summary": (
        rejection_summary,
        with_both(
            f"""SELECT rejection_reason, count(*) AS rejected_rows,
            count(*) FILTER (WHERE drift) AS drift_rows
            FROM (SELECT rejection_reason, false AS drift FROM ({_DOCUMENT_REJECTS}) AS d
                  UNION ALL
                  SELECT final_reason, {_REJECT_DRIFT} FROM final WHERE final_reason IS NOT NULL)
            GROUP BY rejection_reason"""
        ),
    ),
    "dedup_processed": (
        dedup_processed,
        with_events(
            """SELECT iso3 AS country_iso3_code, indicator_id, yr AS observation_year,
            min_by(source_file, event_id) AS source_file, min_by(idx, event_id) AS source_record_index,
            min_by(val, event_id) AS observation_value
            FROM judged WHERE reason IS NULL GROUP BY ALL"""
        ),
    ),
    "dedup_rejected": (
        dedup_rejected,
        with_events(f"SELECT * FROM ({_RECORD_REJECTS}) WHERE rejection_reason LIKE 'DUPLICATE%'"),
    ),
    "dedup_hot_key": (
        dedup_hot_key,
        """SELECT event_type, printf('user-%08d', user_id) AS source_file,
        CAST(event_id AS INTEGER) AS source_record_index,
        CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY user_id, event_id) > 1
             THEN 'DUPLICATE_BUSINESS_KEY' END AS rejection_reason FROM events""",
    ),
}
