"""Whole JSON documents -> one event row per record, or per unreadable document.

Everything is a narrow projection plus one explode: no shuffle and no
Python worker. The document text and its parsed form stay below the explode, so
a record row never carries the document it came from.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.functions.evaluation import with_computed
from lakegate.functions.json_text import (
    allow_duplicate_keys,
    object_at,
    unexpected_keys,
    with_page_parts,
    with_prefix,
)
from lakegate.records import INDICATOR_OBSERVATIONS, RecordSpec

# Rejection reasons of the parser, kinds of event, document columns.
MALFORMED_JSON = "MALFORMED_JSON"
INVALID_DOCUMENT_SHAPE = "INVALID_DOCUMENT_SHAPE"
RECORD_NOT_OBJECT = "RECORD_NOT_OBJECT"
INVALID_NESTED_OBJECT = "INVALID_NESTED_OBJECT"
CANDIDATE = "candidate"
REJECTED = "rejected"
DOCUMENT_COLUMNS = ("source_file", "raw_text")


def require_document_columns(documents: DataFrame) -> None:
    missing = sorted(set(DOCUMENT_COLUMNS) - set(documents.columns))
    if missing:
        raise ValueError(f"Documents DataFrame is missing columns: {missing}")


def split_documents(documents: DataFrame) -> DataFrame:
    """One row per document: its record array, or the reason it has none.

    Columns: ``source_file``, ``document_reason``, ``document_evidence`` (both
    NULL for a readable document) and ``records``, an array of variants. A
    rejected document gets an array of one JSON null, so that it stays one row.
    """
    require_document_columns(documents)
    allow_duplicate_keys(documents.sparkSession)
    opened = with_page_parts(documents.select("source_file", "raw_text"))
    is_json = F.col("_is_json")
    is_page = F.col("_is_pair") & F.col("_records").isNotNull()
    return opened.select(
        "source_file",
        F.when(~is_json, F.lit(f"{MALFORMED_JSON}: text is not a single JSON value"))
        .when(~is_page, F.lit(INVALID_DOCUMENT_SHAPE))
        .alias("document_reason"),
        F.when(~is_json, F.col("raw_text")).when(~is_page, F.col("_evidence")).alias("document_evidence"),
        F.when(is_json & is_page, F.col("_records"))
        .otherwise(F.array(F.parse_json(F.lit("null"))))
        .alias("records"),
    )


def explode_records(split: DataFrame) -> DataFrame:
    """One row per record with its 0-based position; an empty array gives none."""
    return split.select(
        "source_file",
        "document_reason",
        "document_evidence",
        F.posexplode("records").alias("position", "record"),
    )


def _drift_fields(spec: RecordSpec) -> Column:
    """Sorted names of unexpected keys, prefixed with the object they are in.

    Objects list their keys in order, so a record with exactly the expected ones
    is told by comparing key arrays; only other records are searched.
    """
    levels = {"record": (F.col("members"), spec.record_keys)}
    for key, children in spec.nested_keys.items():
        levels[key] = (F.col(f"fields.{key}"), children)
    as_expected = [
        F.map_keys(members) == F.array(*[F.lit(key) for key in sorted(expected)])
        for members, expected in levels.values()
    ]
    extras = {name: unexpected_keys(*level) for name, level in levels.items()}
    total = sum((F.size(extra) for extra in extras.values()), F.lit(0))
    named = [with_prefix(extra, f"{prefix}.") for prefix, extra in extras.items()]
    return (
        F.when(reduce(and_, as_expected), _no_names())
        .when(total > 0, F.sort_array(F.concat(*named)))
        .otherwise(_no_names())
    )


def _no_names() -> Column:
    return F.array().cast("array<string>")


def read_records(split: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS) -> DataFrame:
    """Split documents -> parsed events (see :func:`parse_documents`)."""
    read = with_computed(
        explode_records(split),
        {
            "fields": F.try_variant_get("record", "$", spec.struct_type),
            "members": object_at(F.col("record")),
        },
    )
    nested_missing = [F.col(f"fields.{key}").isNull() for key in spec.nested_keys]
    reason = F.when(F.col("members").isNull(), F.lit(RECORD_NOT_OBJECT)).when(
        reduce(or_, nested_missing, F.lit(False)), F.lit(INVALID_NESTED_OBJECT)
    )
    is_document = F.col("document_reason").isNotNull()
    judged = read.select(
        "source_file",
        F.when(~is_document, F.col("position")).cast("int").alias("source_record_index"),
        F.coalesce(F.col("document_reason"), reason).alias("rejection_reason"),
        F.when(is_document, F.col("document_evidence"))
        .otherwise(F.to_json("record"))
        .alias("raw_record"),
        "fields",
        "members",
    )
    is_candidate = F.col("rejection_reason").isNull()
    return judged.select(
        F.when(is_candidate, F.lit(CANDIDATE)).otherwise(F.lit(REJECTED)).alias("record_type"),
        "source_file",
        "source_record_index",
        "rejection_reason",
        "raw_record",
        *[F.when(is_candidate, spec.value_in("fields", f)).alias(f.raw_name) for f in spec.fields],
        F.when(is_candidate, _drift_fields(spec))
        .otherwise(_no_names())
        .alias("schema_drift_fields"),
    ).withColumn("schema_drift", F.size("schema_drift_fields") > 0)


def parse_documents(documents: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS) -> DataFrame:
    """Documents -> parsed events, one row per record or unreadable document.

    ``record_type`` is ``candidate`` or ``rejected``; a candidate carries one
    ``*_raw`` text column per field and the names of unexpected keys, a rejected
    row its reason. Both carry ``raw_record``: the record as compact key-sorted
    JSON, or the text of the unreadable document.
    """
    return read_records(split_documents(documents), spec)
