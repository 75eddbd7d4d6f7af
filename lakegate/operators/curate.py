"""Parsed events -> processed rows and rejected rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.functions.casts import lenient_double, lenient_int
from lakegate.operators.parse import read_records, split_documents
from lakegate.records import (
    CODE,
    DOUBLE,
    INDICATOR_OBSERVATIONS,
    INT,
    NOT_BLANK,
    PRESENT,
    REJECTED_COLUMNS,
    TEXT,
    Field,
    RecordSpec,
)

# Fixed value: reason of every row but the first of its business key.
DUPLICATE_BUSINESS_KEY = "DUPLICATE_BUSINESS_KEY"

# Lanes a business key is spread over before its winners meet in one group. It
# bounds both ends: a key with a third of all rows is ranked in this many
# separate groups, and at most this many rows of a key reach the last ranking.
DEDUP_LANES = 16384


@dataclass(frozen=True)
class TransformResult:
    """Two lazy views of one classified plan."""

    processed: DataFrame
    rejected: DataFrame


def _typed(field: Field) -> Column:
    raw = F.col(field.raw_name)
    return {
        TEXT: F.trim(raw),
        CODE: F.upper(F.trim(raw)),
        INT: lenient_int(raw),
        DOUBLE: lenient_double(raw),
    }[field.kind]


def normalize(events: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS) -> DataFrame:
    """Add the trimmed, upper-cased and cast columns next to the raw ones."""
    return events.withColumns({f.name: _typed(f) for f in spec.fields})


def validation_reason(spec: RecordSpec = INDICATOR_OBSERVATIONS) -> Column:
    """First failed check in field order, or NULL for a valid record."""
    checks: list[tuple[Column, str]] = []
    for f in spec.fields:
        typed, raw, label = F.col(f.name), F.col(f.raw_name), f.name.upper()
        if f.required == NOT_BLANK:
            checks.append((typed.isNull() | (typed == ""), f"NULL_{label}"))
        if f.required == PRESENT:
            checks.append((raw.isNull(), f"NULL_{label}"))
        if f.kind in (INT, DOUBLE):
            checks.append((raw.isNotNull() & typed.isNull(), f"INVALID_{label}"))
    return F.coalesce(*[F.when(failed, F.lit(reason)) for failed, reason in checks])


def validate(events: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS) -> DataFrame:
    """Fill ``rejection_reason`` for candidates that fail validation."""
    return normalize(events, spec).withColumn(
        "rejection_reason", F.coalesce(F.col("rejection_reason"), validation_reason(spec))
    )


def mark_duplicates(
    validated: DataFrame,
    spec: RecordSpec = INDICATOR_OBSERVATIONS,
    lanes: int = DEDUP_LANES,
) -> DataFrame:
    """Reject every valid row but the first of its business key.

    First means lowest ``(source_file, source_record_index)``. The ranking runs
    in two windows so that no key has to fit into one task: rows are ranked
    within ``(key, lane)``, where the lane is a hash of the row's origin, and
    then only the lane winners of a key are ranked against each other. Rows that
    are already out (invalid, or beaten in their lane) keep a hash of their own
    as the group, which spreads them evenly instead of piling them on one key.
    """
    is_valid = F.col("rejection_reason").isNull()
    origin = F.xxhash64("source_file", "source_record_index")
    order = origin_order(validated)

    by_lane = Window.partitionBy("_valid", *spec.business_key, "_lane").orderBy(*order)
    by_key = Window.partitionBy("_contender", *spec.business_key, "_lane").orderBy(*order)
    is_contender = F.col("_valid") & (F.col("_lane_rank") == 1)
    lane = F.when(is_valid, F.pmod(origin, F.lit(lanes))).otherwise(origin)
    ranked = (
        validated.withColumns({"_valid": is_valid, "_lane": lane})
        .withColumn("_lane_rank", F.row_number().over(by_lane))
        .withColumns({"_contender": is_contender, "_lane": F.when(~is_contender, origin)})
        .withColumn("_key_rank", F.row_number().over(by_key))
    )
    beaten = F.col("_valid") & ((F.col("_lane_rank") > 1) | (F.col("_key_rank") > 1))
    return ranked.withColumn(
        "rejection_reason",
        F.when(beaten, F.lit(DUPLICATE_BUSINESS_KEY)).otherwise(F.col("rejection_reason")),
    ).drop("_valid", "_lane", "_lane_rank", "_contender", "_key_rank")


def classify_split(split: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS) -> DataFrame:
    """Split documents -> every event with its final ``rejection_reason``.

    ``rejection_reason`` is NULL for a processed row; only the other rows keep
    their ``raw_record``.
    """
    return mark_duplicates(validate(read_records(split, spec), spec), spec).select(
        *spec.processed_columns,
        "rejection_reason",
        F.when(F.col("rejection_reason").isNotNull(), F.col("raw_record")).alias("raw_record"),
    )


def classify_documents(
    documents: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS
) -> DataFrame:
    return classify_split(split_documents(documents), spec)


def first_rows(validated: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS) -> DataFrame:
    """Processed rows: of the valid rows of each business key the one :func:`mark_duplicates` keeps.

    One aggregate, so that the first row of a key is found before the only shuffle: a key with
    a third of all rows leaves each task as one row. Rejected rows and record texts are in no
    exchange.
    """
    others = [name for name in spec.processed_columns if name not in spec.business_key]
    first = F.min_by(F.struct(*others), F.col("_origin"))
    # Behind a one-row inline, so that the sort of the aggregate holds the hash and not the text.
    origin = F.struct(F.struct(*origin_order(validated)).alias("_origin"))
    valid = validated.filter(F.col("rejection_reason").isNull())
    lean = valid.select(*spec.processed_columns, F.inline(F.array(origin)))
    winners = lean.groupBy(*spec.business_key).agg(first.alias("_first"))
    return winners.select(*spec.business_key, "_first.*").select(*spec.processed_columns)


def origin_order(events: DataFrame) -> list[Column]:
    """Order of rows with one key. A file that is read twice gives two rows of one origin; the
    texts then decide, by hash, so that every plan over the same rows keeps the same one."""
    text = [F.xxhash64("raw_record")] if "raw_record" in events.columns else []
    return [F.col("source_file"), F.col("source_record_index"), *text]


def select_processed(
    classified: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS
) -> DataFrame:
    return classified.filter(F.col("rejection_reason").isNull()).select(*spec.processed_columns)


def select_rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("rejection_reason").isNotNull()).select(*REJECTED_COLUMNS)


def transform_documents(
    documents: DataFrame, spec: RecordSpec = INDICATOR_OBSERVATIONS
) -> TransformResult:
    """Flatten, cast, validate and deduplicate documents.

    Either side has the plan that it needs alone: the processed rows one aggregate, the
    rejected ones, of which no key can be summed up, the two rankings.
    """
    validated = validate(read_records(split_documents(documents), spec), spec)
    return TransformResult(
        processed=first_rows(validated, spec),
        rejected=select_rejected(classify_documents(documents, spec)),
    )
