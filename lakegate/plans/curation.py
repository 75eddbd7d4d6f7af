"""Documents -> curated tables, published only if they pass the quality policy."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakegate.operators.curate import TransformResult, mark_duplicates, validate
from lakegate.operators.parse import read_records, split_documents
from lakegate.operators.quality import (
    FAIL,
    INDICATOR_QUALITY_POLICY,
    DataQualityConfig,
    DataQualityFailure,
    DataQualityResult,
    evaluate_quality,
)
from lakegate.operators.reconcile import declared_total, total_in_metadata
from lakegate.plans.staging import stage
from lakegate.records import INDICATOR_OBSERVATIONS, REJECTED_COLUMNS, RecordSpec
from lakegate.sinks import (
    run_output_path,
    write_quality_result,
    write_rejected,
    write_transform_result,
)
from lakegate.sources.documents import only_runs, read_documents, read_run_documents


@dataclass(frozen=True)
class CurationOutcome:
    quality: DataQualityResult
    processed_path: str
    rejected_path: str
    quality_path: str


def stage_classified(
    documents: DataFrame, name: str, spec: RecordSpec = INDICATOR_OBSERVATIONS
) -> tuple[TransformResult, int | None]:
    """Read, parse, validate and write all events once; also the declared total.

    The total is observed while the documents stream past, so the source is
    scanned a single time. It is a minimum and a maximum: a task that runs twice
    after a lost executor leaves both unchanged.

    Duplicates are found on key, origin and row number of the valid rows alone;
    the rows themselves, and their JSON text, meet the losers by row number and
    so pass through one exchange at most (none while the losers are few).
    """
    observed = Observation()
    total = total_in_metadata(F.col("raw_text"))
    watched = documents.observe(observed, F.min(total).alias("low"), F.max(total).alias("high"))
    reason = F.col("rejection_reason")
    validated = validate(read_records(split_documents(watched), spec), spec).select(
        *spec.processed_columns, "rejection_reason", "raw_record"
    )
    staged = stage(
        validated.withColumns({"is_valid": reason.isNull(), "row_id": F.monotonically_increasing_id()}),
        name,
        partition_by="is_valid",
    )
    valid, broken = staged.filter("is_valid"), staged.filter("NOT is_valid")
    slim = valid.select(
        "row_id", *spec.business_key, "source_file", "source_record_index", "rejection_reason"
    )
    beaten = mark_duplicates(slim, spec).filter(reason.isNotNull()).select("row_id", "rejection_reason")
    beaten = stage(beaten, f"{name}-duplicates")
    duplicates = valid.drop("rejection_reason").join(beaten, "row_id")
    result = TransformResult(
        processed=valid.join(beaten.select("row_id"), "row_id", "left_anti").select(*spec.processed_columns),
        rejected=broken.select(*REJECTED_COLUMNS).union(duplicates.select(*REJECTED_COLUMNS)),
    )
    return result, _observed_total(observed, documents)


def _observed_total(observed: Observation, documents: DataFrame) -> int | None:
    try:
        totals = observed.get
    except Py4JJavaError as error:
        # Without a single event Spark drops the branch that watched the documents,
        # and a row without metrics cannot be read. Anything else is a failure.
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return declared_total(documents).first().expected_rows
    return totals["high"] if totals["low"] == totals["high"] else None


def run_curation(
    spark: SparkSession,
    source: str | DataFrame,
    *,
    processed_base: str,
    rejected_base: str,
    quality_base: str,
    run_id: str,
    policy: DataQualityConfig = INDICATOR_QUALITY_POLICY,
    spec: RecordSpec = INDICATOR_OBSERVATIONS,
    source_run_ids: list[str] | None = None,
    evaluated_at: datetime | None = None,
) -> CurationOutcome:
    """Curate ``source`` (a landing folder or a documents frame) under ``run_id``.

    The quality result is written first. If it fails, only the rejected rows
    follow and :class:`DataQualityFailure` is raised; a processed table exists
    only for a passing run. A passing result therefore means "may publish"; the
    processed table is complete once its own write has committed.
    """
    if not isinstance(source, str):
        documents = source if source_run_ids is None else only_runs(source, source_run_ids)
    elif source_run_ids is None:
        documents = read_documents(spark, source)
    else:
        documents = read_run_documents(spark, source, source_run_ids)
    result, expected = stage_classified(documents, f"classified-{run_id}", spec)

    quality = evaluate_quality(
        result.processed,
        result.rejected,
        run_id=run_id,
        config=policy,
        expected_row_count=expected,
        evaluated_at=evaluated_at,
    )
    outcome = CurationOutcome(
        quality=quality,
        processed_path=run_output_path(processed_base, run_id),
        rejected_path=run_output_path(rejected_base, run_id),
        quality_path=f"{run_output_path(quality_base, run_id)}/result.json",
    )
    write_quality_result(spark, quality, outcome.quality_path)
    if quality.status == FAIL:
        write_rejected(result.rejected, outcome.rejected_path)
        raise DataQualityFailure(
            f"Data quality failed for run {run_id}; see {outcome.quality_path}"
        )
    write_transform_result(result, outcome.processed_path, outcome.rejected_path)
    return outcome
