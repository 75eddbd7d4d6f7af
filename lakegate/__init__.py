"""Spark operators from landed JSON pages to curated tables behind a quality gate."""

from lakegate.operators.curate import TransformResult, classify_documents, transform_documents
from lakegate.operators.parse import parse_documents
from lakegate.operators.quality import (
    DataQualityConfig,
    DataQualityFailure,
    DataQualityResult,
    RuleResult,
    evaluate_quality,
)
from lakegate.operators.reconcile import declared_total
from lakegate.plans.compaction import compact_files
from lakegate.plans.curation import run_curation
from lakegate.plans.ingest import run_ingest
from lakegate.records import INDICATOR_OBSERVATIONS, Field, RecordSpec
from lakegate.sinks import run_output_path, write_quality_result, write_transform_result
from lakegate.sources.documents import read_documents

__all__ = [
    "DataQualityConfig",
    "DataQualityFailure",
    "DataQualityResult",
    "Field",
    "INDICATOR_OBSERVATIONS",
    "RecordSpec",
    "RuleResult",
    "TransformResult",
    "classify_documents",
    "compact_files",
    "declared_total",
    "evaluate_quality",
    "parse_documents",
    "read_documents",
    "run_curation",
    "run_ingest",
    "run_output_path",
    "transform_documents",
    "write_quality_result",
    "write_transform_result",
]
