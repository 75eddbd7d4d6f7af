"""Run requests and fetched pages -> landing table and run manifests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.identifiers import utc_wall_time
from lakegate.operators.landing import (
    CONFLICT,
    CONTENT_DIFFERS,
    EXISTING,
    disposition,
    page_contract,
    with_checksum,
    with_landing_keys,
)
from lakegate.operators.reconcile import first_gaps, within_run
from lakegate.operators.runs import (
    NEW,
    RESUME,
    RunDefaults,
    admit_runs,
    manifest_objects,
    run_manifests,
    validate_requests,
    with_fingerprint,
)
from lakegate.plans.staging import stage
from lakegate.sinks import write_landing, write_manifest_objects, write_manifests
from lakegate.sinks.objects import claimed_runs
from lakegate.sources.documents import of_runs, read_landing_table
from lakegate.sources.tables import read_manifests

API_ERROR = "ApiResponseError"
LANDING_ERROR = "LandingConflictError"


@dataclass(frozen=True)
class IngestOutcome:
    """Decisions on all requests, and the manifests of the runs that were let in."""

    decisions: DataFrame
    manifests: DataFrame
    objects: DataFrame


def judge_pages(pages: DataFrame, active: DataFrame) -> DataFrame:
    """Pages of active runs with contract verdict, metrics, landing key and checksum."""
    settings = active.select(
        "run_id", "indicator", "start_page", F.col("started_at").alias("ingested_at")
    )
    known = pages.select("run_id", "page", "raw_text").join(settings, "run_id")
    mismatch = F.when(
        ~F.col("page").eqNullSafe(F.col("returned_page")),
        F.concat(
            F.lit("Requested page "),
            F.col("page").cast("string"),
            F.lit(", but the API returned page "),
            F.coalesce(F.col("returned_page").cast("string"), F.lit("none")),
        ),
    )
    return with_checksum(with_landing_keys(page_contract(known))).withColumn(
        "problem", F.coalesce("violation", mismatch)
    )


def first_failures(active: DataFrame, inside: DataFrame, disposed: DataFrame) -> DataFrame:
    """The earliest page at which each run stopped, with error type and message.

    A run is fetched page by page, so nothing after that page counts as landed;
    a run without its first page has failed there.
    """
    broken = inside.filter(F.col("problem").isNotNull()).select(
        "run_id", "page", F.lit(API_ERROR).alias("type"), F.col("problem").alias("message")
    )
    conflicting = disposed.filter(F.col("disposition") == CONFLICT).select(
        "run_id",
        "page",
        F.lit(LANDING_ERROR).alias("type"),
        F.concat(F.lit(CONTENT_DIFFERS), F.col("path")).alias("message"),
    )
    absent = first_gaps(active, inside).select(
        "run_id",
        "page",
        F.lit(API_ERROR).alias("type"),
        F.concat(F.lit("Page "), F.col("page").cast("string"), F.lit(" was not returned")).alias(
            "message"
        ),
    )
    failures = broken.union(conflicting).union(absent)
    return (
        failures.groupBy("run_id")
        .agg(F.min(F.struct("page", "type", "message")).alias("failure"))
        .select(
            "run_id",
            F.col("failure.page").alias("failed_page"),
            F.col("failure.type").alias("error_type"),
            F.col("failure.message").alias("error_message"),
        )
    )


def run_ingest(
    spark: SparkSession,
    requests: DataFrame,
    pages: DataFrame,
    *,
    landing_path: str,
    manifest_root: str,
    defaults: RunDefaults = RunDefaults(),
) -> IngestOutcome:
    """Admit requests, land their pages and write the manifests.

    ``requests``: ``request_text, default_run_id, requested_at, finished_at``.
    ``pages``: ``run_id, page`` (as requested), ``raw_text``; a page that comes
    twice with one content counts once, with two it conflicts. A run that is
    already complete is skipped, one that reuses a run id for another source is
    refused, and an interrupted one resumes: its pages that landed before come
    out as ``EXISTING``. Every run that is let in has a RUNNING manifest before
    its first page lands, so a run that breaks off anywhere resumes under its
    first landing date. Runs are claimed before their manifests are read: while
    one ingest works on a run, another of that run is refused with
    :class:`~lakegate.sinks.objects.RunClaimedError` and lands nothing.
    """
    checked = stage(with_fingerprint(validate_requests(requests, defaults), defaults), "requests")
    valid = checked.filter(F.col("request_error").isNull())
    with claimed_runs(spark, valid.select("run_id"), manifest_root):
        return _land(spark, valid, pages, landing_path, manifest_root)


def _land(
    spark: SparkSession, valid: DataFrame, pages: DataFrame, landing_path: str, manifest_root: str
) -> IngestOutcome:
    """Decide on valid requests, land pages and write manifests while the runs are claimed."""
    # Staged because the manifests it is decided on are replaced further down.
    decisions = stage(admit_runs(valid, read_manifests(spark, manifest_root, valid.select("run_id"))), "decisions")
    # Identical requests at the same moment are all let in, and make one run.
    active = decisions.filter(F.col("decision").isin(NEW, RESUME)).dropDuplicates(["run_id"])
    active = stage(active, "active-runs")
    write_manifests(_started(active), manifest_root)

    judged = stage(judge_pages(pages, active), "judged-pages")
    # The texts stay in the staged pages until the few that are new are written.
    slim = judged.drop("raw_text").dropDuplicates(["run_id", "page", "sha256"])
    inside = within_run(slim, F.col("problem").isNull())
    sound = inside.filter(F.col("problem").isNull())
    disposed = stage(
        disposition(sound, _landed_index(spark, landing_path, decisions), order_by="page"), "disposed-pages"
    )

    failures = stage(first_failures(active, inside, disposed), "run-failures")
    kept = stage(
        disposed.join(failures.select("run_id", "failed_page"), "run_id", "left")
        .filter(F.col("failed_page").isNull() | (F.col("page") < F.col("failed_page")))
        .drop("failed_page"),
        "landable-pages",
    )
    texts = judged.select("path", "sha256", "raw_text").dropDuplicates(["path", "sha256"])
    to_write = kept.filter(F.col("disposition") != EXISTING).join(texts, ["path", "sha256"])
    write_landing(to_write, landing_path)

    runs = active.join(failures, "run_id", "left").withColumn(
        "completed_at", F.col("finished_at")
    )
    manifests = run_manifests(runs, kept)
    objects = manifest_objects(kept)
    write_manifests(manifests, manifest_root)
    write_manifest_objects(objects, manifest_root)
    return IngestOutcome(decisions, manifests, objects)


def _started(active: DataFrame) -> DataFrame:
    """Manifests of runs that have no page yet."""
    none = F.lit(None)
    runs = active.withColumns(
        {
            "completed_at": none.cast("timestamp"),
            "error_type": none.cast("string"),
            "error_message": none.cast("string"),
        }
    )
    nothing = active.limit(0).select(
        "run_id", *(none.cast("bigint").alias(c) for c in ("page", "total_pages", "record_count", "source_bytes"))
    )
    return run_manifests(runs, nothing)


def _landed_index(spark: SparkSession, landing_path: str, decisions: DataFrame) -> DataFrame:
    """Paths and checksums of what the active runs landed before.

    A run's pages land under the date of its first start. The keys of the active runs meet the
    partition columns of the landing table in a join, by which Spark prunes its partitions.
    """
    try:
        landed = read_landing_table(spark, landing_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, sha256 string")
    active = decisions.filter(F.col("decision").isin(NEW, RESUME))
    moment = utc_wall_time(F.col("started_at"), dict(active.dtypes)["started_at"])
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    keys = active.select("run_id", *(F.date_format(moment, form).alias(name) for name, form in parts.items()))
    return of_runs(landed, keys.distinct()).select("path", "sha256")
