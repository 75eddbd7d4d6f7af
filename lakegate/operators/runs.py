"""Run control: request validation, admission and run manifests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.functions.evaluation import with_computed
from lakegate.functions.hot_keys import with_first_of_key
from lakegate.functions.identifiers import (
    COUNTRY_PATTERN,
    INDICATOR_PATTERN,
    RUN_ID_PATTERN,
    SOURCE_PREFIX,
    source_fingerprint,
)
from lakegate.functions.json_text import (
    allow_duplicate_keys,
    is_one_json_value,
    object_at,
    parse_in_array,
    variant_at,
)

# Request fields, decisions, run states and dataset name.
REQUEST_FIELDS = ("run_id", "country", "indicator", "start_page", "per_page")
NEW, SKIP, RESUME, CONFLICT_RUN = "NEW", "SKIP", "RESUME", "CONFLICT"
RUNNING, COMPLETED, FAILED = "RUNNING", "COMPLETED", "FAILED"
MANIFEST_DATASET = "world_bank_indicator"

# Messages of request validation.
NOT_AN_OBJECT = "Lambda event must be a JSON object"
UNSUPPORTED_FIELDS = "Lambda event contains unsupported fields: "
BAD_RUN_ID = "run_id must be 1-64 characters using only letters, numbers, hyphens, and underscores"
BAD_IDENTIFIER = "{field} contains unsupported characters"
BAD_NUMBER = "{field} must be a positive integer"

# Pages per manifest part. One row never holds more objects than this, however
# long its run is; a run of up to this many pages is a single part.
PAGES_PER_PART = 1000


# Settings for whatever a request leaves out.
@dataclass(frozen=True)
class RunDefaults:
    """Source settings for whatever a request leaves out."""

    api_base_url: str = "https://api.worldbank.org/v2"
    country: str = "USA"
    indicator: str = "SP.POP.TOTL"
    start_page: int = 1
    per_page: int = 25

    def __post_init__(self) -> None:
        for name in ("start_page", "per_page"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than zero")


# ---------------------------------------------------------------------------
# Requests


def validate_requests(requests: DataFrame, defaults: RunDefaults = RunDefaults()) -> DataFrame:
    """Add the five settings and ``request_error`` (NULL for a valid request).

    ``requests`` holds ``request_text`` (a JSON object; NULL asks for all
    defaults) and ``default_run_id``, used when the request names no run.
    """
    allow_duplicate_keys(requests.sparkSession)
    parsed = requests.withColumn("_in_array", parse_in_array(F.col("request_text"))).withColumn(
        "_request",
        F.when(F.col("request_text").isNull(), F.parse_json(F.lit("{}"))).when(
            is_one_json_value(F.col("_in_array"), F.col("request_text")),
            variant_at(F.col("_in_array"), "$[0]"),
        ),
    )
    # JSON null asks for the defaults like an absent request does.
    opened = parsed.withColumn(
        "_members",
        F.when(F.is_variant_null("_request"), object_at(F.parse_json(F.lit("{}")))).otherwise(
            object_at(F.col("_request"))
        ),
    )

    # Kind and text of every field first, so that each is computed once.
    read = opened.withColumns(
        {f"_{name}": F.try_element_at(F.col("_members"), F.lit(name)) for name in REQUEST_FIELDS}
    ).withColumns(
        {
            **{
                f"_{name}_kind": F.coalesce(F.schema_of_variant(f"_{name}"), F.lit("VOID"))
                for name in REQUEST_FIELDS
            },
            **{
                f"_{name}_text": F.try_variant_get(f"_{name}", "$", "string")
                for name in REQUEST_FIELDS
            },
        }
    )

    def kind(name: str) -> Column:
        return F.col(f"_{name}_kind")

    def text(name: str) -> Column:
        return F.col(f"_{name}_text")

    def absent(name: str) -> Column:
        return F.col(f"_{name}").isNull()

    # An empty value of any kind counts as "no run named".
    names_no_run = (
        (kind("run_id") == "VOID")
        | text("run_id").isin("", "[]", "{}")
        | ((kind("run_id") == "BOOLEAN") & (text("run_id") == "false"))
        | (
            kind("run_id").rlike("^(BIGINT|DECIMAL|DOUBLE)")
            & (text("run_id").try_cast("double") == 0)
        )
    )
    settings = {
        "run_id": F.when(names_no_run, F.col("default_run_id")).when(
            kind("run_id") == "STRING", text("run_id")
        )
    }
    for name, default in (("country", defaults.country), ("indicator", defaults.indicator)):
        settings[name] = F.when(absent(name), F.lit(default)).when(
            kind(name) == "STRING", text(name)
        )
    for name, default in (("start_page", defaults.start_page), ("per_page", defaults.per_page)):
        settings[name] = F.when(absent(name), F.lit(default).cast("bigint")).when(
            kind(name) == "BIGINT", text(name).try_cast("bigint")
        )

    extra = F.sort_array(
        F.array_except(F.map_keys("_members"), F.array(*[F.lit(n) for n in REQUEST_FIELDS]))
    )
    judged = with_computed(read, {**settings, "_extra": extra})

    def breaks(name: str, pattern: str) -> Column:
        return ~F.coalesce(F.col(name).rlike(pattern), F.lit(False))

    error = F.coalesce(
        F.when(F.col("_members").isNull(), F.lit(NOT_AN_OBJECT)),
        F.when(
            F.size("_extra") > 0,
            F.concat(F.lit(UNSUPPORTED_FIELDS), F.array_join("_extra", ", ")),
        ),
        F.when(breaks("run_id", RUN_ID_PATTERN), F.lit(BAD_RUN_ID)),
        *[
            F.when(breaks(name, pattern), F.lit(BAD_IDENTIFIER.format(field=name)))
            for name, pattern in (("country", COUNTRY_PATTERN), ("indicator", INDICATOR_PATTERN))
        ],
        *[
            F.when(
                ~F.coalesce(F.col(name) > 0, F.lit(False)),
                F.lit(BAD_NUMBER.format(field=name)),
            )
            for name in ("start_page", "per_page")
        ],
    )
    return judged.select(*requests.columns, *settings, error.alias("request_error"))


def with_fingerprint(runs: DataFrame, defaults: RunDefaults = RunDefaults()) -> DataFrame:
    return runs.withColumn(
        "config_fingerprint",
        source_fingerprint(
            F.lit(defaults.api_base_url),
            F.col("country"),
            F.col("indicator"),
            F.col("start_page"),
            F.col("per_page"),
        ),
    )


def admit_runs(requests: DataFrame, manifests: DataFrame) -> DataFrame:
    """Add ``decision``, ``replayed`` and the effective ``started_at`` to each request.

    ``requests`` holds ``run_id, config_fingerprint, requested_at``; ``manifests``
    one row per run with ``run_id, config_fingerprint, status, started_at``. A
    resumed run keeps its first start, and with it its landing date.

    Requests for one run in the same batch take their turns: the earliest decides
    as above, a later one finds the run taken and is skipped, or refused if it
    names another source.
    """
    turn = ["requested_at", "config_fingerprint"]
    queued = with_first_of_key(requests, "run_id", turn, "_first")
    known = manifests.select(
        "run_id",
        F.col("config_fingerprint").alias("_known_fingerprint"),
        F.col("status").alias("_known_status"),
        F.col("started_at").alias("_known_start"),
        F.lit(True).alias("_known"),
    )
    is_known = F.col("_known").isNotNull()
    is_first = F.struct(*turn) == F.col("_first")
    owner = F.when(is_known, F.col("_known_fingerprint")).otherwise(
        F.col("_first.config_fingerprint")
    )
    decision = (
        F.when(~owner.eqNullSafe(F.col("config_fingerprint")), CONFLICT_RUN)
        .when(~is_first | (F.col("_known_status") == COMPLETED), SKIP)
        .when(is_known, RESUME)
        .otherwise(NEW)
    )
    decided = queued.join(known, "run_id", "left").withColumns(
        {
            "decision": decision,
            "started_at": F.coalesce(F.col("_known_start"), F.col("_first.requested_at")),
        }
    )
    return decided.select(
        *requests.columns,
        "decision",
        F.col("decision").isin(SKIP, RESUME).alias("replayed"),
        "started_at",
    )


# ---------------------------------------------------------------------------
# Manifests


def run_manifests(runs: DataFrame, objects: DataFrame) -> DataFrame:
    """One manifest row per run: settings, state and totals over its objects.

    ``runs`` holds the settings, ``started_at``, ``completed_at``, ``replayed``,
    ``error_type`` and ``error_message``; ``objects`` one row per landed page
    with ``run_id, page, total_pages, record_count, source_bytes``. Totals are
    summed before the shuffle; the objects themselves stay in their own table
    (see :func:`manifest_objects`), because one run may hold any share of them.
    """
    totals = objects.groupBy("run_id").agg(
        F.max_by("total_pages", "page").cast("bigint").alias("pages_expected"),
        F.count(F.lit(1)).alias("pages_landed"),
        F.sum("record_count").cast("bigint").alias("record_count"),
        F.sum("source_bytes").cast("bigint").alias("source_bytes"),
    )
    status = (
        F.when(F.col("error_type").isNotNull(), FAILED)
        .when(F.col("completed_at").isNull(), RUNNING)
        .otherwise(COMPLETED)
    )
    none = F.lit(0).cast("bigint")
    return runs.join(totals, "run_id", "left").select(
        "run_id",
        F.lit(MANIFEST_DATASET).alias("dataset"),
        status.alias("status"),
        "started_at",
        "completed_at",
        "country",
        "indicator",
        "start_page",
        "per_page",
        "config_fingerprint",
        "replayed",
        "pages_expected",
        F.coalesce("pages_landed", none).alias("pages_landed"),
        F.coalesce("record_count", none).alias("record_count"),
        F.coalesce("source_bytes", none).alias("source_bytes"),
        F.when(
            F.col("error_type").isNotNull(),
            F.struct(F.col("error_type").alias("type"), F.col("error_message").alias("message")),
        ).alias("error"),
    )


def manifest_objects(objects: DataFrame) -> DataFrame:
    """The ``objects`` of each manifest in page order, cut into bounded parts.

    ``run_id, part, objects``: part 0 holds pages 0 to ``PAGES_PER_PART - 1``
    and so on. A run lands a page once, so a part never outgrows that size.
    """
    entry = F.struct(
        "page", "record_count", "source_bytes", "path", "sha256", "disposition"
    )
    return (
        objects.withColumn("part", F.floor(F.col("page") / PAGES_PER_PART).cast("int"))
        .groupBy("run_id", "part")
        .agg(F.sort_array(F.collect_list(entry)).alias("objects"))
    )


def run_summaries(manifests: DataFrame, manifest_root: str) -> DataFrame:
    """What the caller of a run gets back."""
    return manifests.select(
        "status",
        "run_id",
        "country",
        "indicator",
        F.col("pages_landed").alias("pages"),
        F.col("record_count").alias("records"),
        "source_bytes",
        F.concat(
            F.lit(f"{manifest_root.rstrip('/')}/{SOURCE_PREFIX}/run_id="), F.col("run_id")
        ).alias("manifest_uri"),
        "replayed",
    )
