"""Landing of raw pages: keys, checksums, dispositions and the page contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.functions.evaluation import with_computed
from lakegate.functions.hot_keys import LANES, with_first_of_key
from lakegate.functions.identifiers import (
    LANDING_PATH_PATTERN,
    SOURCE_PREFIX,
    content_sha256,
    landing_file_name,
    utc_wall_time,
)
from lakegate.functions.json_text import (
    allow_duplicate_keys,
    is_json_number,
    is_json_string,
    object_at,
    variant_at,
    whole_number,
    whole_text,
    with_page_parts,
)

WRITTEN = "WRITTEN"
EXISTING = "EXISTING"
CONFLICT = "CONFLICT"

# What a page must hold, in the order in which it is checked.
METADATA_NUMBERS = ("page", "pages", "per_page", "total")
RECORD_KEYS = ("country", "countryiso3code", "date", "indicator", "value")
NESTED_KEYS = ("country", "indicator")

# Messages of the page contract.
INVALID_JSON = "World Bank API returned invalid JSON"
NOT_A_PAIR = "Expected a two-item World Bank response array"
METADATA_NOT_OBJECT = "Expected response metadata to be an object"
RECORDS_NOT_ARRAY = "Expected response records to be an array"
METADATA_INCOMPLETE = "Response metadata is missing fields: "
RECORD_NOT_OBJECT = "Expected every response record to be an object"
NUMBER_NOT_INTEGER = "Response metadata field {field} must be an integer"
NUMBER_TOO_SMALL = "Response metadata field {field} must be at least {minimum}"
RECORD_PREFIX = "Record "
RECORD_INCOMPLETE = " is missing required fields: "
NESTED_NOT_STRING = " field {field} must contain a string {child}"
TEXT_EMPTY = " field {field} must be a non-empty string"
VALUE_NOT_NUMBER = " field value must be numeric or null"

# Fixed value: message of a landing conflict, before the path.
CONTENT_DIFFERS = "Landing object already exists with different content: "


class LandingConflictError(RuntimeError):
    """Raised when a landing key would receive different content."""


# ---------------------------------------------------------------------------
# Keys and checksums


def with_landing_keys(pages: DataFrame, root: str = "landing") -> DataFrame:
    """Add ``year, month, day`` and ``path`` from ``ingested_at, run_id, indicator, page``."""
    moment = utc_wall_time(F.col("ingested_at"), dict(pages.dtypes)["ingested_at"])
    dated = pages.withColumns(
        {
            "year": F.date_format(moment, "yyyy"),
            "month": F.date_format(moment, "MM"),
            "day": F.date_format(moment, "dd"),
        }
    )
    path = F.concat(
        F.lit(f"{root.rstrip('/')}/{SOURCE_PREFIX}/year="),
        F.col("year"),
        F.lit("/month="),
        F.col("month"),
        F.lit("/day="),
        F.col("day"),
        F.lit("/run_id="),
        F.col("run_id"),
        F.lit("/"),
        landing_file_name(F.col("indicator"), F.col("page")),
    )
    return dated.withColumn("path", path)


def landing_path_columns(documents: DataFrame, path: str = "source_file") -> DataFrame:
    """Read date, run, indicator stem and page back out of landing paths.

    Filters on the new columns are plain predicates over the path, so they apply
    before any document is parsed.
    """

    def part(group: int) -> Column:
        text = F.regexp_extract(F.col(path), LANDING_PATH_PATTERN, group)
        return F.when(text != "", text)

    return documents.withColumns(
        {
            "year": part(1).try_cast("int"),
            "month": part(2).try_cast("int"),
            "day": part(3).try_cast("int"),
            "run_id": part(4),
            "indicator_stem": part(5),
            "page": part(6).try_cast("int"),
        }
    )


def with_checksum(pages: DataFrame, text: str = "raw_text") -> DataFrame:
    return pages.withColumn("sha256", content_sha256(F.col(text)))


# ---------------------------------------------------------------------------
# Disposition


def disposition(
    incoming: DataFrame, landed: DataFrame, order_by: str = "arrival", lanes: int = LANES
) -> DataFrame:
    """Decide for every incoming page what landing it would do.

    ``incoming`` holds ``path, sha256`` and an ``order_by`` column that orders
    the copies of a path; ``landed`` holds ``path, sha256``.
    The first copy of an unseen path is ``WRITTEN``; any other copy is
    ``EXISTING`` if its checksum equals what the path then holds, and
    ``CONFLICT`` if not.

    One path may have any number of copies: see :func:`with_first_of_key`. The
    landed checksums meet the incoming pages in an equi-join with one row per
    path on their side, which Spark may split for a hot path.
    """
    firsts = with_first_of_key(incoming, "path", [order_by, "sha256"], "_first", lanes)
    # A path that was landed twice counts once; with two contents it conflicts with anything.
    held = landed.groupBy("path").agg(
        F.min("sha256").alias("_landed_sha"), F.max("sha256").alias("_other_sha")
    )
    is_first = F.col("_landed_sha").isNull() & (
        F.struct(F.col(order_by), F.col("sha256")) == F.col("_first")
    )
    same = (F.col("sha256") == F.coalesce(F.col("_landed_sha"), F.col("_first.sha256"))) & (
        F.col("_landed_sha").isNull() | (F.col("_landed_sha") == F.col("_other_sha"))
    )
    return (
        firsts.join(held, "path", "left")
        .withColumn(
            "disposition",
            F.when(is_first, WRITTEN).when(same, EXISTING).otherwise(CONFLICT),
        )
        .select(*incoming.columns, "disposition")
    )


# ---------------------------------------------------------------------------
# Page contract


def _number_violation(field: str) -> Column:
    """What is wrong with one metadata number; NULL if nothing.

    Numbers are cut to whole ones, booleans count as 0 and 1, and text must
    spell a whole number.
    """
    value = variant_at(F.col("_metadata"), f"$.{field}")
    text = whole_text(value)
    is_number, is_boolean = is_json_number(value), F.schema_of_variant(value) == "BOOLEAN"
    minimum = 0 if field == "total" else 1
    amount = F.try_variant_get(value, "$", "double")
    if minimum:
        # At least 1, decided on the digits: text of any length stays exact.
        text_ok = ~text.startswith("-") & text.rlike("[1-9]")
        number_ok, boolean_ok = amount >= 1, F.try_variant_get(value, "$", "boolean")
    else:
        text_ok = ~(text.startswith("-") & text.rlike("[1-9]"))
        number_ok, boolean_ok = amount > -1, F.lit(True)
    enough = (
        F.when(is_number, number_ok).when(is_boolean, boolean_ok).when(text.isNotNull(), text_ok)
    )
    return F.when(enough.isNull(), F.lit(NUMBER_NOT_INTEGER.format(field=field))).when(
        ~enough, F.lit(NUMBER_TOO_SMALL.format(field=field, minimum=minimum))
    )


def _record_violation(record: Column, index: Column) -> Column:
    """First thing wrong with one record; NULL if nothing."""
    members = object_at(record)
    required = F.array(*[F.lit(key) for key in sorted(RECORD_KEYS)])
    missing = F.array_except(required, F.map_keys(members))

    def at(path: str) -> Column:
        return variant_at(record, f"$.{path}")

    def message(text: str) -> Column:
        return F.concat(F.lit(RECORD_PREFIX), index.cast("string"), F.lit(text))

    checks = [
        (
            F.size(missing) > 0,
            F.concat(message(RECORD_INCOMPLETE), F.array_join(missing, ", ")),
        )
    ]
    for key in NESTED_KEYS:
        for child in ("id", "value"):
            checks.append(
                (
                    ~is_json_string(at(f"{key}.{child}")),
                    message(NESTED_NOT_STRING.format(field=key, child=child)),
                )
            )
    for key in ("countryiso3code", "date"):
        empty = ~is_json_string(at(key)) | (F.try_variant_get(record, f"$.{key}", "string") == "")
        checks.append((empty, message(TEXT_EMPTY.format(field=key))))
    value = at("value")
    is_number_or_null = F.is_variant_null(value) | is_json_number(value)
    checks.append((~is_number_or_null, message(VALUE_NOT_NUMBER)))
    return F.coalesce(*[F.when(failed, text) for failed, text in checks])


def page_contract(pages: DataFrame) -> DataFrame:
    """Add ``violation`` and the numbers of each page, from one parse.

    ``violation`` is the first broken rule, NULL for a sound page; the numbers are
    ``returned_page, total_pages, record_count`` and ``source_bytes``, as
    :func:`lakegate.operators.reconcile.page_metrics` gives them. A page is judged
    inside its own row, records included, so there is no explode and no shuffle.
    """
    allow_duplicate_keys(pages.sparkSession)
    opened = with_page_parts(pages).withColumn("_members", object_at(F.col("_metadata")))
    required = F.array(*[F.lit(key) for key in sorted(METADATA_NUMBERS)])
    missing = F.array_except(required, F.map_keys("_members"))
    broken_records = F.filter(
        F.transform("_records", _record_violation), lambda text: text.isNotNull()
    )
    violation = F.coalesce(
        F.when(~F.col("_is_json"), F.lit(INVALID_JSON)),
        F.when(~F.col("_is_pair"), F.lit(NOT_A_PAIR)),
        F.when(F.col("_members").isNull(), F.lit(METADATA_NOT_OBJECT)),
        F.when(F.col("_records").isNull(), F.lit(RECORDS_NOT_ARRAY)),
        F.when(
            F.size(missing) > 0,
            F.concat(F.lit(METADATA_INCOMPLETE), F.array_join(missing, ", ")),
        ),
        F.when(
            F.exists("_records", lambda record: object_at(record).isNull()),
            F.lit(RECORD_NOT_OBJECT),
        ),
        *[_number_violation(field) for field in METADATA_NUMBERS],
        F.try_element_at(broken_records, F.lit(1)),
    )
    return with_computed(opened, {"violation": violation, **page_numbers()}).drop(
        "_is_json", "_is_pair", "_metadata", "_records", "_evidence", "_members"
    )


def page_numbers() -> dict[str, Column]:
    """The numbers of a page opened by :func:`with_page_parts`."""
    return {
        "returned_page": whole_number(variant_at(F.col("_metadata"), "$.page")),
        "total_pages": whole_number(variant_at(F.col("_metadata"), "$.pages")),
        "record_count": F.when(F.col("_is_pair"), F.size("_records")).cast("bigint"),
        "source_bytes": F.octet_length("raw_text").cast("bigint"),
    }
