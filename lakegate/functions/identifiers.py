"""Landing keys, checksums, run identifiers and configuration fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of run ids, source identifiers and landing paths.
RUN_ID_PATTERN = r"\A[A-Za-z0-9][A-Za-z0-9_-]{0,63}\z"
COUNTRY_PATTERN = r"\A[A-Za-z0-9;]{2,64}\z"
INDICATOR_PATTERN = r"\A[A-Za-z0-9.]{2,64}\z"
SOURCE_PREFIX = "world_bank"
LANDING_PATH_PATTERN = (
    r"/year=(\d{4,})/month=(\d{2})/day=(\d{2})/run_id=([^/]+)/([^/]+)_page_(\d{5,})\.json\z"
)


def utc_wall_time(timestamp: Column, type_name: str) -> Column:
    """UTC wall-clock time; a ``timestamp_ntz`` column is taken to be UTC already."""
    if type_name == "timestamp_ntz":
        return timestamp
    return F.convert_timezone(None, F.lit("UTC"), timestamp.cast("timestamp_ntz"))


def landing_file_name(indicator: Column, page: Column) -> Column:
    stem = F.lower(F.replace(indicator, F.lit("."), F.lit("_")))
    # lpad would cut a number that is wider than the padding; %05d does not.
    return F.concat(stem, F.format_string("_page_%05d.json", page))


def content_sha256(text: Column) -> Column:
    """SHA-256 over the exact UTF-8 bytes of a text column."""
    return F.sha2(text.cast("binary"), 256)


def source_fingerprint(
    api_base_url: Column, country: Column, indicator: Column, page: Column, per_page: Column
) -> Column:
    """SHA-256 over the source settings as key-sorted JSON with ``", "`` and ``": "``.

    Only what identifies the source goes in: timeouts and retries stay out, so
    changing them never makes a resumed run look like another source.
    """

    def quoted(text: Column) -> Column:
        in_brackets = F.to_json(F.array(text))
        return F.substring(in_brackets, F.lit(2), F.length(in_brackets) - 2)

    body = F.concat(
        F.lit('{"api_base_url": '),
        quoted(api_base_url),
        F.lit(', "country": '),
        quoted(country),
        F.lit(', "indicator": '),
        quoted(indicator),
        F.lit(', "page": '),
        page.cast("string"),
        F.lit(', "per_page": '),
        per_page.cast("string"),
        F.lit("}"),
    )
    return content_sha256(body)


def manifest_bucket(run_id: Column) -> Column:
    """One of sixteen buckets a run's manifests are kept in."""
    return F.substring(F.md5(run_id.cast("binary")), 1, 1)


def manifest_folder(root: str) -> str:
    return f"{root.rstrip('/')}/{SOURCE_PREFIX}"


def manifest_objects_folder(root: str) -> str:
    return f"{root.rstrip('/')}/{SOURCE_PREFIX}_objects"
