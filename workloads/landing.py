"""Landing keys, checksums, dispositions, contracts, runs and written outputs."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.identifiers import SOURCE_PREFIX
from lakegate.operators.landing import (
    disposition,
    landing_path_columns,
    page_contract,
    with_checksum,
    with_landing_keys,
)
from lakegate.operators.quality import (
    INDICATOR_QUALITY_POLICY,
    DataQualityFailure,
)
from lakegate.operators.reconcile import (
    declared_total,
    expected_from_landed,
    missing_page_ranges,
    missing_pages,
    page_metrics,
)
from lakegate.operators.runs import (
    admit_runs,
    manifest_objects,
    run_manifests,
    run_summaries,
    validate_requests,
    with_fingerprint,
)
from lakegate.plans.compaction import TABLE_IN_TURN, compact_files, landing_path, packed_scans
from lakegate.plans.curation import run_curation, stage_classified
from lakegate.plans.ingest import run_ingest
from lakegate.plans.staging import stage, staging_root
from lakegate.sinks import write_landing, write_transform_result
from lakegate.sources.documents import of_runs, read_documents, read_landing_table
from lakegate.sources.tables import read_manifests, read_processed
from workloads.curation import QUERIES as CURATION
from workloads.fixtures import PAGE_SIZE, indicator_documents, table, with_documents, write_files

INDICATOR = "SP.POP.TOTL"
PAGES_PER_RUN = 40
# A folder is listed by one task.
FILES_PER_FOLDER = 1000


def _folder(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/lakegate-queries/{name}-{uuid4().hex}"


def _iso(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _run_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture documents as pages of runs of ``PAGES_PER_RUN`` pages each."""
    return indicator_documents(spark, sf_dir).select(
        F.format_string("run-%010d", F.floor(F.col("page") / PAGES_PER_RUN)).alias("run_id"),
        (F.col("page") % PAGES_PER_RUN + 1).cast("int").alias("page"),
        F.lit(INDICATOR).alias("indicator"),
        "ingested_at",
        "raw_text",
        F.col("page").alias("document"),
    )


# ---------------------------------------------------------------------------
# Documents and keys


def declared_totals_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared total of all pages, and of the same pages when every seventh declares its number."""
    documents = indicator_documents(spark, sf_dir)
    own = F.concat(F.lit('"total":'), F.col("page").cast("string"))
    text = F.regexp_replace(F.col("raw_text"), F.lit('"total":[0-9]+'), own)
    differing = documents.withColumn("raw_text", F.when(F.col("page") % 7 == 1, text).otherwise(F.col("raw_text")))
    return reduce(
        DataFrame.unionByName,
        [
            declared_total(pages).withColumn("pages", F.lit(name))
            for name, pages in (("alike", documents), ("differing", differing))
        ],
    )


def declared_total_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared_total(indicator_documents(spark, sf_dir))


def page_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_metrics(indicator_documents(spark, sf_dir)).select(
        "source_file", "returned_page", "total_pages", "record_count", "source_bytes"
    )


def page_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_checksum(indicator_documents(spark, sf_dir)).select("source_file", "sha256")


def page_checksums_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_checksum(table(spark, sf_dir, "pages"), "html")
    return pages.select(
        "page_id", "sha256", F.octet_length("html").cast("bigint").alias("source_bytes")
    )


def landing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_landing_keys(_run_pages(spark, sf_dir)).select("path", "year", "month", "day")


def landing_path_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = with_landing_keys(_run_pages(spark, sf_dir)).select(F.col("path").alias("source_file"))
    return landing_path_columns(paths)


def landing_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page arrives twice; the first half of the month has landed before."""
    pages = with_landing_keys(_run_pages(spark, sf_dir)).select(
        "path", "ingested_at", "raw_text", "document"
    )
    other = F.when(F.col("document") % 11 == 3, F.concat("raw_text", F.lit(" ")))
    landed = pages.filter(F.col("ingested_at") < F.lit("2024-01-16").cast("timestamp_ntz")).select(
        "path", F.coalesce(other, "raw_text").alias("raw_text")
    )
    again = F.when(F.col("document") % 13 == 5, F.concat("raw_text", F.lit("!")))
    copies = F.array(
        F.struct(F.lit(1).alias("arrival"), F.col("raw_text")),
        F.struct(F.lit(2).alias("arrival"), F.coalesce(again, "raw_text").alias("raw_text")),
    )
    incoming = pages.select("path", F.inline(copies))
    return disposition(
        with_checksum(incoming).drop("raw_text"), with_checksum(landed)
    ).select("path", "arrival", "sha256", "disposition")


def landing_disposition_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document texts landing on one path per source, so each path is hot."""
    texts = with_checksum(table(spark, sf_dir, "documents"), "text").select(
        F.concat(F.lit("landing/"), "source").alias("path"), "sha256", "lang", "doc_id"
    )
    landed = (
        texts.filter(F.col("lang") == "en")
        .groupBy("path")
        .agg(F.min_by("sha256", "doc_id").alias("sha256"))
    )
    disposed = disposition(texts, landed, order_by="doc_id")
    return disposed.select("path", "doc_id", "disposition")


def missing_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _run_pages(spark, sf_dir).withColumns(
        {"total_pages": F.lit(PAGES_PER_RUN), "start_page": F.lit(1)}
    )
    landed = pages.filter(F.minute("ingested_at") >= 20)
    return missing_pages(expected_from_landed(landed), landed)


# ---------------------------------------------------------------------------
# Contract

_CONTRACT_RECORD = """
CASE WHEN event_id % 211 = 7 THEN '7'
ELSE '{"indicator":{"id":"EV","value":' || CASE WHEN event_id % 163 = 7 THEN 'null' ELSE '"e"' END
  || '},"country":{"id":' || CASE WHEN event_id % 157 = 7 THEN '5' ELSE '"US"' END || ',"value":"u"}'
  || CASE WHEN event_id % 151 = 7 THEN ''
     ELSE ',"countryiso3code":' || CASE WHEN event_id % 167 = 7 THEN '""' ELSE '"USA"' END
          || ',"date":' || CASE WHEN event_id % 173 = 7 THEN '2001' ELSE '"2001"' END END
  || ',"value":' || CASE WHEN event_id % 179 = 7 THEN 'true' WHEN event_id % 181 = 7 THEN '"1"'
     WHEN event_id % 191 = 7 THEN 'null' ELSE CAST(value AS STRING) END || '}' END
"""
_CONTRACT_METADATA = """
CASE WHEN page % 41 = 4 THEN '[]' ELSE
  '{"page":' || CASE WHEN page % 53 = 4 THEN '"x"' WHEN page % 71 = 4 THEN '1.9' ELSE '1' END
  || ',"pages":' || CASE WHEN page % 59 = 4 THEN '0' WHEN page % 73 = 4 THEN 'false' ELSE '3' END
  || CASE WHEN page % 47 = 4 THEN '' ELSE
     ',"per_page":' || CASE WHEN page % 61 = 4 THEN '" 2_5 "' ELSE '25' END
     || ',"total":' || CASE WHEN page % 67 = 4 THEN '-1' WHEN page % 29 = 4 THEN 'null' ELSE '0' END END
  || '}' END
"""
_CONTRACT_DOCUMENT = f"""
CASE WHEN page % 31 = 4 THEN '[1], [2' WHEN page % 37 = 4 THEN '[{{}},[],0]'
     WHEN page % 43 = 4 THEN '[' || {_CONTRACT_METADATA} || ',{{}}]'
     ELSE '[' || {_CONTRACT_METADATA} || ',[' || records || ']]' END
"""


def page_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = (
        table(spark, sf_dir, "events")
        .select(
            F.floor(F.col("event_id") / PAGE_SIZE).cast("bigint").alias("page"),
            "event_id",
            F.expr(_CONTRACT_RECORD).alias("record"),
        )
        .groupBy("page")
        .agg(F.expr("listagg(record, ',') WITHIN GROUP (ORDER BY event_id)").alias("records"))
        .select("page", F.expr(_CONTRACT_DOCUMENT).alias("raw_text"))
    )
    return page_contract(pages).select("page", "violation")


_CONTRACT_SQL = f"""
WITH e AS (SELECT event_id // {PAGE_SIZE} AS page, event_id % {PAGE_SIZE} AS idx, event_id FROM events),
m AS (SELECT page, 'Record ' || idx || CASE
    WHEN event_id % 151 = 7 THEN ' is missing required fields: countryiso3code, date'
    WHEN event_id % 157 = 7 THEN ' field country must contain a string id'
    WHEN event_id % 163 = 7 THEN ' field indicator must contain a string value'
    WHEN event_id % 167 = 7 THEN ' field countryiso3code must be a non-empty string'
    WHEN event_id % 173 = 7 THEN ' field date must be a non-empty string'
    WHEN event_id % 179 = 7 OR event_id % 181 = 7 THEN ' field value must be numeric or null'
  END AS message, idx FROM e),
r AS (SELECT page, min_by(message, idx) AS message FROM m WHERE message IS NOT NULL GROUP BY page),
p AS (SELECT page, bool_or(event_id % 211 = 7) AS has_scalar FROM e GROUP BY page)
SELECT p.page, CASE
  WHEN p.page % 31 = 4 THEN 'World Bank API returned invalid JSON'
  WHEN p.page % 37 = 4 THEN 'Expected a two-item World Bank response array'
  WHEN p.page % 41 = 4 THEN 'Expected response metadata to be an object'
  WHEN p.page % 43 = 4 THEN 'Expected response records to be an array'
  WHEN p.page % 47 = 4 THEN 'Response metadata is missing fields: per_page, total'
  WHEN has_scalar THEN 'Expected every response record to be an object'
  WHEN p.page % 53 = 4 THEN 'Response metadata field page must be an integer'
  WHEN p.page % 59 = 4 OR p.page % 73 = 4 THEN 'Response metadata field pages must be at least 1'
  WHEN p.page % 67 = 4 THEN 'Response metadata field total must be at least 0'
  WHEN p.page % 29 = 4 THEN 'Response metadata field total must be an integer'
  ELSE r.message END AS violation
FROM p LEFT JOIN r ON p.page = r.page
"""


# ---------------------------------------------------------------------------
# Runs


def _customer_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.format_string("run-%d", "c_custkey").alias("run_id"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.concat(F.lit("AC."), "c_mktsegment").alias("indicator"),
        (F.col("c_custkey") % 5 + 1).alias("start_page"),
        F.lit(25).cast("bigint").alias("per_page"),
        "c_acctbal",
        "c_nationkey",
        "c_mktsegment",
    )


def config_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fingerprint(_customer_sources(spark, sf_dir)).select("run_id", "config_fingerprint")


def run_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = with_fingerprint(_customer_sources(spark, sf_dir))
    manifests = runs.filter(F.col("c_acctbal") >= 0).select(
        "run_id",
        F.when(F.col("c_nationkey") == 7, "another").otherwise(F.col("config_fingerprint")).alias(
            "config_fingerprint"
        ),
        F.when(F.col("c_mktsegment") == "BUILDING", "COMPLETED")
        .when(F.col("c_mktsegment") == "MACHINERY", "FAILED")
        .otherwise("RUNNING")
        .alias("status"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("started_at"),
    )
    requests = runs.select(
        "run_id",
        "config_fingerprint",
        F.lit("2024-02-01 12:30:00").cast("timestamp_ntz").alias("requested_at"),
    )
    return admit_runs(requests, manifests).select(
        "run_id", "decision", "replayed", _iso("started_at")
    )


_REQUEST_TEXT = r"""
CASE c_custkey % 23
  WHEN 1 THEN '["not","an","object"]'
  WHEN 2 THEN NULL
  WHEN 3 THEN '{"speed":1,"run_id":"a","colour":2}'
  WHEN 4 THEN '{"country":"P?Q=1"}'
  WHEN 5 THEN '{"per_page":true}'
  WHEN 6 THEN '{"start_page":0}'
  WHEN 7 THEN '{"per_page":"5"}'
  WHEN 8 THEN '{"run_id":"","country":"PQR;ST"}'
  WHEN 9 THEN '{"run_id":"-bad"}'
  WHEN 10 THEN '{"country":null}'
  WHEN 11 THEN '{"start_page":2.0}'
  WHEN 12 THEN '{"start_page":2} trailing'
  WHEN 13 THEN '{"indicator":"A B"}'
  WHEN 14 THEN '{"country":"X"}'
  WHEN 15 THEN '{"run_id":5}'
  WHEN 16 THEN 'null'
  ELSE '{"run_id":"r-' || CAST(c_custkey AS STRING) || '","country":"PQR","start_page":2,"per_page":'
       || CAST(c_custkey AS STRING) || '}' END
"""


def validate_run_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr(_REQUEST_TEXT).alias("request_text"),
        F.format_string("req-%d", "c_custkey").alias("default_run_id"),
    )
    settings = ["run_id", "country", "indicator", "start_page", "per_page"]
    is_valid = F.col("request_error").isNull()
    return validate_requests(requests).select(
        "c_custkey", *[F.when(is_valid, F.col(s)).alias(s) for s in settings], "request_error"
    )


_REQUESTS_SQL = """
WITH k AS (SELECT c_custkey, c_custkey % 23 AS m FROM customer),
e AS (SELECT *, CASE
  WHEN m IN (1, 12) THEN 'Lambda event must be a JSON object'
  WHEN m = 3 THEN 'Lambda event contains unsupported fields: colour, speed'
  WHEN m IN (9, 15) THEN 'run_id must be 1-64 characters using only letters, numbers, hyphens, and underscores'
  WHEN m IN (4, 10, 14) THEN 'country contains unsupported characters'
  WHEN m = 13 THEN 'indicator contains unsupported characters'
  WHEN m IN (6, 11) THEN 'start_page must be a positive integer'
  -- Customer keys start at 0, which makes a page size of 0.
  WHEN m IN (5, 7) OR c_custkey = 0 THEN 'per_page must be a positive integer' END AS request_error FROM k)
SELECT c_custkey,
  CASE WHEN request_error IS NULL THEN
    CASE WHEN m IN (2, 8, 16) THEN 'req-' ELSE 'r-' END || c_custkey END AS run_id,
  CASE WHEN request_error IS NULL THEN
    CASE WHEN m IN (2, 16) THEN 'USA' WHEN m = 8 THEN 'PQR;ST' ELSE 'PQR' END END AS country,
  CASE WHEN request_error IS NULL THEN 'SP.POP.TOTL' END AS indicator,
  CASE WHEN request_error IS NULL THEN
    CAST(CASE WHEN m IN (2, 8, 16) THEN 1 ELSE 2 END AS BIGINT) END AS start_page,
  CASE WHEN request_error IS NULL THEN
    CAST(CASE WHEN m IN (2, 8, 16) THEN 25 ELSE c_custkey END AS BIGINT) END AS per_page,
  request_error FROM e
"""


def _run_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_checksum(with_landing_keys(_run_pages(spark, sf_dir)))
    return page_metrics(pages.withColumn("total_declared", F.lit(PAGES_PER_RUN))).select(
        "run_id",
        "page",
        F.col("total_declared").alias("total_pages"),
        "record_count",
        "source_bytes",
        "path",
        "sha256",
        F.lit("WRITTEN").alias("disposition"),
    )


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring_index("run_id", "-", -1).cast("int")
    runs = (
        _run_pages(spark, sf_dir)
        .groupBy("run_id")
        .agg(F.min("ingested_at").alias("started_at"), F.max("ingested_at").alias("finished_at"))
        .withColumns(
            {
                "country": F.lit("USA"),
                "indicator": F.lit(INDICATOR),
                "start_page": F.lit(1).cast("bigint"),
                "per_page": F.lit(25).cast("bigint"),
                "replayed": number % 2 == 1,
                "error_type": F.when(number % 4 == 2, "ApiResponseError"),
                "error_message": F.when(number % 4 == 2, "page failed"),
                "completed_at": F.when(number % 5 != 3, F.col("finished_at")),
            }
        )
    )
    return run_manifests(with_fingerprint(runs), _run_objects(spark, sf_dir))


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = _manifests(spark, sf_dir)
    return manifests.select(
        *[c for c in manifests.columns if c not in ("started_at", "completed_at", "error")],
        _iso("started_at"),
        _iso("completed_at"),
        F.col("error.type").alias("error_type"),
        F.col("error.message").alias("error_message"),
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summaries(_manifests(spark, sf_dir), "manifests")


def run_manifest_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = manifest_objects(_run_objects(spark, sf_dir))
    line = F.transform(
        "objects",
        lambda o: F.concat_ws(
            ":",
            o.page.cast("string"),
            o.record_count.cast("string"),
            o.source_bytes.cast("string"),
            o.path,
            o.sha256,
            o.disposition,
        ),
    )
    return parts.select("run_id", "part", F.array_join(line, ",").alias("objects"))


_PATH_SQL = f"""'landing/world_bank/year=' || strftime(ingested_at, '%Y') || '/month='
  || strftime(ingested_at, '%m') || '/day=' || strftime(ingested_at, '%d') || '/run_id='
  || printf('run-%010d', page // {PAGES_PER_RUN}) || '/sp_pop_totl_page_'
  || printf('%05d', page % {PAGES_PER_RUN} + 1) || '.json'"""
def missing_page_ranges_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages as stretches; runs declare four pages more than they have."""
    landed = _run_pages(spark, sf_dir).filter(F.minute("ingested_at") >= 20).select("run_id", "page")
    runs = landed.select("run_id", F.lit(1).alias("start_page"), F.lit(PAGES_PER_RUN + 4).alias("pages_expected"))
    return missing_page_ranges(runs.distinct(), landed)


def scan_one_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of chosen runs, of whose partitions alone the landing table is read."""
    folder = _folder(spark, "landing")
    pages = with_checksum(with_landing_keys(_run_pages(spark, sf_dir)))
    write_landing(pages.withColumn("disposition", F.lit("WRITTEN")), folder)
    runs = pages.select("run_id").distinct().filter(F.col("run_id").endswith("3"))
    found = of_runs(read_landing_table(spark, folder), stage(runs, "chosen-runs").filter(F.col("run_id") > ""))
    return found.select("run_id", "path", "page", "sha256")


def compacted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per page, all brought into the landing table, twice; its rows."""
    files, landed = _folder(spark, "files"), _folder(spark, "landing")
    layout = ["year", "month", "day", "run_id", "page"]
    pages = with_landing_keys(_run_pages(spark, sf_dir))
    write_files(pages, layout, f"{files}/{SOURCE_PREFIX}")

    def named(file: F.Column) -> F.Column:
        # The name, or a folder where Spark names the file, tells the page; the landed name follows from it.
        name = F.concat(
            F.lit("/sp_pop_totl_page_"), F.lpad(F.regexp_extract(file, r"/page=(\d+)[./]", 1), 5, "0"), F.lit(".json")
        )
        return F.concat(F.regexp_replace(landing_path(file), r"/page=.*$", ""), name)

    for _ in range(2):
        compact_files(spark, files, landed, locate=named)
    with packed_scans(spark, in_turn=TABLE_IN_TURN):
        return read_landing_table(spark, landed).select("run_id", "path", "page", "sha256")


_PAGES_CTE = f"""
pages AS (SELECT page, ingested_at, raw_text, {_PATH_SQL} AS path,
  printf('run-%010d', page // {PAGES_PER_RUN}) AS run_id,
  CAST(page % {PAGES_PER_RUN} + 1 AS INTEGER) AS run_page,
  CASE WHEN page % 41 = 3 OR page % 43 = 3 THEN 0
       ELSE (SELECT count(*) FROM events e WHERE e.event_id // {PAGE_SIZE} = page) END AS record_count
  FROM docs)
"""


def _with_pages(select: str, ctes: str = "") -> str:
    """``select`` over ``pages``, with further CTEs in between if given."""
    return f"{with_documents('').rstrip()}, {_PAGES_CTE}{ctes} {select}"


# ---------------------------------------------------------------------------
# Written outputs


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document, written and scanned back whole."""
    folder = _folder(spark, "documents")
    pages = indicator_documents(spark, sf_dir).withColumn("block", F.expr(f"page div {FILES_PER_FOLDER}"))
    write_files(pages, ["block", "page"], folder)
    with packed_scans(spark):
        scanned = read_documents(spark, folder).select(
            F.regexp_extract("source_file", r"/page=(\d+)[./]", 1).cast("bigint").alias("page"),
            F.sha2(F.col("raw_text").cast("binary"), 256).alias("sha256"),
        )
        return stage(scanned, "scanned-documents")


def _written(spark: SparkSession, sf_dir: str) -> str:
    """Both outputs, from documents that are read and parsed once, as in a curation run."""
    folder = _folder(spark, "curated")
    result, _ = stage_classified(indicator_documents(spark, sf_dir), "roundtrip")
    write_transform_result(result, f"{folder}/processed", f"{folder}/rejected")
    return folder


def processed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = read_processed(spark, f"{_written(spark, sf_dir)}/processed")
    return processed.withColumn("schema_drift_fields", F.array_join("schema_drift_fields", ","))


def rejected_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = (
        "source_file string, source_record_index int, rejection_reason string, "
        "raw_record string, schema_drift boolean, schema_drift_fields array<string>"
    )
    rejected = spark.read.schema(schema).json(f"{_written(spark, sf_dir)}/rejected")
    return rejected.withColumn("schema_drift_fields", F.array_join("schema_drift_fields", ","))


def clean_documents(spark: SparkSession, sf_dir: str, pages_per_run: int | None = None) -> DataFrame:
    """Every customer as one sound record, 25 to a document.

    With ``pages_per_run`` the documents are numbered as pages of runs.
    """
    customer = table(spark, sf_dir, "customer")
    total = customer.agg(F.count(F.lit(1))).scalar()
    paged = (
        customer.select(
            F.floor(F.col("c_custkey") / PAGE_SIZE).cast("bigint").alias("document"),
            "c_custkey",
            F.expr(
                """'{"indicator":{"id":"SP.POP.TOTL","value":"Population, total"},"country":{"id":"'
                || c_custkey || '","value":"' || c_name || '"},"countryiso3code":"C' || c_custkey
                || '","date":"' || (1960 + c_custkey % 60) || '","value":' || c_acctbal
                || ',"unit":"","obs_status":"","decimal":0}'"""
            ).alias("record"),
        )
        .groupBy("document")
        .agg(F.expr("listagg(record, ',') WITHIN GROUP (ORDER BY c_custkey)").alias("records"))
    )
    size = pages_per_run or 1
    return paged.select(
        F.format_string("batch-%010d", F.floor(F.col("document") / size)).alias("run_id"),
        (F.col("document") % size + 1).cast("int").alias("page"),
        F.format_string("mem://customer-%010d.json", "document").alias("source_file"),
        F.concat(
            F.lit('[{"page":'),
            (F.col("document") % size + 1).cast("string"),
            F.lit(f',"pages":{size},"per_page":{PAGE_SIZE},"total":'),
            total.cast("string"),
            F.lit("},["),
            "records",
            F.lit("]]"),
        ).alias("raw_text"),
    )


def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A passing and a failing run; only the passing one may publish rows."""
    policy = replace(INDICATOR_QUALITY_POLICY, allowed_values={"indicator_id": frozenset({INDICATOR})})
    frames = []
    for run_id, documents in (
        ("passing", clean_documents(spark, sf_dir)),
        ("failing", indicator_documents(spark, sf_dir)),
    ):
        folder = _folder(spark, "published")
        bases = {f"{kind}_base": f"{folder}/{kind}" for kind in ("processed", "rejected", "quality")}
        try:
            run_curation(spark, documents, run_id=run_id, policy=policy, **bases)
            published = read_processed(spark, f"{folder}/processed/run_id={run_id}")
        except DataQualityFailure:
            published = None
        result = spark.read.text(f"{folder}/quality/run_id={run_id}/result.json", wholetext=True)
        rejected = spark.read.text(f"{folder}/rejected/run_id={run_id}")
        row = result.select(
            F.lit(run_id).alias("run_id"),
            F.get_json_object("value", "$.status").alias("status"),
            F.get_json_object("value", "$.row_count").cast("bigint").alias("row_count"),
        ).withColumn("rejected_written", rejected.agg(F.count(F.lit(1))).scalar())
        count = published.agg(F.count(F.lit(1))).scalar() if published is not None else F.lit(0)
        frames.append(row.withColumn("published_rows", count.cast("bigint")))
    return frames[0].unionByName(frames[1])


def ingest_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests of the same runs; the manifests after the second one.

    In the first, every third run breaks off after its second page. In the
    second, every run is requested again with all pages, and the run after each
    of those comes with other settings.
    """
    folder = _folder(spark, "ingest")
    pages = clean_documents(spark, sf_dir, pages_per_run=4).select("run_id", "page", "raw_text")
    number = F.substring_index("run_id", "-", -1).cast("int")
    runs = pages.select("run_id").distinct()

    def requests(moment: str, per_page: F.Column) -> DataFrame:
        return runs.select(
            F.to_json(F.struct("run_id", per_page.alias("per_page"))).alias("request_text"),
            F.col("run_id").alias("default_run_id"),
            F.lit(moment).cast("timestamp").alias("requested_at"),
            F.lit(moment).cast("timestamp").alias("finished_at"),
        )

    where = {"landing_path": f"{folder}/landing", "manifest_root": f"{folder}/manifests"}
    broken_off = (number % 3 == 1) & (F.col("page") > 2)
    run_ingest(spark, requests("2024-01-01 00:00:00", F.lit(25)), pages.filter(~broken_off), **where)
    changed = F.when(number % 3 == 2, 50).otherwise(25)
    run_ingest(spark, requests("2024-01-02 00:00:00", changed), pages, **where)
    return read_manifests(spark, f"{folder}/manifests").select(
        "run_id", "status", "replayed", "pages_landed", _iso("started_at"), _iso("completed_at")
    )


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingest of runs of seven kinds: sound, without pages, with pages beyond their
    end, with numbers as text, with a broken page, with a gap, with two contents of a page.
    """
    folder = _folder(spark, "outcomes")
    sound = clean_documents(spark, sf_dir, pages_per_run=4).select("run_id", "page", "raw_text")
    kind = F.substring_index("run_id", "-", -1).cast("int") % 7
    requests = sound.select("run_id").distinct().select(
        F.to_json(F.struct("run_id")).alias("request_text"),
        F.col("run_id").alias("default_run_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("requested_at"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("finished_at"),
    )
    declared = F.lit('"pages":4,')
    text = (
        F.when(kind == 2, F.replace("raw_text", declared, F.lit('"pages":2,')))
        .when(kind == 3, F.replace("raw_text", declared, F.lit('"pages":" 0_4 ",')))
        .when((kind == 4) & (F.col("page") == 3), F.concat("raw_text", F.lit("]")))
        .otherwise(F.col("raw_text"))
    )
    absent = (kind == 1) | ((kind == 5) & (F.col("page") == 2))
    pages = sound.filter(~absent).withColumn("raw_text", text)
    other = sound.filter((kind == 6) & (F.col("page") == 1)).withColumn(
        "raw_text", F.concat("raw_text", F.lit(" "))
    )
    outcome = run_ingest(
        spark,
        requests,
        pages.union(other),
        landing_path=f"{folder}/landing",
        manifest_root=f"{folder}/manifests",
    )
    return outcome.manifests.select(
        "run_id",
        "status",
        "pages_landed",
        F.col("error.type").alias("error_type"),
        F.col("error.message").alias("error_message"),
    )


QUERIES = {
    "declared_total": (declared_total_query, "SELECT count(*) AS expected_rows FROM events"),
    "declared_totals_agree": (
        declared_totals_agree,
        f"""WITH n AS (SELECT count(*) AS total FROM events),
        told AS (SELECT total, CASE WHEN page % 7 = 1 THEN page ELSE total END AS other
                 FROM (SELECT DISTINCT event_id // {PAGE_SIZE} AS page FROM events), n
                 WHERE page % 41 <> 3 AND page % 43 <> 3)
        SELECT 'alike' AS pages, CASE WHEN min(total) = max(total) THEN min(total) END AS expected_rows FROM told
        UNION ALL
        SELECT 'differing', CASE WHEN min(other) = max(other) THEN min(other) END FROM told""",
    ),
    "page_metrics": (
        page_metrics_query,
        _with_pages(
            """SELECT printf('mem://page-%010d.json', page) AS source_file,
            CASE WHEN page % 41 = 3 OR page % 43 = 3 THEN NULL ELSE CAST(page + 1 AS BIGINT) END AS returned_page,
            CASE WHEN page % 41 = 3 OR page % 43 = 3 THEN NULL
                 ELSE CAST((SELECT ceil(count(*) / 25.0) FROM events) AS BIGINT) END AS total_pages,
            record_count, CAST(strlen(raw_text) AS BIGINT) AS source_bytes FROM pages"""
        ),
    ),
    "page_checksums": (
        page_checksums,
        with_documents("SELECT source_file, sha256(raw_text) AS sha256 FROM docs"),
    ),
    "page_checksums_html": (
        page_checksums_html,
        "SELECT page_id, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS source_bytes FROM pages",
    ),
    "landing_keys": (
        landing_keys,
        _with_pages(
            """SELECT path, strftime(ingested_at, '%Y') AS year, strftime(ingested_at, '%m') AS month,
            strftime(ingested_at, '%d') AS day FROM pages"""
        ),
    ),
    "landing_path_columns": (
        landing_path_columns_query,
        _with_pages(
            """SELECT path AS source_file, CAST(year(ingested_at) AS INTEGER) AS year,
            CAST(month(ingested_at) AS INTEGER) AS month, CAST(day(ingested_at) AS INTEGER) AS day,
            run_id, 'sp_pop_totl' AS indicator_stem, run_page AS page FROM pages"""
        ),
    ),
    "landing_disposition": (
        landing_disposition,
        _with_pages(
            ctes=""", c AS (
            SELECT path, 1 AS arrival, raw_text AS t, ingested_at, page, raw_text FROM pages
            UNION ALL SELECT path, 2, CASE WHEN page % 13 = 5 THEN raw_text || '!' ELSE raw_text END,
              ingested_at, page, raw_text FROM pages),
            d AS (SELECT *, ingested_at < TIMESTAMP '2024-01-16' AS was_landed,
              CASE WHEN ingested_at < TIMESTAMP '2024-01-16' AND page % 11 = 3
                   THEN raw_text || ' ' ELSE raw_text END AS held FROM c)""",
            select="""SELECT path, CAST(arrival AS INTEGER) AS arrival, sha256(t) AS sha256,
            CASE WHEN NOT was_landed AND arrival = 1 THEN 'WRITTEN'
                 WHEN t = held THEN 'EXISTING' ELSE 'CONFLICT' END AS disposition FROM d""",
        ),
    ),
    "landing_disposition_texts": (
        landing_disposition_texts,
        """WITH d AS (SELECT doc_id, 'landing/' || source AS path, text, lang FROM documents),
        l AS (SELECT path, min_by(text, doc_id) AS held FROM d WHERE lang = 'en' GROUP BY path),
        f AS (SELECT path, min(doc_id) AS first_id, min_by(text, doc_id) AS first_text FROM d GROUP BY path)
        SELECT d.path, d.doc_id, CASE WHEN l.held IS NULL AND d.doc_id = f.first_id THEN 'WRITTEN'
          WHEN d.text = coalesce(l.held, f.first_text) THEN 'EXISTING' ELSE 'CONFLICT' END AS disposition
        FROM d JOIN f ON d.path = f.path LEFT JOIN l ON d.path = l.path""",
    ),
    "missing_pages": (
        missing_pages_query,
        _with_pages(
            ctes=""", seen AS (SELECT run_id, run_page FROM pages WHERE minute(ingested_at) >= 20),
            runs AS (SELECT DISTINCT run_id FROM seen)""",
            select=f"""SELECT run_id, CAST(n AS BIGINT) AS page FROM runs, range(1, {PAGES_PER_RUN} + 1) AS g(n)
            WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.run_id = runs.run_id AND seen.run_page = n)""",
        ),
    ),
    "missing_page_ranges": (
        missing_page_ranges_query,
        _with_pages(
            ctes=f""", seen AS (SELECT run_id, run_page FROM pages WHERE minute(ingested_at) >= 20),
            gone AS (SELECT run_id, n FROM (SELECT DISTINCT run_id FROM seen) r, range(1, {PAGES_PER_RUN} + 5) AS g(n)
              WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.run_id = r.run_id AND seen.run_page = n)),
            islands AS (SELECT run_id, n, n - row_number() OVER (PARTITION BY run_id ORDER BY n) AS island FROM gone)""",
            select="""SELECT run_id, CAST(min(n) AS BIGINT) AS from_page, CAST(max(n) AS BIGINT) AS to_page
            FROM islands GROUP BY run_id, island""",
        ),
    ),
    "scan_one_run": (
        scan_one_run,
        _with_pages(
            """SELECT run_id, path, run_page AS page, sha256(raw_text) AS sha256 FROM pages
            WHERE run_id LIKE '%3'"""
        ),
    ),
    "compacted_files": (
        compacted_files,
        _with_pages(
            "SELECT run_id, path, run_page AS page, sha256(raw_text || chr(10)) AS sha256 FROM pages"
        ),
    ),
    "page_contract_violations": (page_contract_violations, _CONTRACT_SQL),
    "config_fingerprint": (
        config_fingerprint,
        """SELECT 'run-' || c_custkey AS run_id,
        sha256('{"api_base_url": "https://api.worldbank.org/v2", "country": "N' || c_nationkey
          || '", "indicator": "AC.' || c_mktsegment || '", "page": ' || (c_custkey % 5 + 1)
          || ', "per_page": 25}') AS config_fingerprint FROM customer""",
    ),
    "run_admission": (
        run_admission,
        """SELECT 'run-' || c_custkey AS run_id, CASE WHEN c_acctbal < 0 THEN 'NEW'
          WHEN c_nationkey = 7 THEN 'CONFLICT' WHEN c_mktsegment = 'BUILDING' THEN 'SKIP'
          ELSE 'RESUME' END AS decision,
        c_acctbal >= 0 AND c_nationkey <> 7 AS replayed,
        CASE WHEN c_acctbal < 0 THEN '2024-02-01 12:30:00' ELSE '2024-01-01 00:00:00' END AS started_at
        FROM customer""",
    ),
    "validate_run_requests": (validate_run_requests, _REQUESTS_SQL),
    "run_manifest": (
        run_manifest,
        _with_pages(
            ctes=f""", runs AS (SELECT run_id, page // {PAGES_PER_RUN} AS n, min(ingested_at) AS s,
              max(ingested_at) AS f, count(*) AS pages_landed,
              CAST(sum(record_count) AS BIGINT) AS record_count,
              CAST(sum(strlen(raw_text)) AS BIGINT) AS source_bytes FROM pages GROUP BY ALL)""",
            select=f"""SELECT run_id, 'world_bank_indicator' AS dataset,
            CASE WHEN n % 4 = 2 THEN 'FAILED' WHEN n % 5 = 3 THEN 'RUNNING' ELSE 'COMPLETED' END AS status,
            'USA' AS country, 'SP.POP.TOTL' AS indicator, CAST(1 AS BIGINT) AS start_page,
            CAST(25 AS BIGINT) AS per_page,
            sha256('{{"api_base_url": "https://api.worldbank.org/v2", "country": "USA", '
              || '"indicator": "SP.POP.TOTL", "page": 1, "per_page": 25}}') AS config_fingerprint,
            n % 2 = 1 AS replayed, CAST({PAGES_PER_RUN} AS BIGINT) AS pages_expected,
            pages_landed, record_count, source_bytes,
            strftime(s, '%Y-%m-%d %H:%M:%S') AS started_at,
            CASE WHEN n % 5 <> 3 THEN strftime(f, '%Y-%m-%d %H:%M:%S') END AS completed_at,
            CASE WHEN n % 4 = 2 THEN 'ApiResponseError' END AS error_type,
            CASE WHEN n % 4 = 2 THEN 'page failed' END AS error_message FROM runs""",
        ),
    ),
    "run_summary": (
        run_summary,
        _with_pages(
            f"""SELECT CASE WHEN n % 4 = 2 THEN 'FAILED' WHEN n % 5 = 3 THEN 'RUNNING' ELSE 'COMPLETED' END AS status,
            run_id, 'USA' AS country, 'SP.POP.TOTL' AS indicator, pages, records, source_bytes,
            'manifests/world_bank/run_id=' || run_id AS manifest_uri, n % 2 = 1 AS replayed
            FROM (SELECT run_id, page // {PAGES_PER_RUN} AS n, count(*) AS pages,
              CAST(sum(record_count) AS BIGINT) AS records,
              CAST(sum(strlen(raw_text)) AS BIGINT) AS source_bytes FROM pages GROUP BY ALL)"""
        ),
    ),
    "run_manifest_objects": (
        run_manifest_objects,
        _with_pages(
            """SELECT run_id, CAST(0 AS INTEGER) AS part, string_agg(run_page || ':' || record_count || ':'
              || strlen(raw_text) || ':' || path || ':' || sha256(raw_text) || ':WRITTEN', ','
              ORDER BY run_page) AS objects FROM pages GROUP BY run_id"""
        ),
    ),
    "scan_documents": (
        scan_documents,
        with_documents("SELECT page, sha256(raw_text || chr(10)) AS sha256 FROM docs"),
    ),
    "processed_roundtrip": (processed_roundtrip, CURATION["processed_rows"][1]),
    "rejected_roundtrip": (rejected_roundtrip, CURATION["rejected_rows"][1]),
    "publish_gate": (
        publish_gate,
        f"""WITH rejects AS ({CURATION["rejection_summary"][1]}),
        good AS ({CURATION["processed_rows"][1]})
        SELECT 'passing' AS run_id, 'PASS' AS status, count(*) AS row_count,
        CAST(0 AS BIGINT) AS rejected_written, count(*) AS published_rows FROM customer
        UNION ALL
        SELECT 'failing', 'FAIL', (SELECT count(*) FROM good),
        (SELECT CAST(sum(rejected_rows) AS BIGINT) FROM rejects), 0""",
    ),
    "ingest_manifests": (
        ingest_manifests,
        """WITH d AS (SELECT DISTINCT c_custkey // 25 AS document FROM customer),
        r AS (SELECT document // 4 AS n, count(*) AS present FROM d GROUP BY ALL),
        -- A run of fewer than four pages never completes: its next page is absent.
        s AS (SELECT *, present = 4 AS whole FROM r)
        SELECT printf('batch-%010d', n) AS run_id,
        CASE WHEN NOT whole THEN 'FAILED' ELSE 'COMPLETED' END AS status,
        n % 3 = 1 OR (NOT whole AND n % 3 = 0) AS replayed, present AS pages_landed,
        '2024-01-01 00:00:00' AS started_at,
        CASE WHEN n % 3 = 1 OR (NOT whole AND n % 3 = 0) THEN '2024-01-02 00:00:00'
             ELSE '2024-01-01 00:00:00' END AS completed_at FROM s""",
    ),
    "ingest_outcomes": (
        ingest_outcomes,
        """WITH d AS (SELECT DISTINCT c_custkey // 25 AS document FROM customer),
        r AS (SELECT document // 4 AS n, document // 4 % 7 AS kind, count(*) AS present FROM d GROUP BY ALL),
        -- The first page at which a run stops; NULL for a run that reaches its end.
        s AS (SELECT *, CASE WHEN kind IN (1, 6) THEN 1 WHEN kind = 5 THEN 2
            WHEN kind = 2 THEN CASE WHEN present < 2 THEN 2 END
            WHEN kind = 4 AND present >= 3 THEN 3 WHEN present < 4 THEN present + 1 END AS stop FROM r)
        SELECT printf('batch-%010d', n) AS run_id,
        CASE WHEN stop IS NULL THEN 'COMPLETED' ELSE 'FAILED' END AS status,
        CAST(coalesce(stop - 1, CASE WHEN kind = 2 THEN 2 ELSE 4 END) AS BIGINT) AS pages_landed,
        CASE WHEN kind = 6 THEN 'LandingConflictError' WHEN stop IS NOT NULL THEN 'ApiResponseError' END AS error_type,
        CASE WHEN kind = 6 THEN 'Landing object already exists with different content: '
            || 'landing/world_bank/year=2024/month=01/day=01/run_id=' || printf('batch-%010d', n)
            || '/sp_pop_totl_page_00001.json'
          WHEN kind = 4 AND stop = 3 AND present >= 3 THEN 'World Bank API returned invalid JSON'
          WHEN stop IS NOT NULL THEN 'Page ' || stop || ' was not returned' END AS error_message FROM s""",
    ),
}
