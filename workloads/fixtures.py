"""Source documents derived from the given tables, with defects mixed in.

One document per ``PAGE_SIZE`` consecutive events. The text of a record is one
SQL expression that Spark and DuckDB both accept, so both sides hold the same
bytes; what a record *should* become is stated separately in ``oracle_cases``
as arithmetic over ``event_id`` and never looks at the text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

PAGE_SIZE = 25

# One record as JSON text. Values are numbers for even events, text for odd ones.
RECORD_TEXT = """
CASE WHEN event_id % 127 = 5 THEN '7' ELSE
  '{"indicator":'
  || CASE WHEN event_id % 131 = 5 THEN '"flat"'
     ELSE '{"id":"' || CASE WHEN event_id % 139 = 5 THEN ' ' ELSE 'EV.' || upper(event_type) END
          || '","value":"Event ' || event_type || '"}' END
  || ',"country":{"id":"u' || CAST(user_id % 90 AS STRING)
  || '","value":"User ' || CAST(user_id % 90 AS STRING) || '"'
  || CASE WHEN event_id % 149 = 5 THEN ',"zone":"z"' ELSE '' END || '}'
  || ',"countryiso3code":"'
  || CASE WHEN event_id % 109 = 5 THEN '  ' ELSE ' u' || CAST(user_id % 90 AS STRING) END
  || '","date":'
  || CASE WHEN event_id % 103 = 5 THEN 'null' WHEN event_id % 107 = 5 THEN '"20x4"'
     ELSE '"' || CAST(1960 + event_id % 60 AS STRING)
          || CASE WHEN event_id % 7 = 0 THEN '.0' ELSE '' END || '"' END
  || ',"value":'
  || CASE WHEN event_id % 97 = 5 THEN 'null' WHEN event_id % 101 = 5 THEN '"not-a-number"'
     WHEN event_id % 2 = 0 THEN CAST(value AS STRING)
     ELSE '"' || CAST(value AS STRING) || '"' END
  || ',"unit":" people ","obs_status":"","decimal":'
  || CASE WHEN event_id % 137 = 5 THEN '"x"' ELSE '0' END
  || CASE WHEN event_id % 113 = 5 THEN ',"zz_new":1,"aa_new":"n"' ELSE '' END
  || '}' END
"""

# A whole document from its page number, record texts and the table totals.
DOCUMENT_TEXT = """
CASE WHEN page % 43 = 3 AND page % 41 <> 3 THEN '{"message":"err"}'
     WHEN page % 41 = 3 THEN substr(body, 1, length(body) - 7)
     ELSE body END
"""

BODY_TEXT = """
'[{"page":' || CAST(page + 1 AS STRING) || ',"pages":' || CAST(pages AS STRING)
|| ',"per_page":25,"total":' || CAST(total AS STRING) || '},[' || records || ']]'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def indicator_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page, ingested_at, source_file, raw_text``: every event exactly once."""
    events = table(spark, sf_dir, "events")
    total = events.agg(F.count(F.lit(1)).alias("total")).scalar()
    pages = events.agg(F.ceil(F.count(F.lit(1)) / PAGE_SIZE)).scalar()
    return (
        events.select(
            F.floor(F.col("event_id") / PAGE_SIZE).cast("bigint").alias("page"),
            "event_id",
            "ts",
            F.expr(RECORD_TEXT).alias("record"),
        )
        .groupBy("page")
        .agg(
            F.min("ts").alias("ingested_at"),
            F.expr("listagg(record, ',') WITHIN GROUP (ORDER BY event_id)").alias("records"),
        )
        .withColumns({"total": total, "pages": pages})
        .withColumn("body", F.expr(BODY_TEXT))
        .select(
            "page",
            "ingested_at",
            F.format_string("mem://page-%010d.json", "page").alias("source_file"),
            F.expr(DOCUMENT_TEXT).alias("raw_text"),
        )
    )


def write_files(pages: DataFrame, layout: Sequence[str], folder: str) -> None:
    """The ``raw_text`` of every row, and a line end, as a file of its own below ``folder``.

    A file is ``a=1/b=2/c=3.txt`` by the columns of ``layout``. On a local file system the tasks
    write it themselves, as a landing does: Hadoop starts up to six processes there for a file in
    a folder of its own (permissions of folder, file and checksum). Elsewhere Spark writes it, as ``a=1/b=2/c=3/part-...``.
    """
    root = folder.removeprefix("file://").removeprefix("file:")
    if not root.startswith("/"):
        pages.select("raw_text", *layout).write.partitionBy(*layout).text(folder)
        return

    def put(rows: Iterator[Row]) -> None:
        for row in rows:
            *outer, name = (f"{column}={row[column]}" for column in layout)
            place = os.path.join(root, *outer)
            # A reader sees no hidden file, and a task that runs twice leaves one whole file.
            draft = os.path.join(place, f".{name}.{os.getpid()}")
            try:
                file = open(draft, "wb")
            except FileNotFoundError:
                os.makedirs(place, exist_ok=True)
                file = open(draft, "wb")
            with file:
                file.write(row["raw_text"].encode() + b"\n")
            os.replace(draft, os.path.join(place, f"{name}.txt"))

    pages.select("raw_text", *layout).foreachPartition(put)


# ---------------------------------------------------------------------------
# DuckDB side

DOCUMENT_CTES = f"""
numbered AS (
  SELECT event_id // {PAGE_SIZE} AS page, event_id, ts, {RECORD_TEXT} AS record FROM events),
paged AS (
  SELECT page, min(ts) AS ingested_at, string_agg(record, ',' ORDER BY event_id) AS records
  FROM numbered GROUP BY page),
bodies AS (
  SELECT page, ingested_at, (SELECT CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) FROM events) AS pages,
         (SELECT count(*) FROM events) AS total, records FROM paged),
texts AS (SELECT page, ingested_at, {BODY_TEXT} AS body FROM bodies),
docs AS (
  SELECT page, ingested_at, printf('mem://page-%010d.json', page) AS source_file,
         {DOCUMENT_TEXT} AS raw_text FROM texts)
"""

# Expected outcome of every event, from event_id alone.
EVENT_CTES = f"""
ev AS (
  SELECT *, event_id // {PAGE_SIZE} AS page, CAST(event_id % {PAGE_SIZE} AS INTEGER) AS idx,
         printf('mem://page-%010d.json', event_id // {PAGE_SIZE}) AS source_file FROM events),
readable AS (SELECT * FROM ev WHERE page % 41 <> 3 AND page % 43 <> 3),
judged AS (
  SELECT *,
    CASE WHEN event_id % 139 = 5 THEN '' ELSE 'EV.' || upper(event_type) END AS indicator_id,
    'Event ' || event_type AS indicator_name,
    'U' || CAST(user_id % 90 AS VARCHAR) AS country_id,
    'User ' || CAST(user_id % 90 AS VARCHAR) AS country_name,
    CASE WHEN event_id % 109 = 5 THEN '' ELSE 'U' || CAST(user_id % 90 AS VARCHAR) END AS iso3,
    CASE WHEN event_id % 103 = 5 OR event_id % 107 = 5 THEN NULL
         ELSE CAST(1960 + event_id % 60 AS INTEGER) END AS yr,
    CASE WHEN event_id % 97 = 5 OR event_id % 101 = 5 THEN NULL ELSE value END AS val,
    CASE WHEN event_id % 137 = 5 THEN NULL ELSE 0 END AS dec,
    event_id % 113 = 5 OR event_id % 149 = 5 AS has_extra,
    concat_ws(',', CASE WHEN event_id % 149 = 5 THEN 'country.zone' END,
              CASE WHEN event_id % 113 = 5 THEN 'record.aa_new,record.zz_new' END) AS extra_fields,
    CASE WHEN event_id % 127 = 5 THEN 'RECORD_NOT_OBJECT'
         WHEN event_id % 131 = 5 THEN 'INVALID_NESTED_OBJECT'
         WHEN event_id % 139 = 5 THEN 'NULL_INDICATOR_ID'
         WHEN event_id % 109 = 5 THEN 'NULL_COUNTRY_ISO3_CODE'
         WHEN event_id % 103 = 5 THEN 'NULL_OBSERVATION_YEAR'
         WHEN event_id % 107 = 5 THEN 'INVALID_OBSERVATION_YEAR'
         WHEN event_id % 97 = 5 THEN 'NULL_OBSERVATION_VALUE'
         WHEN event_id % 101 = 5 THEN 'INVALID_OBSERVATION_VALUE'
         WHEN event_id % 137 = 5 THEN 'INVALID_DECIMAL_PLACES' END AS reason
  FROM readable),
ranked AS (
  SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (
    PARTITION BY reason IS NULL, iso3, indicator_id, yr ORDER BY source_file, idx) END AS rnk
  FROM judged),
final AS (
  SELECT *, CASE WHEN rnk > 1 THEN 'DUPLICATE_BUSINESS_KEY' ELSE reason END AS final_reason
  FROM ranked)
"""

# Canonical (compact, key-sorted) text of a record; numbers lose trailing zeros.
CANONICAL_RECORD = """
CASE WHEN event_id % 127 = 5 THEN '7' ELSE
  '{' || CASE WHEN event_id % 113 = 5 THEN '"aa_new":"n",' ELSE '' END
  || '"country":{"id":"u' || CAST(user_id % 90 AS VARCHAR)
  || '","value":"User ' || CAST(user_id % 90 AS VARCHAR) || '"'
  || CASE WHEN event_id % 149 = 5 THEN ',"zone":"z"' ELSE '' END || '}'
  || ',"countryiso3code":"'
  || CASE WHEN event_id % 109 = 5 THEN '  ' ELSE ' u' || CAST(user_id % 90 AS VARCHAR) END
  || '","date":'
  || CASE WHEN event_id % 103 = 5 THEN 'null' WHEN event_id % 107 = 5 THEN '"20x4"'
     ELSE '"' || CAST(1960 + event_id % 60 AS VARCHAR)
          || CASE WHEN event_id % 7 = 0 THEN '.0' ELSE '' END || '"' END
  || ',"decimal":' || CASE WHEN event_id % 137 = 5 THEN '"x"' ELSE '0' END
  || ',"indicator":' || CASE WHEN event_id % 131 = 5 THEN '"flat"'
     ELSE '{"id":"' || CASE WHEN event_id % 139 = 5 THEN ' ' ELSE 'EV.' || upper(event_type) END
          || '","value":"Event ' || event_type || '"}' END
  || ',"obs_status":"","unit":" people ","value":'
  || CASE WHEN event_id % 97 = 5 THEN 'null' WHEN event_id % 101 = 5 THEN '"not-a-number"'
     WHEN event_id % 2 = 0 THEN rtrim(rtrim(CAST(value AS VARCHAR), '0'), '.')
     ELSE '"' || CAST(value AS VARCHAR) || '"' END
  || CASE WHEN event_id % 113 = 5 THEN ',"zz_new":1' ELSE '' END
  || '}' END
"""


def with_events(select: str) -> str:
    return f"WITH {EVENT_CTES} {select}"


def with_documents(select: str) -> str:
    return f"WITH {DOCUMENT_CTES} {select}"


def with_both(select: str) -> str:
    return f"WITH {EVENT_CTES}, {DOCUMENT_CTES} {select}"
