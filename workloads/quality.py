"""Metrics and rules over the curated output and over plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.operators.curate import classify_documents, transform_documents
from lakegate.operators.quality import (
    INDICATOR_QUALITY_POLICY,
    RULES,
    DataQualityConfig,
    classified_quality_metrics,
    quality_metrics,
    reject_metrics,
    row_metrics,
    rules_frame,
)
from lakegate.operators.reconcile import declared_total
from workloads.fixtures import indicator_documents, table, with_both, with_events

ORDERS = DataQualityConfig(
    dataset="orders",
    required_columns=("o_orderkey", "o_custkey", "o_orderpriority"),
    business_key=("o_orderkey",),
    expected_types={"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"},
    allowed_values={"o_orderstatus": frozenset({"F", "O"})},
)
CUSTOMER = DataQualityConfig(
    dataset="customer",
    required_columns=("c_custkey", "c_name"),
    business_key=("c_custkey",),
    expected_types={"c_custkey": "bigint", "c_nationkey": "string"},
    allowed_values={
        "c_mktsegment": frozenset({"BUILDING", "MACHINERY"}),
        "c_nationkey": frozenset(str(n) for n in range(20)),
    },
)
LINEITEM = DataQualityConfig(
    dataset="lineitem",
    required_columns=("l_orderkey", "l_linenumber", "l_returnflag"),
    business_key=("l_orderkey", "l_linenumber"),
    expected_types={"l_orderkey": "bigint", "l_linenumber": "int", "l_comment": "string"},
    allowed_values={
        "l_returnflag": frozenset({"A", "R", " "}),
        "l_linestatus": frozenset({"F", "O"}),
    },
)
EVENT_POLICY = DataQualityConfig(
    dataset="event_observations",
    required_columns=INDICATOR_QUALITY_POLICY.required_columns,
    business_key=INDICATOR_QUALITY_POLICY.business_key,
    expected_types=INDICATOR_QUALITY_POLICY.expected_types,
    allowed_values={"indicator_id": frozenset({"EV.CLICK", "EV.VIEW", "EV.PURCHASE"})},
    require_expected_row_count=False,
    fail_on_rejected_rows=False,
    maximum_schema_drift_rows=10,
)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT"))
    )


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Blank text counts as missing just like NULL.
    flag = F.when(F.col("l_linenumber") == 3, " ").when(F.col("l_linenumber") != 5, F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").withColumn("l_returnflag", flag)


def _plain_tables(spark: SparkSession, sf_dir: str):
    return [
        (ORDERS, _orders(spark, sf_dir)),
        (CUSTOMER, table(spark, sf_dir, "customer")),
        (LINEITEM, _lineitem(spark, sf_dir)),
    ]


def _per_table(*metrics: str):
    duplicates = "surviving_duplicates" in metrics

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = [
            row_metrics(rows, config, duplicates).select(F.lit(config.dataset).alias("dataset"), *metrics)
            for config, rows in _plain_tables(spark, sf_dir)
        ]
        return reduce(DataFrame.unionByName, frames)

    return query


def _metrics(spark: SparkSession, sf_dir: str, config: DataQualityConfig) -> DataFrame:
    documents = indicator_documents(spark, sf_dir)
    return classified_quality_metrics(
        classify_documents(documents), config, declared_total(documents)
    )


def dq_reject_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_metrics(transform_documents(indicator_documents(spark, sf_dir)).rejected)


def dq_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, EVENT_POLICY).select("drift_rows", "failures_schema_drift")


def dq_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, INDICATOR_QUALITY_POLICY).select(
        "row_count", "rejected_rows", "expected_rows", "row_count_match", "failures_row_count"
    )


def _rules(config: DataQualityConfig):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rules_frame(_metrics(spark, sf_dir, config))

    return query


def dq_plain_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over the plain tables, each against a frame of rejects without reasons.

    The orders come in the expected number, one customer too few, and nobody knows how many
    line items there should be.
    """
    expected_from = {
        "orders": F.count(F.lit(1)),
        "customer": F.count(F.lit(1)) + 1,
        "lineitem": F.max(F.lit(None).cast("bigint")),
    }
    frames = []
    for config, rows in _plain_tables(spark, sf_dir):
        rejects = rows.filter(F.lit(False))
        metrics = quality_metrics(rows, rejects, config, rows.agg(expected_from[config.dataset].alias("expected_rows")))
        frames.append(rules_frame(metrics).withColumn("dataset", F.lit(config.dataset)))
    return reduce(DataFrame.unionByName, frames)


_ORDERS_SQL = "(SELECT * REPLACE (nullif(o_orderpriority, '1-URGENT') AS o_orderpriority) FROM orders)"
_LINEITEM_SQL = """(SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN ' ' WHEN l_linenumber = 5
  THEN NULL ELSE l_returnflag END AS l_returnflag) FROM lineitem)"""
_PLAIN_METRICS = f"""
SELECT 'orders' AS dataset, count(*) AS row_count,
  count(*) FILTER (WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderpriority IS NULL) AS null_rows,
  count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS enum_rows, CAST(0 AS BIGINT) AS drift_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders)) AS surviving_duplicates
FROM {_ORDERS_SQL}
UNION ALL
SELECT 'customer', count(*), count(*) FILTER (WHERE trim(c_name) = ''),
  count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_nationkey > 19), 0,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT c_custkey FROM customer)) FROM customer
UNION ALL
SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_linenumber IN (3, 5)),
  count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R', ' ') OR l_linestatus NOT IN ('F', 'O')), 0,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
FROM {_LINEITEM_SQL}
"""

# Rejects by class; a malformed or badly shaped document is one rejected row.
_REJECT_CLASSES = """
rejects AS (
  SELECT 'MALFORMED' AS reason FROM docs WHERE page % 41 = 3
  UNION ALL SELECT 'INVALID_DOCUMENT_SHAPE' FROM docs WHERE page % 43 = 3 AND page % 41 <> 3
  UNION ALL SELECT final_reason FROM final WHERE final_reason IS NOT NULL),
r AS (SELECT count(*) AS rejected_rows, count(*) FILTER (WHERE reason LIKE 'NULL%') AS rejected_nulls,
  count(*) FILTER (WHERE reason LIKE 'DUPLICATE%') AS rejected_duplicates,
  count(*) FILTER (WHERE reason LIKE 'INVALID%') AS rejected_invalid FROM rejects),
p AS (SELECT count(*) AS row_count, count(*) FILTER (WHERE has_extra) AS drift_rows,
  count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS enum_rows
  FROM final WHERE final_reason IS NULL),
-- Unreadable documents declare nothing, but the rest agree on the table's size.
t AS (SELECT count(*) AS expected_rows FROM events)
"""


def _with_classes(select: str) -> str:
    return with_both("").rstrip() + f", {_REJECT_CLASSES} {select}"


def _rules_sql(failures: dict[str, str]) -> str:
    rows = [
        f"SELECT {i} AS rule_order, '{rule}' AS rule, CAST({failures[rule]} AS BIGINT) AS failures FROM r, p, t"
        for i, rule in enumerate(RULES)
    ]
    return _with_classes(
        f"""SELECT CAST(rule_order AS INTEGER) AS rule_order, rule,
        CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status, failures
        FROM ({' UNION ALL '.join(rows)})"""
    )


_COMMON_FAILURES = {
    "required_columns": "0",
    "column_types": "rejected_invalid",
    "row_count": "CASE WHEN row_count + rejected_rows = expected_rows THEN 0 ELSE 1 END",
    "required_nulls": "rejected_nulls",
    "duplicate_business_keys": "rejected_duplicates",
}

_PLAIN_RULES = " UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS rule_order, '{rule}' AS rule,
    CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS status, f AS failures, dataset
    FROM (SELECT dataset, CAST({failures} AS BIGINT) AS f FROM m)"""
    for i, (rule, failures) in enumerate(
        {
            "required_columns": "CASE WHEN dataset = 'lineitem' THEN 1 ELSE 0 END",
            "column_types": "CASE WHEN dataset = 'customer' THEN 1 ELSE 0 END",
            "row_count": "CASE WHEN dataset = 'orders' THEN 0 ELSE 1 END",
            "required_nulls": "null_rows",
            "duplicate_business_keys": "surviving_duplicates",
            "allowed_values": "enum_rows",
            "schema_drift": "0",
            "rejected_rows": "0",
        }.items()
    )
)

QUERIES = {
    "dq_row_metrics": (
        _per_table("row_count", "null_rows", "enum_rows", "drift_rows", "surviving_duplicates"),
        _PLAIN_METRICS,
    ),
    "dq_required_nulls": (
        _per_table("row_count", "null_rows"),
        f"SELECT dataset, row_count, null_rows FROM ({_PLAIN_METRICS})",
    ),
    "dq_allowed_values": (
        _per_table("row_count", "enum_rows"),
        f"SELECT dataset, row_count, enum_rows FROM ({_PLAIN_METRICS})",
    ),
    "dq_duplicates": (
        _per_table("row_count", "surviving_duplicates"),
        f"SELECT dataset, row_count, surviving_duplicates FROM ({_PLAIN_METRICS})",
    ),
    "dq_plain_rules": (dq_plain_rules, f"WITH m AS ({_PLAIN_METRICS}) {_PLAIN_RULES}"),
    "dq_reject_metrics": (dq_reject_metrics, _with_classes("SELECT * FROM r")),
    "dq_schema_drift": (
        dq_schema_drift,
        with_events(
            """SELECT count(*) FILTER (WHERE has_extra) AS drift_rows,
            greatest(0, count(*) FILTER (WHERE has_extra) - 10) AS failures_schema_drift
            FROM final WHERE final_reason IS NULL"""
        ),
    ),
    "dq_reconciliation": (
        dq_reconciliation,
        _with_classes(
            """SELECT row_count, rejected_rows, expected_rows,
            row_count + rejected_rows = expected_rows AS row_count_match,
            CAST(CASE WHEN row_count + rejected_rows = expected_rows THEN 0 ELSE 1 END AS BIGINT)
              AS failures_row_count FROM r, p, t"""
        ),
    ),
    "dq_rules": (
        _rules(INDICATOR_QUALITY_POLICY),
        _rules_sql(
            {
                **_COMMON_FAILURES,
                # No event carries the indicator or country of this policy.
                "allowed_values": "row_count",
                "schema_drift": "drift_rows",
                "rejected_rows": "rejected_rows",
            }
        ),
    ),
    "dq_policy_end_to_end": (
        _rules(EVENT_POLICY),
        _rules_sql(
            {
                **_COMMON_FAILURES,
                "allowed_values": "enum_rows",
                "schema_drift": "greatest(0, drift_rows - 10)",
                "rejected_rows": "0",
            }
        ),
    ),
}
