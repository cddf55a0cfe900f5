"""Batch cleaning, data quality and run-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality, runlog
from millrace.operators.cleaning import AUDIT_COLUMN, clean, drop_duplicates
from millrace.operators.impute import null_counts
from millrace.operators.patients import mask
from millrace.plans.etl import publish_if_valid, run_etl, validate_then_run
from millrace.plans.scratch import scratch_path
from millrace.queries.registry import query, table
from millrace.sources.files import merge_sources


@query("""
WITH raw AS (
  SELECT c_custkey, ' ' || lower(c_name) || '  ' AS c_name, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer)
SELECT DISTINCT c_custkey, upper(trim(c_name)) AS c_name, c_nationkey, c_acctbal, upper(trim(c_mktsegment)) AS c_mktsegment
FROM raw WHERE c_acctbal IS NOT NULL AND c_name IS NOT NULL AND c_mktsegment IS NOT NULL
""")
def etl_clean(spark, sf):
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), F.lower("c_name"), F.lit("  ")).alias("c_name"),
        "c_nationkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
    )
    return clean(raw.unionAll(raw)).drop(AUDIT_COLUMN)


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def etl_dedup_lineitem(spark, sf):
    lines = table(spark, sf, "lineitem")
    return drop_duplicates(lines.unionAll(lines))


@query("""
SELECT DISTINCT o_orderkey, o_custkey, upper(trim(o_orderstatus)) AS o_orderstatus, o_totalprice, o_orderdate,
       upper(trim(o_orderpriority)) AS o_orderpriority
FROM orders
""")
def etl_run(spark, sf):
    target = scratch_path(spark, "etl")
    run_etl(spark, f"{sf}/orders.parquet", target, "parquet", run_log=scratch_path(spark, "runs"))
    return spark.read.parquet(target).drop(AUDIT_COLUMN)


def _through_text(spark, sf, fmt: str):
    """Customers written as text files, then extracted from them."""
    source, target = scratch_path(spark, fmt), scratch_path(spark, "etl")
    customers = table(spark, sf, "customer")
    customers.write.format(fmt).option("header", True).save(source)
    run_etl(spark, source, target, fmt, schema=customers.schema)
    return spark.read.parquet(target).drop(AUDIT_COLUMN)


_UPPER_CUSTOMERS = """
SELECT DISTINCT c_custkey, upper(trim(c_name)) AS c_name, c_nationkey, c_acctbal, upper(trim(c_mktsegment)) AS c_mktsegment FROM customer
"""


@query(_UPPER_CUSTOMERS)
def etl_csv(spark, sf):
    return _through_text(spark, sf, "csv")


@query(_UPPER_CUSTOMERS)
def etl_json(spark, sf):
    return _through_text(spark, sf, "json")


@query("""
SELECT count(*) AS rows_extracted, count(*) AS rows_loaded, TRUE AS validated,
       (SELECT count(*) FROM customer) AS rows_stored
FROM customer
""")
def etl_validated(spark, sf):
    target = scratch_path(spark, "etl")
    done = validate_then_run(
        spark, f"{sf}/customer.parquet", target, "parquet", not_null=["c_custkey", "c_name"], run_id="first", replay_safe=True
    )
    return spark.read.parquet(target).agg(
        F.lit(done["rows_extracted"]).cast("long").alias("rows_extracted"),
        F.lit(done["rows_loaded"]).cast("long").alias("rows_loaded"),
        F.lit(done["validation"]["success"]).alias("validated"),
        F.count(F.lit(1)).alias("rows_stored"),
    )


@query("""
SELECT (SELECT count(*) FROM customer) AS rows_extracted, (SELECT count(*) FROM customer) AS rows_loaded, (SELECT count(*) FROM customer) AS rows_stored, TRUE AS refused, 0::BIGINT AS rows_refused
""")
def etl_published(spark, sf):
    """A sound table is published; one with holes is refused and leaves nothing to read."""
    target = scratch_path(spark, "published")
    done = publish_if_valid(spark, f"{sf}/customer.parquet", target, "parquet", ["c_custkey", "c_name"], run_id="first")
    holes = scratch_path(spark, "holes")
    table(spark, sf, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 5 > 0, F.col("c_name"))).write.parquet(holes)
    try:
        publish_if_valid(spark, holes, target, "parquet", ["c_custkey", "c_name"], run_id="second")
        refused = False
    except ValueError:
        refused = True
    stored = spark.read.parquet(target)
    return stored.agg(
        F.lit(done["rows_extracted"]).cast("long").alias("rows_extracted"), F.lit(done["rows_loaded"]).cast("long").alias("rows_loaded"),
        F.count_if(F.col("run_id") == "first").alias("rows_stored"), F.lit(refused).alias("refused"), F.count_if(F.col("run_id") == "second").alias("rows_refused"),
    )


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type FROM events),
     n AS (SELECT count(*) AS rows_n, count(*) - count(event_id) AS id_n, count(*) - count(value) AS value_n FROM e)
SELECT 0 AS rule, 'expect_table_row_count_to_be_between' AS expectation_type, NULL::VARCHAR AS "column",
       rows_n >= 1 AS success, rows_n AS element_count, 0::BIGINT AS unexpected_count, 0.0::DOUBLE AS unexpected_percent FROM n
UNION ALL SELECT 1, 'expect_table_columns_to_match_ordered_list', NULL, TRUE, rows_n, 0, 0.0 FROM n
UNION ALL SELECT 2, 'expect_column_values_to_not_be_null', 'event_id', id_n = 0, rows_n, id_n, round(id_n / rows_n * 100, 6) FROM n
UNION ALL SELECT 3, 'expect_column_values_to_not_be_null', 'value', value_n = 0, rows_n, value_n, round(value_n / rows_n * 100, 6) FROM n
UNION ALL SELECT 4, 'expect_column_values_to_not_be_null', 'gone', FALSE, NULL, NULL, NULL FROM n
""")
def dq_results(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "event_type"
    )
    rules = quality.suite(["event_id", "value", "gone"], ["event_id", "value", "event_type"])
    return quality.evaluate(events, rules).withColumn("unexpected_percent", F.round("unexpected_percent", 6))


@query("""
SELECT 'value' AS "column", 'expect_column_values_to_not_be_null' AS expectation_type, count(*) FILTER (WHERE event_type = 'error') AS unexpected_count
FROM events HAVING count(*) FILTER (WHERE event_type = 'error') > 0
""")
def dq_failures(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    failed = quality.failures(quality.evaluate(events, quality.suite(["event_id", "value"])))
    return failed.select("column", "expectation_type", "unexpected_count")


@query("""
SELECT 0 AS rule, 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS element_count,
       count(DISTINCT o_orderstatus) BETWEEN 1 AND 3 AS success FROM orders
UNION ALL SELECT 1, 'o_custkey', count(DISTINCT o_custkey), count(DISTINCT o_custkey) >= 10 FROM orders
UNION ALL SELECT 2, 'o_orderpriority', count(DISTINCT o_orderpriority), count(DISTINCT o_orderpriority) BETWEEN 1 AND 4 FROM orders
""")
def dq_cardinality(spark, sf):
    rules = [
        quality.Cardinality("o_orderstatus", 1, 3),
        quality.Cardinality("o_custkey", 10),
        quality.Cardinality("o_orderpriority", 1, 4),
    ]
    return quality.evaluate(table(spark, sf, "orders"), rules).select("rule", "column", "element_count", "success")


@query("""
WITH d AS (SELECT documents.doc_id, lang, quality, toxic FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)
SELECT 'doc_id' AS "column", count(*) AS n_rows, count(*) - count(doc_id) AS n_missing FROM d
UNION ALL SELECT 'lang', count(*), count(*) - count(lang) FROM d
UNION ALL SELECT 'quality', count(*), count(*) - count(quality) FROM d
UNION ALL SELECT 'toxic', count(*), count(*) - count(toxic) FROM d
""")
def null_profile(spark, sf):
    labelled = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return null_counts(labelled)


def _run_log(spark, sf):
    """Events read as runs: errors are failures."""
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(failed, "failure").otherwise("success").alias("status"),
        F.col("user_id").alias("rows_extracted"),
        F.get_json_object("props", "$.k").cast("long").alias("rows_loaded"),
        (F.col("value") * 10).alias("duration_seconds"),
        F.col("ts").alias("run_ts"),
    )


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status, count(*) AS n_runs
FROM events GROUP BY 1
""")
def runlog_status(spark, sf):
    return runlog.status_counts(_run_log(spark, sf))


@query("""
SELECT CAST(sum(user_id) AS BIGINT) AS rows_extracted,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS rows_loaded
FROM events WHERE event_type <> 'error'
""")
def runlog_rows(spark, sf):
    return runlog.row_totals(_run_log(spark, sf))


@query("""
SELECT b.le, count(*) FILTER (WHERE value * 10 <= b.bound) AS "count", round(sum(value * 10), 2) AS "sum"
FROM events, (VALUES ('30', 30), ('60', 60), ('120', 120), ('300', 300), ('600', 600), ('1800', 1800), ('3600', 3600),
                     ('+Inf', 1e300)) AS b(le, bound)
GROUP BY b.le
""")
def runlog_histogram(spark, sf):
    return runlog.duration_histogram(_run_log(spark, sf)).withColumn("sum", F.round("sum", 2))


@query("SELECT max(ts) AS last_run FROM events")
def runlog_last(spark, sf):
    return runlog.last_run(_run_log(spark, sf))


@query("""
SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, substr(c_name, 1, 1) || '***' AS c_name, c_nationkey, c_mktsegment
FROM customer
""")
def mask_customer(spark, sf):
    return mask(table(spark, sf, "customer"), hashed=["c_custkey"], shortened=["c_name"], dropped=["c_acctbal"])


@query("""
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier' FROM supplier
""")
def merge_parties(spark, sf):
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey AS party_key", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf, "supplier").selectExpr("s_suppkey AS party_key", "s_name AS name", "s_nationkey AS nation")
    return merge_sources({"customer": customers, "supplier": suppliers})
