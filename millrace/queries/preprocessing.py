"""Imputation, outlier, scaling, encoding and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import encoding, impute, outliers, profile, scaling
from millrace.plans.health import HealthModel, preprocess
from millrace.plans.scratch import scratch_path
from millrace.queries.registry import query, table


def _events_with_holes(spark, sf):
    """Values of error events are missing."""
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )


_HOLES = "SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events"


@query(f"""
WITH e AS ({_HOLES})
SELECT event_id, round(coalesce(value, (SELECT median(value) FROM e)), 6) AS value FROM e
""")
def impute_median(spark, sf):
    filled = impute.impute_missing(_events_with_holes(spark, sf), numeric=["value"], categorical=["event_type"])
    return filled.select("event_id", F.round("value", 6).alias("value"))


@query(f"""
WITH e AS ({_HOLES})
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM e)), 6) AS value FROM e
""")
def impute_mean(spark, sf):
    filled = impute.impute_missing(
        _events_with_holes(spark, sf), numeric_strategy="mean", numeric=["value"], categorical=["event_type"]
    )
    return filled.select("event_id", F.round("value", 6).alias("value"))


def _orders_with_holes(spark, sf):
    open_order = F.col("o_orderstatus") == "P"
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(~open_order, F.col("o_orderpriority")).alias("o_orderpriority"), "o_orderstatus"
    )


_ORDER_HOLES = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
o_orderstatus FROM orders"""


@query(f"""
WITH o AS ({_ORDER_HOLES}),
     m AS (SELECT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority FROM o
""")
def impute_mode(spark, sf):
    filled = impute.impute_missing(_orders_with_holes(spark, sf), numeric=["o_orderkey"])
    return filled.select("o_orderkey", "o_orderpriority")


@query(f"WITH o AS ({_ORDER_HOLES}) SELECT o_orderkey, coalesce(o_orderpriority, 'UNKNOWN') AS o_orderpriority FROM o")
def impute_constant(spark, sf):
    filled = impute.impute_missing(
        _orders_with_holes(spark, sf), categorical_strategy="constant", numeric=["o_orderkey"]
    )
    return filled.select("o_orderkey", "o_orderpriority")


@query("""
WITH e AS (SELECT event_id, event_type, CASE WHEN value > 100 THEN NULL ELSE value END AS value FROM events),
     m AS (SELECT event_type, median(value) AS fill FROM e GROUP BY 1)
SELECT event_id, event_type, round(coalesce(value, fill), 6) AS value FROM e JOIN m USING (event_type)
""")
def impute_by_group(spark, sf):
    holes = table(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("value") <= 100, F.col("value")).alias("value")
    )
    filled = impute.impute_missing(holes, numeric=["value"], by=["event_type"])
    return filled.select("event_id", "event_type", F.round("value", 6).alias("value"))


@query("""
WITH b AS (SELECT c_nationkey AS g, c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT g AS c_nationkey, v AS c_mktsegment FROM b QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC, v) = 1
""")
def modes_by_nation(spark, sf):
    found = impute.modes(table(spark, sf, "customer"), ["c_mktsegment"], ["c_nationkey"])
    return found.select("c_nationkey", F.col("value").alias("c_mktsegment"))


_FENCES = """
SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower,
       quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper FROM {t}"""
PRICES = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(lower, 6) AS lower, round(upper, 6) AS upper FROM ({_FENCES.format(c=c, t='lineitem')})"""
        for c in PRICES
    )
)
def iqr_fences(spark, sf):
    fences = outliers.fit_fences(table(spark, sf, "lineitem"), PRICES)
    return fences.to_df(spark).select("column", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query("""
SELECT l_returnflag, 'l_extendedprice' AS "column",
       round(quantile_cont(l_extendedprice, 0.25) - 1.5 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)), 6) AS lower,
       round(quantile_cont(l_extendedprice, 0.75) + 1.5 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)), 6) AS upper
FROM lineitem GROUP BY 1
""")
def iqr_fences_by_group(spark, sf):
    fences = outliers.fit_fences(table(spark, sf, "lineitem"), ["l_extendedprice"], by=["l_returnflag"])
    return fences.to_df().select(
        "l_returnflag", "column", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")
    )


@query(f"""
WITH f AS ({_FENCES.format(c='value', t='events')})
SELECT event_id, round(greatest(least(value, upper), lower), 6) AS value FROM events, f
""")
def iqr_cap(spark, sf):
    capped, _ = outliers.cap_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"])
    return capped.select("event_id", F.round("value", 6).alias("value"))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n_values, count(*) FILTER (WHERE {c} < lower OR {c} > upper) AS n_capped
FROM {t}, ({_FENCES.format(c=c, t=t)})"""
        for c, t in (("value", "events"), ("user_id", "events"))
    )
)
def outlier_counts(spark, sf):
    events = table(spark, sf, "events").select("value", "user_id")
    return outliers.outlier_counts(events, outliers.fit_fences(events, ["value", "user_id"]))


@query("""
WITH s AS (SELECT avg(l_extendedprice) AS pm, stddev_pop(l_extendedprice) AS pd, avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qd FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - pm) / pd, 6) AS l_extendedprice, round((l_quantity - qm) / qd, 6) AS l_quantity
FROM lineitem, s
""")
def scale_standard(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    scaled, _ = scaling.scale_features(lines, ["l_extendedprice", "l_quantity"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("l_extendedprice", "l_quantity")})


@query("""
WITH s AS (SELECT min(l_extendedprice) AS p0, max(l_extendedprice) AS p1, min(l_quantity) AS q0, max(l_quantity) AS q1 FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - p0) / (p1 - p0), 6) AS l_extendedprice, round((l_quantity - q0) / (q1 - q0), 6) AS l_quantity
FROM lineitem, s
""")
def scale_minmax(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    scaled, _ = scaling.scale_features(lines, ["l_extendedprice", "l_quantity"], "minmax")
    return scaled.withColumns({c: F.round(c, 6) for c in ("l_extendedprice", "l_quantity")})


@query("SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice FROM orders")
def scale_inverse(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    scaled, scaler = scaling.scale_features(orders, ["o_totalprice"])
    return scaling.unscale(scaled, scaler).withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("""
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type
FROM part
""")
def label_encode(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return encoding.encode_labels(parts, ["p_brand", "p_type"])[0]


@query("""
SELECT 'c_mktsegment' AS "column", c_mktsegment AS "value", CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT c_mktsegment FROM customer)
UNION ALL
SELECT 'c_name', c_name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) FROM (SELECT DISTINCT c_name FROM customer)
""")
def encoder_classes(spark, sf):
    return encoding.fit_encoder(table(spark, sf, "customer"), ["c_mktsegment", "c_name"]).entries


@query("""
SELECT doc_id, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS source FROM documents
""")
def encode_through_slices(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    # A bound of one class sends the dictionary through the distributed ranking.
    encoder = encoding.fit_encoder(documents, ["source"], rank_limit=1)
    return encoding.encode(documents, encoder)


_FITTED = """
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
                  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                  CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind FROM events),
     mode AS (SELECT kind AS v FROM e WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
     i AS (SELECT event_id, coalesce(value, (SELECT median(value) FROM e)) AS value, k, coalesce(kind, (SELECT v FROM mode)) AS kind FROM e),
     f AS (SELECT quantile_cont(value, 0.25) AS v1, quantile_cont(value, 0.75) AS v3, quantile_cont(k, 0.25) AS k1, quantile_cont(k, 0.75) AS k3 FROM i),
     c AS (SELECT event_id, kind, greatest(least(value, v3 + 1.5 * (v3 - v1)), v1 - 1.5 * (v3 - v1)) AS value,
                  greatest(least(k, k3 + 1.5 * (k3 - k1)), k1 - 1.5 * (k3 - k1)) AS k FROM i, f),
     s AS (SELECT avg(value) AS vm, stddev_pop(value) AS vd, avg(k) AS km, stddev_pop(k) AS kd FROM c)
"""

_PREPROCESSED = _FITTED + """
SELECT event_id, round((value - vm) / vd, 5) AS value, round((k - km) / kd, 5) AS k,
       CAST(dense_rank() OVER (ORDER BY kind) - 1 AS INTEGER) AS kind
FROM c, s
"""


def _raw_health(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
    )


@query(_PREPROCESSED)
def preprocess_health(spark, sf):
    done = preprocess(_raw_health(spark, sf), not_null=["value", "kind"], exclude=["event_id"]).dataframe
    return done.withColumns({c: F.round(c, 5) for c in ("value", "k")})


@query(_PREPROCESSED)
def preprocess_new_rows(spark, sf):
    """A fitted model applied to rows as if they were new."""
    raw = _raw_health(spark, sf)
    applied = preprocess(raw, exclude=["event_id"]).apply(raw)
    return applied.withColumns({c: F.round(c, 5) for c in ("value", "k")})


@query(
    _FITTED
    + """, n AS (SELECT event_id, coalesce(value, (SELECT median(value) FROM e)) AS value,
             coalesce(CASE WHEN kind = 'purchase' THEN NULL ELSE k END, (SELECT median(k) FROM e)) AS k, coalesce(kind, (SELECT v FROM mode)) AS kind FROM e)
SELECT event_id, round((greatest(least(value, v3 + 1.5 * (v3 - v1)), v1 - 1.5 * (v3 - v1)) - vm) / vd, 5) AS value,
       round((greatest(least(k, k3 + 1.5 * (k3 - k1)), k1 - 1.5 * (k3 - k1)) - km) / kd, 5) AS k,
       CAST(dense_rank() OVER (ORDER BY kind) - 1 AS INTEGER) AS kind
FROM n, f, s
"""
)
def preprocess_saved_model(spark, sf):
    """A model that was saved and loaded, on rows with holes where the fit saw none."""
    raw, path = _raw_health(spark, sf), scratch_path(spark, "model")
    preprocess(raw, exclude=["event_id"], for_new_rows=True).save(spark, path)
    holes = raw.withColumn("k", F.when(F.coalesce(F.col("kind"), F.lit("")) != "purchase", F.col("k")))
    applied = HealthModel.load(spark, path).apply(holes)
    return applied.withColumns({c: F.round(c, 5) for c in ("value", "k")})


@query(
    _FITTED
    + """SELECT 'impute' AS step, 'value' AS "column", (SELECT count(*) - count(value) FROM e) AS n_changed
UNION ALL SELECT 'impute', 'kind', (SELECT count(*) - count(kind) FROM e)
UNION ALL SELECT 'cap', 'value', (SELECT count(*) FROM i, f WHERE value > v3 + 1.5 * (v3 - v1) OR value < v1 - 1.5 * (v3 - v1))
UNION ALL SELECT 'cap', 'k', (SELECT count(*) FROM i, f WHERE k > k3 + 1.5 * (k3 - k1) OR k < k1 - 1.5 * (k3 - k1))
UNION ALL SELECT 'standard', 'value', (SELECT count(*) FROM c, s WHERE (value - vm) / vd <> value)
UNION ALL SELECT 'standard', 'k', (SELECT count(*) FROM c, s WHERE (k - km) / kd <> k) UNION ALL SELECT 'encode', 'kind', (SELECT count(*) FROM e)
"""
)
def preprocess_audit(spark, sf):
    return preprocess(_raw_health(spark, sf), exclude=["event_id"]).audit().select("step", "column", "n_changed")


def _describe_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", count({name}) AS "count", round(avg({name}), 4) AS mean, round(stddev_samp({name}), 4) AS std,
       CAST(min({name}) AS DOUBLE) AS "min", round(quantile_cont({name}, 0.25), 6) AS p25, round(quantile_cont({name}, 0.5), 6) AS p50,
       round(quantile_cont({name}, 0.75), 6) AS p75, CAST(max({name}) AS DOUBLE) AS "max" FROM events"""


@query(" UNION ALL ".join(_describe_sql(n) for n in ("event_id", "user_id", "value")))
def describe_numeric(spark, sf):
    found = profile.describe(table(spark, sf, "events").select("event_id", "user_id", "value"))
    return found.select(
        "column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
        *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max",
    )


def _text_sql(name: str) -> str:
    return f"""(SELECT '{name}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
       first(v ORDER BY n DESC, v) AS top, max(n) AS freq FROM (SELECT {name} AS v, count(*) AS n FROM customer GROUP BY 1))"""


@query(" UNION ALL ".join(_text_sql(n) for n in ("c_name", "c_mktsegment")))
def describe_text(spark, sf):
    found = profile.describe(table(spark, sf, "customer").select("c_name", "c_mktsegment"))
    return found.select("column", "count", "unique", "top", "freq")
