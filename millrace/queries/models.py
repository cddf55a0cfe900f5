"""Feature-store, as-of, split, metric and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import decode
from millrace.operators import attributions, boosting, metrics
from millrace.operators.asof import as_of
from millrace.operators.feature_store import FeatureStore
from millrace.operators.sketches import DISTINCT_ERROR, RANK_ERROR
from millrace.operators.split import stratified_split
from millrace.plans.risk import explain_rows, run_risk
from millrace.plans.scratch import scratch_path
from millrace.queries.registry import query, spread_table, table


@query("""
WITH f AS (SELECT user_id, ts AS click_ts, value AS click_value FROM events WHERE event_type = 'click')
SELECT e.event_id, e.user_id, e.ts, f.click_value
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.click_ts
""")
def asof_features(spark, sf):
    events = table(spark, sf, "events")
    clicks = events.where("event_type = 'click'").selectExpr("user_id", "ts AS click_ts", "value AS click_value")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return as_of(purchases, clicks, ["user_id"], "ts", "click_ts")


@query("""
WITH f AS (SELECT o_custkey AS k, o_orderdate AS odate, max(o_totalprice) AS last_price FROM orders GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.ts, f.last_price
FROM (SELECT event_id, user_id, ts FROM events) e ASOF LEFT JOIN f ON e.user_id = f.k AND e.ts >= f.odate
""")
def asof_split_keys(spark, sf):
    """The same lookup with every key treated as too large for one task."""
    orders = table(spark, sf, "orders").selectExpr("o_custkey AS user_id", "o_orderdate AS odate", "o_totalprice AS last_price")
    return as_of(table(spark, sf, "events").select("event_id", "user_id", "ts"), orders, ["user_id"], "ts", "odate", hot_key_rows=1)


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS k, event_type, ts, value FROM events),
     f AS (SELECT k, ts AS seen, max(value) AS last_value FROM e WHERE event_type = 'click' GROUP BY 1, 2)
SELECT e.event_id, e.k, e.ts, f.last_value FROM e ASOF LEFT JOIN f ON e.k = f.k AND e.ts >= f.seen
""")
def asof_one_hot_key(spark, sf):
    """A third of all rows have one key: it is cut into slices, the other keys are not."""
    events = table(spark, sf, "events").withColumn("k", F.expr("CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"))
    seen = events.where("event_type = 'click'").selectExpr("k", "ts AS seen", "value AS last_value")
    tenth = table(spark, sf, "events").count() // 10
    return as_of(events.select("event_id", "k", "ts"), seen, ["k"], "ts", "seen", hot_key_rows=tenth)


_DATES = """
WITH s AS (SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events),
f AS (SELECT user_id, ts AS seen, max(value) AS last_value FROM events GROUP BY 1, 2)
SELECT s.event_id, s.user_id, f.last_value FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.day >= f.seen
"""


def _by_date(spark, sf, **options):
    """A spine of dates against features with a time of day."""
    days = table(spark, sf, "events").selectExpr("event_id", "user_id", "CAST(ts AS DATE) AS day")
    seen = table(spark, sf, "events").selectExpr("user_id", "ts AS seen", "value AS last_value")
    return as_of(days, seen, ["user_id"], "day", "seen", **options).drop("day")


@query(_DATES)
def asof_date_spine(spark, sf):
    return _by_date(spark, sf)


@query(_DATES)
def asof_date_spine_split(spark, sf):
    return _by_date(spark, sf, hot_key_rows=1)


@query("SELECT c_custkey, c_acctbal, c_acctbal * 2 AS doubled FROM customer")
def feature_resave(spark, sf):
    """A version saved again from itself with one column more."""
    store = FeatureStore(spark, scratch_path(spark, "features"))
    store.save("customers", table(spark, sf, "customer").select("c_custkey", "c_acctbal"), 1)
    store.save("customers", store.load("customers", 1).withColumn("doubled", F.col("c_acctbal") * 2), 1)
    store.vacuum("customers", 1)
    return store.load("customers")


@query("SELECT count(*) AS n_rows, 1 AS latest, 0 AS n_empty FROM customer")
def feature_incomplete(spark, sf):
    """A version without metadata is not served, and an empty store has an empty catalog."""
    store = FeatureStore(spark, scratch_path(spark, "features"))
    empty = store.catalog().count()
    rows = table(spark, sf, "customer").select("c_custkey")
    store.save("customers", rows, 1)
    rows.limit(1).write.parquet(f"{store.root}/customers/v2/broken/features.parquet")
    latest = store.latest_version("customers")
    return store.load("customers").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(latest).alias("latest"), F.lit(empty).cast("int").alias("n_empty"))


@query("""
WITH e AS (SELECT CAST(user_id AS DOUBLE) AS u, value AS v, event_type AS t FROM events)
SELECT 'user_id' AS "column", count(*) AS n_rows, count(*) - count(u) AS n_missing, min(u) AS minimum, max(u) AS maximum,
       TRUE AS distinct_close, TRUE AS quartiles_close, NULL::VARCHAR AS most_frequent FROM e
UNION ALL SELECT 'value', count(*), count(*) - count(v), min(v), max(v), TRUE, TRUE, NULL FROM e
UNION ALL SELECT 'event_type', count(*), count(*) - count(t), NULL, NULL, TRUE, TRUE,
       (SELECT t FROM e GROUP BY t ORDER BY count(*) DESC, t LIMIT 1) FROM e
""")
def feature_profile_merged(spark, sf):
    """Three versions with a third of the events each; their sketches together, held against the exact numbers of all events."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    store = FeatureStore(spark, scratch_path(spark, "features"))
    for version in (1, 2, 3):
        store.save("events", events.where(F.col("event_id") % 3 == version - 1).drop("event_id"), version, sketches=True)
    profile = store.profile("events")
    found = {r["column"]: r for r in profile.collect()}
    checks = []
    for name in ("user_id", "value", "event_type"):
        checks.append(F.countDistinct(name).alias(f"d_{name}"))
        for p in ("p25", "p50", "p75") if name != "event_type" else ():
            checks += [F.avg((F.col(name) < found[name][p]).cast("int")).alias(f"{p}_below_{name}"), F.avg((F.col(name) <= found[name][p]).cast("int")).alias(f"{p}_upto_{name}")]
    exact = events.agg(*checks).first()

    def ranks_close(name):
        return name == "event_type" or all(
            exact[f"p{q}_below_{name}"] - RANK_ERROR <= q / 100 <= exact[f"p{q}_upto_{name}"] + RANK_ERROR for q in (25, 50, 75)
        )

    close = [(n, abs(found[n]["n_distinct"] - exact[f"d_{n}"]) <= DISTINCT_ERROR * exact[f"d_{n}"], ranks_close(n)) for n in found]
    verdict = spark.createDataFrame(close, "column string, distinct_close boolean, quartiles_close boolean")
    return profile.join(verdict, "column").select(
        "column", "n_rows", "n_missing", "minimum", "maximum", "distinct_close", "quartiles_close", F.get("frequent", 0)["item"].alias("most_frequent")
    )


def _saved(spark, sf):
    store = FeatureStore(spark, scratch_path(spark, "features"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    store.save("customers", customers, 1, "balances", ["risk", "customer"])
    store.save("customers", customers.where("c_acctbal >= 0"), 3, "without debt", ["risk"])
    store.save("suppliers", table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), 2)
    return store


@query("""
SELECT 'customers' AS name, 1 AS version, 'balances' AS description, count(*) AS num_rows, 3 AS num_columns FROM customer
UNION ALL SELECT 'customers', 3, 'without debt', count(*), 3 FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'suppliers', 2, '', count(*), 2 FROM supplier
""")
def feature_versions(spark, sf):
    return _saved(spark, sf).catalog().select("name", "version", "description", "num_rows", "num_columns")


@query("""
SELECT 3 AS latest, round(avg(c_acctbal), 4) AS mean_balance, count(*) AS n_rows,
       (SELECT count(*) FROM (VALUES (1), (3))) AS n_tagged
FROM customer WHERE c_acctbal >= 0
""")
def feature_metadata(spark, sf):
    store = _saved(spark, sf)
    latest = store.latest_version("customers")
    document = store.get_metadata("customers", latest)
    return store.find(tag="risk").agg(
        F.lit(latest).alias("latest"),
        F.round(F.lit(document["statistics"]["c_acctbal"]["mean"]), 4).alias("mean_balance"),
        F.lit(document["num_rows"]).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_tagged"),
    )


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def feature_load_latest(spark, sf):
    return _saved(spark, sf).load("customers")


_SPLIT = """SELECT c_custkey, c_mktsegment,
  CASE WHEN row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('42|' || c_custkey)) <= round(0.2 * count(*) OVER (PARTITION BY c_mktsegment))
       THEN 'test' ELSE 'train' END AS split
FROM customer"""


@query(_SPLIT)
def stratified_split_rows(spark, sf):
    return stratified_split(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["c_custkey"])


@query(f"SELECT c_mktsegment, split, count(*) AS n FROM ({_SPLIT}) GROUP BY 1, 2")
def split_shares(spark, sf):
    rows = stratified_split(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["c_custkey"])
    return rows.groupBy("c_mktsegment", "split").agg(F.count(F.lit(1)).alias("n"))


def _guessed(spark, sf):
    """Lines with a class from the discount and a guess from the quantity."""
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_discount") < 0.03, 0).when(F.col("l_discount") < 0.07, 1).otherwise(2).alias("label"),
        F.when(F.col("l_quantity") < 17, 0).when(F.col("l_quantity") < 34, 1).otherwise(2).alias("prediction"),
        "l_extendedprice",
        "l_quantity",
    )


_GUESSED = """SELECT CASE WHEN l_discount < 0.03 THEN 0 WHEN l_discount < 0.07 THEN 1 ELSE 2 END AS label,
  CASE WHEN l_quantity < 17 THEN 0 WHEN l_quantity < 34 THEN 1 ELSE 2 END AS prediction, l_extendedprice, l_quantity FROM lineitem"""


@query(f"SELECT label, prediction, count(*) AS n FROM ({_GUESSED}) GROUP BY 1, 2")
def confusion_counts(spark, sf):
    return metrics.confusion_counts(_guessed(spark, sf), "label", "prediction")


_REPORT = f"""
WITH g AS ({_GUESSED}),
  k AS (SELECT c, CASE c WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS class,
          count(*) FILTER (WHERE label = c AND prediction = c) AS hit, count(*) FILTER (WHERE prediction = c) AS pred,
          count(*) FILTER (WHERE label = c) AS support FROM g, (VALUES (0), (1), (2)) AS v(c) GROUP BY 1),
  r AS (SELECT class, CASE WHEN pred > 0 THEN hit / pred ELSE 0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS q,
          CASE WHEN pred + support > 0 THEN 2 * hit / (pred + support) ELSE 0 END AS f, support, hit FROM k)
SELECT class, round(p, 6) AS precision, round(q, 6) AS recall, round(f, 6) AS f1_score, support FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(q), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM r
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(q * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r
"""


@query(_REPORT)
def classification_report(spark, sf):
    report = metrics.classification_report(_guessed(spark, sf), "label", "prediction", boosting.RISK_LABELS)
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


@query(_REPORT)
def classification_report_double(spark, sf):
    """The target as a csv or a cap leaves it: a double."""
    rows = _guessed(spark, sf).withColumn("label", F.col("label").cast("double"))
    report = metrics.classification_report(rows, "label", "prediction", boosting.RISK_LABELS)
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


@query("""
WITH s AS (SELECT l_returnflag = 'A' AS pos, l_extendedprice AS score FROM lineitem WHERE l_linenumber <> 3),
     r AS (SELECT pos, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM s),
     a AS (SELECT count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS n, sum(rk) FILTER (WHERE pos) AS w FROM r)
SELECT p AS n_pos, n AS n_neg, round((w - p * (p + 1) / 2) / p / n, 6) AS auc FROM a
""")
def roc_auc_with_missing(spark, sf):
    """Every third line of an order has no score."""
    score = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("score")
    rows = table(spark, sf, "lineitem").select("l_returnflag", score)
    return metrics.roc_auc(rows, "l_returnflag", "score", "A").withColumn("auc", F.round("auc", 6))


@query("""
WITH s AS (SELECT l_returnflag = 'A' AS pos, l_extendedprice AS score FROM lineitem),
     r AS (SELECT pos, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM s),
     a AS (SELECT count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS n, sum(rk) FILTER (WHERE pos) AS w FROM r)
SELECT p AS n_pos, n AS n_neg, round((w - p * (p + 1) / 2) / p / n, 6) AS auc FROM a
""")
def roc_auc_binary(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return metrics.roc_auc(rows, "l_returnflag", "l_extendedprice", "A").withColumn("auc", F.round("auc", 6))


def _rank_area(c: int, score: str) -> str:
    return f"""SELECT {c} AS class, round((sum(rk) FILTER (WHERE pos) - count(*) FILTER (WHERE pos) * (count(*) FILTER (WHERE pos) + 1) / 2)
  / count(*) FILTER (WHERE pos) / count(*) FILTER (WHERE NOT pos), 6) AS auc
FROM (SELECT label = {c} AS pos, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS rk FROM ({_GUESSED}))"""


_SCORES = {0: "l_extendedprice", 1: "l_quantity", 2: "l_extendedprice"}


@query(" UNION ALL ".join(_rank_area(c, s) for c, s in _SCORES.items()))
def roc_auc_ovr(spark, sf):
    areas = metrics.roc_auc_by_class(_guessed(spark, sf), "label", _SCORES)
    return areas.select("class", F.round("auc", 6).alias("auc"))


_LINEAR = {"l_quantity": (0.1, 25.0), "l_extendedprice": (0.0001, 50000.0), "l_discount": (-40.0, 0.05), "l_tax": (30.0, 0.04)}


def _linear(spark, sf):
    """Contributions of a linear score: weight times distance from a reference point."""
    parts = [F.lit(w) * (F.col(c) - F.lit(m)) for c, (w, m) in _LINEAR.items()]
    return spread_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", *_LINEAR).select(
        "l_orderkey", "l_linenumber", F.lit(2).alias("class"), F.array(*parts).alias("contributions")
    )


_NUMBERED = "WITH numbered AS (SELECT *, row_number() OVER () AS rid FROM lineitem)"
_LINEAR_SQL = " UNION ALL ".join(
    f"SELECT rid, l_orderkey, l_linenumber, {i} AS i, '{c}' AS feature, {w}::DOUBLE * ({c} - {m}::DOUBLE) AS contribution FROM numbered"
    for i, (c, (w, m)) in enumerate(_LINEAR.items())
)


@query(f"""{_NUMBERED}
SELECT l_orderkey, l_linenumber, CAST(rank AS INTEGER) AS rank, feature, round(contribution, 6) AS contribution FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(contribution) DESC, i) AS rank FROM ({_LINEAR_SQL}))
WHERE rank <= 2
""")
def topk_contributions(spark, sf):
    top = attributions.top_contributions(_linear(spark, sf), list(_LINEAR), 2)
    return top.select("l_orderkey", "l_linenumber", "rank", "feature", F.round("contribution", 6).alias("contribution"))


@query(f"""{_NUMBERED}
SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM ({_LINEAR_SQL}) GROUP BY 1 ORDER BY importance DESC LIMIT 3
""")
def global_importance(spark, sf):
    sizes = attributions.global_importance(_linear(spark, sf), list(_LINEAR), 3)
    return sizes.select("feature", F.round("importance", 6).alias("importance"))


@query(f"""
SELECT label, CASE label WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS risk, count(*) AS n FROM ({_GUESSED}) GROUP BY 1, 2
""")
def risk_labels(spark, sf):
    rows = _guessed(spark, sf).select("label", decode(F.col("label"), boosting.RISK_LABELS).alias("risk"))
    return rows.groupBy("label", "risk").agg(F.count(F.lit(1)).alias("n"))


def _patients(spark, sf):
    """One row per customer: order behaviour as features, the balance tier as risk level."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.sum("o_totalprice").alias("spent"),
        F.max("o_totalprice").alias("largest"),
    )
    tier = F.when(F.col("c_acctbal") < 2000, 0).when(F.col("c_acctbal") < 6000, 1).otherwise(2)
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("nation"),
        F.length("c_mktsegment").cast("double").alias("segment"), tier.alias("risk_level"),
    )
    return customers.join(orders, "c_custkey", "left").fillna(0.0)


_SMALL_TREES = {"trees": 10, "depth": 3, "rate": 0.1}


@query()
def risk_model_metrics(spark, sf):
    _, _, found = boosting.train_risk_model(_patients(spark, sf), key=["c_custkey"], features=_FEATURES, **_SMALL_TREES)
    return found["classification_report"]


_TESTED = """SELECT tier, c_custkey FROM (
  SELECT *, row_number() OVER (PARTITION BY tier ORDER BY md5('42|' || c_custkey)) AS place, round(0.2 * count(*) OVER (PARTITION BY tier)) AS n_test
  FROM (SELECT c_custkey, CASE WHEN c_acctbal < 2000 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS tier FROM customer))
WHERE place <= n_test"""


@query(f"SELECT tier, count(*) AS n_test, count(*) AS n_sum_one, count(*) AS n_likeliest FROM ({_TESTED}) GROUP BY 1")
def risk_model_invariants(spark, sf):
    """Test rows of each class: their share, probabilities that sum to 1, the likeliest class predicted."""
    _, scored, _ = boosting.train_risk_model(_patients(spark, sf), key=["c_custkey"], features=_FEATURES, **_SMALL_TREES)
    chances = [F.col(f"probability_{c}") for c in range(3)]
    return scored.groupBy(F.col("risk_level").alias("tier")).agg(
        F.count(F.lit(1)).alias("n_test"),
        F.count_if(F.abs(sum(chances[1:], chances[0]) - 1) < 1e-9).alias("n_sum_one"),
        F.count_if(F.get(F.array(*chances), F.col("prediction")) == F.greatest(*chances)).alias("n_likeliest"),
    )


@query(f"SELECT CAST(c AS INTEGER) AS class, count(*) AS n_rows, count(*) AS n_additive FROM ({_TESTED}), (VALUES (0), (1), (2)) AS v(c) GROUP BY 1")
def risk_attribution_invariants(spark, sf):
    """Base value and contributions of a row add up to its margin, for every class."""
    run = run_risk(_patients(spark, sf), ["c_custkey"], features=_FEATURES, **_SMALL_TREES)
    whole = F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    margins = F.array(*[F.col(f"margin_{c}") for c in range(3)])
    both = run.attributed.join(run.scored, "c_custkey")
    return both.groupBy("class").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(whole - F.get(margins, F.col("class"))) < 1e-9).alias("n_additive"))


@query(
    f"""SELECT tier, count(*) AS n_test, count(*) AS n_softmax, CAST(10 AS BIGINT) AS n_rounds, CAST(9 AS BIGINT) AS n_falling FROM ({_TESTED}) GROUP BY 1"""
)
def risk_softmax_invariants(spark, sf):
    """Test rows of each class whose probabilities are the softmax of their margins; rounds, and rounds after which the training loss fell."""
    model, scored, _ = boosting.train_risk_model(_patients(spark, sf), key=["c_custkey"], features=_FEATURES, **_SMALL_TREES, subsample=1.0)
    losses = spark.createDataFrame(list(enumerate(model.softmax.losses)), "round bigint, loss double")
    falling = losses.alias("a").join(losses.alias("b"), F.expr("b.round = a.round + 1 and b.loss < a.loss")).count()
    whole = sum((F.exp(F.col(f"margin_{c}")) for c in (1, 2)), F.exp(F.col("margin_0")))
    right = F.forall(F.array(*[F.abs(F.exp(F.col(f"margin_{c}")) / whole - F.col(f"probability_{c}")) for c in range(3)]), lambda d: d < 1e-9)
    return scored.groupBy(F.col("risk_level").alias("tier")).agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(right).alias("n_softmax"),
        F.lit(losses.count()).cast("bigint").alias("n_rounds"), F.lit(falling).cast("bigint").alias("n_falling"),
    )


_FEATURES = ["nation", "segment", "n_orders", "spent", "largest"]


@query()
def risk_attributions(spark, sf):
    run = run_risk(_patients(spark, sf), ["c_custkey"], features=_FEATURES, **_SMALL_TREES)
    return explain_rows(run.attributed, run.model.features)
