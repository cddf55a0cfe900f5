"""JSON event and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import events as ev
from millrace.plans.scratch import scratch_path
from millrace.queries.registry import query, table
from millrace.sinks.tables import publish_files
from millrace.sources.topics import read_file_stream, schema_of
from millrace.streaming import ingest


def _envelope(source, value, topic):
    """Rows as raw messages; error events carry text that is no JSON."""
    broken = F.col("event_type") == "error"
    return source.select(
        F.when(broken, F.lit("not json")).otherwise(value).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _text(name: str):
    return F.col(name).cast("string")


def _parsed(spark, raw, topic):
    parsed = ev.parse_events(raw, schema_of(topic)).drop("ingested_at")
    return parsed.withColumn("kafka_ts", F.col("kafka_ts").cast("timestamp_ntz"))


def _action(source):
    fields = ev.action_fields(F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("ts"))
    return _envelope(source, ev.event_json(fields), "user-actions")


def _order(source):
    status = F.when(F.col("event_type") == "purchase", "placed")
    fields = ev.order_fields(
        F.col("event_id"), F.md5(_text("event_id")), F.col("user_id"), F.col("value"), status, F.col("ts")
    )
    return _envelope(source, ev.event_json(fields), "orders")


def _page_view(source):
    page = F.concat(F.lit("/"), F.col("event_type"))
    fields = ev.page_view_fields(
        F.col("event_id"), F.col("user_id"), page, F.get_json_object("props", "$.k"), F.col("ts")
    )
    return _envelope(source, ev.event_json(fields), "page-views")


_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def _unless_broken(**fields: str) -> str:
    return ", ".join(f"CASE WHEN event_type = 'error' THEN NULL ELSE {e} END AS {n}" for n, e in fields.items())


_ACTIONS = f"""SELECT 'user-actions' AS topic, ts AS kafka_ts, {_unless_broken(
    event_id='CAST(event_id AS VARCHAR)', event_kind="'user_action'", user_id='CAST(user_id AS VARCHAR)',
    action='event_type', timestamp=_ISO)} FROM events"""
_ORDERS = f"""SELECT 'orders' AS topic, ts AS kafka_ts, {_unless_broken(
    event_id='CAST(event_id AS VARCHAR)', event_kind="'order'", order_id='md5(CAST(event_id AS VARCHAR))', user_id='CAST(user_id AS VARCHAR)',
    amount='value', currency="'USD'", status="CASE WHEN event_type = 'purchase' THEN 'placed' END", timestamp=_ISO)} FROM events"""
_VIEWS = f"""SELECT 'page-views' AS topic, ts AS kafka_ts, {_unless_broken(
    event_id='CAST(event_id AS VARCHAR)', event_kind="'page_view'", user_id='CAST(user_id AS VARCHAR)',
    page="'/' || event_type", duration_ms="CAST(json_extract_string(props, '$.k') AS INTEGER)", timestamp=_ISO)} FROM events"""


def _renamed(sql: str) -> str:
    return f"SELECT * RENAME (event_kind AS event_type) FROM ({sql})"


@query(_renamed(_ACTIONS))
def parse_events_user_actions(spark, sf):
    return _parsed(spark, _action(table(spark, sf, "events")), "user-actions")


@query(_renamed(_ORDERS))
def parse_events_orders(spark, sf):
    return _parsed(spark, _order(table(spark, sf, "events")), "orders")


@query(_renamed(_VIEWS))
def parse_events_page_views(spark, sf):
    return _parsed(spark, _page_view(table(spark, sf, "events")), "page-views")


@query(f"""
SELECT * EXCLUDE (kafka_ts) FROM ({_renamed(_ACTIONS)})
UNION ALL BY NAME SELECT * EXCLUDE (kafka_ts) FROM ({_renamed(_ORDERS)})
UNION ALL BY NAME SELECT * EXCLUDE (kafka_ts) FROM ({_renamed(_VIEWS)})
""")
def union_topics(spark, sf):
    source = table(spark, sf, "events")
    made = {"user-actions": _action(source), "orders": _order(source), "page-views": _page_view(source)}
    parsed = {t: ev.parse_events(raw, schema_of(t)).drop("topic", "kafka_ts", "ingested_at") for t, raw in made.items()}
    return ingest.union_topics(parsed)


def _mixed(source):
    """Messages that are whole, lack fields, are no object, or are no JSON, by event type."""
    kind = F.col("event_type")
    head = F.concat(F.lit('{"event_type": "'), kind, F.lit('"'))
    whole = F.concat(head, F.lit(', "event_id": "'), _text("event_id"), F.lit('", "timestamp": null}'))
    value = (
        F.when(kind == "error", F.lit("not json"))
        .when(kind == "signup", F.concat(F.lit("["), _text("event_id"), F.lit("]")))
        .when(kind == "view", F.concat(head, F.lit("}")))
        .when(kind == "click", F.concat(whole, F.lit(" trailing")))
        .otherwise(whole)
    )
    return source.select("event_id", value.alias("value"))


_MIXED = """SELECT event_id,
  CASE event_type WHEN 'error' THEN 'not json' WHEN 'signup' THEN '[' || event_id || ']'
    WHEN 'view' THEN '{"event_type": "view"}'
    WHEN 'click' THEN '{"event_type": "click", "event_id": "' || event_id || '", "timestamp": null} trailing'
    ELSE '{"event_type": "' || event_type || '", "event_id": "' || event_id || '", "timestamp": null}' END AS value,
  CASE event_type WHEN 'error' THEN 'JSONDecodeError' WHEN 'click' THEN 'JSONDecodeError' WHEN 'signup' THEN 'TypeError'
    WHEN 'view' THEN 'ValueError' END AS error_type,
  CASE event_type WHEN 'error' THEN 'Message is not valid JSON' WHEN 'click' THEN 'Message is not valid JSON'
    WHEN 'signup' THEN 'Message is not a JSON object'
    WHEN 'view' THEN 'Message is missing required fields: {''event_id'', ''timestamp''}' END AS error_reason
FROM events"""


@query(f"SELECT event_id, error_type, error_reason FROM ({_MIXED})")
def json_required_fields(spark, sf):
    return ev.check_events(_mixed(table(spark, sf, "events"))).select("event_id", "error_type", "error_reason")


@query(f"""SELECT error_reason AS dlq_reason, error_type AS dlq_error_type, value AS original_message
FROM ({_MIXED}) WHERE error_type IS NOT NULL""")
def dlq_split(spark, sf):
    return ev.dead_letters(ev.check_events(_mixed(table(spark, sf, "events"))))


@query(f"""SELECT event_id, rtrim(value, '}}') || ', "processed": true}}' AS message, TRUE AS processed
FROM ({_MIXED}) WHERE error_type IS NULL""")
def processed_events(spark, sf):
    good = ev.valid_events(ev.check_events(_mixed(table(spark, sf, "events"))))
    return good.select("event_id", ev.mark_processed(F.col("value")).alias("message"), "processed")


def _typed(spark, sf):
    kind = F.col("event_type")
    named = (
        F.when(kind.isin("click", "signup"), "user_action").when(kind == "purchase", "order").when(kind == "view", "page_view").otherwise(kind)
    )
    return table(spark, sf, "events").select(_text("event_id").alias("event_id"), named.alias("event_type"), "value")


_TOPIC = """CASE event_type WHEN 'click' THEN 'user-actions' WHEN 'signup' THEN 'user-actions' WHEN 'purchase' THEN 'orders'
WHEN 'view' THEN 'page-views' END"""


@query(f"SELECT CAST(event_id AS VARCHAR) AS key, {_TOPIC} AS topic FROM events")
def event_routing(spark, sf):
    return ev.to_messages(_typed(spark, sf)).select("key", "topic")


@query(f"SELECT coalesce({_TOPIC}, 'dead-letter') AS topic, count(*) AS n_messages FROM events GROUP BY 1")
def route_counts(spark, sf):
    target = scratch_path(spark, "topics")
    publish_files(ev.to_messages(_typed(spark, sf)), target)
    return spark.read.parquet(target).groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"))


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_file_stream(spark, f"{sf}/events*.parquet", schema)


@query(_renamed(_ORDERS))
def stream_ingest(spark, sf):
    base = scratch_path(spark, "stream")
    started, _ = ingest.start_topics(
        lambda topic: _order(_stream(spark, sf)), "orders", f"{base}/out", f"{base}/checkpoint", available_now=True
    )
    ingest.wait(spark, started)
    rows = spark.read.parquet(f"{base}/out/orders").drop("ingested_at")
    return rows.withColumn("kafka_ts", F.col("kafka_ts").cast("timestamp_ntz"))


@query(f"SELECT coalesce(error_type, 'valid') AS outcome, count(*) AS n_messages FROM ({_MIXED}) GROUP BY 1")
def stream_dlq(spark, sf):
    base = scratch_path(spark, "stream")
    ingest.consume(
        _mixed(_stream(spark, sf)), f"{base}/events", f"{base}/dead", f"{base}/checkpoint", available_now=True
    ).awaitTermination()
    outcomes = spark.read.parquet(f"{base}/events").select(F.lit("valid").alias("outcome")).unionAll(
        spark.read.parquet(f"{base}/dead").select("dlq_error_type")
    )
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_messages"))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n_events FROM events GROUP BY 1, 2
""")
def window_counts(spark, sf):
    return ingest.window_counts(table(spark, sf, "events"), "ts", "1 hour", ["event_type"])


@query("SELECT event_id, event_type FROM events")
def stream_redelivery(spark, sf):
    """Every event arrives twice and is kept once."""
    base = scratch_path(spark, "stream")
    once = _stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    twice = once.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    kept = ingest.drop_redelivered(twice, "ts", "10 minutes").select("event_id", "event_type")
    ingest.write_stream(kept, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n_events FROM events
WHERE ts < (SELECT time_bucket(INTERVAL 1 DAY, max(ts) - INTERVAL 1 HOUR) FROM events) GROUP BY 1, 2
""")
def stream_window_counts(spark, sf):
    """Only windows that the watermark has closed are final."""
    base = scratch_path(spark, "stream")
    timed = _stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    counted = ingest.window_counts(timed, "ts", "1 day", ["event_type"], delay="1 hour")
    ingest.write_stream(counted, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{base}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _delivered(spark, sf, rows, n_files):
    """A stream over files written one after the other, one a batch; `rows` has their number in `_file`."""
    base = scratch_path(spark, "deliveries")
    for n in range(n_files):
        rows.where(F.col("_file") == n).drop("_file").coalesce(1).write.parquet(f"{base}/{n}")
    return read_file_stream(spark, f"{base}/*", rows.drop("_file").schema, max_files_per_trigger=1)


_DELIVERIES = """
WITH n AS (SELECT event_id, ts, least(4, CAST(floor((epoch(ts) - (SELECT epoch(min(ts)) FROM events)) / 518400) AS INTEGER)) AS f FROM events),
d AS (SELECT event_id, ts, CASE WHEN event_id % 50 = 0 THEN 4 ELSE f END AS f FROM n UNION ALL SELECT event_id, ts, least(4, f + 1) FROM n WHERE event_id % 7 = 0),
h AS (SELECT f, (SELECT max(ts) - INTERVAL 1 HOUR FROM d AS e WHERE e.f < g.f) AS horizon FROM (SELECT DISTINCT f FROM d) AS g),
o AS (SELECT event_id, f, coalesce(ts < horizon, false) AS behind FROM d JOIN h USING (f)),
c AS (SELECT event_id, behind, row_number() OVER (PARTITION BY event_id, behind ORDER BY f) AS place FROM o)
SELECT event_id, count(*) FILTER (NOT behind AND place = 1) AS n_kept, count(*) FILTER (NOT behind AND place > 1) AS n_repeated, count(*) FILTER (behind) AS n_late FROM c GROUP BY 1
"""


@query(_DELIVERIES)
def stream_late_events(spark, sf):
    """Events in five files by time, some a file later or days late, some delivered twice: each delivery is accounted for."""
    base = scratch_path(spark, "stream")
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    start = rows.agg(F.min(F.unix_micros("ts"))).first()[0]
    in_turn = F.least(F.lit(4), F.floor((F.unix_micros("ts") - start) / 518_400_000_000)).cast("int")
    once = rows.withColumn("_file", F.when(F.col("event_id") % 50 == 0, 4).otherwise(in_turn))
    again = rows.where("event_id % 7 = 0").withColumn("_file", F.least(F.lit(4), in_turn + 1))
    stream = _delivered(spark, sf, once.unionByName(again), 5)
    ingest.settle_events(stream, "ts", 3600, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    parts = [spark.read.parquet(f"{base}/out/{t}").select("event_id", F.lit(t).alias("part")) for t in ("kept", "repeated", "late")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("event_id").agg(*[F.count_if(F.col("part") == t).alias(f"n_{t}") for t in ("kept", "repeated", "late")])


@query(f"""
SELECT event_id % 6 AS batch, 'success' AS status, count(*) FILTER (error_type IS NULL) AS n_valid, count(*) FILTER (error_type IS NOT NULL) AS n_dead, count(*) AS n_total
FROM (SELECT e.event_id, m.error_type FROM ({_MIXED}) AS m JOIN events AS e ON m.event_id = e.event_id) GROUP BY 1
""")
def stream_metrics(spark, sf):
    """Valid and dead messages of each batch of a stream of six files, from the stored metrics."""
    base = scratch_path(spark, "stream")
    rows = table(spark, sf, "events").withColumn("_file", (F.col("event_id") % 6).cast("int"))
    ingest.consume(
        _mixed(_delivered(spark, sf, rows, 6)), f"{base}/events", f"{base}/dead", f"{base}/checkpoint", available_now=True, metrics_path=f"{base}/metrics"
    ).awaitTermination()
    runs = ingest.batch_metrics(spark, f"{base}/metrics")
    return runs.select(F.col("batch_id").alias("batch"), "status", F.col("valid").alias("n_valid"), F.col("dead").alias("n_dead"), (F.col("valid") + F.col("dead")).alias("n_total"))
