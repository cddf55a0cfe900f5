"""Streaming queries: typed ingest per topic, validated consume, windows, progress."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.events import check_events, dead_letters, parse_events, valid_events
from millrace.operators.runlog import FAILURE, SCHEMA, SUCCESS
from millrace.sources.topics import schema_of, topic_names

log = logging.getLogger(__name__)
INTERVAL = "30 seconds"


def _triggered(writer, interval: str, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str = INTERVAL,
    available_now: bool = False,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append micro-batches to a table."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, interval, available_now).start(path)


def start_topics(
    source: Callable[[str], DataFrame],
    topics: str | Sequence[str],
    output_base: str,
    checkpoint_base: str,
    **options,
) -> tuple[dict[str, StreamingQuery], list[str]]:
    """One independent ingest query per declared topic; undeclared topics are skipped and named
    in the result. `source` gives the raw stream of a topic."""
    started: dict[str, StreamingQuery] = {}
    skipped: list[str] = []
    for topic in topic_names(topics):
        schema = schema_of(topic)
        if schema is None:
            log.warning("No schema found for topic '%s', skipping", topic)
            skipped.append(topic)
            continue
        parsed = parse_events(source(topic), schema)
        started[topic] = write_stream(parsed, f"{output_base}/{topic}", f"{checkpoint_base}/{topic}", **options)
    return started, skipped


def wait(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> None:
    """Block until all queries have ended; the first failure of any of them is raised."""
    while any(q.isActive for q in queries.values()):
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
    for q in queries.values():
        q.awaitTermination()


def consume(
    raw: DataFrame,
    events_path: str,
    dead_letter_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str = INTERVAL,
    available_now: bool = False,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
    metrics_path: str | None = None,
) -> StreamingQuery:
    """Validate every message and write it to the event table or to the dead letters.

    Both outputs of a batch go to folders named by the batch id and are overwritten when the
    batch is replayed, so a restart neither loses nor repeats rows. `on_batch` receives the
    number of valid and dead messages of each batch. At `metrics_path` every batch leaves a row
    (`batch_metrics`), a failed one too; a replay replaces it.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        started, spark = time.monotonic(), batch.sparkSession
        seen: dict[str, int] = {}

        def note(status: str) -> None:
            if metrics_path:
                row = (status, seen.get("valid"), seen.get("dead"), round(1000 * (time.monotonic() - started)), datetime.now(timezone.utc))
                spark.createDataFrame([row], _METRICS).coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")

        checked = check_events(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid_events(checked).write.format(fmt).mode("overwrite").save(f"{events_path}/batch_id={batch_id}")
            dead_letters(checked).write.format(fmt).mode("overwrite").save(f"{dead_letter_path}/batch_id={batch_id}")
            if on_batch or metrics_path:
                seen = checked.agg(
                    F.count_if(F.col("error_type").isNull()).alias("valid"),
                    F.count_if(F.col("error_type").isNotNull()).alias("dead"),
                ).first().asDict()
                if on_batch:
                    on_batch(batch_id, seen)
        except Exception:
            note(FAILURE)
            raise
        else:
            note(SUCCESS)
        finally:
            checked.unpersist()

    writer = raw.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval, available_now).start()


_METRICS = "status string, valid bigint, dead bigint, duration_ms bigint, run_ts timestamp"


def batch_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """(batch_id, status, valid, dead, duration_ms, run_ts): one row for every batch of a stream, however long it has run.
    A failed batch counts none unless its outputs were written."""
    schema = f"batch_id bigint, {_METRICS}"
    return spark.read.schema(schema).option("basePath", metrics_path).parquet(metrics_path).select("batch_id", "status", "valid", "dead", "duration_ms", "run_ts")


def batch_runs(spark: SparkSession, metrics_path: str, name: str) -> DataFrame:
    """The batches as rows of the run log: all messages were extracted, the valid ones loaded."""
    rows = batch_metrics(spark, metrics_path)
    valid, dead = F.coalesce("valid", F.lit(0)), F.coalesce("dead", F.lit(0))
    return rows.select(
        F.concat_ws("-", F.lit(name), "batch_id").alias("run_id"), "status", (valid + dead).alias("rows_extracted"),
        valid.alias("rows_loaded"), (F.col("duration_ms") / 1000.0).alias("duration_seconds"), "run_ts",
    )


def processed_count(spark: SparkSession, metrics_path: str) -> int:
    """Valid messages of all batches so far."""
    return batch_metrics(spark, metrics_path).agg(F.sum("valid")).first()[0] or 0


def union_topics(parsed: Mapping[str, DataFrame]) -> DataFrame:
    """One table or stream over several topics, NULL where a topic lacks a field."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.withColumn("topic", F.lit(t)) for t, df in parsed.items()],
    )


def forward(
    stream: DataFrame,
    send: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Hand each micro-batch to a downstream sink."""
    writer = stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval, available_now).start()


def drop_redelivered(events: DataFrame, event_time: str, delay: str, key: str = "event_id") -> DataFrame:
    """Drop messages delivered again within `delay` of event time. The stream's watermark also drops what is later than
    `delay`, first deliveries included: use `settle_events` where these count."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def settle_events(
    events: DataFrame,
    event_time: str,
    delay_seconds: int,
    output: str,
    checkpoint: str,
    key: str = "event_id",
    interval: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Write every delivery to one of three tables under `output`: `kept`, `repeated` or `late`. None is dropped.

    The horizon of a batch is the greatest event time of all batches before it, less the delay. A delivery at or after
    the horizon is kept unless its key was kept before: keys are remembered while their event time is not behind the
    horizon. A delivery behind it goes to `late`, as its key may be forgotten; `settled` tells its first deliveries from
    repeats. Every table has a folder per batch, which a replay overwrites; a batch reads earlier batches only, and of
    the remembered keys only batches that still hold live ones. Deliveries without time or key are kept.
    """
    tables = {name: f"{output}/{name}" for name in ("kept", "repeated", "late", "keys", "times")}
    spark = events.sparkSession

    def settle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_at", F.col(event_time).cast("timestamp"))
        horizon, live = None, []
        if batch_id:
            times = spark.read.schema("batch_id bigint, latest timestamp, kept_latest timestamp").option("basePath", tables["times"]).parquet(tables["times"]).where(F.col("batch_id") < batch_id)
            horizon = times.agg((F.max("latest") - F.make_dt_interval(secs=F.lit(delay_seconds))).alias("h")).first()["h"]
            live = [r["batch_id"] for r in times.where(F.col("kept_latest") >= F.lit(horizon)).select("batch_id").collect()] if horizon else []
        behind = F.coalesce(F.col("_at") < F.lit(horizon), F.lit(False)) if horizon else F.lit(False)
        place = F.row_number().over(Window.partitionBy(key).orderBy("_at"))
        in_time = rows.where(~behind).withColumn("_place", F.when(F.col(key).isNull() | F.col("_at").isNull(), 1).otherwise(place))
        if live:
            known = spark.read.parquet(*[f"{tables['keys']}/batch_id={n}" for n in live]).where(F.col("_at") >= F.lit(horizon))
            in_time = in_time.join(known.select(F.col("_key").alias(key), F.lit(True).alias("_known")), key, "left")
        else:
            in_time = in_time.withColumn("_known", F.lit(None).cast("boolean"))
        in_time = in_time.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            again = F.col("_known").isNotNull() | (F.col("_place") > 1)
            kept = in_time.where(~again)
            late = rows.where(behind)
            for name, part in (("kept", kept), ("repeated", in_time.where(again)), ("late", late)):
                part.select(*[f"`{c}`" for c in batch.columns]).write.mode("overwrite").parquet(f"{tables[name]}/batch_id={batch_id}")
            remembered = kept.where(F.col(key).isNotNull() & F.col("_at").isNotNull()).select(F.col(key).alias("_key"), "_at")
            remembered.write.mode("overwrite").parquet(f"{tables['keys']}/batch_id={batch_id}")
            latest = in_time.agg(F.max("_at").alias("latest"), F.max(F.when(~again, F.col("_at"))).alias("kept_latest"))
            latest.coalesce(1).write.mode("overwrite").parquet(f"{tables['times']}/batch_id={batch_id}")
        finally:
            in_time.unpersist()

    writer = events.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval, available_now).start()


def settled(spark: SparkSession, output: str, key: str = "event_id") -> DataFrame:
    """All first deliveries of a settled stream: what was kept, and of the late ones a row for each key that was not."""
    kept = spark.read.parquet(f"{output}/kept").drop("batch_id")
    late = spark.read.parquet(f"{output}/late").drop("batch_id")
    first = late.join(kept.select(key), key, "left_anti").dropDuplicates([key])
    return kept.withColumn("late", F.lit(False)).unionByName(first.withColumn("late", F.lit(True)))


def window_counts(
    events: DataFrame, event_time: str, width: str, by: Sequence[str] = (), delay: str | None = None
) -> DataFrame:
    """(window_start, by..., n_events): events per time window, late ones beyond `delay` left out
    of a stream's result."""
    timed = events.withWatermark(event_time, delay) if delay else events
    counted = timed.groupBy(F.window(event_time, width), *by).agg(F.count(F.lit(1)).alias("n_events"))
    return counted.select(F.col("window.start").alias("window_start"), *by, "n_events")


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch_id, n_rows, duration_ms) of the batches the query still remembers."""
    rows = [(p.batchId, p.numInputRows, p.batchDuration) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id bigint, n_rows bigint, duration_ms bigint")


def log_progress(spark: SparkSession, query: StreamingQuery, run_log: str) -> None:
    """Append the batches of a query that the run log lacks, one run per batch.

    A query remembers `spark.sql.streaming.numRecentProgressUpdates` batches (100 by default): call
    this more often than that, or raise the setting. A gap since the last call is logged as a warning.
    """
    runs = progress(spark, query).select(
        F.concat_ws("-", F.lit(query.id), "batch_id").alias("run_id"),
        F.lit(SUCCESS).alias("status"),
        F.col("n_rows").alias("rows_extracted"),
        F.col("n_rows").alias("rows_loaded"),
        (F.col("duration_ms") / 1000.0).alias("duration_seconds"),
        F.current_timestamp().alias("run_ts"),
    )
    where = spark._jvm.org.apache.hadoop.fs.Path(run_log)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        logged = spark.read.schema(SCHEMA).parquet(run_log).where(F.col("run_id").startswith(f"{query.id}-"))
        last = logged.agg(F.max(F.substring_index("run_id", "-", -1).cast("long"))).first()[0]
        oldest = min((p.batchId for p in query.recentProgress), default=None)
        if last is not None and oldest is not None and oldest > last + 1:
            log.warning("Batches %d to %d of %s are not in the run log", last + 1, oldest - 1, query.id)
        runs = runs.join(logged.select("run_id"), "run_id", "left_anti")
    runs.write.mode("append").parquet(run_log)
