"""Streams that lose nothing: late first deliveries, metrics of every batch, long messages."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.events import check_events, parse_events
from millrace.sources.files import read_files
from millrace.sources.topics import read_file_stream, schema_of
from millrace.streaming import ingest

START = datetime(2024, 1, 1)
SCHEMA = "event_id string, ts timestamp, batch_id int"


def files(spark, folder, batches):
    for n, rows in enumerate(batches):
        spark.createDataFrame([(i, None if h is None else START + timedelta(hours=h), n) for i, h in rows], SCHEMA).coalesce(1).write.parquet(f"{folder}/{n}")
    return read_file_stream(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1).drop("batch_id")


def ids(spark, path):
    return sorted((r.event_id or "-") for r in spark.read.parquet(path).collect())


def test_late_first_deliveries_are_set_aside(spark, tmp_path):
    batches = [[("a", 0), ("a", 0), (None, 1)], [("b", 10), ("a", 0)], [("b", 10), ("c", 20)], [("d", 9), ("e", 20), ("a", 0), ("x", None), ("x", None)], [("b", 10), ("e", 20), ("f", 19.5)]]
    stream = files(spark, tmp_path / "in", batches)
    out = str(tmp_path / "out")
    start = lambda: ingest.settle_events(stream, "ts", 3600, out, str(tmp_path / "c"), available_now=True).awaitTermination()
    start()
    # Horizons: none, hour 0, hour 9, hour 19, hour 19.
    assert ids(spark, f"{out}/kept") == ["-", "a", "b", "c", "e", "f", "x", "x"]
    assert ids(spark, f"{out}/repeated") == ["a", "a", "b", "e"]
    assert ids(spark, f"{out}/late") == ["a", "b", "d"]
    first = {(r.event_id, r.late) for r in ingest.settled(spark, out).collect() if r.event_id}
    assert first == {("a", False), ("b", False), ("c", False), ("d", True), ("e", False), ("f", False), ("x", False)}
    # A batch that was cut off before its commit runs again and changes nothing.
    before = {t: ids(spark, f"{out}/{t}") for t in ("kept", "repeated", "late")}
    (tmp_path / "c/commits/4").unlink()
    (tmp_path / "c/commits/.4.crc").unlink(missing_ok=True)
    start()
    assert {t: ids(spark, f"{out}/{t}") for t in ("kept", "repeated", "late")} == before


def messages(spark, folder, n):
    rows = spark.createDataFrame([(k, '{"event_id": "%d", "event_type": "x", "timestamp": null}' % k if k % 3 else "broken") for k in range(n)], "k int, value string")
    for k in range(n):
        rows.where(F.col("k") <= k).where(F.col("k") >= k - k % 4).coalesce(1).write.parquet(f"{folder}/{k}")
    return read_file_stream(spark, f"{folder}/*", rows.schema, max_files_per_trigger=1)


def test_metrics_of_more_batches_than_a_query_remembers(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        stream = messages(spark, tmp_path / "in", 30)
        metrics = str(tmp_path / "m")
        args = (str(tmp_path / "e"), str(tmp_path / "d"), str(tmp_path / "c"))
        query = ingest.consume(stream, *args, available_now=True, metrics_path=metrics)
        query.awaitTermination()
        assert len(query.recentProgress) <= 10
        got = {r.batch_id: (r.status, r.valid, r.dead) for r in ingest.batch_metrics(spark, metrics).collect()}
        want = {k: ("success", sum(bool(j % 3) for j in range(k - k % 4, k + 1)), sum(not j % 3 for j in range(k - k % 4, k + 1))) for k in range(30)}
        assert got == want
        assert ingest.processed_count(spark, metrics) == sum(v for _, v, _ in want.values())
        runs = ingest.batch_runs(spark, metrics, "q")
        assert runs.agg(F.sum("rows_extracted"), F.sum("rows_loaded")).first()[:] == (sum(v + d for _, v, d in want.values()), sum(v for _, v, _ in want.values()))
        (tmp_path / "c/commits/29").unlink()  # replayed: still one row for the batch
        (tmp_path / "c/commits/.29.crc").unlink(missing_ok=True)
        ingest.consume(stream, *args, available_now=True, metrics_path=metrics).awaitTermination()
        assert ingest.batch_metrics(spark, metrics).count() == 30
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_failed_batch_is_noted(spark, tmp_path):
    def fail(batch_id, counts):
        raise RuntimeError("sink is gone")

    query = ingest.consume(messages(spark, tmp_path / "in", 1), str(tmp_path / "e"), str(tmp_path / "d"), str(tmp_path / "c"), available_now=True, on_batch=fail, metrics_path=str(tmp_path / "m"))
    with pytest.raises(Exception, match="sink is gone"):
        query.awaitTermination()
    assert [(r.batch_id, r.status) for r in ingest.batch_metrics(spark, str(tmp_path / "m")).collect()] == [(0, "failure")]


@pytest.mark.parametrize("size", [25_000_000, 120_000_000])
def test_long_strings_stay(spark, tmp_path, size):
    shell = json.dumps({"event_id": "e1", "event_type": "order", "timestamp": "t", "status": "@"})
    before, after = shell.split("@")
    raw = spark.range(1).select(F.concat(F.lit(before), F.repeat(F.lit("x"), size), F.lit(after)).alias("value"), F.lit("orders").alias("topic"), F.lit(START).alias("timestamp"))
    longest = lambda df: [F.max(F.length(c)).alias(c) for c, t in df.dtypes if t == "string"]
    parsed = parse_events(raw, schema_of("orders"))
    found = parsed.select(*longest(parsed)).first().asDict()
    assert found["event_id"] == 2 and max(v for v in found.values() if v) == size
    assert check_events(raw).first()["error_type"] is None
    if size < 100_000_000:
        raw.select("value").write.text(str(tmp_path / "j"))
        assert read_files(spark, str(tmp_path / "j"), "json", "status string").select(F.length("status")).first()[0] == size
