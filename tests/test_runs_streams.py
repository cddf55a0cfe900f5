import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning
from millrace.operators.events import to_messages, unroutable
from millrace.operators.patients import current_patients
from millrace.operators.runlog import status_counts
from millrace.plans.clinical import start_clinical_stream, store_batch
from millrace.plans.etl import run_etl, validate_then_run
from millrace.plans.health import preprocess
from millrace.sinks import tables
from millrace.sources.files import merge_sources, read_files, read_resources
from millrace.sources.topics import ENVELOPE, first_messages, read_file_stream
from millrace.streaming import ingest

CSV = "id,event_date,value,name\n1,2024-01-01,1.5, ann \n1,2024-01-01,1.5, ann \n2,2024-01-02,,bob\n3,2024-01-03,2.5,\tcy\n4,2024-01-01,1.5,ANN\n"


@pytest.fixture
def raw_csv(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    return str(path)


def test_run_etl(spark, raw_csv, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    result = run_etl(spark, raw_csv, out, run_log=log)
    assert (result["rows_extracted"], result["rows_loaded"]) == (5, 3)
    rows = spark.read.parquet(out).orderBy("id").collect()
    assert [r["name"] for r in rows] == ["ANN", "\tCY", "ANN"] and rows[0]["etl_timestamp"] is not None
    run_etl(spark, raw_csv, out, run_log=log)
    assert spark.read.parquet(out).count() == 6
    with pytest.raises(ValueError, match="Unsupported file format"):
        run_etl(spark, raw_csv, out, "xml", run_log=log)
    assert sorted(r["status"] for r in spark.read.parquet(log).collect()) == ["failure", "success", "success"]


def test_replay_and_gate(spark, raw_csv, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        run_etl(spark, raw_csv, out, run_id="r1", replay_safe=True)
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(ValueError, match="Data quality check failed"):
        validate_then_run(spark, raw_csv, str(tmp_path / "gated"))
    ok = validate_then_run(spark, raw_csv, str(tmp_path / "gated"), not_null=["id"], schema="id int, event_date date, value double, name string")
    assert ok["validation"]["success"] and ok["rows_loaded"] == 3


def test_cleaning_options(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, s string")
    assert cleaning.drop_duplicates(df, ["k"]).count() == 2
    assert cleaning.drop_incomplete(df, ["s"]).count() == 3
    assert cleaning.clean(df, F.lit("2024-01-01").cast("timestamp")).columns == ["k", "s", "etl_timestamp"]


def test_first_messages(spark):
    assert first_messages(spark.range(5), 2).count() == 2 and first_messages(spark.range(5), None).count() == 5


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    df.write.json(str(tmp_path / "j"))
    df.write.parquet(str(tmp_path / "p"))
    both = merge_sources({"j": read_files(spark, str(tmp_path / "j"), "json", "a int, b string"), "p": read_files(spark, str(tmp_path / "p"), "parquet").drop("b")})
    assert {tuple(r) for r in both.select("a", "b", "source").collect()} == {(1, "x", "j"), (1, None, "p")}


def test_preprocess(spark):
    df = spark.createDataFrame([(25.0, 22.0, "A", "M"), (45.0, 30.5, "B", "F"), (None, 27.1, None, "M"), (60.0, None, "A", "F"), (35.0, 24.3, "C", "M")],
                               "age double, bmi double, diagnosis string, gender string")
    done = preprocess(df, not_null=["age", "absent"])
    rows = done.dataframe.collect()
    assert len(rows) == 5 and abs(sum(r["age"] for r in rows)) < 1e-9
    assert {r["diagnosis"] for r in rows} == {0, 1, 2}
    assert sorted(map(tuple, done.apply(df).collect())) == sorted(map(tuple, rows))
    assert {(r["step"], r["column"]) for r in done.audit().collect()} >= {("impute", "age"), ("cap", "bmi"), ("standard", "age"), ("encode", "gender")}
    assert {(r["step"], r["column"]): r["n_changed"] for r in done.audit().collect()} == {
        ("impute", "age"): 1, ("impute", "bmi"): 1, ("impute", "diagnosis"): 1, ("cap", "age"): 0, ("cap", "bmi"): 0,
        ("standard", "age"): 5, ("standard", "bmi"): 5, ("encode", "diagnosis"): 5, ("encode", "gender"): 5,
    }
    empty = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 3.0)], "id double, val double")
    with pytest.raises(ValueError, match="Null values remain"):
        preprocess(empty, not_null=["id"], scale_columns=["val"])
    kept = preprocess(df.withColumn("id", F.monotonically_increasing_id()), exclude=["id"]).dataframe
    assert dict(kept.dtypes)["id"] == "bigint"


def messages(spark):
    docs = [("user-actions", {"event_id": "1", "event_type": "user_action", "user_id": "u", "action": "login", "timestamp": "t"}),
            ("orders", {"event_id": "2", "event_type": "order", "amount": 5.5, "timestamp": "t"}), ("orders", "not json"), ("orders", {"event_type": "order"})]
    rows = [(d if isinstance(d, str) else json.dumps(d), t) for t, d in docs]
    return spark.createDataFrame(rows, "value string, topic string").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).select(*ENVELOPE.names)


def test_topic_ingest(spark, tmp_path):
    src = str(tmp_path / "in")
    messages(spark).write.parquet(src)
    started, skipped = ingest.start_topics(
        lambda t: read_file_stream(spark, src).where(F.col("topic") == t), " orders, user-actions , unknown",
        str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    ingest.wait(spark, started)
    assert skipped == ["unknown"] and set(started) == {"orders", "user-actions"}
    orders = spark.read.parquet(str(tmp_path / "out" / "orders"))
    assert orders.count() == 3 and orders.where("amount = 5.5").count() == 1
    assert ingest.progress(spark, started["orders"]).agg(F.sum("n_rows")).first()[0] >= 1
    log = str(tmp_path / "log")
    ingest.log_progress(spark, started["orders"], log)
    once = spark.read.parquet(log).count()
    ingest.log_progress(spark, started["orders"], log)
    assert spark.read.parquet(log).count() == once
    assert status_counts(spark.read.parquet(log)).first()["status"] == "success"
    united = ingest.union_topics({t: spark.read.parquet(str(tmp_path / "out" / t)).drop("topic") for t in started})
    assert united.count() == 4 and {"action", "amount"} <= set(united.columns)


def test_consume_is_replay_safe(spark, tmp_path):
    src, good, bad = (str(tmp_path / n) for n in ("in", "good", "bad"))
    messages(spark).coalesce(1).write.parquet(src)
    seen = {}
    for cp in ("cp1", "cp2"):  # a lost checkpoint replays batch 0
        q = ingest.consume(read_file_stream(spark, src), good, bad, str(tmp_path / cp), available_now=True, on_batch=lambda i, n: seen.update({i: n}))
        q.awaitTermination()
    assert seen == {0: {"valid": 2, "dead": 2}}
    rows = spark.read.parquet(good)
    assert rows.count() == 2 and rows.where("processed").count() == 2
    assert sorted(r["dlq_error_type"] for r in spark.read.parquet(bad).collect()) == ["JSONDecodeError", "ValueError"]


def test_windows_and_redelivery(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("a", "2024-01-01 00:00:10"), ("a", "2024-01-01 00:00:20"), ("b", "2024-01-01 00:01:10")]
    df = spark.createDataFrame(rows, "event_id string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(src)
    stream = read_file_stream(spark, src, df.schema)
    q = ingest.write_stream(ingest.drop_redelivered(stream, "ts", "5 minutes"), str(tmp_path / "o"), str(tmp_path / "c"), available_now=True)
    q.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["a", "b"]
    assert [r["n_events"] for r in ingest.window_counts(df, "ts", "1 minute").orderBy("window_start").collect()] == [2, 1]


def test_forward_publishes_by_topic(spark, tmp_path):
    src, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    events = spark.createDataFrame([("1", "order"), ("2", "page_view"), ("3", "odd")], "event_id string, event_type string")
    events.write.parquet(src)

    def send(batch, batch_id):
        sent = to_messages(batch)
        tables.publish_files(sent, out, unrouted="odd")
        tables.write_dead_letters(unroutable(sent), bad)
    ingest.forward(read_file_stream(spark, src, events.schema), send, str(tmp_path / "c"), available_now=True).awaitTermination()
    assert sorted(r["topic"] for r in spark.read.parquet(out).collect()) == ["odd", "orders", "page-views"]
    assert spark.read.parquet(bad).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, p string")
    path = str(tmp_path / "t")
    tables.write_table(df, path, partition_by=["p"])
    tables.write_table(df, path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 2
    tables.export_objects(df, f"file://{path}")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        tables.write_table(df, path, "merge")
    assert tables.object_uri("acc", "box", "/a/b") == "abfss://box@acc.dfs.core.windows.net/a/b"
    assert tables.object_url("acc", "box", "a/b") == "https://acc.dfs.core.windows.net/box/a/b"
    assert "encrypt=true" in tables.warehouse_url("h", "d") and tables.publish_options("h:1")["kafka.acks"] == "all"


def test_warehouse_call(monkeypatch, spark):
    from pyspark.sql import DataFrameWriter
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a: calls.append(a))
    df = spark.range(3)
    tables.load_warehouse(df, "jdbc:x", "t")
    tables.load_warehouse(df, "jdbc:x", "t", "s", "replace")
    assert calls[0] == ("jdbc:x", "dbo.t", "append", {"batchsize": "1000", "numPartitions": "16"})
    assert calls[1][1:3] == ("s.t", "overwrite")
    with pytest.raises(ValueError):
        tables.load_warehouse(df, "jdbc:x", "t", if_exists="fail")


def test_clinical_store(spark, tmp_path):
    docs = [{"resourceType": "Patient", "id": "1", "name": [{"text": n}]} for n in ("Old", "New")] + [{"resourceType": "X"}]
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(d) for d in docs))
    base = str(tmp_path / "base")
    for _ in range(2):
        paths = store_batch(read_resources(spark, str(lines)), base, 0)
    now = current_patients(spark, paths["patients"])
    assert [(r["patient_id"], r["name"]) for r in now.collect()] == [("1", "New")]
    assert spark.read.parquet(paths["errors"]).count() == 1
    src = str(tmp_path / "stream")
    spark.createDataFrame([(json.dumps({**docs[0], "name": [{"text": "Newest"}]}),)], "value string").write.text(src)
    raw = spark.readStream.text(src)
    start_clinical_stream(raw, str(tmp_path / "b2"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert current_patients(spark, str(tmp_path / "b2" / "patients")).first()["name"] == "Newest"
