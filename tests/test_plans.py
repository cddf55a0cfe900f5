import os
import random

import numpy as np
import pytest

from millrace.plans import quantiles
from millrace.plans.quantiles import approx_quantiles, exact_quantiles
from millrace.plans.slices import dense_position

P = [0.0, 0.25, 0.5, 0.75, 1.0]


def _hot(n, seed):
    rnd = random.Random(seed)
    return [7.0 if rnd.random() < 0.4 else round(rnd.gauss(0, 50), 2) for _ in range(n)]


@pytest.mark.parametrize("limit", [5, 40, 700, 50_000])
def test_exact_quantiles_match_numpy_with_a_hot_value(spark, limit):
    values = _hot(4000, 1)  # more than five times the smaller limits
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = exact_quantiles(df, ["x"], P, accuracy=200, gather_limit=limit).first()["x"]
    assert got == pytest.approx(list(np.quantile(values, P)), abs=1e-9)


@pytest.mark.parametrize("limit,broadcast", [(5, 100), (500, 100), (500, 0), (5, 1), (50_000, 100)])
def test_exact_quantiles_by_group_with_a_hot_group(spark, monkeypatch, limit, broadcast):
    monkeypatch.setattr(quantiles, "BROADCAST_GROUPS", broadcast)
    monkeypatch.setattr(quantiles, "HOT_SHARE", 3)
    groups = {"a": _hot(3000, 2), "b": _hot(60, 3), None: _hot(7, 4), "c": [1.5]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("d", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r["x"] for r in exact_quantiles(df, ["x"], P, ["g"], 200, limit).collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    assert got["d"] == [None] * 5
    for g, vs in groups.items():
        assert got[g] == pytest.approx(list(np.quantile(vs, P)), abs=1e-9)


def test_two_columns_and_empty_input(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 8.0)], "a int, b double")
    row = exact_quantiles(df, ["a", "b"], [0.5]).first()
    assert row["a"] == [2.0] and row["b"] == [5.0]
    assert exact_quantiles(df.where("a > 9"), ["a"], [0.5]).first()["a"] == [None]
    assert approx_quantiles(df, ["a"], [0.5]).first()["a"] == [2.0]


def test_dense_position_matches_a_plain_sort(spark):
    rnd = random.Random(5)
    keys = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(4)}", i) for i in range(500)]
    df = spark.createDataFrame(keys, "k string, v int").repartition(6)
    got = {(r.k, r.v): r.pos for r in dense_position(df, ["v"], "pos", by=["k"]).collect()}
    for k in {k for k, _ in keys}:
        for want, v in enumerate(sorted(v for kk, v in keys if kk == k)):
            assert got[(k, v)] == want


def test_patient_store_reads_newest_whole_snapshot_and_later_batches(spark, tmp_path):
    from millrace.operators import patients

    store = str(tmp_path / "patients")
    assert patients.compact_patients(spark, store) is None
    for batch, rows in enumerate([[("a", "one", 1), ("b", "one", 2), (None, "none", 3)], [("a", "two", 1)], [("c", "three", 1), ("a", "three", 2)]]):
        patients.append_versions(spark.createDataFrame(rows, "patient_id string, name string, sequence int"), store, batch)
        if batch == 1:
            assert patients.compact_patients(spark, store) == 1
            os.makedirs(f"{store}/_snapshots/upto=7")  # begun, never finished
            patients.drop_compacted(spark, store)
            assert sorted(x for x in os.listdir(store) if x.startswith("batch")) == []
            names = {r.patient_id: r.name for r in patients.current_patients(spark, store).collect()}
            assert names == {"a": "two", "b": "one"}
    expected = {"a": "three", "b": "one", "c": "three"}
    assert {r.patient_id: r.name for r in patients.current_patients(spark, store).collect()} == expected
    assert patients.compact_patients(spark, store) == 2
    assert {r.patient_id: r.name for r in patients.current_patients(spark, store).collect()} == expected


def test_patient_store_compacts_only_what_cannot_change(spark, tmp_path):
    from millrace.operators import patients

    store, checkpoint = str(tmp_path / "patients"), tmp_path / "checkpoint"

    def put(batch, *rows):
        patients.append_versions(spark.createDataFrame(rows, "patient_id string, name string, sequence int"), store, batch)

    def names():
        return {r.patient_id: r.name for r in patients.current_patients(spark, store).collect()}

    put(0, ("a", "zero", 1))
    put(1, ("a", "one", 1))
    os.makedirs(f"{store}/batch_id=2/_temporary")  # in progress
    put(3, ("d", "three", 1))
    assert patients.compact_patients(spark, store) == 1
    patients.drop_compacted(spark, store)
    assert patients.compact_patients(spark, store) == 1
    put(2, ("b", "two", 1))  # its replay
    assert names() == {"a": "one", "b": "two", "d": "three"}
    (checkpoint / "commits").mkdir(parents=True)
    assert patients.compact_patients(spark, store, checkpoint=str(checkpoint)) == 1
    for n in range(3):
        (checkpoint / "commits" / str(n)).write_text("v1\n{}")
    assert patients.compact_patients(spark, store, checkpoint=str(checkpoint)) == 2
    patients.drop_compacted(spark, store)
    put(3, ("c", "replayed", 1))  # not committed, so it may come again with other rows
    assert names() == {"a": "one", "b": "two", "c": "replayed"}
    assert patients.compact_patients(spark, store) == 3


def test_grouped_and_text_models_come_back_from_their_folder(spark, tmp_path):
    from millrace.operators import encoding, impute, scaling
    from millrace.operators.fitted import Fitted

    rows = spark.createDataFrame([("x", 1.0, "p"), ("x", 3.0, None), ("y", None, "q"), (None, 5.0, "q")], "g string, v double, t string")
    fitted = impute.fit_imputer(rows, by=["g"], for_new_rows=True)
    fitted.save(spark, str(tmp_path / "imputer"))
    loaded = impute.Imputer.load(spark, str(tmp_path / "imputer"))
    assert sorted(map(str, impute.impute(rows, loaded).collect())) == sorted(map(str, impute.impute(rows, fitted).collect()))
    assert loaded.n_missing == fitted.n_missing == {"v": 1, "t": 1}
    scaler = scaling.fit_scaler(rows, ["v"])
    scaler.save(spark, str(tmp_path / "scaler"))
    assert Fitted.load(spark, str(tmp_path / "scaler")) == scaler
    coded, encoder = encoding.encode_labels(rows, ["t"])
    encoder.save(spark, str(tmp_path / "encoder"))
    again = encoding.encode(rows, encoding.LabelEncoder.load(spark, str(tmp_path / "encoder")))
    assert sorted(map(str, again.collect())) == sorted(map(str, coded.collect()))


def test_other_resource_types_go_before_validation(spark):
    from millrace.operators import fhir

    lines = [('{"resourceType": "Patient", "id": "1", "name": []}',), ('{"resourceType": "Condition", "id": "c"}',), ("no json",), (None,), ('{"resourceType": ["Patient"], "id": "2", "name": []}',)]
    found = fhir.ingest(spark.createDataFrame(lines, "value string"), only=["patients"])["patients"]
    assert [r.patient_id for r in found.collect()] == ["1"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") >= 2 and "onsetDateTime" not in plan and "effectiveDateTime" not in plan and plan.count("try_parse_json") <= 1


def test_write_audit_publish(spark, tmp_path):
    import pytest as _pytest

    from millrace.plans import etl

    target = str(tmp_path / "t")
    rows = [(1, "2024-01-01", 1.0, " a "), (1, "2024-01-01", 1.0, " a "), (2, "2024-01-02", 2.0, None)]
    spark.createDataFrame(rows, "id int, event_date string, value double, name string").write.parquet(str(tmp_path / "good"))
    done = etl.publish_if_valid(spark, str(tmp_path / "good"), target, "parquet", run_id="a")
    assert (done["rows_extracted"], done["rows_loaded"]) == (3, 1) and all(r["success"] for r in done["results"])
    assert [r.name for r in spark.read.parquet(target).collect()] == ["A"]
    with _pytest.raises(FileExistsError):
        etl.publish_if_valid(spark, str(tmp_path / "good"), target, "parquet", run_id="a")
    bad = [(1, None, 1.0, "x"), (3, "2024-01-01", None, "y"), (4, "2024-01-01", None, "y")]
    spark.createDataFrame(bad, "id int, event_date string, value double, name string").write.parquet(str(tmp_path / "bad"))
    with _pytest.raises(ValueError, match="2 violation"):
        etl.publish_if_valid(spark, str(tmp_path / "bad"), target, "parquet", run_id="b")
    with _pytest.raises(ValueError, match="no column gone"):
        etl.publish_if_valid(spark, str(tmp_path / "bad"), target, "parquet", ["gone"], run_id="c")
    spark.createDataFrame([], "id int, event_date string, value double").write.parquet(str(tmp_path / "none"))
    with _pytest.raises(ValueError, match="1 violation"):
        etl.publish_if_valid(spark, str(tmp_path / "none"), target, "parquet", run_id="d")
    assert spark.read.parquet(target).select("run_id").distinct().collect()[0][0] == "a" and spark.read.parquet(target).count() == 1


def test_a_run_cut_off_before_publishing_shows_nothing(spark, tmp_path, monkeypatch):
    from millrace.plans import etl

    target = str(tmp_path / "t")
    spark.createDataFrame([(1, "2024-01-01", 1.0)], "id int, event_date string, value double").write.parquet(str(tmp_path / "in"))
    whole = etl.hadoop
    calls = []

    def cut(session, path):
        calls.append(path)
        if "_staged" in path:
            raise KeyboardInterrupt
        return whole(session, path)

    monkeypatch.setattr(etl, "hadoop", cut)
    try:
        etl.publish_if_valid(spark, str(tmp_path / "in"), target, "parquet", run_id="a")
    except KeyboardInterrupt:
        pass
    assert not (tmp_path / "t" / "run_id=a").exists() and (tmp_path / "t" / "_staged" / "run_id=a").exists()
    monkeypatch.undo()
    assert etl.publish_if_valid(spark, str(tmp_path / "in"), target, "parquet", run_id="a")["rows_loaded"] == 1
    assert spark.read.parquet(target).count() == 1
