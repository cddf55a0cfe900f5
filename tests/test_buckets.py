"""Bucketed tables and incremental views against plain dictionaries."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.buckets import BucketedTable
from millrace.operators.patients import latest_by_key, patient_view
from millrace.operators.views import PatientCounts, count_facts
from millrace.plans.clinical import patient_counts, patient_table, store_batch

ROW = "k bigint, seq int, v string"


def _table(spark, path, buckets=16):
    return BucketedTable(spark, str(path), "k", lambda d: latest_by_key(d, "k", ["seq"]), buckets)


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _state(table):
    return {r["k"]: (r["seq"], r["v"]) for r in table.read().collect()}


def test_merges_equal_a_dictionary(spark, tmp_path):
    rng, table, want = random.Random(3), _table(spark, tmp_path), {}
    for batch in range(4):
        rows = [(rng.choice([None, 7, 7, rng.randrange(200)]), 1000 * batch + i, f"{batch}-{i}") for i in range(400)]
        for k, seq, v in rows:
            if k is not None:
                want[k] = (seq, v)
        table.merge(spark.createDataFrame(rows, ROW), batch)
        table.merge(spark.createDataFrame([(7, 10**6, "replayed")], ROW), batch)
        assert _state(table) == want
    assert table.versions() == [1, 2, 3, 4]
    pinned = table.read(1).count()
    table.vacuum(keep=4)
    assert table.read(1).count() == pinned
    table.vacuum()
    assert table.versions() == [4] and _state(table) == want
    assert {r["k"] for r in table.lookup([7, 5000]).collect()} == {7}


def test_few_keys_rewrite_their_buckets_only(spark, tmp_path):
    table = _table(spark, tmp_path, 64)
    table.merge(spark.range(1000).selectExpr("id AS k", "0 AS seq", "'a' AS v"), 0)
    before, files = table.manifest()["parts"], _files(tmp_path)
    table.merge(spark.range(10).selectExpr("id AS k", "1 AS seq", "'b' AS v"), 1)
    after = table.manifest()["parts"]
    changed = {b for b in after if after[b] != before.get(b)}
    touched = {str(r[0]) for r in spark.range(10).select(F.pmod(F.hash("id"), F.lit(64))).collect()}
    assert changed == touched and len(before) == 64
    assert files < _files(tmp_path) and len(_files(tmp_path) - files) == len(touched)  # one file a bucket
    assert table.read().where("v = 'b'").count() == 10 and table.read().count() == 1000


def test_rows_are_shuffled_once_to_be_merged(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id AS k", "0 AS seq", "'a' AS v")
    dealt = latest_by_key(rows.repartition(16, "k"), "k", ["seq"])
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path)
    table.merge(spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], ROW), 0)
    files = _files(tmp_path)

    def lost(self, manifest):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(BucketedTable, "_commit", lost)
        with pytest.raises(OSError):
            table.merge(spark.createDataFrame([(1, 5, "c")], ROW), 1)
    assert _state(table) == {1: (0, "a"), 2: (0, "b")} and _files(tmp_path) > files
    table.merge(spark.createDataFrame([(1, 5, "c")], ROW), 1)
    table.vacuum()
    assert _state(table) == {1: (5, "c"), 2: (0, "b")}
    assert len(_files(tmp_path)) == len(table.manifest()["parts"])


def test_a_second_writer_is_noticed(spark, tmp_path, monkeypatch):
    table, other = _table(spark, tmp_path), _table(spark, tmp_path)
    table.merge(spark.createDataFrame([(1, 0, "a")], ROW), 0)
    old = other.manifest()
    table.merge(spark.createDataFrame([(1, 1, "b")], ROW), 1)
    monkeypatch.setattr(other, "manifest", lambda version=None: old)
    with pytest.raises(RuntimeError):
        other.merge(spark.createDataFrame([(1, 2, "c")], ROW), 2)
    assert _state(table) == {1: (1, "b")}


def test_edges(spark, tmp_path):
    table = _table(spark, tmp_path / "t")
    empty = spark.createDataFrame([], ROW)
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.read(schema=empty.schema).count() == 0 and table.versions() == []
    table.merge(empty, 0)
    assert table.versions() == [1] and table.read().count() == 0 and table.lookup([1]).count() == 0
    table.merge(spark.createDataFrame([(None, 0, "x")], ROW), 1)
    assert table.read().count() == 0
    table.merge(spark.createDataFrame([(1, 0, None), (2, 0, "b")], ROW), 2)
    table.merge(spark.createDataFrame([(2, 1, "c", 9)], ROW + ", extra int"), 3)
    table.merge(spark.createDataFrame([(3, 1)], "k bigint, seq int"), 4)
    got = {tuple(r) for r in table.read().select("k", "seq", "v", "extra").collect()}
    assert got == {(1, 0, None, None), (2, 1, "c", 9), (3, 1, None, None)}
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, 0, 3)], "k bigint, seq int, _bucket int"), 5)
    with pytest.raises(TypeError):
        table.merge(spark.createDataFrame([("1", 0)], "k string, seq int"), 5)


FACT = "patient_id string"


def _facts(spark, rng, n):
    return {
        name: spark.createDataFrame([(rng.choice([None, "Patient/1", "1", f"Patient/{rng.randrange(30)}"]),) for _ in range(n)], FACT)
        for name in ("encounters", "observations", "conditions")
    }


def test_counts_of_batches_equal_the_full_view(spark, tmp_path):
    rng, counts, every = random.Random(5), PatientCounts(spark, str(tmp_path), 4), []
    people = spark.range(40).selectExpr("cast(id AS string) AS patient_id", "'n' AS name")
    assert counts.view(people).where("n_encounters + n_observations + n_conditions > 0").count() == 0
    for batch in range(4):
        facts = _facts(spark, rng, 60)
        every.append(facts)
        counts.add(batch, _facts(spark, rng, 20) if batch == 2 else facts)  # cut off ...
        if batch == 2:
            counts.add(batch, facts)  # ... and replayed
        if batch == 1:
            assert counts.compact(upto=0) == 0
        full = patient_view(people, *[_union(every, n) for n in ("encounters", "observations", "conditions")])
        assert sorted(counts.view(people).collect()) == sorted(full.collect())
    assert counts.compact() == 3 and counts.compact() == 3
    counts.add(1, _facts(spark, rng, 9))  # folded already
    assert sorted(counts.view(people).collect()) == sorted(full.collect())


def _union(every, name):
    out = every[0][name]
    for facts in every[1:]:
        out = out.unionAll(facts[name])
    return out


def test_unfinished_batches_are_not_folded(spark, tmp_path):
    counts = PatientCounts(spark, str(tmp_path), 4)
    one = {"encounters": spark.createDataFrame([("1",)], FACT)}
    for batch in (0, 2):
        counts.add(batch, one)
    os.makedirs(tmp_path / "batches" / "batch_id=1")
    assert counts.compact() == 0
    counts.add(1, one)
    assert counts.compact(checkpoint=str(tmp_path / "none")) == 0
    assert counts.compact() == 2
    assert [tuple(r) for r in counts.read().collect()] == [("1", 3, 0, 0)]


def test_fact_tables_must_be_known(spark):
    with pytest.raises(ValueError):
        count_facts({"visits": spark.createDataFrame([], FACT)})
    with pytest.raises(ValueError):
        count_facts({})
    assert count_facts({"conditions": spark.createDataFrame([], FACT)}).count() == 0


def test_clinical_batches_keep_table_and_counts(spark, tmp_path):
    def patient(name):
        return f'{{"resourceType":"Patient","id":"p","name":[{{"text":"{name}"}}],"gender":"x","birthDate":"2000-01-01"}}'

    seen = '{"resourceType":"Condition","id":"c","subject":{"reference":"Patient/p"},"code":{"coding":[{"code":"a"}]}}'
    for batch, lines in ((0, [patient("a"), seen]), (1, [patient("b"), seen, seen]), (1, [patient("b"), seen, seen])):
        store_batch(spark.createDataFrame([(x,) for x in lines], "value string"), str(tmp_path), batch, buckets=4)
    people = patient_table(spark, str(tmp_path), 4).read()
    assert [r["name"] for r in people.collect()] == ["b"]
    assert patient_counts(spark, str(tmp_path), 4).view(people).first()["n_conditions"] == 3
