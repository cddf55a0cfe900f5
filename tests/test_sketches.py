"""Profiles from merged sketches against the exact numbers, within the stated bounds."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.feature_store import FeatureStore
from millrace.operators.quality import Cardinality, ColumnOrder, NotNull, RowCount
from millrace.operators.sketches import DISTINCT_ERROR, RANK_ERROR, TOP_ITEMS, evaluate_profile, merged_profile, sketch


@pytest.fixture(scope="module")
def parts(spark):
    """A third of all rows share one value, some miss theirs."""
    every = spark.range(60_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7.0D WHEN id % 50 = 1 THEN double('NaN') WHEN id % 50 = 2 THEN NULL ELSE hash(id) / 1000.0D END AS x",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 1 THEN NULL ELSE concat('w', id % 9000) END AS w")
    return every, [every.where(f"id % 4 = {i}") for i in range(4)]


def test_bounds_hold_after_merging(parts):
    every, pieces = parts
    got = {r["column"]: r for r in merged_profile([sketch(p) for p in pieces]).collect()}
    x = every.where("x IS NOT NULL AND NOT isnan(x)")
    exact = x.agg(F.min("x"), F.max("x"), F.avg("x"), F.count("x")).first()
    assert got["x"]["n_rows"] == 60_000 and got["x"]["n_missing"] == 60_000 - exact[3]
    assert (got["x"]["minimum"], got["x"]["maximum"]) == (exact[0], exact[1]) and got["x"]["mean"] == pytest.approx(exact[2])
    for q in (25, 50, 75):
        below, upto = x.agg(F.avg((F.col("x") < got["x"][f"p{q}"]).cast("int")), F.avg((F.col("x") <= got["x"][f"p{q}"]).cast("int"))).first()
        assert below - RANK_ERROR <= q / 100 <= upto + RANK_ERROR
    for c in ("id", "w"):
        n = every.agg(F.countDistinct(c)).first()[0]
        assert abs(got[c]["n_distinct"] - n) <= DISTINCT_ERROR * n
    best = got["w"]["frequent"][0]
    assert best["item"] == "hot" and abs(best["count"] - 20_000) <= 60_000 / TOP_ITEMS
    assert got["w"]["p50"] is None and got["x"]["frequent"] is None


def test_one_part_or_many_give_the_same_counts(parts):
    every, pieces = parts
    exact = ("column", "n_rows", "n_missing", "minimum", "maximum")
    one, many = merged_profile([sketch(every)]), merged_profile([sketch(p) for p in pieces])
    assert sorted(one.select(*exact).collect()) == sorted(many.select(*exact).collect())


def test_empty_parts_and_missing_columns(spark):
    full = sketch(spark.createDataFrame([(1, "a"), (2, None)], "a int, b string"))
    empty = sketch(spark.createDataFrame([], "a int, b string, c double"))
    none = sketch(spark.createDataFrame([([1],)], "z array<int>"))
    assert none.count() == 0
    got = {r["column"]: r for r in merged_profile([full, empty, none]).collect()}
    assert (got["a"]["n_rows"], got["a"]["p50"], got["a"]["mean"], got["b"]["n_missing"]) == (2, 1.0, 1.5, 1)
    assert got["c"]["n_rows"] == 0 and got["c"]["p50"] is None and got["c"]["mean"] is None and got["c"]["n_distinct"] == 0
    with pytest.raises(ValueError):
        merged_profile([])


def test_a_column_of_two_kinds(spark):
    got = merged_profile([sketch(spark.createDataFrame([(1,), (3,)], "a int")), sketch(spark.createDataFrame([("x",)], "a string"))]).first()
    assert (got["n_rows"], got["n_distinct"], got["mean"], got["frequent"][0]["item"]) == (3, 3, 2.0, "x")


def test_rules_on_a_profile(spark, parts):
    profile = merged_profile([sketch(p) for p in parts[1]])
    rules = [RowCount(), RowCount(70_000), NotNull("id"), NotNull("w"), NotNull("nowhere"), Cardinality("id", 59_999, 60_001), Cardinality("w", 1, 100)]
    assert [r["success"] for r in evaluate_profile(profile, rules).collect()] == [True, False, True, False, False, True, False]
    with pytest.raises(ValueError):
        evaluate_profile(profile, [ColumnOrder(("id",))])


def test_versions_are_profiled_from_their_sketches(spark, tmp_path):
    store, rng = FeatureStore(spark, str(tmp_path)), random.Random(1)
    for v in (1, 2):
        store.save("f", spark.createDataFrame([(rng.random(), f"s{i}") for i in range(50)], "x double, s string"), v, sketches=True)
    got = {r["column"]: r for r in store.profile("f").collect()}
    assert (got["s"]["n_rows"], got["s"]["n_distinct"]) == (100, 50)
    assert store.profile("f", [1]).first()["n_rows"] == 50
    with pytest.raises(FileNotFoundError):
        store.profile("none")


def test_metadata_is_replaced_without_a_gap(spark, tmp_path, monkeypatch):
    store, rows = FeatureStore(spark, str(tmp_path)), spark.range(3)
    store.save("f", rows, 1)
    assert os.path.isfile(tmp_path / "f" / "v1" / "metadata.json")
    with monkeypatch.context() as patch:
        patch.setattr(FeatureStore, "_replace", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.save("f", spark.range(5), 1)
    assert store.load("f", 1).count() == 3 and store.get_metadata("f", 1)["num_rows"] == 3
    store.save("f", spark.range(5), 1)
    assert store.load("f", 1).count() == 5 and store.catalog().count() == 1
    store.vacuum("f", 1)
    assert store.load("f", 1).count() == 5
