import pytest

from millrace.operators import encoding, impute, outliers, profile, quality, runlog, scaling
from millrace.operators.fitted import Fitted
from millrace.plans.health import preprocess


@pytest.fixture
def health(spark):
    return spark.createDataFrame(
        [(22.0, 20.9, "K", "x"), (47.0, 33.1, "L", "y"), (None, 26.4, None, "x"), (64.0, None, "K", "y"), (33.0, 25.0, "N", "x")],
        "age double, bmi double, diagnosis string, gender string",
    )


def column(df, name):
    return [r[name] for r in df.collect()]


def test_impute_median_and_mode(health):
    rows = impute.impute_missing(health).collect()
    assert len(rows) == 5
    assert rows[2]["age"] == 40.0 and rows[3]["bmi"] == pytest.approx(25.7)
    assert rows[2]["diagnosis"] == "K"


def test_impute_leaves_full_table_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "x int, y string")
    assert impute.impute_missing(df).collect() == df.collect()


def test_impute_mean_constant_and_types(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "x int, y string")
    out = impute.impute_missing(df, numeric_strategy="mean", categorical_strategy="constant")
    assert [tuple(r) for r in out.collect()] == [(1.0, "a"), (2.0, "UNKNOWN"), (1.5, "UNKNOWN")]
    even = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert column(impute.impute_missing(even), "x") == [1, 3, 2]
    with pytest.raises(ValueError):
        impute.fit_imputer(df, numeric_strategy="mod")


def test_impute_mode_tie_and_empty_column(spark):
    df = spark.createDataFrame([("b", None), ("b", None), ("a", None), ("a", None), (None, None)], "s string, t string")
    out = impute.impute_missing(df).collect()
    assert out[4]["s"] == "a" and {r["t"] for r in out} == {"UNKNOWN"}


def test_impute_by_group_including_null_group(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "x"), ("a", 3.0, "x"), ("a", None, None), (None, 5.0, "y"), (None, None, None), ("c", None, None)],
        "g string, v double, s string",
    )
    out = impute.impute_missing(df, by=["g"]).collect()
    assert sorted((str(r["g"]), r["v"], r["s"]) for r in out if r["v"] is not None) == [
        ("None", 5.0, "y"), ("None", 5.0, "y"), ("a", 1.0, "x"), ("a", 2.0, "x"), ("a", 3.0, "x")]
    assert [(r["v"], r["s"]) for r in out if r["g"] == "c"] == [(None, "UNKNOWN")]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert column(impute.impute_missing(df), "x") == [1.0, 2.0, 3.0]


def test_cap(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 5, 100)], "val int")
    capped, fences = outliers.cap_outliers(df)
    assert fences.values["val"] == {"lower": -1.5, "upper": 8.5}
    assert column(capped, "val") == [1, 2, 3, 4, 5, 8.5]
    assert [tuple(r) for r in outliers.outlier_counts(df, fences).collect()] == [("val", 6, 1)]
    again, _ = outliers.cap_outliers(capped)
    assert column(again, "val") == column(capped, "val")


def test_cap_without_outliers_and_with_nulls(spark):
    five = spark.createDataFrame([(v,) for v in (10, 20, 30, 40, 50)], "a int")
    _, fences = outliers.cap_outliers(five)
    assert fences.values["a"] == {"lower": -10.0, "upper": 70.0}
    holes = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,), (100.0,), (None,), (float("nan"),)], "x double")
    assert column(outliers.cap_outliers(holes)[0], "x") == [1, 2, 3, 4, 5, 8.5, None, None]


def test_cap_by_group(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 5, 100)] + [("b", 100.0)], "g string, x double")
    capped, fences = outliers.cap_outliers(df, by=["g"])
    assert sorted(column(capped.where("g = 'a'"), "x")) == [1, 2, 3, 4, 5, 8.5]
    assert sorted(tuple(r) for r in outliers.outlier_counts(df, fences).collect()) == [("a", "x", 6, 1), ("b", "x", 1, 0)]
    assert sorted(tuple(r) for r in fences.to_df().collect()) == [("a", "x", -1.5, 8.5), ("b", "x", 100.0, 100.0)]


def test_scaling(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 6)], "x double")
    scaled, model = scaling.scale_features(df)
    assert column(scaled, "x") == pytest.approx([-1.414214, -0.707107, 0, 0.707107, 1.414214], abs=1e-6)
    assert column(scaling.unscale(scaled, model), "x") == pytest.approx([1, 2, 3, 4, 5])
    read = Fitted.from_df(model.to_df(spark), "standard")
    assert column(scaling.scale(df, read), "x") == pytest.approx(column(scaled, "x"))
    ten = spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "x double")
    assert column(scaling.scale_features(ten, method="minmax")[0], "x") == [0, 0.5, 1]
    with pytest.raises(ValueError):
        scaling.fit_scaler(ten, method="robust")


@pytest.mark.parametrize("method", scaling.METHODS)
def test_constant_column_scales_to_zero(spark, method):
    df = spark.createDataFrame([(7.1,)] * 3, "x double")
    assert column(scaling.scale_features(df, method=method)[0], "x") == [0, 0, 0]


@pytest.mark.parametrize("rank_limit", [1, 100])
def test_label_encoding(spark, rank_limit):
    df = spark.createDataFrame([("low",), ("medium",), ("high",), ("low",)], "cat string")
    encoder = encoding.fit_encoder(df, rank_limit=rank_limit)
    encoded = encoding.encode(df, encoder)
    assert sorted(column(encoded, "cat")) == [0, 1, 1, 2]
    assert dict(tuple(r) for r in encoder.classes("cat").collect()) == {"high": 0, "low": 1, "medium": 2}
    assert sorted(column(encoding.decode_labels(encoded, encoder), "cat")) == ["high", "low", "low", "medium"]
    new = spark.createDataFrame([("none",)], "cat string")
    assert column(encoding.encode(new, encoder, unseen="ignore"), "cat") == [-1]
    with pytest.raises(Exception, match="Unseen value"):
        encoding.encode(new, encoder).collect()


def test_null_is_a_class(spark):
    df = spark.createDataFrame([("z",), (None,), ("a",)], "cat string")
    assert sorted(column(encoding.encode_labels(df)[0], "cat")) == [0, 1, 2]


def test_quality(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0)], "id int, value double")
    rules = [*quality.suite(["id", "value", "gone"], columns=["id", "value"]),
             quality.Cardinality("id", 1, 2), quality.Cardinality("id", 3), quality.Cardinality("value", 1, 1, approximate=True)]
    got = [(r["column"], r["success"], r["element_count"], r["unexpected_count"]) for r in quality.evaluate(df, rules).orderBy("rule").collect()]
    assert got == [(None, True, 2, 0), (None, True, 2, 0), ("id", True, 2, 0), ("value", False, 2, 1), ("gone", False, None, None),
                   ("id", True, 2, 0), ("id", False, 2, 0), ("value", True, 1, 0)]
    assert quality.failures(quality.evaluate(df, rules)).count() == 3
    with pytest.raises(ValueError, match=r"failed with 1 violation\(s\)"):
        quality.validate(df, ["id", "value"])
    with pytest.raises(ValueError, match=r"failed with 1 violation"):
        quality.validate(df.where("id > 9"), ["id"])
    assert quality.validate(df, ["id"])["success"] is True
    assert not quality.evaluate(df, [quality.ColumnOrder(("value", "id"))]).first()["success"]


def test_describe(spark):
    df = spark.createDataFrame([(1, "b"), (2, "b"), (3, "a"), (4, None)], "x int, s string")
    rows = {r["column"]: r for r in profile.describe(df).collect()}
    x, s = rows["x"], rows["s"]
    assert (x["count"], x["mean"], x["min"], x["p25"], x["p50"], x["p75"], x["max"]) == (4, 2.5, 1, 1.75, 2.5, 3.25, 4)
    assert x["std"] == pytest.approx(1.290994, abs=1e-6) and x["top"] is None
    assert (s["count"], s["unique"], s["top"], s["freq"], s["mean"]) == (3, 2, "b", 2, None)
    assert list(profile.statistics(df)) == ["x", "s"]
    assert ("s", "top", "b") in [tuple(r) for r in profile.describe_long(df).collect()]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append_run(spark, path, "1", True, 1000, 950, 45.5)
    runlog.append_run(spark, path, "2", False, duration_seconds=5.0)
    log = spark.read.parquet(path)
    assert dict(tuple(r) for r in runlog.status_counts(log).collect()) == {"success": 1, "failure": 1}
    assert tuple(runlog.row_totals(log).first()) == (1000, 950)
    bars = {r["le"]: r["count"] for r in runlog.duration_histogram(log).collect()}
    assert bars == {"30": 1, "60": 2, "120": 2, "300": 2, "600": 2, "1800": 2, "3600": 2, "+Inf": 2}
    assert runlog.last_run(log).first()[0] is not None


def test_fit_for_new_rows_fills_columns_that_were_complete(spark):
    known = spark.createDataFrame([(1.0, "p"), (2.0, "q"), (6.0, "q")], "a double, t string")
    later = spark.createDataFrame([(None, None), (5.0, "p")], "a double, t string")
    fitted = impute.fit_imputer(known, for_new_rows=True)
    assert [tuple(r) for r in impute.impute(later, fitted).collect()] == [(2.0, "q"), (5.0, "p")]
    assert impute.impute(known, fitted).collect() == known.collect()
    for out in (preprocess(known, for_new_rows=True).apply(later).collect(), preprocess(known).apply(later).collect()):
        assert len(out) == 2 and all(v is not None for r in out for v in r)
    hole = spark.createDataFrame([(None, "p")], "a double, t string")
    assert preprocess(known, for_new_rows=False).apply(hole).first()["a"] is None


def test_codes_beyond_an_int(spark, monkeypatch):
    df = spark.createDataFrame([("p",), ("q",), (None,)], "t string")
    assert dict(encoding.encode_labels(df)[0].dtypes) == {"t": "int"}
    monkeypatch.setattr(encoding, "LAST_INT", 2)
    codes, encoder = encoding.encode_labels(df)
    assert dict(codes.dtypes) == {"t": "bigint"} and sorted(r.t for r in codes.collect()) == [0, 1, 2]
    assert {r.t for r in encoding.decode_labels(codes, encoder).collect()} == {"p", "q", "nan"}
    assert [r.t for r in encoding.encode(spark.createDataFrame([("z",)], "t string"), encoder, unseen="ignore").collect()] == [-1]
