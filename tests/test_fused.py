"""The shared fit against the separate steps, which read the filled column anew each time."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import encoding, impute, outliers
from millrace.plans.fused import _raw_rank, fit_together
from millrace.plans.health import preprocess

SCHEMA = "id int, a int, x double, y float, full double, none double, k string, gone string, sure string"


def _rows(n, seed=1):
    rng = random.Random(seed)
    hot = lambda v, share: 7 if rng.random() < share else v
    return [
        (
            i, None if i % 5 == 0 else hot(rng.randrange(40), 1 / 3), rng.choice([None, math.nan, 7.0, rng.gauss(0, 9), rng.gauss(0, 9)]),
            None if i % 2 else rng.random() * 1000, rng.gauss(5, 2), None, None if i % 4 == 0 else rng.choice("zzabc"), None, rng.choice("pq"),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 50, 1501])
@pytest.mark.parametrize("limit", [4, 50_000])
def test_equals_the_separate_steps(spark, n, limit):
    df = spark.createDataFrame(_rows(n, n), SCHEMA).repartition(4)
    numbers, texts = ["a", "x", "y", "full", "none"], ["k", "gone", "sure"]
    got = fit_together(df, numbers, texts, numbers, texts, gather_limit=limit)
    want = impute.fit_imputer(df, numeric=numbers, categorical=texts)
    assert got.imputer.n_missing == want.n_missing
    assert set(got.imputer.numeric.columns) == set(want.numeric.columns)
    for c, p in want.numeric.values.items():
        assert got.imputer.numeric.values[c]["fill"] == pytest.approx(p["fill"])
    assert got.imputer.categorical.values == want.categorical.values
    filled = impute.impute(df, got.imputer)
    fences = outliers.fit_fences(filled, numbers)
    for c, p in fences.values.items():
        for end in ("lower", "upper"):
            assert got.fences.values[c][end] == pytest.approx(p[end]), c
    classes = encoding.fit_encoder(filled, texts)
    assert sorted(got.encoder.entries.collect()) == sorted(classes.entries.collect())
    assert got.encoder.sizes == classes.sizes and got.encoder.text_bytes == classes.text_bytes


def test_ranks_around_the_fills():
    raw, m = [1, 2, 3, 4, 5], 4
    filled = sorted(raw + [3] * m)
    at = [_raw_rank(k, 3, m) for k in range(1, 10)]
    assert [3 if r is None else raw[r - 1] for r in at] == filled


def test_empty_table_and_no_columns(spark):
    empty = fit_together(spark.createDataFrame([], SCHEMA), ["x"], ["k"], ["x"], ["k"])
    assert empty.fences.values == {"x": {"lower": None, "upper": None}} and empty.encoder.entries.count() == 0
    nothing = fit_together(spark.createDataFrame([(1,)], "id int"), [], [], [], [])
    assert nothing.encoder is None and nothing.imputer.n_missing == {}


def test_columns_outside_the_filling(spark):
    """Fences and classes of columns that are not filled: missing values stay out, or are the class of their own."""
    df = spark.createDataFrame([(1.0, "b"), (None, None), (3.0, "a")], "x double, k string")
    got = fit_together(df, [], [], ["x"], ["k"])
    assert got.fences.values["x"] == {"lower": 1.5 - 1.5, "upper": 2.5 + 1.5}
    assert [r["value"] for r in got.encoder.entries.orderBy("code").collect()] == ["a", "b", "nan"]


def test_the_source_is_read_four_times_at_most(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    watched = F.udf(seen, T.DoubleType()).asNondeterministic()
    df = spark.createDataFrame(_rows(500), SCHEMA).select("id", watched("full").alias("x"), "k")
    done = preprocess(df, not_null=["x", "k"], exclude=["id"])
    assert read.value <= 3 * 500  # and the texts once
    assert done.dataframe.count() == 500


def test_gate(spark):
    df = spark.createDataFrame(_rows(40), SCHEMA)
    assert preprocess(df, not_null=["a", "k", "absent"], exclude=["id"]).dataframe.count() == 40
    for bad in ("none", "x"):
        with pytest.raises(ValueError, match=bad):
            preprocess(df, not_null=["a", bad], exclude=["id"] if bad == "none" else ["id", "x"])


def test_named_columns_use_the_separate_steps_where_needed(spark):
    df = spark.createDataFrame(_rows(60), SCHEMA)
    coded = preprocess(df, exclude=["id"], encode_columns=["a"]).dataframe  # a number, coded after scaling
    assert dict(coded.dtypes)["a"] == "int" and coded.where("a IS NULL").count() == 0
