"""Softmax boosting against a direct fit in numpy, and its invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import boosting, softmax


def data(n, seed=4):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, n), rng.integers(0, 9, n), np.round(5 * rng.normal(size=n)) / 5], axis=1).astype(float)
    y = (x[:, 0] + 4 * x[:, 1] + 6 * rng.normal(size=n) > 40).astype(int) + (x[:, 2] > 0.4)
    return x, y


def table(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y))], "id bigint, a double, b double, c double, risk_level int")


def direct(x, y, rounds, depth, rate, n_classes):
    """All cuts between values tried one by one; margins of the rows after each round."""
    margins = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))
    history = []
    for _ in range(rounds):
        e = np.exp(margins)
        p = e / e.sum(axis=1, keepdims=True)
        history.append(-np.log(p[np.arange(len(y)), y]).mean())
        step = np.zeros_like(margins)
        for k in range(n_classes):
            g, h = (y == k) - p[:, k], p[:, k] * (1 - p[:, k])

            def grow(rows, left, k=k, g=g, h=h, step=step):
                best = (1e-12, None)
                if left:
                    for f in range(x.shape[1]):
                        for cut in np.unique(x[rows, f])[:-1]:
                            a = rows[x[rows, f] <= cut]
                            b = rows[x[rows, f] > cut]
                            gain = g[a].sum() ** 2 / len(a) + g[b].sum() ** 2 / len(b) - g[rows].sum() ** 2 / len(rows)
                            if gain > best[0] * (1 + 1e-9):
                                best = (gain, (a, b))
                if best[1] is None:
                    step[rows, k] = rate * (n_classes - 1) / n_classes * g[rows].sum() / h[rows].sum()
                else:
                    for part in best[1]:
                        grow(part, left - 1)

            grow(np.arange(len(y)), depth)
        margins = margins + step
    return margins, history


def test_against_a_direct_fit(spark):
    x, y = data(500)
    df = table(spark, x, y).repartition(3)
    model = boosting.fit_risk_model(df, "risk_level", ["a", "b", "c"], trees=12, depth=3, rate=0.2, subsample=1.0)
    want, history = direct(x, y, 12, 3, 0.2, 3)
    assert model.softmax.losses == pytest.approx(history, abs=1e-9)
    scored = {r["id"]: r for r in boosting.predict(df, model).collect()}
    got = np.array([[scored[i][f"margin_{c}"] for c in range(3)] for i in range(len(y))])
    np.testing.assert_allclose(got, want, atol=1e-9)
    e = np.exp(want)
    chances = np.array([[scored[i][f"probability_{c}"] for c in range(3)] for i in range(len(y))])
    np.testing.assert_allclose(chances, e / e.sum(axis=1, keepdims=True), atol=1e-9)
    assert [scored[i]["prediction"] for i in range(len(y))] == e.argmax(axis=1).tolist()


def test_leaves_give_the_margins(spark):
    x, y = data(300)
    model = boosting.fit_risk_model(table(spark, x, y), "risk_level", ["a", "b", "c"], trees=4, depth=3, rate=0.3)
    margins = model.softmax.margins(x)
    for c, leaves in model.leaves(spark).items():
        by_leaf = np.zeros(len(x))
        for leaf in leaves:
            cells = x[:, leaf.features]
            by_leaf += leaf.value * ((cells > leaf.low) & (cells <= leaf.high)).all(axis=1)
        np.testing.assert_allclose(by_leaf, margins[:, c], atol=1e-9)


def test_two_hundred_trees(spark):
    x, y = data(400, seed=8)
    df = table(spark, x, y).coalesce(1)
    model = boosting.fit_risk_model(df, "risk_level", ["a", "b", "c"], depth=2)
    assert len(model.softmax.rounds) == 200
    losses = np.array(model.softmax.losses)
    assert losses[-1] < 0.6 * losses[0] and (np.diff(losses[::10]) < 0).all()
    right = boosting.predict(df, model).agg(F.avg((F.col("prediction") == F.col("risk_level")).cast("double"))).first()[0]
    assert right > 0.8


def test_rows_are_drawn_by_round():
    rows = np.arange(100_000)
    a, b = softmax._drawn(rows, 0, 42, 0.8), softmax._drawn(rows, 1, 42, 0.8)
    assert abs(a.mean() - 0.8) < 0.01 and abs((a & b).mean() - 0.64) < 0.01
    assert softmax._drawn(rows, 0, 42, 1.0).all() and (a == softmax._drawn(rows, 0, 42, 0.8)).all()


def test_odd_tables(spark):
    x, y = data(60)
    flat = table(spark, np.zeros_like(x), y)  # nothing to split
    model = boosting.fit_risk_model(flat, "risk_level", ["a", "b", "c"], trees=2, depth=2, subsample=1.0)
    np.testing.assert_allclose(model.softmax.margins(np.zeros((1, 3)))[0], np.log(np.bincount(y) / len(y)), atol=1e-9)
    named = table(spark, x, y).withColumnsRenamed({"a": "row", "b": "k", "c": "cells"}).withColumn("risk_level", F.col("risk_level") * 5 - 3)
    model = boosting.fit_risk_model(named, "risk_level", ["row", "k", "cells"], trees=2, depth=2)
    scored = boosting.predict(named, model)
    assert model.classes == (-3, 2, 7) and {r["prediction"] for r in scored.collect()} <= {-3, 2, 7}
