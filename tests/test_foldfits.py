"""Folds fitted from sums against the same folds fitted from rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import foldfits, selection
from tabforge.operators.preprocess import Preprocessor


@pytest.fixture(scope="module")
def table(spark):
    """Two numbers with missing values, one without any, a constant, and two text columns, one with a level few rows have."""
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") % 7 > 0, F.col("id") % 23 * 1000.5).alias("a"),
        F.when(F.col("id") % 5 > 0, F.sin("id") * 3).alias("b"),
        F.lit(None).cast("double").alias("empty"),
        F.lit(4.0).alias("same"),
        F.when(F.col("id") % 6 > 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("c"),
        F.when(F.col("id") == 17, "rare").otherwise("usual").alias("d"),
    )
    y = 2 * F.coalesce("a", F.lit(0.0)) - 5000 * F.coalesce("b", F.lit(1.0)) + F.when(F.col("c") == "k2", 900.0).otherwise(0.0) + F.cos(F.col("id") * 3) * 50
    return df.withColumn("y", F.when(F.col("id") % 97 > 0, y)).repartition(4)


def errors(table, model, params, monkeypatch, rows: bool, task="regression", **prep):
    order = {"order": ["id"]} if task == "timeseries" else {"key": "id"}
    with monkeypatch.context() as patch:
        if rows:
            patch.setattr(selection, "held_out_predictions", lambda *a: None)
        found = selection.run_cv(table, "y", task, model, params, 3, preprocessor=lambda: Preprocessor(**prep), skip=["id"], **order)
    return {(r.fold, r.metric): r.value for r in found.collect()}


@pytest.mark.parametrize(
    "model,params,prep",
    [
        ("ridge", {"alpha": 7.0}, {}),
        ("ridge", {}, {"numeric_strategy": "mean", "categorical_strategy": "constant"}),
        ("ridge", {"alpha": 0.5}, {"numeric_strategy": "most_frequent", "categorical_constant": "k1", "categorical_strategy": "constant"}),
        ("linear_regression", None, {"numeric": ["a", "b", "same"], "categorical": [], "numeric_strategy": "constant"}),
        ("linear_regression", None, {"numeric": ["a", "b"], "categorical": [], "scale_numeric": False}),
    ],
)
def test_sums_equal_rows(table, monkeypatch, model, params, prep):
    fast, slow = (errors(table, model, params, monkeypatch, rows, **prep) for rows in (False, True))
    assert fast.keys() == slow.keys() and len(fast) == 15
    for k, v in slow.items():
        assert math.isclose(fast[k], v, rel_tol=2e-5, abs_tol=1e-6), k


def test_sums_equal_rows_in_time_order(table, monkeypatch):
    fast, slow = (errors(table, "ridge", {"alpha": 1.0}, monkeypatch, rows, "timeseries") for rows in (False, True))
    assert all(math.isclose(fast[k], v, rel_tol=2e-5) for k, v in slow.items()) and len(fast) == 15


def test_what_sums_do_not_give_is_fitted_from_rows(table):
    df = selection._folded(table, "y", "regression", 3, "id", (), True, 1)
    give = lambda model, candidates, **prep: foldfits.held_out_predictions(
        df, "y", "regression", selection.FOLD, 3, model, candidates, Preprocessor(exclude=["id"], **prep), 20
    )
    assert give("ridge", [{"alpha": 1.0}, {"alpha": 2.0}]).count() == 2 * 395
    assert give("ridge", [{"fit_intercept": False}]) is None and give("random_forest", [{}]) is None
    assert give("ridge", [{}], min_frequency=0.1) is None and give("ridge", [{}], categorical=["id"]) is not None
    wide = df.withColumn("w", F.col("id").cast("string"))
    assert foldfits.held_out_predictions(wide, "y", "regression", selection.FOLD, 3, "ridge", [{}], Preprocessor(exclude=["id"]), 40) is None


def test_exact_numbers(spark):
    """A line through four points, three folds: the ridge of each by hand."""
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate([(1, 2), (2, 3), (4, 8), (5, 7), (7, 9), (8, 12)])]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    folded = df.withColumn("f", F.col("id") % 3 + 1)
    got = foldfits.held_out_predictions(folded, "y", "regression", "f", 3, "ridge", [{"alpha": 2.0}], Preprocessor(["x"], []))
    want = {}
    for f in (1, 2, 3):
        x, y = (np.array([r[k] for r in rows if r[0] % 3 + 1 != f]) for k in (1, 2))
        z = (x - x.mean()) / x.std()
        w = z @ y / (z @ z + 2.0)
        want |= {r[2]: y.mean() + w * (r[1] - x.mean()) / x.std() for r in rows if r[0] % 3 + 1 == f}
    assert {r.y: round(r.prediction, 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}
