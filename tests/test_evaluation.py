import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabforge.operators import chartdata, drift, metrics
from tests.conftest import by, rows


def scored(spark, y, p, s=None):
    s = s or [float(v) for v in p]
    return spark.createDataFrame(list(zip(y, p, s)), "y int, p int, s double")


def test_binary_metrics(spark):
    m = by(metrics.classification_metrics(scored(spark, [0, 1, 1, 0, 1], [0, 1, 0, 0, 1], [0.1, 0.9, 0.4, 0.2, 0.8]), "y", "p", "s"), "metric", "value")
    assert m["accuracy"] == 0.8 and m["precision"] == 1.0 and m["recall"] == pytest.approx(2 / 3) and m["roc_auc"] == 1.0


def test_multiclass_metrics(spark):
    m = by(metrics.classification_metrics(scored(spark, [0, 1, 2, 0, 1, 2], [0, 1, 1, 0, 2, 2]), "y", "p", "s"), "metric", "value")
    assert m["accuracy"] == pytest.approx(4 / 6) and "roc_auc" not in m


def test_one_class_and_text_labels(spark):
    m = by(metrics.classification_metrics(scored(spark, [0, 0], [0, 0]), "y", "p", "s"), "metric", "value")
    assert m["accuracy"] == 1.0 and m["precision"] == 0.0 and "roc_auc" not in m
    df = spark.createDataFrame([("no", "no"), ("yes", "no"), ("yes", "yes")], "y string, p string")
    assert by(metrics.classification_metrics(df, "y", "p"), "metric", "value")["recall"] == 0.5
    first = metrics.classification_metrics(df, "y", "p", positive="no")
    assert by(first, "metric", "value")["recall"] == 1.0


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=50))
def test_auc_equals_evaluator(spark, pairs):
    df = spark.createDataFrame([(y, s / 6) for y, s in pairs], "y int, s double")
    got = metrics.roc_auc(df, "y", "s", task_rows=3).first().roc_auc
    if len({y for y, _ in pairs}) < 2:
        assert got is None
        return
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert math.isclose(got, want, abs_tol=1e-9)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0), (4.0, 5.0)], "y double, p double")
    m = by(metrics.regression_metrics(df, "y", "p"), "metric", "value")
    assert m["mae"] == pytest.approx(2 / 3) and m["r2"] == pytest.approx(1 - 2 / 8)
    assert m["mape"] == pytest.approx(100 * (0.5 + 0.25) / 2) and m["smape"] == pytest.approx(100 * (2 / 3 + 2 / 9) / 2)
    flat = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "y double, p double")
    m = by(metrics.regression_metrics(flat, "y", "p"), "metric", "value")
    assert m["r2"] == 1.0 and m["mape"] is None and m["smape"] is None


def test_gate(spark):
    found = spark.createDataFrame([("accuracy", 1.0), ("mae", 3.0), ("bad", float("nan"))], "metric string, value double")
    assert metrics.gate_passed(metrics.evaluate_gate(found, {"accuracy": 0.9}))
    assert not metrics.gate_passed(metrics.evaluate_gate(found, {"absent": 0.0}))
    assert not metrics.gate_passed(metrics.evaluate_gate(found, {"bad": 0.0}))
    assert not metrics.gate_passed(metrics.evaluate_gate(found, None, {"mae": 2.0}))
    assert metrics.gate_passed(metrics.evaluate_gate(found))
    with pytest.raises(ValueError):
        metrics.compute_metrics("clustering")


def test_residuals_and_their_sign(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.5), (3.0, 2.5), (4.0, 3.5)], "y double, p double")
    assert [r["residual"] for r in rows(metrics.with_residual(df, "y", "p"), "y")] == [-0.5, -0.5, 0.5, 0.5]
    assert metrics.residual_summary(df, "y", "p").first().rmse == 0.5
    grid = chartdata.residuals_vs_predicted(df, "y", "p", 2)
    assert grid.agg(F.sum("n")).first()[0] == 4


def test_confusion_has_zero_cells(spark):
    cells = {(r["actual"], r["predicted"]): r["n"] for r in rows(metrics.confusion_matrix(scored(spark, [0, 1, 2], [0, 0, 0]), "y", "p", zeros=True))}
    assert len(cells) == 9 and cells[2, 2] == 0 and cells[1, 0] == 1


def test_roc_points(spark):
    df = scored(spark, [0, 0, 1, 1], [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    points = [(r["fpr"], r["tpr"]) for r in sorted(rows(metrics.roc_points(df, "y", "s")), key=lambda r: -(r["threshold"] or 9))]
    assert points == [(0, 0), (0, 0.5), (0.5, 0.5), (0.5, 1), (1, 1)]
    many = spark.range(400).selectExpr("CAST(id % 3 = 0 AS INT) AS y", "CAST(id % 97 AS DOUBLE) AS s")
    one, cut = (metrics.roc_points(many, "y", "s", task_rows=n) for n in (10**6, 10))
    assert one.exceptAll(cut).isEmpty() and one.count() == cut.count()
    with pytest.raises(ValueError):
        metrics.roc_points(scored(spark, [1, 1], [1, 1]), "y", "s")


def test_histogram_edges(spark):
    values = [0.0, 0.1, 0.2, 0.3, 0.7, 1.0, 1.0]
    df = spark.createDataFrame([(v, 4) for v in values], "v double, same int")
    found = {(r["column"], r["bin"]): r["n"] for r in rows(chartdata.histograms(df, bins=10))}
    want = np.histogram(values, 10)[0]
    assert [found.get(("v", i), 0) for i in range(10)] == want.tolist() and found["same", 5] == 7


def numpy_psi(expected, actual, bins=10):
    edges = np.quantile(expected, np.linspace(0, 1, bins + 1))
    at = lambda x: np.bincount(np.searchsorted(edges[1:-1], x, side="right"), minlength=bins)
    e, a = at(expected) / len(expected) + 1e-6, at(actual) / len(actual) + 1e-6
    return float(np.sum((a - e) * np.log(a / e)))


def ints(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def test_psi_golden(spark):
    profile = drift.drift_profile(ints(spark, [1, 2, 3, 4] * 25))
    same = drift.check_drift(profile, ints(spark, [1, 2, 3, 4] * 6)).first()
    assert same.psi == 0.0 and not same.drifted
    far = drift.check_drift(profile, ints(spark, [100] * 20 + [1] * 4)).first()
    assert math.isclose(far.psi, 6.950714526622414, rel_tol=1e-9) and far.drifted


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.floats(-100, 100), min_size=1, max_size=40), st.lists(st.floats(-100, 100), min_size=1, max_size=40)
)
def test_psi_equals_numpy(spark, expected, actual):
    got = drift.check_drift(drift.drift_profile(ints(spark, expected)), ints(spark, actual)).first().psi
    assert math.isclose(got, numpy_psi(np.array(expected), np.array(actual)), rel_tol=1e-9, abs_tol=1e-9)


def test_drift_columns(spark):
    ref = spark.createDataFrame([(1.0, 1), (2.0, 2), (3.0, 3)], "a double, only_ref int")
    live = spark.createDataFrame([(2.0, 5.0, None), (float("nan"), 6.0, None)], "a double, new double, empty double")
    found = by(drift.check_drift(drift.drift_profile(ref), live), "column", "psi")
    assert set(found) == {"a", "new"} and found["new"] == 0.0 and found["a"] > 0
    summary = drift.drift_summary(drift.check_drift(drift.drift_profile(ref), live)).first()
    assert summary.drifted
    head = drift.drift_profile(ref, ["a"], sample_rows=2, order=["only_ref"]).first()
    assert head.n == 2


def test_ks_equals_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 30, 300), rng.integers(5, 40, 200)
    both = np.unique(np.concatenate([a, b]))
    want = max(abs((a <= v).mean() - (b <= v).mean()) for v in both)
    assert math.isclose(drift.ks_two_sample(ints(spark, a), ints(spark, b)).first().ks, want, rel_tol=1e-12)


def test_class_psi_sees_new_classes(spark):
    a = spark.createDataFrame([("x",), ("y",)], "c string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "c string")
    assert drift.class_psi(a, a, "c").first().psi == 0.0 and drift.class_psi(a, b, "c").first().psi > 1


def test_calibration(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.05), (1, 0.05)], "y int, s double")
    found = by(metrics.calibration_bins(df, "y", "s"), "bin")
    assert found[9]["observed_rate"] == 1.0 and found[0]["observed_rate"] == 0.5


def test_confusion_without_zero_cells(spark):
    df = spark.range(3000).selectExpr("id AS y", "id + CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END AS p")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in rows(metrics.confusion_matrix(df, "y", "p"))}
    assert len(cells) == 3000 and cells[10, 11] == 1 and (10, 10) not in cells and metrics.confusion_matrix(df.limit(0), "y", "p", zeros=True).count() == 0


def test_one_vs_rest_scores_each_row_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(v):
        calls.add(1)
        return v / 60.0

    df = spark.range(60).select(F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("y"), score("id").alias("s"))
    got = metrics.roc_auc_one_vs_rest(df, "y", {"a": "s", "b": "s"}).first().value
    assert got == pytest.approx(0.5) and calls.value == 60
