import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators import jobs, models, selection
from tabforge.operators.preprocess import Preprocessor
from tabforge.sources import registry, tables
from tabforge.streaming import lags as stream_lags
from tabforge.streaming import scoring, sources, windows
from tabforge.operators import drift, lags
from tests.conftest import by, rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(300).selectExpr(
        "id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CASE id % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'y' END AS c",
        "3.0D * (id % 17) - 2.0D * (id % 5) + (id % 7) * 0.1D AS y", "CAST(id % 17 > 8 AS INT) AS big",
    )


def test_ridge_closed_form(frame):
    data = frame.toPandas()
    x = data[["a", "b"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    c = data.y - data.y.mean()
    want = np.linalg.solve(z.T @ z + 7 * np.eye(2), z.T @ c)
    model = models.fit_model(frame.select("a", "b", "y"), "y", "regression", "ridge", {"alpha": 7.0})
    got = by(models.linear_coefficients(model, frame.select("a", "b", "y")), "feature", "coefficient")
    assert math.isclose(got["num__a"], want[0], rel_tol=1e-6) and math.isclose(got["num__b"], want[1], rel_tol=1e-6)


def test_logistic_objective(spark):
    data = [(float(i % 7), int((i * 3) % 11 > 5 - i % 7)) for i in range(200)]
    df = spark.createDataFrame(data, "x double, y int")
    model = models.fit_model(df, "y", "classification", "logistic_regression", {"C": 0.5, "tol": 1e-12, "max_iter": 500}, Preprocessor(["x"], [], scale_numeric=False))
    fitted = [s for s in model.stages if hasattr(s, "coefficients")][0]
    w, b = fitted.coefficients[0], fitted.intercept
    x, y = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    p = 1 / (1 + np.exp(-(w * x + b)))
    # the gradient of 0.5 w^2 + C * loss vanishes; the intercept is not penalised
    assert abs(w + 0.5 * np.sum((p - y) * x)) < 1e-3 and abs(np.sum(p - y)) < 1e-3


def test_unknown_names():
    with pytest.raises(ValueError, match="there are|Available"):
        models.build_model("xgboost", "regression")
    with pytest.raises(ValueError, match="parameters"):
        models.build_model("ridge", "regression", {"beta": 1})
    with pytest.raises(ValueError, match="Unknown task"):
        jobs.get_task("clustering")


def test_classification_train_score(frame):
    job = jobs.Job("big", "classification", ["id"], model="random_forest", params={"n_estimators": 5, "max_depth": 5})
    result = jobs.run_training(frame.drop("y"), job)
    found = by(result.metrics, "metric", "value")
    assert found["accuracy"] > 0.9 and 0 <= found["roc_auc"] <= 1 and result.scored.count() == 60
    assert result.scored.schema["prediction"].dataType == T.IntegerType()
    top = models.feature_importances(result.model, result.train, 2)
    assert top.first().feature == "num__a"
    assert set(models.input_columns(result.model)) == {"a", "b", "c"}


def test_text_target_and_multiclass_boosting(frame):
    labelled = frame.withColumn("kind", F.expr("CASE WHEN a < 6 THEN 'lo' WHEN a < 12 THEN 'mid' ELSE 'hi' END")).drop("y", "big")
    job = jobs.Job("kind", "classification", ["id"], model="gradient_boosting", params={"n_estimators": 3})
    result = jobs.run_training(labelled, job)
    assert by(result.metrics, "metric", "value")["accuracy"] > 0.9 and "probability" not in result.scored.columns


def test_registry_round_trip(spark, frame, tmp_path):
    root = str(tmp_path / "registry")
    job = jobs.Job("y", "regression", ["id"], model="linear_regression")
    with pytest.raises(FileNotFoundError):
        registry.load_production(spark, root)
    result = jobs.run_training(frame.drop("big"), job, root=root)
    with pytest.raises(FileNotFoundError):
        registry.promote(spark, root, "nope")
    registry.promote(spark, root, result.run_id)
    second = registry.save_run(spark, root, result.model, {"mae": 1.0})
    registry.promote(spark, root, second)
    assert registry.production_run(spark, root).run_id == second
    registry.promote(spark, root, result.run_id)
    scored = jobs.score_table(registry.load_production(spark, root), frame.drop("y", "big"), job)
    assert scored.columns == ["id", "prediction"] and scored.count() == 300
    report = by(jobs.run_monitor(spark, root, frame.withColumn("a", F.col("a") * 3)), "column")
    assert report["a"]["drifted"] and not report["b"]["drifted"]
    with pytest.raises(RuntimeError, match="'a'"):
        jobs.run_monitor(spark, root, frame.withColumn("a", F.col("a") * 3), raise_on_drift=True)
    with pytest.raises(ValueError, match=r"\['a', 'c'\]"):
        jobs.score_table(result.model, frame.drop("a", "c"), job)


def test_evaluate_recreates_the_split(frame):
    job = jobs.Job("y", "regression", ["id"], model="linear_regression")
    result = jobs.run_training(frame.drop("big"), job)
    table, gate = jobs.run_evaluation(frame.drop("big"), job, result.model, {"r2": 0.5})
    assert by(table, "metric", "value") == by(result.metrics, "metric", "value") and gate.first().passed
    with pytest.raises(RuntimeError, match="r2"):
        jobs.run_evaluation(frame.drop("big"), job, result.model, {"r2": 2.0}, raise_on_failure=True)


def test_dates_live_in_the_model(spark, tmp_path):
    df = spark.sql("SELECT id, date_add(DATE'2023-01-01', CAST(id AS INT)) AS d, CAST(id % 7 AS DOUBLE) AS y FROM range(200)")
    job = jobs.Job("y", "regression", ["id"], datetime_columns=["d"], cyclical=True, holiday_country="US", model="random_forest", params={"n_estimators": 3, "max_depth": 4})
    result = jobs.run_training(df, job)
    assert by(result.metrics, "metric", "value")["r2"] > 0.5
    result.model.write().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    made = back.stages[0].transform(df)
    want = lags.add_datetime_features(df, "d", cyclical=True, holiday_country="US")
    names = [c for c in want.columns if c.startswith("d_")]
    assert made.select(names).exceptAll(want.select(names)).isEmpty()
    assert models.input_columns(back, ["d"]) == ["d"]


def test_timeseries_job(spark):
    df = spark.sql("SELECT date_add(DATE'2023-01-01', CAST(id AS INT)) AS date, 50 + 0.05D * id + 10 * sin(2 * pi() * id / 7) AS y FROM range(200)")
    job = jobs.Job("y", "timeseries", date="date", model="ridge")
    result = jobs.run_training(df, job)
    assert by(result.metrics, "metric", "value")["r2"] > 0.95
    chart = jobs.forecast_chart(result, job)
    assert chart.count() == 186 and chart.where("split = 'train' AND predicted IS NOT NULL").isEmpty()
    assert chart.where("split = 'test'").count() == 37
    assert jobs.score_table(result.model, df, job).columns == ["date", "prediction"]
    _per, summary = jobs.run_crossval(df, job, 3)
    assert {r.n_folds for r in summary.collect()} == {3}


def test_crossval_and_tuning(frame):
    job = jobs.Job("big", "classification", ["id"], model="random_forest", params={"n_estimators": 3, "max_depth": 3})
    per_fold, summary = jobs.run_crossval(frame.drop("y"), job, 3, parallelism=3)
    assert {r.fold for r in per_fold.collect()} == {1, 2, 3}
    assert by(summary, "metric")["accuracy"]["mean"] > 0.8
    _model, table = jobs.run_tune(frame.drop("y"), job, {"model__max_depth": [1, 4]}, folds=2)
    scores = [r.mean_score for r in table.orderBy("rank").collect()]
    assert len(scores) == 2 and scores == sorted(scores, reverse=True)
    with pytest.raises(ValueError):
        selection.parameter_grid({})
    with pytest.raises(ValueError, match="model__"):
        selection.parameter_grid({"preprocess__x": [1]})


def test_csv(spark, tmp_path):
    path = tmp_path / "in.CSV"
    path.write_text('a,b,c,d,e\n1,x,1.5,true,\n2,"q, ""z""",NA,False,\nN/A,null,3,,\n')
    df = tables.read_table(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string", "double", "boolean", "double"]
    got = [tuple(r) for r in df.collect()]
    assert got == [(1, "x", 1.5, True, None), (2, 'q, "z"', None, False, None), (None, None, 3.0, None, None)]
    typed = tables.read_table(spark, str(path), schema="a double, b string, c string, d string, e string")
    assert [r.a for r in typed.collect()] == [1.0, 2.0, None]
    out = tables.write_table(df, str(tmp_path / "deep" / "out.csv"))
    assert [tuple(r) for r in tables.read_table(spark, out).collect()] == got


def test_formats_and_sources(spark):
    assert tables.resolve_format("x/y.Parquet") == "parquet" and tables.resolve_format("x", "csv") == "csv"
    for bad in (("x.json", None), ("x", None), ("x.csv", "xml")):
        with pytest.raises(ValueError):
            tables.resolve_format(*bad)
    with pytest.raises(ValueError, match="path"):
        tables.load_data(spark)
    with pytest.raises(ValueError, match="kind of source"):
        tables.load_data(spark, "synthetic")


# ----------------------------------------------------------------- streams ---


def parts(df, path, n=4):
    """The table as n files in time order."""
    df.repartitionByRange(n, "ts").write.parquet(path)
    return path


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, stream_lags.ROCKSDB)
    yield
    spark.conf.unset(key)


NAMES = ["event_type", "event_id", "value", "lag_1", "lag_3", "round(rolling_mean_4, 9)", "round(rolling_std_4, 9)"]


def lag_stream(stream, **more):
    return stream_lags.stream_lag_features(stream, "value", "ts", ["event_type"], "event_id", [1, 3], [4], ["mean", "std"], **more)


def batch_lags(e):
    return lags.add_lag_features(e, "value", "ts", [1, 3], [4], ["mean", "std"], date_parts=False, series=["event_type"], tie=["event_id"])


def test_stream_lags_wait_for_late_files(spark, load, tmp_path, rocksdb):
    e = load("events").select("event_id", "ts", "event_type", F.when(F.col("event_id") % 50 > 0, F.col("value")).alias("value"))
    path = parts(e, str(tmp_path / "in"), 5)
    stream = sources.read_stream(spark, path, e.schema, files_per_trigger=1)
    # files arrive in any order, so the delay covers the whole month: all rows come out at the end
    out = sources.run_to_end(stream, "ts", lambda s: lag_stream(s, delay="40 days", stretch="3 days"), "lags")
    want = batch_lags(e)
    assert out.count() == want.count() > 800
    assert out.selectExpr(NAMES).exceptAll(want.selectExpr(NAMES)).isEmpty()
    assert sources.run_to_table(lag_stream(sources.read_stream(spark, path, e.schema), delay="40 days"), "lags").count() == 0


def test_one_busy_series_over_many_batches(spark, load, tmp_path, rocksdb):
    """Whatever the series, a key holds a day; finished days leave the state."""
    e = load("events").select("event_id", "ts", F.lit("only").alias("event_type"), "value")
    path, day = str(tmp_path / "in"), F.dayofmonth("ts")
    for first in range(1, 32, 8):  # files in time order, each a little late for the one after it
        e.where(day.between(first, first + 7)).coalesce(1).write.mode("append").parquet(path)
    stream = sources.read_stream(spark, path, e.schema, files_per_trigger=1)
    folder, out, kept = str(tmp_path / "flush"), str(tmp_path / "out"), []
    made = lag_stream(sources.with_flush(stream, folder), ttl="20 days")
    for last in (False, True):
        if last:
            sources.flush(spark, folder, e.schema, "ts")
        query = sources.start(made, out, str(tmp_path / "checkpoint"), available_now=True)
        query.awaitTermination()
        kept.append([[o["numRowsTotal"] for o in p["stateOperators"]] for p in query.recentProgress if p["stateOperators"]])
    got, want = spark.read.schema(made.schema).parquet(out), batch_lags(e)
    assert got.count() == want.count() > 900
    assert got.selectExpr(NAMES).exceptAll(want.selectExpr(NAMES)).isEmpty()
    # about nine days, each with its rows and a timer, and the one series' last values
    assert max(n for batch in kept[0] for n in batch) <= 40
    assert kept[1][-1] == [0, 0]


def test_series_features_equal_pandas():
    y = np.random.default_rng(1).normal(size=40)
    y[7] = np.nan
    s = pd.Series(y)
    got = stream_lags.series_features(y, [1, 50], [1, 4], ["mean", "std", "min", "max"])
    want = [s.shift(1), s.shift(50)]
    for w in (1, 4):
        roll = s.shift(1).rolling(w)
        want += [roll.mean(), roll.std(), roll.min(), roll.max()]
    np.testing.assert_allclose(got, np.stack(want, axis=1), rtol=1e-9)
    assert stream_lags.series_features(y[:0], [1], [2], ["mean"]).shape == (0, 2)


def test_stream_volume_drops_late_rows(spark, load, tmp_path):
    e = load("events").select("ts", "value")
    out = sources.run_to_table(windows.stream_volume(sources.read_stream(spark, parts(e, str(tmp_path / "in"))), "ts"), "volume")
    want = e.groupBy(F.date_trunc("day", "ts").alias("period_start")).count()
    got = {str(r.period_start)[:10]: r.n for r in out.collect()}
    assert got.items() <= {str(r.period_start)[:10]: r["count"] for r in want.collect()}.items() and len(got) >= 28


def test_stream_drift_equals_batch(spark, load, tmp_path):
    e = load("events")
    profile = drift.drift_profile(e, ["value"])
    out = sources.run_to_table(windows.stream_drift(sources.read_stream(spark, parts(e, str(tmp_path / "in"), 1)), profile, "ts"), "drift")
    one = out.orderBy("window_start").first()
    day = e.where((F.col("ts") >= F.lit(str(one.window_start)).cast("timestamp_ntz")) & (F.col("ts") < F.lit(str(one.window_end)).cast("timestamp_ntz")))
    assert math.isclose(one.psi, drift.check_drift(profile, day, columns=["value"]).first().psi, rel_tol=1e-9)


def test_stream_scoring_with_quarantine(spark, frame, tmp_path):
    model = models.fit_model(frame.select("a", "b", "y"), "y", "regression", "linear_regression")
    records = ['{"id": 1, "a": 2.0, "b": 1.0}', '{"id": 2, "a": null, "b": 1.0, "extra": 5}', '{"id": 3, "b": 1.0}', "not json"]
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = sources.read_stream(spark, str(tmp_path / "in"))
    schema = T.StructType.fromDDL("id long, a double, b double")
    parsed = scoring.parse_records(stream, schema, models.input_columns(model))
    query = scoring.start_scoring(parsed, model, str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "ck"), ["id"], available_now=True)
    query.awaitTermination()
    good = rows(spark.read.parquet(str(tmp_path / "out")), "id")
    assert [r["id"] for r in good] == [1, 2] and all(r["prediction"] is not None for r in good)
    bad = rows(spark.read.parquet(str(tmp_path / "bad")), "value")
    assert [r["reject_reason"] for r in bad] == ["not a JSON object", 'Missing columns: ["a"]'] or {r["reject_reason"] for r in bad} == {"not a JSON object", 'Missing columns: ["a"]'}
    with pytest.raises(ValueError, match="Missing columns"):
        scoring.score_stream(stream, model)
