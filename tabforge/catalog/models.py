"""Queries that fit, score, search, register and monitor models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.registry import DAILY_SQL, daily_revenue, query, rounded_doubles, table
from tabforge.operators import jobs, models, selection
from tabforge.operators.preprocess import Preprocessor
from tabforge.plans.ordering import with_global_rank
from tabforge.session import scratch_dir
from tabforge.sources import registry, tables

# A target that depends on the features, so that fitted models can be told from noise
PRICED_SQL = (
    "(SELECT o_orderkey, o_totalprice, (o_custkey % 50)::DOUBLE AS x, o_orderstatus, "
    "o_totalprice * 0.01 + (o_custkey % 50) * 120.0 + CASE o_orderstatus WHEN 'F' THEN 900 WHEN 'O' THEN 0 ELSE -400 END AS y FROM orders)"
)


def priced(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_totalprice",
        "CAST(o_custkey % 50 AS DOUBLE) AS x",
        "o_orderstatus",
        "o_totalprice * 0.01D + (o_custkey % 50) * 120.0D + CASE o_orderstatus WHEN 'F' THEN 900 WHEN 'O' THEN 0 ELSE -400 END AS y",
    )


_SPLIT = (
    "(SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', o_orderkey::VARCHAR))) <= ceil(0.2 * count(*) OVER ()) "
    f"THEN 'test' ELSE 'train' END AS split FROM {PRICED_SQL})"
)


def _plain(columns):
    return Preprocessor(columns, [], scale_numeric=False)


@query(
    "simple_linear_fit",
    f"SELECT '(intercept)' AS feature, round(regr_intercept(y, o_totalprice), 4) AS coefficient FROM {PRICED_SQL} "
    f"UNION ALL SELECT 'num__o_totalprice', round(regr_slope(y, o_totalprice), 4) FROM {PRICED_SQL}",
)
def simple_linear_fit(spark, sf_dir):
    df = priced(spark, sf_dir).select("o_totalprice", "y")
    model = models.fit_model(df, "y", "regression", "linear_regression", None, _plain(["o_totalprice"]))
    return rounded_doubles(models.linear_coefficients(model, df), 4)


@query(
    "ridge_fit",
    "WITH m AS (SELECT avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx FROM " + PRICED_SQL + "), "
    "t AS (SELECT (x - mx) / sx AS z, y - my AS c FROM " + PRICED_SQL + ", m), "
    "f AS (SELECT sum(z * c) / (sum(z * z) + 2500) AS b FROM t) "
    "SELECT '(intercept)' AS feature, round((SELECT my FROM m), 4) AS coefficient UNION ALL SELECT 'num__x', round(b, 4) FROM f",
)
def ridge_fit(spark, sf_dir):
    df = priced(spark, sf_dir).select("x", "y")
    model = models.fit_model(df, "y", "regression", "ridge", {"alpha": 2500.0}, Preprocessor(["x"], []))
    return rounded_doubles(models.linear_coefficients(model, df), 4)


@query(
    "train_linear_metrics",
    f"WITH s AS (SELECT * FROM {_SPLIT}), m AS (SELECT regr_slope(y, o_totalprice) AS b, regr_intercept(y, o_totalprice) AS a FROM s WHERE split = 'train'), "
    "t AS (SELECT y AS t, a + b * o_totalprice AS p FROM s, m WHERE split = 'test') "
    "SELECT 'mae' AS metric, round(avg(abs(t - p)), 4) AS value FROM t UNION ALL SELECT 'rmse', round(sqrt(avg((t - p) * (t - p))), 4) FROM t "
    "UNION ALL SELECT 'r2', round(1 - sum((t - p) * (t - p)) / (var_pop(t) * count(*)), 4) FROM t "
    "UNION ALL SELECT 'mape', round(avg(abs((t - p) / nullif(t, 0))) * 100, 4) FROM t "
    "UNION ALL SELECT 'smape', round(avg(2 * abs(t - p) / nullif(abs(t) + abs(p), 0)) * 100, 4) FROM t",
)
def train_linear_metrics(spark, sf_dir):
    job = jobs.Job("y", "regression", ["o_orderkey"], model="linear_regression", numeric_columns=["o_totalprice"], categorical_columns=[])
    df = priced(spark, sf_dir).select("o_orderkey", "o_totalprice", "y")
    return rounded_doubles(jobs.run_training(df, job).metrics, 4)


@query(
    "predict_linear",
    f"WITH s AS (SELECT * FROM {PRICED_SQL}), m AS (SELECT regr_slope(y, o_totalprice) AS b, regr_intercept(y, o_totalprice) AS a FROM s) "
    "SELECT o_orderkey, round(a + b * o_totalprice, 3) AS prediction FROM s, m",
)
def predict_linear(spark, sf_dir):
    df = priced(spark, sf_dir).select("o_orderkey", "o_totalprice", "y")
    job = jobs.Job("y", "regression", ["o_orderkey"])
    model = models.fit_model(df, "y", "regression", "linear_regression", None, _plain(["o_totalprice"]))
    return rounded_doubles(jobs.score_table(model, df, job), 3)


_FOLDED = (
    "(SELECT *, least(5, 1 + ((k - 1) >= s1)::INT + ((k - 1) >= s2)::INT + ((k - 1) >= s3)::INT + ((k - 1) >= s4)::INT) AS fold FROM ("
    "SELECT *, n // 5 + (n % 5 > 0)::INT AS s1, 2 * (n // 5) + (n % 5 > 0)::INT + (n % 5 > 1)::INT AS s2, "
    "3 * (n // 5) + (n % 5 > 0)::INT + (n % 5 > 1)::INT + (n % 5 > 2)::INT AS s3, 4 * (n // 5) + n % 5 AS s4 FROM ("
    "SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', o_orderkey::VARCHAR))) AS k, count(*) OVER () AS n FROM " + PRICED_SQL + ")))"
)


@query(
    "cv_linear",
    f"WITH d AS (SELECT * FROM {_FOLDED}), f AS (SELECT unnest(range(1, 6)) AS f), "
    "m AS (SELECT f, regr_slope(y, o_totalprice) AS b, regr_intercept(y, o_totalprice) AS a FROM f, d WHERE d.fold <> f GROUP BY f), "
    "e AS (SELECT m.f, avg(abs(y - a - b * o_totalprice)) AS mae, sqrt(avg((y - a - b * o_totalprice) ** 2)) AS rmse, "
    "1 - sum((y - a - b * o_totalprice) ** 2) / (var_pop(y) * count(*)) AS r2 FROM m JOIN d ON d.fold = m.f GROUP BY m.f) "
    "SELECT 'mae' AS metric, round(avg(mae), 4) AS mean, round(stddev_pop(mae), 4) AS std, count(*) AS n_folds FROM e "
    "UNION ALL SELECT 'rmse', round(avg(rmse), 4), round(stddev_pop(rmse), 4), count(*) FROM e "
    "UNION ALL SELECT 'r2', round(avg(r2), 4), round(stddev_pop(r2), 4), count(*) FROM e",
)
def cv_linear(spark, sf_dir):
    df = priced(spark, sf_dir).select("o_orderkey", "o_totalprice", "y")
    per_fold = selection.run_cv(
        df, "y", "regression", "linear_regression", None, 5, "o_orderkey",
        preprocessor=lambda: _plain(["o_totalprice"]), parallelism=5,
    )
    return rounded_doubles(selection.aggregate_cv(per_fold).where("metric IN ('mae', 'rmse', 'r2')"), 4)


# Targets that are a step of one feature, so that a model that works predicts them exactly and SQL can say what
_STEPS = {
    "y": "CASE WHEN o_custkey % 10 < 5 THEN 100.0 ELSE 200.0 END",
    "big": "CASE WHEN o_custkey % 10 < 5 THEN 0 ELSE 1 END",
    "band": "CASE WHEN o_custkey % 10 < 3 THEN 'A' WHEN o_custkey % 10 < 7 THEN 'B' ELSE 'C' END",
}


def stepped(spark, sf_dir, target):
    step = _STEPS[target].replace(".0", ".0D")
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(o_custkey % 10 AS DOUBLE) AS x", f"{step} AS {target}")


def _step_sql(target):
    kind = {"y": "DOUBLE", "big": "INTEGER", "band": "VARCHAR"}[target]
    return f"SELECT o_orderkey, CAST({_STEPS[target]} AS {kind}) AS prediction FROM orders"


def _step_job(target, model, **params):
    task = "regression" if target == "y" else "classification"
    return jobs.Job(target, task, ["o_orderkey"], model=model, params=params)


def _predict_steps(spark, sf_dir, target, model, **params):
    """Train on the training part, then score every order."""
    df, job = stepped(spark, sf_dir, target), _step_job(target, model, **params)
    scored = jobs.score_table(jobs.run_training(df, job).model, df, job).select("o_orderkey", "prediction")
    return rounded_doubles(scored, 6)


@query("train_score_rf", _step_sql("y"))
def train_score_rf(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "y", "random_forest", n_estimators=20, max_depth=6)


@query("train_score_rf_classes", _step_sql("big"))
def train_score_rf_classes(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "big", "random_forest", n_estimators=10, max_depth=5)


@query("train_gbt", _step_sql("big"))
def train_gbt(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "big", "gradient_boosting", n_estimators=10)


@query("train_hist_gbt", _step_sql("y"))
def train_hist_gbt(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "y", "hist_gradient_boosting", max_iter=10)


@query("train_bagging", _step_sql("y"))
def train_bagging(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "y", "bagging", n_estimators=5, max_depth=8)


@query("train_gbt_multiclass", _step_sql("band"))
def train_gbt_multiclass(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "band", "gradient_boosting", n_estimators=5)


@query("train_logreg", _step_sql("big"))
def train_logreg(spark, sf_dir):
    return _predict_steps(spark, sf_dir, "big", "logistic_regression")


def _held_out(result, df, target, least):
    """Test rows, classes, and whether the accuracy on the test rows reaches ``least``."""
    accuracy = result.metrics.where("metric = 'accuracy'").first().value
    rows = result.scored.agg(F.count(F.lit(1)).alias("n_test"))
    kinds = df.agg(F.count_distinct(target).alias("n_classes"))
    return rows.join(F.broadcast(kinds)).withColumn("learned", F.lit(accuracy >= least))


@query(
    "train_embeddings_logreg",
    "SELECT ceil(0.2 * count(*))::BIGINT AS n_test, count(DISTINCT label) AS n_classes, true AS learned FROM embeddings",
)
def train_embeddings_logreg(spark, sf_dir):
    """Classes over the numbers of a vector column. The labels hardly follow from them, so little is asked."""
    e = table(spark, sf_dir, "embeddings")
    low, width, kinds = e.agg(F.min(F.size("embedding")), F.max(F.size("embedding")), F.count_distinct("label")).first()
    if low != width:
        raise ValueError(f"vectors of {low} to {width} numbers")
    wide = e.select("vec_id", "label", *[F.col("embedding")[i].alias(f"e{i}") for i in range(width)])
    job = jobs.Job("label", "classification", ["vec_id"], model="logistic_regression", params={"max_iter": 20})
    return _held_out(jobs.run_training(wide, job), wide, "label", 0.2 / kinds)


@query(
    "train_quality_logreg",
    "SELECT ceil(0.2 * count(*))::BIGINT AS n_test, count(DISTINCT quality) AS n_classes, true AS learned "
    "FROM labels JOIN documents USING (doc_id)",
)
def train_quality_logreg(spark, sf_dir):
    """Mixed columns; learned means right for half of the rows, as the labels hardly follow from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    joined = table(spark, sf_dir, "labels").join(docs, "doc_id").drop("toxic")
    job = jobs.Job("quality", "classification", ["doc_id"], model="logistic_regression")
    return _held_out(jobs.run_training(joined, job), joined, "quality", 0.5)


@query(
    "baseline_forest",
    "SELECT 'metric' AS kind, unnest(['accuracy', 'precision', 'recall', 'f1']) AS name, 1.0::DOUBLE AS value "
    "UNION ALL SELECT 'importance', 'num__x', 1.0",
)
def baseline_forest(spark, sf_dir):
    df = stepped(spark, sf_dir, "big")
    found, top = jobs.run_baseline(df, jobs.Job("big", "classification", ["o_orderkey"], params={"max_depth": 5}), n_trees=20)
    out = found.select(F.lit("metric").alias("kind"), F.col("metric").alias("name"), "value").unionByName(
        top.select(F.lit("importance").alias("kind"), F.col("feature").alias("name"), F.col("importance").alias("value"))
    )
    return rounded_doubles(out, 6)


def _ridge_sql(folded, k, alphas):
    """Per fold and penalty: slope and intercept of a ridge on the one standardised feature, and errors of the held-out rows."""
    return (
        f"d AS (SELECT * FROM {folded}), g AS (SELECT f, unnest({alphas}) AS alpha FROM (SELECT unnest(range(1, {k + 1})) AS f)), "
        "t AS (SELECT f, alpha, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, covar_pop(x, y) AS c, count(*) AS n "
        "FROM g, d WHERE d.fold <> f GROUP BY f, alpha), "
        "p AS (SELECT t.f, t.alpha, y, my + (x - mx) / sx * (t.n * c / sx) / (t.n + alpha) AS p FROM t JOIN d ON d.fold = t.f), "
        "e AS (SELECT f, alpha, avg(abs(y - p)) AS mae, sqrt(avg((y - p) ** 2)) AS rmse, "
        "1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2 FROM p GROUP BY f, alpha) "
    )


@query(
    "cv_ridge",
    f"WITH {_ridge_sql(_FOLDED, 5, [1.0])} "
    "SELECT 'mae' AS metric, round(avg(mae), 4) AS mean, round(stddev_pop(mae), 4) AS std, count(*) AS n_folds FROM e "
    "UNION ALL SELECT 'rmse', round(avg(rmse), 4), round(stddev_pop(rmse), 4), count(*) FROM e "
    "UNION ALL SELECT 'r2', round(avg(r2), 4), round(stddev_pop(r2), 4), count(*) FROM e",
)
def cv_ridge(spark, sf_dir):
    df = priced(spark, sf_dir).select("o_orderkey", "x", "y")
    job = jobs.Job("y", "regression", ["o_orderkey"], model="ridge", params={"alpha": 1.0})
    return rounded_doubles(jobs.run_crossval(df, job, 5, parallelism=5)[1].where("metric IN ('mae', 'rmse', 'r2')"), 4)


# rows in hash order: test, validation, then the training rows in three folds
_TUNED = (
    "(SELECT *, CASE WHEN j <= m // 3 + (m % 3 > 0)::INT THEN 1 WHEN j <= 2 * (m // 3) + (m % 3 > 0)::INT + (m % 3 > 1)::INT THEN 2 ELSE 3 END AS fold "
    "FROM (SELECT *, k - held AS j, n - held AS m FROM (SELECT *, (ceil(0.2 * n) + ceil(0.25 * (n - ceil(0.2 * n))))::BIGINT AS held FROM ("
    "SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', o_orderkey::VARCHAR))) AS k, count(*) OVER () AS n FROM "
    + PRICED_SQL
    + ")) WHERE k > held))"
)


@query(
    "grid_search",
    f"WITH {_ridge_sql(_TUNED, 3, [0.1, 10.0, 1000.0])}, s AS (SELECT alpha, -avg(mae) AS score FROM e GROUP BY alpha) "
    "SELECT (row_number() OVER (ORDER BY score DESC, alpha))::INTEGER AS rank, "
    "'{\"model__alpha\":\"' || alpha::DOUBLE || '\"}' AS params, round(score, 4) AS mean_score, 'grid' AS method FROM s",
)
def grid_search(spark, sf_dir):
    grid = {"model__alpha": [0.1, 10.0, 1000.0]}
    df = priced(spark, sf_dir).select("o_orderkey", "x", "y")
    job = jobs.Job("y", "regression", ["o_orderkey"], model="ridge")
    table_ = jobs.run_tune(df, job, grid, folds=3, parallelism=6)[1]
    return rounded_doubles(table_.select("rank", F.to_json("params").alias("params"), "mean_score", "method"), 4)


@query(
    "random_search",
    "SELECT unnest([1, 2, 3])::INTEGER AS rank, 1.0::DOUBLE AS mean_score, 'random' AS method, 3::BIGINT AS candidates",
)
def random_search(spark, sf_dir):
    """Every drawn candidate solves the step, so all score 1."""
    grid = {"model__max_depth": [2, 3, 4], "model__n_estimators": [3, 5]}
    job = _step_job("big", "random_forest")
    out = jobs.run_tune(stepped(spark, sf_dir, "big"), job, grid, "random", 3, folds=2, parallelism=6)[1]
    drawn = out.agg(F.count_distinct(F.to_json("params")).alias("candidates"))
    return rounded_doubles(out.join(F.broadcast(drawn)).select("rank", "mean_score", "method", "candidates"), 6)


# a series that goes up by one a day it has, so that yesterday's value gives today's
_RISING = "(SELECT date, CAST(row_number() OVER (ORDER BY date) AS DOUBLE) AS y FROM " + DAILY_SQL + ")"


def rising(spark, sf_dir):
    return with_global_rank(daily_revenue(spark, sf_dir).select("date"), ["date"], "y").withColumn("y", F.col("y").cast("double"))


def _rising_job(model):
    return jobs.Job("y", "timeseries", date="date", model=model, n_lags=[1], rolling_windows=[])


@query(
    "cv_timeseries",
    f"SELECT unnest(['mae', 'rmse', 'r2']) AS metric, 3::BIGINT AS n_folds, true AS good FROM (SELECT count(*) AS n FROM {_RISING}) WHERE n > 8",
)
def cv_timeseries(spark, sf_dir):
    found = jobs.run_crossval(rising(spark, sf_dir), _rising_job("linear_regression"), 3, parallelism=3)[1]
    # errors of under ten days where the series goes over thousands
    good = F.when(F.col("metric") == "r2", F.col("mean") > 0.99).otherwise(F.col("mean") < 10)
    return found.where("metric IN ('mae', 'rmse', 'r2')").select("metric", "n_folds", good.alias("good"))


@query(
    "train_forecast",
    f"SELECT strftime(date, '%Y-%m-%d') AS date, y, CASE WHEN i >= n - greatest(1, floor(0.2 * n)) THEN y END AS forecast "
    f"FROM (SELECT *, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM {_RISING} WHERE y > 1)",
)
def train_forecast(spark, sf_dir):
    """The series and its forecast of the last fifth."""
    job = _rising_job("linear_regression")
    result = jobs.run_training(rising(spark, sf_dir), job)
    seen = result.train.select("date", "y", F.lit(None).cast("double").alias("forecast"))
    out = seen.unionByName(result.scored.select("date", "y", F.col("prediction").alias("forecast")))
    return rounded_doubles(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")), 1)


@query(
    "predict_forecast",
    f"SELECT strftime(date, '%Y-%m-%d') AS date, y AS prediction FROM {_RISING} WHERE y > 1",
)
def predict_forecast(spark, sf_dir):
    job = _rising_job("linear_regression")
    df = rising(spark, sf_dir)
    scored = jobs.score_table(jobs.run_training(df, job).model, df, job).select("date", "prediction")
    return rounded_doubles(scored.withColumn("date", F.date_format("date", "yyyy-MM-dd")), 1)


@query(
    "train_with_dates",
    "SELECT o_orderkey, CAST(100 * month(o_orderdate) + 7 * (dayofweek(o_orderdate) IN (0, 6))::INT AS DOUBLE) AS prediction FROM orders",
)
def train_with_dates(spark, sf_dir):
    """Date and holiday features derived inside the saved model; the target follows from two of them."""
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.expr("100.0D * month(o_orderdate) + 7 * CAST(dayofweek(o_orderdate) IN (1, 7) AS INT)").alias("y")
    )
    job = jobs.Job(
        "y", "regression", ["o_orderkey"], datetime_columns=["o_orderdate"], holiday_country="US", model="linear_regression"
    )
    scored = jobs.score_table(jobs.run_training(df, job).model, df, job).select("o_orderkey", "prediction")
    return rounded_doubles(scored, 2)


@query(
    "evaluate_gate_job",
    f"WITH s AS (SELECT * FROM {_SPLIT}), m AS (SELECT regr_slope(y, o_totalprice) AS b, regr_intercept(y, o_totalprice) AS a FROM s WHERE split = 'train'), "
    "t AS (SELECT avg(abs(y - a - b * o_totalprice)) AS mae, 1 - sum((y - a - b * o_totalprice) ** 2) / (var_pop(y) * count(*)) AS r2 FROM s, m WHERE split = 'test') "
    "SELECT 'r2' AS metric, 'min' AS kind, 0.9::DOUBLE AS bound, round(r2, 4) AS value, r2 >= 0.9 AS passed FROM t "
    "UNION ALL SELECT 'mae', 'max', 5000.0, round(mae, 4), mae <= 5000 FROM t",
)
def evaluate_gate_job(spark, sf_dir):
    job = jobs.Job("y", "regression", ["o_orderkey"], model="linear_regression", numeric_columns=["o_totalprice"], categorical_columns=[])
    df = priced(spark, sf_dir).select("o_orderkey", "o_totalprice", "y")
    model = jobs.run_training(df, job).model
    return rounded_doubles(jobs.run_evaluation(df, job, model, {"r2": 0.9}, {"mae": 5000.0})[1], 4)


@query(
    "validate_sizes",
    "SELECT 'test' AS split, ceil(0.2 * count(*))::BIGINT AS n FROM orders UNION ALL "
    "SELECT 'val', ceil(0.25 * (count(*) - ceil(0.2 * count(*))))::BIGINT FROM orders UNION ALL "
    "SELECT 'train', (count(*) - ceil(0.2 * count(*)) - ceil(0.25 * (count(*) - ceil(0.2 * count(*)))))::BIGINT FROM orders",
)
def validate_sizes(spark, sf_dir):
    job = jobs.Job("o_orderstatus", "classification", ["o_orderkey"])
    return jobs.run_validation(priced(spark, sf_dir), job)


# ---------------------------------------------------------------- registry ---


@query(
    "registry_round_trip",
    f"WITH s AS (SELECT * FROM {_SPLIT}), m AS (SELECT regr_slope(y, o_totalprice) AS b, regr_intercept(y, o_totalprice) AS a FROM s WHERE split = 'train') "
    "SELECT o_orderkey, round(a + b * o_totalprice, 3) AS prediction FROM s, m",
)
def registry_round_trip(spark, sf_dir):
    """Train, register, promote, write the input, score it from storage with the promoted model."""
    root = scratch_dir(spark, "registry")
    job = jobs.Job("y", "regression", ["o_orderkey"], model="linear_regression", numeric_columns=["o_totalprice"], categorical_columns=[])
    df = priced(spark, sf_dir).select("o_orderkey", "o_totalprice", "y")
    run_id = jobs.run_training(df, job, root=root).run_id
    registry.promote(spark, root, run_id)
    source = tables.write_table(df, f"{root}/input.parquet")
    target = jobs.run_prediction(spark, job, source, f"{root}/predictions.parquet", root=root)
    return rounded_doubles(tables.read_table(spark, target), 3)


@query(
    "promotion_latest",
    "SELECT c_mktsegment AS name, max_by(c_name, lpad(c_custkey::VARCHAR, 12, '0')) AS run_id FROM customer GROUP BY 1",
)
def promotion_latest(spark, sf_dir):
    """The newest-promotion rule over a table of promotions, here read from the customers."""
    promoted = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("name"), F.col("c_name").alias("run_id"),
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("promoted_at"),
    )
    return registry.latest(promoted)


@query(
    "monitor_job",
    "SELECT 'l_quantity' AS column_name, true AS drifted UNION ALL SELECT unnest(['l_tax', 'l_discount', 'l_extendedprice']), false "
    "FROM (SELECT count(*) FROM lineitem)",
)
def monitor_job(spark, sf_dir):
    """PSI of doubled quantities against the profile stored with the promoted run."""
    root = scratch_dir(spark, "monitor")
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_tax", "l_discount", "l_extendedprice")
    job = jobs.Job("l_extendedprice", "regression", model="linear_regression")
    result = jobs.run_training(li, job, root=root)
    registry.promote(spark, root, result.run_id)
    report = jobs.run_monitor(spark, root, li.withColumn("l_quantity", F.col("l_quantity") * 2))
    return report.select(F.col("column").alias("column_name"), "drifted")


# ----------------------------------------------------------------- storage ---


@query(
    "csv_round_trip",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status, "
    "'a \"quoted\", ' || o_orderpriority AS note, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey END AS custkey, o_orderkey % 2 = 0 AS even FROM orders",
)
def csv_round_trip(spark, sf_dir):
    """Write the orders as csv with missing-value tokens, and read them back with their types."""
    path = scratch_dir(spark, "orders") + ".csv"
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_totalprice",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'N/A' ELSE o_orderstatus END AS status",
        "concat('a \"quoted\", ', o_orderpriority) AS note",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'NaN' ELSE CAST(o_custkey AS STRING) END AS custkey",
        "o_orderkey % 2 = 0 AS even",
    )
    tables.write_table(df, path)
    return tables.read_table(spark, path)


@query("parquet_round_trip", "SELECT * REPLACE (ts::VARCHAR AS ts) FROM events")
def parquet_round_trip(spark, sf_dir):
    path = scratch_dir(spark, "events") + ".parquet"
    tables.write_table(table(spark, sf_dir, "events"), path)
    return tables.read_table(spark, path).withColumn("ts", F.col("ts").cast("string"))


@query(
    "eda_reports",
    "SELECT 'report' AS report, count(*) AS n FROM (DESCRIBE orders) UNION ALL SELECT 'missing_values', count(*) FROM (DESCRIBE orders) "
    "UNION ALL SELECT 'correlation_heatmap', 9 "
    "UNION ALL SELECT 'histograms', 90",
)
def eda_reports(spark, sf_dir):
    """Rows of each report of the profiling job, read back from storage."""
    paths = jobs.run_eda(table(spark, sf_dir, "orders"), scratch_dir(spark, "eda"))
    parts = [
        spark.read.json(p).groupBy().count().select(F.lit(name).alias("report"), F.col("count").alias("n"))
        for name, p in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_REPORTED = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "eda_report_rows",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS missing_count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, max({c})::DOUBLE AS max FROM orders"
        for c in _REPORTED
    ),
)
def eda_report_rows(spark, sf_dir):
    """The numeric part of the profiling job's report, as it was written."""
    paths = jobs.run_eda(table(spark, sf_dir, "orders"), scratch_dir(spark, "eda"))
    number = lambda c, d: F.round(F.col(c).cast("double"), d).alias(c)
    out = spark.read.json(paths["report"]).where(F.col("column").isin(_REPORTED))
    return out.select(F.col("column").alias("name"), "n_rows", "missing_count", number("mean", 4), number("std", 4), number("min", 4), number("p50", 4), number("max", 4))


@query(
    "feature_target_separation",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
)
def feature_target_separation(spark, sf_dir):
    return tables.drop_target(table(spark, sf_dir, "orders").drop("o_orderdate"), "o_totalprice", required=True)

