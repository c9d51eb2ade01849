"""Training over whole tables with every kind of feature: priced orders, the daily series and its calendar, dated orders.

The priced target is linear in all features, so linear models have exact answers; ensembles are held against what a model
that learned nothing would reach.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.evaluation import _psi_sql
from tabforge.catalog.models import PRICED_SQL, priced
from tabforge.catalog.registry import DAILY_SQL, daily_revenue, query, rounded_doubles, table
from tabforge.operators import jobs, metrics, models
from tabforge.session import materialise, scratch_dir
from tabforge.sources import registry

_KINDS = {
    "big": "CASE WHEN y > 5000 THEN 1 ELSE 0 END",
    "band": "CASE WHEN y < 3000 THEN 'low' WHEN y < 5000 THEN 'mid' ELSE 'high' END",
}


def _classed(spark, sf_dir, target):
    return priced(spark, sf_dir).withColumn(target, F.expr(_KINDS[target])).drop("y")


def _job(target, model, **params):
    task = "regression" if target == "y" else "classification"
    return jobs.Job(target, task, ["o_orderkey"], model=model, params=params)


def _beats(result, target):
    """Held-out rows, and whether the model does much better there than the best constant."""
    rows = result.scored.agg(F.count(F.lit(1)).alias("n_test"))
    found = {r.metric: r.value for r in result.metrics.collect()}
    if target == "y":
        return rows.withColumn("learned", F.lit(found["r2"] > 0.8))
    most = result.scored.groupBy(target).count().agg(F.max("count") / F.sum("count")).first()[0]
    # at least half of the constant's errors are gone
    return rows.withColumn("learned", F.lit(1 - found["accuracy"] < 0.5 * (1 - most)))


_LEARNED = "SELECT ceil(0.2 * count(*))::BIGINT AS n_test, true AS learned FROM orders"


def _learn(name, target, model, **params):
    @query(name, _LEARNED)
    def run(spark, sf_dir):
        df = priced(spark, sf_dir) if target == "y" else _classed(spark, sf_dir, target)
        return _beats(jobs.run_training(df, _job(target, model, **params)), target)


_learn("full_random_forest", "y", "random_forest", n_estimators=20, max_depth=8)
_learn("full_random_forest_classes", "big", "random_forest", n_estimators=20, max_depth=8)
_learn("full_gradient_boosting", "big", "gradient_boosting", n_estimators=10)
_learn("full_gradient_boosting_classes", "band", "gradient_boosting", n_estimators=10)
_learn("full_hist_gradient_boosting", "y", "hist_gradient_boosting", max_iter=20)
_learn("full_bagging", "y", "bagging", n_estimators=5, max_depth=8)
_learn("full_logistic_regression", "big", "logistic_regression")


@query(
    "boosting_probabilities",
    f"SELECT band, count(*) AS n, true AS sums_to_one, true AS ranked FROM (SELECT {_KINDS['band']} AS band FROM {PRICED_SQL}) GROUP BY 1",
)
def boosting_probabilities(spark, sf_dir):
    """Chances of three classes from boosting: each row's sum to 1, and the macro one-vs-rest AUC is above 0.9."""
    df, job = _classed(spark, sf_dir, "band"), _job("band", "gradient_boosting", n_estimators=10)
    result = jobs.run_training(df, job)
    names = {c: f"probability_{c}" for c in ("high", "low", "mid")}
    chances = materialise(models.class_probabilities(result.model, df, ["band"]), "chances")
    auc = metrics.roc_auc_one_vs_rest(chances, "band", names).first().value
    whole = F.abs(sum((F.col(n) for n in names.values()), F.lit(0.0)) - 1) < 1e-9
    out = chances.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.every(whole).alias("sums_to_one"))
    return out.withColumn("ranked", F.lit(auc > 0.9))


@query(
    "full_baseline",
    "SELECT 'o_orderstatus_o_totalprice_x' AS features, true AS learned, true AS sums_to_one FROM (SELECT count(*) FROM orders)",
)
def full_baseline(spark, sf_dir):
    """Weighted metrics of the quick forest, and importances of all three features."""
    found, top = jobs.run_baseline(_classed(spark, sf_dir, "big"), jobs.Job("big", "classification", ["o_orderkey"], params={"max_depth": 6}), n_trees=20)
    sources = top.select(F.regexp_extract("feature", "__(x|o_totalprice|o_orderstatus)", 1).alias("f")).distinct()
    names = sources.agg(F.array_join(F.array_sort(F.collect_set("f")), "_").alias("features"))
    accuracy = found.where("metric = 'accuracy'").first().value
    total = top.agg(F.sum("importance")).first()[0]
    return names.withColumn("learned", F.lit(accuracy > 0.8)).withColumn("sums_to_one", F.lit(abs(total - 1) < 1e-6))


@query(
    "full_cv_ridge",
    "SELECT unnest(['mae', 'rmse', 'r2']) AS metric, unnest([0.0, 0.0, 1.0]::DOUBLE[]) AS mean, 5::BIGINT AS n_folds "
    f"FROM (SELECT count(*) FROM {PRICED_SQL})",
)
def full_cv_ridge(spark, sf_dir):
    """Imputed, scaled and one-hot features of every order; a penalty near nothing leaves the exact line."""
    found = jobs.run_crossval(priced(spark, sf_dir), _job("y", "ridge", alpha=1e-9), 5)[1]
    return rounded_doubles(found.where("metric IN ('mae', 'rmse', 'r2')").select("metric", "mean", "n_folds"), 3)


@query(
    "full_grid_search",
    "SELECT unnest([1, 2, 3])::INTEGER AS rank, unnest(['{\"model__alpha\":\"1.0E-9\"}', '{\"model__alpha\":\"10.0\"}', '{\"model__alpha\":\"1000.0\"}']) AS params, "
    f"unnest([true, false, false]) AS exact, 'grid' AS method FROM (SELECT count(*) FROM {PRICED_SQL})",
)
def full_grid_search(spark, sf_dir):
    """The smaller the penalty, the better, as the target is linear."""
    out = jobs.run_tune(priced(spark, sf_dir), _job("y", "ridge"), {"model__alpha": [10.0, 1000.0, 1e-9]}, folds=3)[1]
    shown = F.map_from_entries(F.transform(F.map_entries("params"), lambda e: F.struct(e.key, e.value.cast("double").cast("string"))))
    return out.select("rank", F.to_json(shown).alias("params"), (F.col("mean_score") > -1e-3).alias("exact"), "method")


@query(
    "full_random_search",
    "SELECT 3::BIGINT AS candidates, true AS ordered, true AS deeper_is_better FROM (SELECT count(*) FROM orders)",
)
def full_random_search(spark, sf_dir):
    grid = {"model__max_depth": [1, 8], "model__n_estimators": [3, 5]}
    out = jobs.run_tune(_classed(spark, sf_dir, "big"), _job("big", "random_forest"), grid, "random", 3, folds=2, parallelism=6)[1]
    rows = out.orderBy("rank").collect()
    scores = [r.mean_score for r in rows]
    deep = rows[0].params["model__max_depth"] == "8" and rows[0].mean_score > rows[-1].mean_score
    made = out.agg(F.count(F.lit(1)).alias("candidates"))
    return made.withColumn("ordered", F.lit(scores == sorted(scores, reverse=True))).withColumn("deeper_is_better", F.lit(deep))


# the rows that have 14 days before them, in order; the last fifth of them is forecast
_WARM = (
    f"(SELECT date, y, row_number() OVER (ORDER BY date) - 15 AS i, count(*) OVER () - 14 AS n FROM {DAILY_SQL})"
)


@query(
    "full_cv_timeseries",
    f"SELECT unnest(['mae', 'rmse', 'r2']) AS metric, 3::BIGINT AS n_folds, true AS finite FROM {_WARM} WHERE i = 0",
)
def full_cv_timeseries(spark, sf_dir):
    """The default lags and windows of daily revenue, in growing folds."""
    found = jobs.run_crossval(daily_revenue(spark, sf_dir), jobs.Job("y", "timeseries", date="date", model="ridge"), 3)[1]
    finite = F.col("mean").isNotNull() & (F.abs("mean") < 1e12)
    return found.where("metric IN ('mae', 'rmse', 'r2')").select("metric", "n_folds", finite.alias("finite"))


@query(
    "full_forecast",
    f"SELECT strftime(date, '%Y-%m-%d') AS date, y, i >= n - greatest(1, floor(0.2 * n)) AS forecast, true AS near FROM {_WARM} WHERE i >= 0",
)
def full_forecast(spark, sf_dir):
    """Default lags, windows, US holidays and calendar circles; a forecast lies within the series' range, widened by half."""
    daily = daily_revenue(spark, sf_dir)
    job = jobs.Job("y", "timeseries", date="date", model="ridge", holiday_country="US", cyclical=True)
    result = jobs.run_training(daily, job)
    low, high = daily.agg(F.min("y"), F.max("y")).first()
    near = F.col("prediction").between(low - (high - low) / 2, high + (high - low) / 2)
    out = result.train.select("date", "y", F.lit(False).alias("forecast"), F.lit(True).alias("near"))
    out = out.unionByName(result.scored.select("date", "y", F.lit(True).alias("forecast"), near.alias("near")))
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("full_dates", "SELECT o_orderkey, true AS near FROM orders")
def full_dates(spark, sf_dir):
    """Date parts, circles, holidays and a text column in one saved model; the target, which goes up to 1257, follows from three."""
    y = (
        "100.0D * month(o_orderdate) + 7 * CAST(dayofweek(o_orderdate) IN (1, 7) AS INT) "
        "+ CASE o_orderstatus WHEN 'F' THEN 50 WHEN 'O' THEN 20 ELSE 0 END"
    )
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", F.expr(y).alias("y"))
    job = jobs.Job(
        "y", "regression", ["o_orderkey"], datetime_columns=["o_orderdate"], cyclical=True, holiday_country="US", model="linear_regression"
    )
    scored = jobs.score_table(jobs.run_training(df, job).model, df, job).select(F.col("o_orderkey").alias("key"), "prediction")
    joined = df.join(scored, F.col("o_orderkey") == F.col("key"))
    return joined.select("o_orderkey", (F.abs(F.col("y") - F.col("prediction")) < 5).alias("near"))


_SIDE = (
    "(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', l_orderkey::VARCHAR, l_linenumber::VARCHAR))) > "
    "ceil(0.2 * count(*) OVER ()) AS train FROM lineitem) WHERE train)"
)
_LIVE = "(SELECT l_quantity * 2 AS l_quantity, l_tax, l_discount FROM lineitem)"


@query("monitor_psi", "\nUNION ALL ".join("SELECT * FROM " + _psi_sql(c, _SIDE, _LIVE) for c in ("l_quantity", "l_tax", "l_discount")))
def monitor_psi(spark, sf_dir):
    """PSI of a live batch against the profile of the promoted run's training rows."""
    root = scratch_dir(spark, "monitor")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_extendedprice")
    job = jobs.Job("l_extendedprice", "regression", ["l_orderkey", "l_linenumber"], model="linear_regression")
    registry.promote(spark, root, jobs.run_training(li, job, root=root).run_id)
    live = li.withColumn("l_quantity", F.col("l_quantity") * 2).select("l_quantity", "l_tax", "l_discount")
    return rounded_doubles(jobs.run_monitor(spark, root, live))
