"""Metric, gate, drift and chart-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.registry import (
    DAILY_SQL,
    INJECTED_SQL,
    LINEITEM_NUMERIC,
    PREDICTED_SQL,
    daily_revenue,
    injected,
    predicted,
    query,
    rounded_doubles,
    table,
    union_sql,
)
from tabforge.operators import bivariate, chartdata, drift, lags, metrics, splits

_BINARY = (
    "SELECT {k} sum((pred = y)::INT)::DOUBLE / count(*) AS accuracy, "
    "sum(pred * y)::DOUBLE / sum(pred) AS precision, sum(pred * y)::DOUBLE / sum(y) AS recall, "
    "2.0 * sum(pred * y) / (sum(pred) + sum(y)) AS f1 FROM " + PREDICTED_SQL + " {g}"
)
_AUC = (
    "(SELECT sum(pos * below) / (sum(pos)::DOUBLE * sum(neg)) FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg / 2.0::DOUBLE AS below "
    "FROM (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM " + PREDICTED_SQL + " {w} GROUP BY p)))"
)


def _long(names, source: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return "\nUNION ALL\n".join(f"SELECT {lead}'{m}' AS metric, round({m}, 6) AS value FROM ({source})" for m in names)


_CLS = ["accuracy", "precision", "recall", "f1"]


@query(
    "cls_metrics",
    _long(_CLS, _BINARY.replace("{k}", "").replace("{g}", ""))
    + f"\nUNION ALL SELECT 'roc_auc', round({_AUC.replace('{w}', '')}, 6)",
)
def cls_metrics(spark, sf_dir):
    return rounded_doubles(metrics.classification_metrics(predicted(spark, sf_dir), "y", "pred", "p"))


@query(
    "cls_metrics_by_slice",
    _long(_CLS, _BINARY.replace("{k}", "l_linestatus,").replace("{g}", "GROUP BY l_linestatus"), "l_linestatus")
    + "".join(
        f"\nUNION ALL SELECT '{s}', 'roc_auc', round({_AUC.replace('{w}', chr(10) + f'WHERE l_linestatus = {chr(39)}{s}{chr(39)}')}, 6)"
        for s in ("F", "O")
    ),
)
def cls_metrics_by_slice(spark, sf_dir):
    return rounded_doubles(
        metrics.classification_metrics(predicted(spark, sf_dir), "y", "pred", "p", by=["l_linestatus"])
    )


_MULTI = (
    "WITH t AS (SELECT l_returnflag AS y, flag_pred AS p FROM " + PREDICTED_SQL + "), "
    "l AS (SELECT DISTINCT y AS c FROM t UNION SELECT DISTINCT p FROM t), "
    "k AS (SELECT c, (SELECT count(*) FROM t WHERE y = c) AS support, (SELECT count(*) FROM t WHERE p = c) AS said, "
    "(SELECT count(*) FROM t WHERE y = c AND p = c) AS tp FROM l), "
    "m AS (SELECT *, CASE WHEN said > 0 THEN tp::DOUBLE / said ELSE 0 END AS pr, CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS re, "
    "CASE WHEN said + support > 0 THEN 2.0 * tp / (said + support) ELSE 0 END AS f FROM k) "
    "SELECT 'accuracy' AS metric, round(sum(tp)::DOUBLE / sum(support), 6) AS value FROM m "
    "UNION ALL SELECT 'precision', round(sum(pr * support) / sum(support), 6) FROM m "
    "UNION ALL SELECT 'recall', round(sum(re * support) / sum(support), 6) FROM m "
    "UNION ALL SELECT 'f1', round(sum(f * support) / sum(support), 6) FROM m"
)


@query("cls_metrics_multiclass", _MULTI)
def cls_metrics_multiclass(spark, sf_dir):
    return rounded_doubles(
        metrics.classification_metrics(predicted(spark, sf_dir), "l_returnflag", "flag_pred")
    )


@query("roc_auc", f"SELECT round({_AUC.replace('{w}', '')}, 6) AS roc_auc")
def roc_auc(spark, sf_dir):
    return rounded_doubles(metrics.roc_auc(predicted(spark, sf_dir), "y", "p"))


_OVR_ONE = (
    "(SELECT sum(pos * below) / (sum(pos)::DOUBLE * sum(neg)) FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg / 2.0::DOUBLE AS below "
    "FROM (SELECT {s} AS s, count(*) FILTER (WHERE l_returnflag = '{c}') AS pos, count(*) FILTER (WHERE l_returnflag <> '{c}') AS neg "
    "FROM lineitem GROUP BY 1)))"
)


@query(
    "roc_auc_one_vs_rest",
    "SELECT 'roc_auc_ovr' AS metric, round(("
    + " + ".join(
        _OVR_ONE.replace("{c}", c).replace("{s}", s)
        for c, s in (("A", "l_discount"), ("N", "l_tax"), ("R", "l_quantity"))
    )
    + ") / 3, 6) AS value",
)
def roc_auc_one_vs_rest(spark, sf_dir):
    scores = {"A": "l_discount", "N": "l_tax", "R": "l_quantity"}
    return rounded_doubles(metrics.roc_auc_one_vs_rest(table(spark, sf_dir, "lineitem"), "l_returnflag", scores))


_REG = ["mae", "rmse", "r2", "mape", "smape"]
_REG_SQL = (
    "SELECT {k} avg(abs(t - p)) AS mae, sqrt(avg((t - p) * (t - p))) AS rmse, "
    "1 - sum((t - p) * (t - p)) / (var_pop(t) * count(*)) AS r2, avg(CASE WHEN t <> 0 THEN abs((t - p) / t) END) * 100 AS mape, "
    "avg(CASE WHEN abs(t) + abs(p) <> 0 THEN 2 * abs(t - p) / (abs(t) + abs(p)) END) * 100 AS smape "
    "FROM (SELECT *, l_extendedprice AS t, price_pred AS p FROM (SELECT * EXCLUDE (p) FROM " + PREDICTED_SQL + ")) {g}"
)


@query("reg_metrics", _long(_REG, _REG_SQL.replace("{k}", "").replace("{g}", "")).replace(", 6) AS value", ", 4) AS value"))
def reg_metrics(spark, sf_dir):
    return rounded_doubles(metrics.regression_metrics(predicted(spark, sf_dir), "l_extendedprice", "price_pred"), 4)


@query(
    "metrics_by_slice",
    _long(_REG, _REG_SQL.replace("{k}", "l_linestatus, l_returnflag,").replace("{g}", "GROUP BY l_linestatus, l_returnflag"), "l_linestatus, l_returnflag").replace(
        ", 6) AS value", ", 4) AS value"
    ),
)
def metrics_by_slice(spark, sf_dir):
    out = metrics.regression_metrics(
        predicted(spark, sf_dir), "l_extendedprice", "price_pred", ["l_linestatus", "l_returnflag"]
    )
    return rounded_doubles(out, 4)


@query(
    "eval_gate",
    "WITH m AS (" + _REG_SQL.replace("{k}", "").replace("{g}", "") + ") "
    "SELECT 'r2' AS metric, 'min' AS kind, -5.0::DOUBLE AS bound, round(r2, 4) AS value, r2 >= -5 AS passed FROM m "
    "UNION ALL SELECT 'mae', 'max', 1000.0, round(mae, 4), mae <= 1000 FROM m "
    "UNION ALL SELECT 'smape', 'max', 90.0, round(smape, 4), smape <= 90 FROM m "
    "UNION ALL SELECT 'roc_auc', 'min', 0.5, NULL, false",
)
def eval_gate(spark, sf_dir):
    found = metrics.regression_metrics(predicted(spark, sf_dir), "l_extendedprice", "price_pred")
    gate = metrics.evaluate_gate(found, {"r2": -5.0, "roc_auc": 0.5}, {"mae": 1000.0, "smape": 90.0})
    return rounded_doubles(gate, 4)


@query(
    "compare_runs",
    "WITH a AS (" + _REG_SQL.replace("{k}", "").replace("{g}", "WHERE l_linestatus = 'F'") + "), "
    "b AS (" + _REG_SQL.replace("{k}", "").replace("{g}", "WHERE l_linestatus = 'O'") + ") "
    + "UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(a.{m}, 4) AS current, round(b.{m}, 4) AS candidate, "
        f"{'b.r2 >= a.r2' if m == 'r2' else f'b.{m} <= a.{m}'} AS better FROM a, b "
        for m in _REG
    ),
)
def compare_runs(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    sides = [
        metrics.regression_metrics(rows.where(F.col("l_linestatus") == s), "l_extendedprice", "price_pred")
        for s in ("F", "O")
    ]
    return rounded_doubles(metrics.compare_metrics(*sides), 4)


@query(
    "confusion",
    "WITH t AS (SELECT l_returnflag AS a, flag_pred AS p FROM " + PREDICTED_SQL + "), l AS (SELECT DISTINCT a AS v FROM t UNION SELECT DISTINCT p FROM t) "
    "SELECT x.v AS actual, z.v AS predicted, (SELECT count(*) FROM t WHERE t.a = x.v AND t.p = z.v) AS n FROM l x, l z",
)
def confusion(spark, sf_dir):
    return chartdata.confusion_matrix(predicted(spark, sf_dir), "l_returnflag", "flag_pred", zeros=True)


@query(
    "confusion_many_labels",
    "SELECT l_partkey AS actual, l_partkey + l_linenumber % 3 AS predicted, count(*) AS n FROM lineitem GROUP BY ALL",
)
def confusion_many_labels(spark, sf_dir):
    """As many labels as parts: only the cells that have rows."""
    df = table(spark, sf_dir, "lineitem").selectExpr("l_partkey", "l_partkey + l_linenumber % 3 AS guess")
    return chartdata.confusion_matrix(df, "l_partkey", "guess")


_RESIDUAL = "(SELECT l_extendedprice - price_pred AS r FROM " + PREDICTED_SQL + ")"


@query(
    "residual_summary",
    "SELECT count(r) AS n, round(sqrt(avg(r * r)), 4) AS rmse, round(avg(r), 4) AS mean, round(min(r), 4) AS min, "
    "round(quantile_cont(r, 0.25), 4) AS p25, round(quantile_cont(r, 0.5), 4) AS p50, round(quantile_cont(r, 0.75), 4) AS p75, round(max(r), 4) AS max "
    f"FROM {_RESIDUAL}",
)
def residual_summary(spark, sf_dir):
    return rounded_doubles(metrics.residual_summary(predicted(spark, sf_dir), "l_extendedprice", "price_pred"), 4)


def _hist_sql(source: str, c: str, bins: int, lead: str = "", digits: int = 6) -> str:
    return (
        f"(WITH x AS (SELECT CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL), "
        "e AS (SELECT min(v) AS lo, max(v) AS hi FROM x), "
        f"r AS (SELECT v, lo, (hi - lo) / {bins} AS w, least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS raw FROM x, e), "
        f"b AS (SELECT lo, w, (raw - (v < lo + raw * w)::INT + (v >= lo + (raw + 1) * w AND raw < {bins - 1})::INT)::INT AS bin FROM r) "
        f"SELECT {lead} bin, round(lo + bin * w, {digits}) AS lo, round(lo + (bin + 1) * w, {digits}) AS hi, count(*) AS n FROM b GROUP BY bin, lo, w)"
    )


@query(
    "residual_hist",
    "SELECT * FROM " + _hist_sql(_RESIDUAL, "r", 30, "'residual' AS \"column\",", 4),
)
def residual_hist(spark, sf_dir):
    rows = metrics.with_residual(predicted(spark, sf_dir), "l_extendedprice", "price_pred").select("residual")
    return rounded_doubles(chartdata.histograms(rows), 4)


@query(
    "prediction_hist",
    "SELECT * FROM " + _hist_sql(PREDICTED_SQL, "price_pred", 20, "'price_pred' AS \"column\",", 4),
)
def prediction_hist(spark, sf_dir):
    return rounded_doubles(chartdata.histograms(predicted(spark, sf_dir).select("price_pred"), bins=20), 4)


@query(
    "calibration",
    "SELECT least(floor(p * 10), 9)::INT AS bin, count(*) AS n, round(avg(p), 6) AS mean_score, round(avg(y), 6) AS observed_rate "
    f"FROM {PREDICTED_SQL} GROUP BY 1",
)
def calibration(spark, sf_dir):
    return rounded_doubles(metrics.calibration_bins(predicted(spark, sf_dir), "y", "p"))


# ------------------------------------------------------------------- drift ---

_EARLY = "(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')"
_LATE = (
    "(SELECT * REPLACE (l_quantity * 1.5 AS l_quantity, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END AS l_tax, "
    "CASE WHEN l_linenumber = 1 THEN 'A' ELSE l_returnflag END AS l_returnflag) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')"
)


def _early(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_shipdate < TIMESTAMP_NTZ '1998-01-01'")


def _late(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_shipdate >= TIMESTAMP_NTZ '1998-01-01'")
        .withColumns(
            {
                "l_quantity": F.col("l_quantity") * 1.5,
                "l_tax": F.expr("CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END"),
                "l_returnflag": F.expr("CASE WHEN l_linenumber = 1 THEN 'A' ELSE l_returnflag END"),
            }
        )
    )


def _psi_sql(c: str, early: str = _EARLY, late: str = _LATE, digits: int = 6) -> str:
    def side(source: str) -> str:
        return (
            f"(SELECT len(list_filter(q.edges, lambda v: v <= CAST(s.{c} AS DOUBLE))) AS bin, count(*) AS n "
            f"FROM {source} s, q WHERE s.{c} IS NOT NULL GROUP BY 1)"
        )

    return (
        f"(WITH q AS (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM {early}), "
        f"e AS {side(early)}, a AS {side(late)}, b AS (SELECT unnest(range(10)) AS bin), "
        "s AS (SELECT coalesce(e.n, 0) / (SELECT sum(n) FROM e)::DOUBLE + 1e-6 AS ep, coalesce(a.n, 0) / (SELECT sum(n) FROM a)::DOUBLE + 1e-6 AS ap "
        "FROM b LEFT JOIN e ON b.bin = e.bin LEFT JOIN a ON b.bin = a.bin) "
        f"SELECT '{c}' AS \"column\", round(sum((ap - ep) * ln(ap / ep)), {digits}) AS psi, sum((ap - ep) * ln(ap / ep)) > 0.25 AS drifted FROM s)"
    )


@query("drift_report", "\nUNION ALL ".join("SELECT * FROM " + _psi_sql(c) for c in LINEITEM_NUMERIC))
def drift_report(spark, sf_dir):
    profile = drift.drift_profile(_early(spark, sf_dir))
    return rounded_doubles(drift.check_drift(profile, _late(spark, sf_dir)))


@query("psi_quantity_shift", "SELECT * FROM " + _psi_sql("l_quantity"))
def psi_quantity_shift(spark, sf_dir):
    profile = drift.drift_profile(_early(spark, sf_dir), ["l_quantity"])
    return rounded_doubles(drift.check_drift(profile, _late(spark, sf_dir), columns=["l_quantity"]))


@query(
    "drift_summary",
    "SELECT max(psi) AS max_psi, bool_or(drifted) AS drifted FROM ("
    + "\nUNION ALL ".join("SELECT * FROM " + _psi_sql(c) for c in LINEITEM_NUMERIC)
    + ")",
)
def drift_summary(spark, sf_dir):
    profile = drift.drift_profile(_early(spark, sf_dir))
    return rounded_doubles(drift.drift_summary(drift.check_drift(profile, _late(spark, sf_dir))))


@query(
    "prediction_drift",
    "SELECT \"column\", psi FROM "
    + _psi_sql("pp", f"(SELECT l_quantity * 2100 AS pp FROM {_EARLY})", f"(SELECT l_quantity * 2100 AS pp FROM {_LATE})"),
)
def prediction_drift(spark, sf_dir):
    sides = [f(spark, sf_dir).selectExpr("l_quantity * 2100 AS pp") for f in (_early, _late)]
    return rounded_doubles(drift.prediction_drift(*sides, prediction="pp"))


@query(
    "class_psi",
    f"WITH e AS (SELECT l_returnflag AS v, count(*)::DOUBLE / (SELECT count(*) FROM {_EARLY}) AS s FROM {_EARLY} GROUP BY 1), "
    f"a AS (SELECT l_returnflag AS v, count(*)::DOUBLE / (SELECT count(*) FROM {_LATE}) AS s FROM {_LATE} GROUP BY 1) "
    "SELECT 'l_returnflag' AS \"column\", round(sum((coalesce(a.s, 0) - coalesce(e.s, 0)) * ln((coalesce(a.s, 0) + 1e-6) / (coalesce(e.s, 0) + 1e-6))), 6) AS psi "
    "FROM e FULL JOIN a ON e.v = a.v",
)
def class_psi(spark, sf_dir):
    return rounded_doubles(drift.class_psi(_early(spark, sf_dir), _late(spark, sf_dir), "l_returnflag"))


@query(
    "ks_two_sample",
    union_sql(
        LINEITEM_NUMERIC,
        "SELECT '{c}' AS \"column\", round(max(abs(fr - fn)), 6) AS ks FROM (SELECT sum(r) OVER (ORDER BY v) / sum(r) OVER () AS fr, "
        "sum(n) OVER (ORDER BY v) / sum(n) OVER () AS fn FROM (SELECT v, sum(r)::DOUBLE AS r, sum(n)::DOUBLE AS n FROM ("
        "SELECT CAST({c} AS DOUBLE) AS v, 1 AS r, 0 AS n FROM " + _EARLY + " WHERE {c} IS NOT NULL UNION ALL "
        "SELECT CAST({c} AS DOUBLE), 0, 1 FROM " + _LATE + " WHERE {c} IS NOT NULL) GROUP BY v))",
    ),
)
def ks_two_sample(spark, sf_dir):
    return rounded_doubles(drift.ks_two_sample(_early(spark, sf_dir), _late(spark, sf_dir)))


# ------------------------------------------------------------------ charts ---


@query(
    "missing_shares",
    union_sql(
        [*LINEITEM_NUMERIC, "l_returnflag", "l_linestatus", "l_shipdate"],
        "SELECT '{c}' AS \"column\", round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS pct_missing FROM " + INJECTED_SQL,
    ),
)
def missing_shares(spark, sf_dir):
    return rounded_doubles(chartdata.missing_shares(injected(spark, sf_dir)))


@query(
    "histograms",
    "\nUNION ALL ".join("SELECT * FROM " + _hist_sql(INJECTED_SQL, c, 30, f"'{c}' AS \"column\",") for c in LINEITEM_NUMERIC),
)
def histograms(spark, sf_dir):
    return rounded_doubles(chartdata.histograms(injected(spark, sf_dir)))


def _auto_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (
        f"(WITH s AS (SELECT {x} AS x FROM {INJECTED_SQL} WHERE {c} IS NOT NULL), r AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, "
        "quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM s), "
        "b AS (SELECT *, ceil((hi - lo) / CASE WHEN iqr > 0 THEN least(2 * iqr / n ** (1 / 3.0::DOUBLE), (hi - lo) / (log2(n) + 1)) "
        "ELSE (hi - lo) / (log2(n) + 1) END) AS k FROM r) "
        f"SELECT '{c}' AS \"column\", max(k)::BIGINT AS bins, sum(m)::BIGINT AS n, max(m) AS most, count(*) AS filled FROM ("
        "SELECT k, least(floor((x - lo) / (hi - lo) * k), k - 1) AS bin, count(*) AS m FROM s, b GROUP BY ALL))"
    )


_AUTO = ["l_orderkey", "l_extendedprice", "l_suppkey"]


@query("histogram_auto_bins", "\nUNION ALL ".join("SELECT * FROM " + _auto_sql(c) for c in _AUTO))
def histogram_auto_bins(spark, sf_dir):
    """The number of bins, the rows in all and in the fullest bin, and the bins that hold rows."""
    out = chartdata.histograms(injected(spark, sf_dir).select(*_AUTO), bins="auto")
    span = out.groupBy("column").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.count(F.lit(1)).alias("filled"),
        F.first(F.col("hi") - F.col("lo")).alias("w"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    return span.select("column", F.round((F.col("hi") - F.col("lo")) / F.col("w")).cast("long").alias("bins"), "n", "most", "filled")


@query(
    "corr_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + (f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)" if a != b else "any_value(1.0::DOUBLE)")
        + f" AS r FROM {INJECTED_SQL}"
        for a in LINEITEM_NUMERIC
        for b in LINEITEM_NUMERIC
    ),
)
def corr_matrix(spark, sf_dir):
    return rounded_doubles(bivariate.correlation_matrix(injected(spark, sf_dir)))


@query(
    "boxplot_stats",
    union_sql(
        LINEITEM_NUMERIC[4:8],
        "SELECT '{c}' AS \"column\", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, "
        "round(least(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)), q1), 6) AS whisker_low, "
        "round(greatest(max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high, "
        "count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers "
        "FROM (SELECT {c}::DOUBLE AS x FROM " + INJECTED_SQL + "), (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS q2, "
        "quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM " + INJECTED_SQL + ") GROUP BY q1, q2, q3",
    )
    + " UNION ALL SELECT 'value', round(q1, 6), round(q2, 6), round(q3, 6), "
    "round(least(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)), q1), 6), round(greatest(max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)), q3), 6), "
    "count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) "
    "FROM (SELECT value AS x FROM events), (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events) GROUP BY q1, q2, q3",
)
def boxplot_stats(spark, sf_dir):
    li = chartdata.boxplot_stats(injected(spark, sf_dir), exclude=LINEITEM_NUMERIC[:4])
    events = chartdata.boxplot_stats(table(spark, sf_dir, "events").select("value"))
    return rounded_doubles(li.unionByName(events))


_SCORED = (
    "(SELECT s AS threshold, sum(neg) OVER w / (sum(neg) OVER ())::DOUBLE AS fpr, sum(pos) OVER w / (sum(pos) OVER ())::DOUBLE AS tpr, "
    "lag(pos) OVER (ORDER BY s) AS lpos, lag(neg) OVER (ORDER BY s) AS lneg, lead(pos) OVER (ORDER BY s) AS upos, pos, neg "
    "FROM (SELECT {s} AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS pos, count(*) FILTER (WHERE l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1) "
    "WINDOW w AS (ORDER BY s DESC))"
)


@query(
    "roc_points",
    "SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL SELECT threshold, round(fpr, 6), round(tpr, 6) FROM "
    + _SCORED.replace("{s}", "l_extendedprice")
    + " WHERE lpos IS NULL OR upos IS NULL OR lpos <> pos OR lneg <> neg",
)
def roc_points(spark, sf_dir):
    out = chartdata.roc_points(predicted(spark, sf_dir), "y", "l_extendedprice")
    return rounded_doubles(out)


def _grid_sql(x: str, y: str, source: str, bins: int) -> str:
    def b(v, lo, hi):
        w = f"(({hi} - {lo}) / {bins})"
        raw = f"least(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}), {bins - 1})"
        return f"({raw} - ({v} < {lo} + {raw} * {w})::INT + ({v} >= {lo} + ({raw} + 1) * {w} AND {raw} < {bins - 1})::INT)::INT"

    return (
        f"WITH t AS (SELECT {x} AS xv, {y} AS yv FROM {source}), e AS (SELECT min(xv) AS xl, max(xv) AS xh, min(yv) AS yl, max(yv) AS yh FROM t), "
        f"g AS (SELECT {b('xv', 'xl', 'xh')} AS x_bin, {b('yv', 'yl', 'yh')} AS y_bin FROM t, e) "
        f"SELECT x_bin, y_bin, round(xl + x_bin * ((xh - xl) / {bins}), 4) AS x_lo, round(yl + y_bin * ((yh - yl) / {bins}), 4) AS y_lo, count(*) AS n "
        "FROM g, e GROUP BY x_bin, y_bin, xl, xh, yl, yh"
    )


@query("pred_vs_actual", _grid_sql("l_extendedprice", "price_pred", PREDICTED_SQL, 20))
def pred_vs_actual(spark, sf_dir):
    out = chartdata.predicted_vs_actual(predicted(spark, sf_dir), "l_extendedprice", "price_pred", 20)
    return rounded_doubles(out, 4)


@query("residuals_vs_predicted", _grid_sql("price_pred", "price_pred - l_extendedprice", PREDICTED_SQL, 20))
def residuals_vs_predicted(spark, sf_dir):
    out = chartdata.residuals_vs_predicted(predicted(spark, sf_dir), "l_extendedprice", "price_pred", 20)
    return rounded_doubles(out, 4)


@query(
    "identity_range",
    "SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem",
)
def identity_range(spark, sf_dir):
    return chartdata.identity_range(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(
    "target_distribution_flag",
    f"SELECT l_returnflag AS label, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS share FROM {INJECTED_SQL} GROUP BY 1",
)
def target_distribution_flag(spark, sf_dir):
    return rounded_doubles(chartdata.target_distribution(injected(spark, sf_dir), "l_returnflag", "classification"))


@query(
    "target_distribution_price",
    "SELECT * FROM " + _hist_sql("orders", "o_totalprice", 50, "'o_totalprice' AS \"column\",", 4),
)
def target_distribution_price(spark, sf_dir):
    return rounded_doubles(chartdata.target_distribution(table(spark, sf_dir, "orders"), "o_totalprice", "regression"), 4)


@query(
    "forecast_series",
    "SELECT date::VARCHAR AS date, y AS actual, CASE WHEN k > cut THEN l7 END AS predicted, CASE WHEN k > cut THEN 'test' ELSE 'train' END AS split FROM ("
    "SELECT date, y, l7, k, n - greatest(1, n * 2 // 10) AS cut FROM (SELECT date, y, lag(y, 7) OVER (ORDER BY date) AS l7, "
    f"row_number() OVER (ORDER BY date) - 7 AS k, count(*) OVER () - 7 AS n FROM {DAILY_SQL}) WHERE k > 0)",
)
def forecast_series(spark, sf_dir):
    featured = lags.add_lag_features(daily_revenue(spark, sf_dir), "y", "date", [7], [], date_parts=False)
    labelled = splits.split_last(featured, ["date"])
    train = labelled.where("split = 'train'")
    test = labelled.where("split = 'test'").withColumn("prediction", F.col("lag_7"))
    out = chartdata.forecast_series(train, test, "date", "y")
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "target_over_time",
    "SELECT date_trunc('month', o_orderdate)::DATE AS period, round(avg(o_totalprice), 4) AS mean, round(sum(o_totalprice), 2) AS total, "
    "count(o_totalprice) AS n FROM orders GROUP BY 1",
)
def target_over_time(spark, sf_dir):
    out = chartdata.target_over_time(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "month")
    return rounded_doubles(out, 4, total=2)
