"""Classification and regression metrics, the release gate, and error distributions.

Classification metrics start from one confusion aggregate of O(classes^2) rows; ranking metrics
from one row per distinct score, summed in score order bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col, field_type, nan_to_null
from tabforge.plans.ordering import TASK_ROWS, running_totals, with_global_rank, with_previous
from tabforge.plans.quantiles import exact_quantiles
from tabforge.session import materialise


def confusion_counts(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., actual, predicted, n`` with the prediction cast to the target's type.

    A fraction is no prediction of a whole-numbered class, so it is an error and not rounded to one.
    """
    dtype = field_type(df, y)
    fractions = (T.FloatType, T.DoubleType, T.DecimalType)
    guess = col(pred).cast(dtype)
    if isinstance(dtype, T.IntegralType) and isinstance(field_type(df, pred), fractions):
        whole = col(pred).isNull() | F.isnan(col(pred).cast("double")) | (col(pred) == F.floor(col(pred)))
        guess = F.when(whole, guess).otherwise(F.raise_error(F.lit(f"{pred} holds fractions, but {y} whole classes")))
    return (
        df.select(*[col(b) for b in by], col(y).alias("actual"), guess.alias("predicted"))
        .where("actual IS NOT NULL AND predicted IS NOT NULL")
        .groupBy(*[col(b) for b in by], "actual", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(df: DataFrame, y: str, pred: str, zeros: bool = False) -> DataFrame:
    """Cells ``actual, predicted, n``, sorted; with ``zeros`` also those of all pairs of labels that no row has.

    Without them there are no more cells than rows, however many labels.
    """
    counts = confusion_counts(df, y, pred)
    if zeros:
        labels = counts.select("actual").union(counts.select("predicted")).distinct()
        counts = with_zero_cells(counts, "actual", "predicted", labels.withColumnRenamed("actual", "label"))
    return counts.orderBy("actual", "predicted")


def with_zero_cells(counts: DataFrame, row: str, column: str, labels: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``row, column, n`` for every one of ``labels`` (column ``label``) in each of ``rows`` (one column; the labels by default).

    Labels are numbered, and each row label asks for all the numbers, so that the cells are dealt out by number.
    """
    numbered = materialise(with_global_rank(labels, ["label"], "__number"), "labels")
    last = numbered.agg(F.max("__number")).first()[0]
    if last is None:
        return counts
    rows = (numbered.select("label") if rows is None else rows).toDF(row)
    cells = rows.withColumn("__number", F.explode(F.sequence(F.lit(1), F.lit(last).cast("long"))))
    cells = cells.join(numbered.withColumnRenamed("label", column), "__number")
    return cells.join(counts, [row, column], "left").select(row, column, F.coalesce("n", F.lit(0)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def classification_metrics(
    df: DataFrame,
    y: str,
    pred: str,
    score: str | None = None,
    positive: object | None = None,
    by: Sequence[str] = (),
    average: str | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Long rows ``(by..., metric, value)``: accuracy, precision, recall, f1, and roc_auc with a score.

    Up to two labels among targets and predictions: values of the positive label, which is 1 or
    else the greatest label. More: the mean over labels weighted by support (``average="weighted"``
    forces it). A zero denominator gives 0. ``roc_auc`` is left out when it is undefined.
    """
    df = nan_to_null(df)
    keys = [col(b) for b in by]
    counts = confusion_counts(df, y, pred, by)
    hit = F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), zero.alias("said"), hit.cast("long").alias("tp")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"), F.col("n").alias("said"), zero.alias("tp")),
    )
    labels = (
        counts.select(*keys, F.explode(sides).alias("s"))
        .select(*keys, "s.*")
        .groupBy(*keys, "label")
        .agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
    )
    parts = {
        "precision": _ratio(F.col("tp"), F.col("said")),
        "recall": _ratio(F.col("tp"), F.col("support")),
        "f1": _ratio(2 * F.col("tp"), F.col("support") + F.col("said")),
    }
    binary = F.count(F.lit(1)) <= 2 if average is None else F.lit(average == "binary")

    def combined(v: Column) -> Column:
        if positive is not None:
            # a positive label that never occurs has nothing to divide by
            one = F.coalesce(F.max(F.when(F.col("label") == F.lit(positive), v)), F.lit(0.0))
        else:
            one = F.max_by(v, F.col("label"))
            if isinstance(field_type(df, y), (T.NumericType, T.BooleanType)):
                # a lone 0 label is not the positive one
                one = F.when(F.max(F.col("label").cast("double")) == 0, 0.0).otherwise(one)
        weighted = F.sum(v * F.col("support")) / F.sum("support")
        return F.when(binary, one).otherwise(weighted)

    wide = labels.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), *[combined(v).alias(k) for k, v in parts.items()]
    )
    out = wide.unpivot([*keys], ["accuracy", *parts], "metric", "value")
    if score is not None:
        auc = roc_auc(df, y, score, positive, by, task_rows).where("roc_auc IS NOT NULL")
        out = out.unionByName(auc.select(*keys, F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")))
    return out


def is_positive(df: DataFrame, y: str, positive: object | None) -> Column:
    if positive is not None:
        return col(y) == F.lit(positive)
    if isinstance(field_type(df, y), (T.NumericType, T.BooleanType)):
        return col(y).cast("double") == 1
    return col(y) == F.lit(df.agg(F.max(col(y))).first()[0])


def _by_score(df: DataFrame, y: str, score: str, positive: object | None, by: Sequence[str] = ()) -> DataFrame:
    """``by..., score, pos, neg``: one row per distinct score."""
    hit = is_positive(df, y, positive)
    return (
        df.where(col(y).isNotNull() & col(score).isNotNull())
        .groupBy(*[col(b) for b in by], col(score).cast("double").alias("score"))
        .agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    )


def _at_most_two(df: DataFrame, y: str) -> bool:
    """Whether a column has at most two labels: those strictly between the least and the greatest say no."""
    low, high = df.agg(F.min(col(y)), F.max(col(y))).first()
    if low is None or low == high:
        return True
    return df.where((col(y) != F.lit(low)) & (col(y) != F.lit(high))).isEmpty()


def _about_distinct(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> int:
    """A safe estimate of the number of distinct scores (per group), to size the buckets."""
    key = F.struct(*[col(b) for b in by], col(score).cast("double")) if by else col(score).cast("double")
    return int(1.2 * df.where(col(y).isNotNull()).agg(F.approx_count_distinct(F.xxhash64(key) if by else key)).first()[0]) + 1


def roc_auc(
    df: DataFrame,
    y: str,
    score: str,
    positive: object | None = None,
    by: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL with only one class present.

    For a binary target. More than two distinct labels give no rows.
    """
    df = nan_to_null(df)
    if positive is None and not _at_most_two(df, y):
        fields = [*[df.schema[b] for b in by], T.StructField("roc_auc", T.DoubleType())]
        return df.sparkSession.createDataFrame([], T.StructType(fields))
    scored = _by_score(df, y, score, positive, by)
    n = _about_distinct(df, y, score, by)
    summed = running_totals(scored, "score", ["neg"], by, n_rows=n, task_rows=task_rows)
    below = (F.col("upto_neg") - F.col("neg") / 2.0) * F.col("pos")
    area = F.try_divide(F.sum(below), F.sum("pos").cast("double") * F.sum("neg"))
    return summed.groupBy(*[col(b) for b in by]).agg(area.alias("roc_auc"))


def roc_auc_one_vs_rest(
    df: DataFrame, y: str, scores: Mapping[object, str], task_rows: int = TASK_ROWS
) -> DataFrame:
    """Unweighted mean over classes of each class against the rest; ``scores`` maps class to score column.

    The scores are written once: each curve reads them several times, and a model behind them would score again.
    """
    df = materialise(df.select(*[col(c) for c in dict.fromkeys([y, *scores.values()])]), "scores")
    rows = []
    for label, score in scores.items():
        rows.append(roc_auc(df, y, score, label, (), task_rows).first().roc_auc)
    known = [r for r in rows if r is not None]
    value = sum(known) / len(known) if len(known) == len(rows) and rows else None
    return df.sparkSession.createDataFrame([("roc_auc_ovr", value)], "metric string, value double")


def roc_points(
    df: DataFrame,
    y: str,
    score: str,
    positive: object | None = None,
    drop_intermediate: bool = True,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``threshold, fpr, tpr`` per distinct score, from the highest down, starting at (0, 0) with a NULL threshold.

    ``drop_intermediate`` leaves out points on a straight line between their neighbours.
    """
    df = nan_to_null(df)
    scored = _by_score(df, y, score, positive)
    hit = is_positive(df, y, positive)
    both = df.where(col(y).isNotNull() & col(score).isNotNull())
    total = both.agg(F.count_if(hit).alias("p"), F.count_if(~hit).alias("n")).first()
    n = _about_distinct(df, y, score)
    if not total.p or not total.n:
        raise ValueError("a ROC curve needs both classes")
    summed = running_totals(scored, "score", ["pos", "neg"], n_rows=n, task_rows=task_rows)
    if drop_intermediate:
        summed = with_previous(summed, "score", {"lpos": F.col("pos"), "lneg": F.col("neg")}, n, task_rows)
        top = (F.col("upto_pos") == total.p) & (F.col("upto_neg") == total.n)
        bend = (F.col("pos") != F.col("lpos")) | (F.col("neg") != F.col("lneg"))
        summed = summed.where(top | F.col("lpos").isNull() | bend)
    points = summed.select(
        F.col("score").alias("threshold"),
        ((total.n - F.col("upto_neg") + F.col("neg")) / F.lit(float(total.n))).alias("fpr"),
        ((total.p - F.col("upto_pos") + F.col("pos")) / F.lit(float(total.p))).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Long rows ``(by..., metric, value)``: mae, rmse, r2, mape, smape, from one aggregate.

    ``mape`` skips rows whose target is 0, ``smape`` rows where both are 0; with none left the
    value is NULL. Without spread in the target ``r2`` is 1 for a perfect fit, else 0.
    """
    df = nan_to_null(df)
    keys = [col(b) for b in by]
    pair = df.select(*keys, col(y).cast("double").alias("__t"), col(pred).cast("double").alias("__p")).where(
        "__t IS NOT NULL AND __p IS NOT NULL"
    )
    t, p = F.col("__t"), F.col("__p")
    err = t - p
    size = F.abs(t) + F.abs(p)
    n = F.count(F.lit(1))
    res, tot = F.sum(err * err), F.var_pop(t) * n
    values = {
        "mae": F.avg(F.abs(err)),
        "rmse": F.sqrt(F.avg(err * err)),
        "r2": F.when(tot == 0, F.when(res == 0, 1.0).otherwise(0.0)).otherwise(1 - res / F.nullif(tot, F.lit(0.0))),
        "mape": F.avg(F.when(t != 0, F.abs(err / F.nullif(t, F.lit(0.0))))) * 100,
        "smape": F.avg(F.when(size != 0, 2 * F.abs(err) / F.nullif(size, F.lit(0.0)))) * 100,
    }
    return pair.groupBy(*keys).agg(*[v.alias(k) for k, v in values.items()]).unpivot(
        [*keys], list(values), "metric", "value"
    )


def compute_metrics(task: str) -> Callable[..., DataFrame]:
    """The metric function of a task."""
    table = {
        "classification": classification_metrics,
        "regression": regression_metrics,
        "timeseries": regression_metrics,
    }
    if task not in table:
        raise ValueError(f"Unknown task {task!r}. Available: {list(table)}")
    return table[task]


# -------------------------------------------------------------------- gate ---


def evaluate_gate(
    metrics: DataFrame, min_metrics: Mapping[str, float] | None = None, max_metrics: Mapping[str, float] | None = None
) -> DataFrame:
    """One row per bound: ``metric, kind, bound, value, passed``. A missing or NaN metric fails."""
    bounds = [(k, "min", float(v)) for k, v in (min_metrics or {}).items()]
    bounds += [(k, "max", float(v)) for k, v in (max_metrics or {}).items()]
    table = metrics.sparkSession.createDataFrame(bounds, "metric string, kind string, bound double")
    value = F.nanvl(F.col("value"), F.lit(None))
    good = F.when(F.col("kind") == "min", value >= F.col("bound")).otherwise(value <= F.col("bound"))
    # both sides are a handful of rows
    return table.join(metrics.select("metric", "value"), "metric", "left").select(
        "metric", "kind", "bound", "value", F.coalesce(good, F.lit(False)).alias("passed")
    )


def gate_passed(gate: DataFrame) -> bool:
    return gate.where(~F.col("passed")).isEmpty()


def compare_metrics(current: DataFrame, candidate: DataFrame, lower_is_better: Sequence[str] = ("mae", "rmse", "mape", "smape")) -> DataFrame:
    """Candidate against the production run: ``metric, current, candidate, better``."""
    joined = current.select("metric", F.col("value").alias("current")).join(
        candidate.select("metric", F.col("value").alias("candidate")), "metric", "full"
    )
    down = F.col("metric").isin(list(lower_is_better))
    better = F.when(down, F.col("candidate") <= F.col("current")).otherwise(F.col("candidate") >= F.col("current"))
    return joined.withColumn("better", F.coalesce(better, F.lit(False)))


# ----------------------------------------------------- error distributions ---


def with_residual(df: DataFrame, y: str, pred: str, name: str = "residual") -> DataFrame:
    """Target minus prediction; stays distributed."""
    return df.withColumn(name, col(y).cast("double") - col(pred).cast("double"))


def residual_summary(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row: count, RMSE, mean and quantiles of the residual."""
    rows = with_residual(nan_to_null(df), y, pred).where("residual IS NOT NULL").select("residual")
    q = exact_quantiles(rows, {"residual": [0.0, 0.25, 0.5, 0.75, 1.0]})["residual"]
    names = ("min", "p25", "p50", "p75", "max")
    return rows.agg(
        F.count("residual").alias("n"),
        F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"),
        F.avg("residual").alias("mean"),
    ).select("*", *[F.lit(v).cast("double").alias(k) for k, v in zip(names, q)])


def calibration_bins(df: DataFrame, y: str, score: str, positive: object | None = None, bins: int = 10) -> DataFrame:
    """Per score bin: rows, mean score and the observed rate of the positive label."""
    df = nan_to_null(df)
    hit = is_positive(df, y, positive)
    at = F.least(F.floor(col(score).cast("double") * bins), F.lit(bins - 1)).cast("int")
    return (
        df.where(col(y).isNotNull() & col(score).isNotNull())
        .groupBy(at.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(col(score).cast("double")).alias("mean_score"),
            F.avg(hit.cast("double")).alias("observed_rate"),
        )
    )
