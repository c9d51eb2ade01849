"""The aggregate behind each standard chart; drawing is left to the caller."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, first_columns, nan_to_null, number_of, numeric_columns
from tabforge.operators import profile
from tabforge.operators.bivariate import correlation_matrix
from tabforge.operators.metrics import confusion_matrix, roc_points
from tabforge.operators.timeprofile import volume_trend
from tabforge.plans.aggregates import aggregate_cells, numeric_cells, per_column, union_all
from tabforge.plans.quantiles import exact_quantiles, present_counts

__all__ = [
    "boxplot_stats",
    "confusion_matrix",
    "correlation_matrix",
    "forecast_series",
    "histograms",
    "missing_shares",
    "predicted_vs_actual",
    "residuals_vs_predicted",
    "roc_points",
    "target_distribution",
    "target_over_time",
    "volume_trend",
]


def missing_shares(df: DataFrame) -> DataFrame:
    """Percent missing of every column, most missing first."""
    return (
        profile.missing_counts(df)
        .select("column", (F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows")) * 100).alias("pct_missing"))
        .orderBy(F.desc("pct_missing"), "column")
    )


def _ranges(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Column -> (low, high) of the present values; a single value gets one unit around it."""
    rows = aggregate_cells(numeric_cells(df, names), names, {"lo": F.min("x"), "hi": F.max("x")}).collect()
    out = {}
    for r in rows:
        if r.lo is not None:
            out[r.column] = (r.lo, r.hi) if r.hi > r.lo else (r.lo - 0.5, r.hi + 0.5)
    return out


def equal_width_bin(x: Column, low: Column, high: Column, bins: int | Column) -> Column:
    """Bin 0..bins-1 of equal width; the last one is closed. Off-by-one division is put right at the edges."""
    bins = F.lit(bins) if isinstance(bins, int) else bins
    width = (high - low) / bins
    raw = F.least(F.floor((x - low) / (high - low) * bins), bins - 1)
    down = (x < low + raw * width).cast("int")
    up = ((x >= low + (raw + 1) * width) & (raw < bins - 1)).cast("int")
    return (raw - down + up).cast("int")


def automatic_bins(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> dict[str, int]:
    """Column -> number of equal bins: the larger of Sturges' and Freedman and Diaconis' from the exact quartiles.

    Without spread between the quartiles the second rule has no width, so the first one holds.
    """
    sizes = present_counts(df, list(ranges))
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in ranges})
    out = {}
    for c, (low, high) in ranges.items():
        spread = quartiles[c][1] - quartiles[c][0]
        width = (high - low) / (math.log2(sizes[c]) + 1)
        if spread > 0:
            width = min(width, 2 * spread / sizes[c] ** (1 / 3))
        out[c] = max(1, math.ceil((high - low) / width))
    return out


def histograms(df: DataFrame, exclude: Sequence[str] = (), k: int | None = None, bins: int | str = 30) -> DataFrame:
    """``column, bin, lo, hi, n`` of the first k numeric columns; empty bins are left out.

    ``bins="auto"`` takes the number of bins of each column from its rows and quartiles (``automatic_bins``).
    """
    df = nan_to_null(df)
    names = first_columns(numeric_columns(df, exclude), k)
    ranges = _ranges(df, names) if names else {}
    names = [c for c in names if c in ranges]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n long")
    low, high = per_column([ranges[c][0] for c in names]), per_column([ranges[c][1] for c in names])
    if bins == "auto":
        number = automatic_bins(df, {c: ranges[c] for c in names})
        bins = per_column([number[c] for c in names], "long")
    cells = numeric_cells(df, names).where("x IS NOT NULL")
    counts = cells.groupBy("c", equal_width_bin(F.col("x"), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / bins
    return counts.select(
        per_column(names, "string").alias("column"),
        "bin",
        (low + F.col("bin") * width).alias("lo"),
        (low + (F.col("bin") + 1) * width).alias("hi"),
        "n",
    )


def boxplot_stats(df: DataFrame, exclude: Sequence[str] = (), k: int | None = None, approx: bool = False) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 interquartile ranges, and outlier count."""
    df = nan_to_null(df)
    names = first_columns(numeric_columns(df, exclude), k)
    found = exact_quantiles(df, {c: profile.QUARTILES for c in names}, approx)
    names = [c for c in names if found[c][0] is not None]
    if not names:
        fields = ", ".join(f"{f} double" for f in ("q1", "median", "q3", "whisker_low", "whisker_high"))
        return df.sparkSession.createDataFrame([], f"column string, {fields}, n_outliers long")

    q1, q2, q3 = (per_column([found[c][i] for c in names]) for i in range(3))
    x, low, high = F.col("x"), q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    rows = aggregate_cells(
        numeric_cells(df, names).withColumns({"q1": q1, "q2": q2, "q3": q3, "low": low, "high": high}),
        names,
        {
            "q1": F.first("q1"),
            "median": F.first("q2"),
            "q3": F.first("q3"),
            "whisker_low": F.least(F.min(F.when(x >= F.col("low"), x)), F.first("q1")),
            "whisker_high": F.greatest(F.max(F.when(x <= F.col("high"), x)), F.first("q3")),
            "n_outliers": F.count_if((x < F.col("low")) | (x > F.col("high"))),
        },
    )
    return rows


def target_distribution(df: DataFrame, target: str, task: str, bins: int = 50) -> DataFrame:
    """Class shares in label order, or a histogram of the target read as a number."""
    if task.startswith("classification"):
        return profile.class_shares(df, target, digits=None).orderBy("label")
    return histograms(df.select(number_of(df, target).alias(target)), bins=bins)


def _grid(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts over a 2-D grid of equal bins, as ``x_bin, y_bin, x_lo, y_lo, n``."""
    ranges = _ranges(df, [x, y])
    if x not in ranges or y not in ranges:
        return df.sparkSession.createDataFrame([], "x_bin int, y_bin int, x_lo double, y_lo double, n long")
    parts = []
    for c in (x, y):
        low, high = ranges[c]
        parts.append((equal_width_bin(col(c), F.lit(low), F.lit(high), bins), low, (high - low) / bins))
    (bx, lx, wx), (by, ly, wy) = parts
    return (
        df.groupBy(bx.alias("x_bin"), by.alias("y_bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "x_bin",
            "y_bin",
            (F.lit(lx) + F.col("x_bin") * F.lit(wx)).alias("x_lo"),
            (F.lit(ly) + F.col("y_bin") * F.lit(wy)).alias("y_lo"),
            "n",
        )
    )


def _pairs(df: DataFrame, y: str, pred: str) -> DataFrame:
    df = nan_to_null(df)
    return df.select(col(y).cast("double").alias("actual"), col(pred).cast("double").alias("predicted")).where(
        "actual IS NOT NULL AND predicted IS NOT NULL"
    )


def predicted_vs_actual(df: DataFrame, y: str, pred: str, bins: int = 50) -> DataFrame:
    """Binned scatter of actual (x) and predicted (y)."""
    return _grid(_pairs(df, y, pred), "actual", "predicted", bins)


def identity_range(df: DataFrame, y: str) -> DataFrame:
    """The two ends of the ideal line: smallest and largest target."""
    return nan_to_null(df).agg(
        F.min(col(y).cast("double")).alias("lo"), F.max(col(y).cast("double")).alias("hi")
    )


def residuals_vs_predicted(df: DataFrame, y: str, pred: str, bins: int = 50) -> DataFrame:
    """Binned scatter of predicted (x) and predicted minus actual (y): the opposite sign of ``with_residual``."""
    rows = _pairs(df, y, pred).select("predicted", (F.col("predicted") - F.col("actual")).alias("residual"))
    return _grid(rows, "predicted", "residual", bins)


def forecast_series(train: DataFrame, test: DataFrame, date: str, y: str, pred: str = "prediction") -> DataFrame:
    """``date, actual, predicted, split``: predictions are NULL before the split."""
    left = train.select(
        col(date).alias("date"), col(y).alias("actual"), F.lit(None).cast("double").alias("predicted"), F.lit("train").alias("split")
    )
    right = test.select(
        col(date).alias("date"), col(y).alias("actual"), col(pred).cast("double").alias("predicted"), F.lit("test").alias("split")
    )
    return union_all([left, right])


def target_over_time(df: DataFrame, date: str, target: str, rule: str = "day") -> DataFrame:
    """Mean, total and count of the target per period, in order."""
    period = F.date_trunc(rule, col(date).cast("timestamp_ntz")).cast("date")
    y = number_of(df, target)
    return (
        df.where(col(date).isNotNull())
        .groupBy(period.alias("period"))
        .agg(F.avg(y).alias("mean"), F.sum(y).alias("total"), F.count(y).alias("n"))
        .orderBy("period")
    )
