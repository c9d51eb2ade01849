"""Table-level quality: duplicate rows, go/no-go flags, and the whole profiling run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, flat_columns, nan_to_null, number_of, numeric_columns
from tabforge.operators import bivariate, profile, timeprofile
from tabforge.plans.aggregates import pairwise_corr
from tabforge.plans.quantiles import exact_quantiles
from tabforge.session import materialise

_CODE = "__target_code"


def _digest(df: DataFrame) -> list:
    """128 bits over all columns. The NULL pattern is hashed too, because hashing skips NULLs."""
    names = df.columns
    nulls = [col(c).isNull() for c in names]
    plain = [col(c) for c in names]
    return [F.xxhash64(F.lit(1), *plain, *nulls), F.xxhash64(F.lit(2), *nulls, *reversed(plain))]


def duplicate_rows(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row ``(n_rows, n_distinct, dup_pct)``: rows equal to an earlier one, NULL equal to NULL.

    The default groups a 128-bit digest of each row, so 16 bytes a row are shuffled instead of the
    row; two different rows among 10^12 share a digest with probability about 10^-15. ``exact=True``
    groups the rows themselves. Identical rows collapse before the shuffle either way.
    """
    df = nan_to_null(df)
    if exact:
        groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    else:
        h1, h2 = _digest(df)
        groups = df.select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")
    ).select(
        "n_rows",
        "n_distinct",
        F.coalesce(1 - F.try_divide(F.col("n_distinct").cast("double"), F.col("n_rows")), F.lit(0.0)).alias("dup_pct"),
    )


def quality_flags(
    df: DataFrame,
    target: str | None = None,
    task: str | None = None,
    leak: Sequence[str] = (),
    pairs: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Long rows ``(flag, value)``: duplicate share, constant, id-like and heavily missing columns,
    leakage suspects, up to six collinear pairs, task and target.

    Id-like here means one distinct value per row, stricter than in ``column_profile``.
    """
    df = nan_to_null(df)
    return flags_of(duplicate_rows(df, exact), profile._uniqueness(df), target, task, leak, pairs)


def flags_of(
    duplicates: DataFrame,
    unique: DataFrame,
    target: str | None = None,
    task: str | None = None,
    leak: Sequence[str] = (),
    pairs: Sequence[str] = (),
) -> DataFrame:
    """``quality_flags`` from the duplicate count and the counts of each column."""
    spark = unique.sparkSession
    dup = duplicates.select(F.lit("dup_pct").alias("flag"), F.bround("dup_pct", 4).cast("string").alias("value"))
    per_column = unique.select(
        "column",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("n_unique") <= 1, F.lit("constant")),
                    F.when(F.col("n_unique") == F.col("n_rows"), F.lit("id_like")),
                    F.when(F.col("n_missing") / F.col("n_rows") > 0.3, F.lit("missing_gt30")),
                )
            )
        ).alias("flag"),
    ).select("flag", F.col("column").alias("value"))
    given = [("leak_suspects", c) for c in leak] + [("multicollinear", p) for p in pairs]
    given += [(k, v) for k, v in (("task", task), ("target", target)) if v is not None]
    return dup.unionByName(per_column).unionByName(spark.createDataFrame(given, "flag string, value string"))


def _kept(df: DataFrame) -> DataFrame:
    """The few rows of a table, held by the driver: what is made of them reads no data again."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def run_universal_eda(
    df: DataFrame,
    target: str | None = None,
    date: str | None = None,
    id_cols: Sequence[str] = (),
    order: Sequence[str] = (),
) -> dict[str, object]:
    """Every check as a dict of DataFrames, plus task, datetime columns and shape.

    All tables are made of a few statistics that the data is read for once each: value counts of every column, duplicate
    rows, parse rates of text, moments, quartiles (two or three scans), outliers beyond them, class counts, and one
    table of correlations with the target's code as one more column. They hold a row a column or pair of columns.
    """
    df = nan_to_null(df)
    dated = timeprofile.detect_datetime_columns(df, forced=date, order=order)
    known = target is not None and target in df.columns
    skip = [target] if target else []
    unique = _kept(profile._uniqueness(df))
    counts = {r.column: r for r in unique.collect()}
    few = {c: r.n_unique - (r.n_missing > 0) for c, r in counts.items()}  # without NULL
    n_rows = max((r.n_rows for r in counts.values()), default=0) if counts else df.count()
    names = numeric_columns(df, skip)
    task = None
    if known:
        task = profile.task_of(df, target, few[target], bool(dated))
    classes = known and task.startswith("classification")

    measured = numeric_columns(df)
    summary = _kept(profile.numeric_summary(df, measured)) if measured else None
    quartiles = exact_quantiles(df, {c: profile.QUARTILES for c in names})
    described = summary.where(F.col("column").isin(names)) if names else None
    coded, n_classes, balance = df, None, None
    if classes:
        n_classes = few[target]
        balance = profile.class_counts(df, target)
        balance = _kept(balance) if n_classes <= bivariate.LITERAL_LABELS else materialise(balance, "classes")
        coded = bivariate.target_code(df, target, _CODE, balance)
    elif known:
        coded = df.withColumn(_CODE, number_of(df, target))
    related = _kept(pairwise_corr(coded, [*names, *([_CODE] if known else [])]))
    correlations = None
    if known:
        with_target = related.where(F.col("b") == _CODE).select(F.col("a").alias("column"), "r", F.lit(n_classes).cast("long").alias("n_classes"))
        correlations = with_target.orderBy(F.abs("r").desc_nulls_last(), "column")
    pairs = bivariate.strong_pairs(related.where(F.col("b") != _CODE))
    # O(columns) rows each; they feed the flags as text
    leak = [r.column for r in bivariate.leakage_suspects(correlations).collect()] if known else []
    place = {c: i for i, c in enumerate(df.columns)}  # in column order, as the rows come in none
    listed = [f"{r.a}~{r.b}={r.r}" for r in sorted(pairs.collect(), key=lambda r: (place[r.a], place[r.b]))]
    stats = None
    if known:
        stats = profile.balance_of(balance) if classes else profile.shape_of(summary.where(F.col("column") == target))
    return {
        "n_rows": n_rows,
        "n_columns": len(df.columns),
        "profile": profile.column_profile_of(unique),
        "missing": profile.missing_summary_of(unique),
        "numeric_describe": profile.describe_of(described, quartiles) if names else profile.numeric_describe(df, exclude=skip),
        "outliers": _kept(profile.outliers_of(df, profile.fences_of(quartiles))),
        "zeros": profile.zeros_of(described) if names else profile.zero_shares(df, exclude=skip),
        "categoricals": profile.categoricals_of(df, target, few),
        "datetime_columns": dated,
        "task": task,
        "target_stats": stats,
        "corr_with_target": correlations,
        "multicollinear": pairs,
        "flags": flags_of(_kept(duplicate_rows(df)), unique, target if known else None, task, leak, listed),
        "id_cols": [c for c in id_cols if c in flat_columns(df)],
    }
