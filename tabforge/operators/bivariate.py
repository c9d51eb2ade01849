"""Relations between columns: correlation, leakage, collinearity, target by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.functions.columns import (
    col,
    field_type,
    first_columns,
    nan_to_null,
    number_of,
    numeric_columns,
    rounded,
)
from tabforge.operators.metrics import with_zero_cells
from tabforge.plans.aggregates import aggregate_cells, numeric_cells, pairwise_corr, pearson
from tabforge.plans.ordering import with_global_rank
from tabforge.session import materialise

MISSING_LABEL = "∅_missing"
# Labels written into the plan as literals; more of them are joined as a table.
LITERAL_LABELS = 1000


def target_code(df: DataFrame, target: str, name: str = "__y", labels: DataFrame | None = None) -> DataFrame:
    """Add the target's class code: its position among the sorted distinct labels, NULL stays NULL.

    ``labels`` may hold the distinct labels (column ``label``), if they are known.
    """
    labels = df.select(col(target).alias("label")).distinct() if labels is None else labels.select("label")
    labels = labels.where(F.col("label").isNotNull())
    few = [r.label for r in labels.limit(LITERAL_LABELS + 1).collect()]
    if len(few) <= LITERAL_LABELS:
        dtype = field_type(df, target)
        listed = F.array_sort(F.array(*[F.lit(v).cast(dtype) for v in few])) if few else None
        code = F.array_position(listed, col(target)) - 1 if few else F.lit(None)
        return df.withColumn(name, code.cast("double"))
    codes = with_global_rank(labels, ["label"], name).withColumn(name, (F.col(name) - 1).cast("double"))
    return df.join(codes.withColumnRenamed("label", "__label"), col(target) == F.col("__label"), "left").drop("__label")


def target_correlations(df: DataFrame, target: str, task: str) -> DataFrame:
    """Pearson of every numeric feature with the target, strongest first.

    A class target is coded by its sorted labels. With more than two classes the number depends
    on that order, so ``n_classes`` (NULL for regression) is given along with it.
    """
    df = nan_to_null(df)
    names = numeric_columns(df, [target])
    classes = task.startswith("classification")
    if classes:
        df = target_code(df, target)
        n_classes = F.lit(df.agg(F.max("__y")).first()[0]).cast("long") + 1
    else:
        df = df.withColumn("__y", number_of(df, target))
        n_classes = F.lit(None).cast("long")
    if not names:
        return df.sparkSession.createDataFrame([], "column string, r double, n_classes long")
    rows = aggregate_cells(
        numeric_cells(df, names, [F.col("__y").alias("y")]), names, {"r": pearson(F.col("x"), F.col("y"))}
    )
    return rows.withColumn("n_classes", n_classes).orderBy(F.abs("r").desc_nulls_last(), "column")


def leakage_suspects(correlations: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Features whose absolute correlation with the target is above the threshold."""
    return correlations.where(F.abs("r") > threshold).select("column", "r")


def multicollinear_pairs(
    df: DataFrame, exclude: Sequence[str] = (), threshold: float = 0.8, digits: int | None = 3
) -> DataFrame:
    """Pairs of numeric columns, in schema order, whose absolute correlation is above the threshold."""
    df = nan_to_null(df)
    return strong_pairs(pairwise_corr(df, numeric_columns(df, exclude)), threshold, digits)


def strong_pairs(pairs: DataFrame, threshold: float = 0.8, digits: int | None = 3) -> DataFrame:
    """``multicollinear_pairs`` of known correlations."""
    return pairs.where(F.abs("r") > threshold).select("a", "b", rounded(F.col("r"), digits).alias("r"))


def correlation_matrix(df: DataFrame, exclude: Sequence[str] = (), k: int | None = None) -> DataFrame:
    """Long matrix ``(a, b, r)`` with both triangles and the diagonal; empty under two columns."""
    df = nan_to_null(df)
    names = first_columns(numeric_columns(df, exclude), k)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    upper = pairwise_corr(df, names)
    both = upper.select(
        F.explode(F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))).alias("p")
    ).select("p.*")
    own = aggregate_cells(numeric_cells(df, names), names, {"r": F.when(F.var_pop("x") > 0, 1.0)})
    return both.unionByName(own.select(F.col("column").alias("a"), F.col("column").alias("b"), "r"))


def numeric_vs_target(
    df: DataFrame, target: str, task: str, k: int | None = None, digits: int | None = 3
) -> DataFrame:
    """Numeric features (the first k if given): mean per class (a NULL class is kept), or correlation for regression."""
    df = nan_to_null(df)
    names = first_columns(numeric_columns(df, [target]), k)
    if task.startswith("classification"):
        return aggregate_cells(
            numeric_cells(df, names, [col(target).alias("label")]),
            names,
            {"mean": rounded(F.avg("x"), digits)},
            by=["label"],
        )
    y = number_of(df, target)
    rows = aggregate_cells(numeric_cells(df, names, [y.alias("y")]), names, {"r": pearson(F.col("x"), F.col("y"))})
    return rows.orderBy(F.abs("r").desc_nulls_last(), "column").select("column", rounded(F.col("r"), digits).alias("r"))


def categorical_vs_target(
    df: DataFrame, column: str, target: str, task: str, digits: int | None = 3, zeros: bool = False
) -> DataFrame:
    """Class shares within each level (classification), or mean and count of the target per level.

    Missing levels are shown as ``∅_missing`` in the class table and rows without a class are left out of it. It has a
    row for each level and class that occur together, whatever their numbers; with ``zeros`` for all levels and classes.
    """
    df = nan_to_null(df)
    if task.startswith("classification"):
        known = df.where(col(target).isNotNull())
        level = F.coalesce(col(column).cast("string"), F.lit(MISSING_LABEL)).alias("level")
        counts = known.groupBy(level, col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
        if zeros:
            counts = materialise(counts, "level-counts")
            counts = with_zero_cells(counts, "level", "label", counts.select("label").distinct(), counts.select("level").distinct())
        total = F.sum("n").over(W.partitionBy("level"))
        return counts.select("level", "label", rounded(F.col("n") / total, digits).alias("share"))
    y = number_of(df, target)
    return (
        df.groupBy(col(column).alias("level"))
        .agg(rounded(F.avg(y), digits).alias("mean"), F.count(y).alias("count"))
        .orderBy("mean", "level")
    )


