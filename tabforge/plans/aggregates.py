"""Per-column aggregates over cells, value counts and pairwise correlation."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, value_text

# Up to this many column pairs are correlated by JVM aggregates; more go through Gram matrices.
JVM_PAIRS = 120


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def cell_values(df: DataFrame, names: Sequence[str]) -> Column:
    return F.array(*[col(n).cast("double") for n in names])


def numeric_cells(df: DataFrame, names: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """One row per cell: ``keep``, column number ``c`` and value ``x`` as double.

    An aggregate grouped by ``c`` costs the same short generated code whether the table has five
    columns or a thousand; one aggregate expression per column would soon be too long to compile.
    Only one row per column and task leaves the map side.
    """
    return df.select(*keep, F.posexplode(cell_values(df, names)).alias("c", "x"))


def missing_cells(
    df: DataFrame, names: Sequence[str], numeric: Sequence[str] = (), keep: Sequence[Column] = ()
) -> DataFrame:
    """Like ``numeric_cells`` for columns of any type, with ``m`` for a missing value; ``x`` only where numeric."""
    known = set(numeric)
    cells = [
        F.struct(
            (col(n).cast("double") if n in known else F.lit(None).cast("double")).alias("x"),
            col(n).isNull().alias("m"),
        )
        for n in names
    ]
    return df.select(*keep, F.posexplode(F.array(*cells)).alias("c", "v")).select(
        *[F.col(k) for k in _kept(keep, df)], "c", F.col("v.x").alias("x"), F.col("v.m").alias("m")
    )


def _kept(keep: Sequence[Column], df: DataFrame) -> list[str]:
    return df.select(*keep).columns if keep else []


def per_column(values: Sequence, kind: str = "double") -> Column:
    """A literal per column number, for use in expressions over cells."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("c"))


def aggregate_cells(
    cells: DataFrame, names: Sequence[str], exprs: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """``by..., column`` and the aggregates, one row per column (and group)."""
    grouped = cells.groupBy(*by, "c").agg(*[e.alias(k) for k, e in exprs.items()])
    return grouped.select(*by, per_column(list(names), "string").alias("column"), *exprs)


def unpivot_text(df: DataFrame, names: Sequence[str], digest_over: int | None = None) -> DataFrame:
    """Rows ``(column, value)`` with the value as text.

    ``digest_over`` replaces longer text by a digest of the whole text: enough for counting
    distinct values, and it keeps long documents out of the shuffle.
    """
    values = []
    for i, c in enumerate(names):
        text = value_text(df, c)
        if digest_over is not None and df.schema[c].dataType.typeName() == "string":
            text = F.when(F.length(text) > digest_over, F.sha2(text, 256)).otherwise(text)
        values.append(F.struct(F.lit(c).alias("column"), text.alias("value")))
    return df.select(F.explode(F.array(*values)).alias("r")).select("r.column", "r.value")


def value_counts(df: DataFrame, names: Sequence[str], digest_over: int | None = None) -> DataFrame:
    """Rows ``(column, value, n)``, NULL counted as a value. Hot values collapse before the shuffle."""
    return unpivot_text(df, names, digest_over).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, names: Sequence[str], approx: bool = False) -> DataFrame:
    """Rows ``(column, n_distinct, n_missing)``; ``n_distinct`` leaves NULL out.

    Exact counting shuffles every distinct value of every column once. ``approx=True`` is one
    scan with a sketch per column and no shuffle of values.
    """
    if approx:
        cells = unpivot_text(df, names, digest_over=64)
        return cells.groupBy("column").agg(
            F.approx_count_distinct("value").alias("n_distinct"), F.count_if(F.col("value").isNull()).alias("n_missing")
        )
    counts = value_counts(df, names, digest_over=64)
    return counts.groupBy("column").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
    )


def pairwise_corr(df: DataFrame, names: Sequence[str], jvm_pairs: int = JVM_PAIRS) -> DataFrame:
    """Rows ``(a, b, r)`` for every pair a before b: Pearson over the rows where both are present.

    Few pairs: one cell per pair, aggregated on the map side. Many: see ``_gram_corr``.
    """
    names = list(names)
    pairs = list(combinations(range(len(names)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    if len(pairs) > jvm_pairs:
        return _gram_corr(df, names)
    x = [col(n).cast("double") for n in names]
    cells = df.select(
        F.posexplode(F.array(*[F.struct(x[i].alias("x"), x[j].alias("y")) for i, j in pairs])).alias("c", "v")
    ).select("c", F.col("v.x").alias("x"), F.col("v.y").alias("y"))
    grouped = cells.groupBy("c").agg(pearson(F.col("x"), F.col("y")).alias("r"))
    return grouped.select(
        per_column([names[i] for i, _ in pairs], "string").alias("a"),
        per_column([names[j] for _, j in pairs], "string").alias("b"),
        "r",
    )


def _gram_corr(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Correlation of many columns: each task sums masked products of its Arrow batches as matrices
    and emits one row per pair, which are then added up.

    Values are centred on the column means first, so the sums do not lose their digits.
    """
    k = len(names)
    means = {
        r.c: r.m
        for r in numeric_cells(df, names).groupBy("c").agg(F.avg("x").alias("m")).collect()
    }
    shift = [means.get(i) or 0.0 for i in range(k)]
    centred = df.select(*[(col(n).cast("double") - F.lit(m)).alias(f"x{i}") for i, (n, m) in enumerate(zip(names, shift))])

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, k, k))
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            m = seen.astype(float)
            square = x * x
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x])
        i, j = np.triu_indices(k, 1)
        yield pd.DataFrame({"i": i, "j": j, **{f"s{t}": total[t][i, j] for t in range(6)}})

    sums = centred.mapInPandas(gram, "i int, j int, " + ", ".join(f"s{t} double" for t in range(6)))
    n, sx, sy, sxx, syy, sxy = (F.sum(f"s{t}") for t in range(6))
    spread = (n * sxx - sx * sx) * (n * syy - sy * sy)
    r = F.when(spread > 0, (n * sxy - sx * sy) / F.sqrt(spread))
    named = F.array(*[F.lit(n_) for n_ in names])
    return sums.groupBy("i", "j").agg(r.alias("r")).select(
        F.get(named, F.col("i")).alias("a"), F.get(named, F.col("j")).alias("b"), "r"
    )


def pearson(a: Column, b: Column) -> Column:
    """Correlation over the rows where both are present; NULL if a side is constant there.

    The built-in ``corr`` raises on a constant side in ANSI mode.
    """
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)
