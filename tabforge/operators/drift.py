"""Drift of live data against a frozen profile: PSI, class PSI and two-sample KS."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, nan_to_null, numeric_columns
from tabforge.plans.aggregates import aggregate_cells, numeric_cells, per_column, union_all
from tabforge.plans.ordering import TASK_ROWS, running_totals
from tabforge.plans.quantiles import exact_quantiles, present_counts

EPSILON = 1e-6
PSI_THRESHOLD = 0.25
BINS = 10
PROFILE_SCHEMA = "column string, edges array<double>, counts array<bigint>, n bigint"


def bin_counts(df: DataFrame, edges: dict[str, Sequence[float]]) -> DataFrame:
    """``column, counts, n`` over half-open bins ``[a, b)`` given the inner edges.

    Counts at or above each edge come from one aggregate without a shuffle of rows; a bin is the
    difference of two of them, so repeated edges give empty bins.
    """

    names = list(edges)
    most = max(len(q) for q in edges.values())
    padded = {c: [*map(float, q), *[None] * (most - len(q))] for c, q in edges.items()}
    x = F.col("x")
    # a column with fewer edges has NULL ones, which no value reaches
    reached = [F.count(x), *[F.count_if(x >= per_column([padded[c][j] for c in names])) for j in range(most)]]
    reached.append(F.lit(0).cast("long"))
    bins = F.array(*[a - b for a, b in zip(reached, reached[1:])])
    return aggregate_cells(numeric_cells(df, names), names, {"counts": bins, "n": F.count(x)})


def drift_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = BINS,
    sample_rows: int | None = None,
    order: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Frozen reference of each numeric column: inner quantile edges and the counts between them.

    Taken over the whole column. ``sample_rows`` with ``order`` limits it to the first present
    values, as a reference kept from the head of a file would be. All-missing columns are left out.
    """
    df = nan_to_null(df)
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    probs = [i / bins for i in range(1, bins)]
    if sample_rows is not None:
        if not order:
            raise ValueError("sample_rows needs an order to say which rows come first")
        parts = []
        for c in names:
            head = df.where(col(c).isNotNull()).orderBy(*[col(o) for o in order]).limit(sample_rows).select(col(c))
            parts.append(drift_profile(head, [c], bins))
        return union_all(parts)
    found = exact_quantiles(df, {c: probs for c in names}, approx)
    edges = {c: q for c, q in found.items() if q[0] is not None}
    if not edges:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    listed = F.create_map(
        *[x for c, q in edges.items() for x in (F.lit(c), F.array(*[F.lit(float(e)) for e in q]))]
    )
    return bin_counts(df, edges).select("column", listed[F.col("column")].alias("edges"), "counts", "n")


def psi_value(expected: Column, actual: Column) -> Column:
    """Population stability index of two arrays of bin counts; shares are lifted by epsilon."""

    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, v: s + v)
        return F.transform(counts, lambda v: v / F.greatest(total, F.lit(1)) + F.lit(EPSILON))

    terms = F.zip_with(shares(expected), shares(actual), lambda e, a: (a - e) * F.ln(a / e))
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)


def check_drift(
    profile: DataFrame, live: DataFrame, threshold: float = PSI_THRESHOLD, columns: Sequence[str] | None = None
) -> DataFrame:
    """``column, psi, drifted`` for every numeric live column that has a value.

    A column without a reference has PSI 0. The profile is O(columns) rows and becomes literals.
    """
    live = nan_to_null(live)
    names = list(columns) if columns is not None else numeric_columns(live)
    if not names:
        return live.sparkSession.createDataFrame([], "column string, psi double, drifted boolean")
    known = {r.column: r for r in profile.where(F.col("column").isin(names)).collect()}
    edges = {c: (known[c].edges if c in known else []) for c in names}
    counted = bin_counts(live, edges).where("n > 0")
    if not known:
        out = counted.select("column", F.lit(0.0).alias("psi"))
    else:
        expected = F.create_map(
            *[x for c, r in known.items() for x in (F.lit(c), F.array(*[F.lit(v).cast("long") for v in r.counts]))]
        )
        out = counted.select(
            "column",
            F.coalesce(psi_value(F.try_element_at(expected, F.col("column")), F.col("counts")), F.lit(0.0)).alias("psi"),
        )
    return out.withColumn("drifted", F.col("psi") > threshold)


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: the largest PSI and whether any column drifted."""
    return report.agg(
        F.max("psi").alias("max_psi"), F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drifted")
    )


def class_psi(reference: DataFrame, live: DataFrame, column: str) -> DataFrame:
    """One row ``(column, psi)`` over the value shares of a categorical column; NULL is a value."""
    sides = []
    for frame, left, right in ((reference, 1, 0), (live, 0, 1)):
        counts = nan_to_null(frame).groupBy(col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
        sides.append(counts.select("label", (F.col("n") * left).alias("e"), (F.col("n") * right).alias("a")))
    both = union_all(sides).groupBy("label").agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    total = both.agg(F.sum("e").alias("e"), F.sum("a").alias("a")).first()
    e = F.col("e") / F.lit(float(max(total.e or 0, 1))) + EPSILON
    a = F.col("a") / F.lit(float(max(total.a or 0, 1))) + EPSILON
    return both.agg(F.coalesce(F.sum((a - e) * F.ln(a / e)), F.lit(0.0)).alias("psi")).select(
        F.lit(column).alias("column"), "psi"
    )


def ks_two_sample(
    reference: DataFrame, live: DataFrame, columns: Sequence[str] | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``column, ks``: largest distance between the two empirical distributions of each column.

    Both samples are reduced to one row per distinct value first; the prefix sums then run over
    value ranges in parallel.
    """
    reference, live = nan_to_null(reference), nan_to_null(live)
    names = list(columns) if columns is not None else [
        c for c in numeric_columns(reference) if c in numeric_columns(live)
    ]
    sides = []
    for frame, left in ((reference, True), (live, False)):
        rows = numeric_cells(frame, names).where("x IS NOT NULL")
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        sides.append(rows.withColumns({"ref": one if left else none, "new": none if left else one}))
    counted = union_all(sides).groupBy("c", "x").agg(F.sum("ref").alias("ref"), F.sum("new").alias("new"))
    ref, new = present_counts(reference, names), present_counts(live, names)
    full = {i: {"ref": ref[c], "new": new[c]} for i, c in enumerate(names) if ref[c] and new[c]}
    if not full:
        return reference.sparkSession.createDataFrame([], "column string, ks double")
    rows = [r["ref"] + r["new"] for r in full.values()]

    def size(side: str) -> Column:
        return per_column([full[i][side] if i in full else None for i in range(len(names))])

    summed = running_totals(
        counted.where(F.col("c").isin(list(full))), "x", ["ref", "new"], ["c"],
        n_rows=sum(rows), task_rows=task_rows, largest=max(rows),
    )
    distance = F.abs(F.col("upto_ref") / size("ref") - F.col("upto_new") / size("new"))
    return aggregate_cells(summed, names, {"ks": F.max(distance)})


def prediction_drift(
    reference: DataFrame, live: DataFrame, prediction: str = "prediction", categorical: bool = False, bins: int = BINS
) -> DataFrame:
    """PSI of the prediction column between two scored batches."""
    if categorical:
        return class_psi(reference, live, prediction)
    profile = drift_profile(reference, [prediction], bins)
    return check_drift(profile, live, columns=[prediction]).select("column", "psi")
