"""Imputation, scaling and one-hot encoding: fitted once, saved with the model, the same on a stream.

Statistics are exact and become literals in a SQL stage, so the fitted stages need no second
table. The library's own imputer and scaler differ (approximate median, sample deviation).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col, field_type, infer_columns, nan_to_null, quote
from tabforge.plans.aggregates import aggregate_cells, numeric_cells, value_counts
from tabforge.plans.quantiles import exact_quantiles

MISSING_VALUE = "missing_value"
INFREQUENT = "__infrequent__"
# One-hot levels one column may have. Each is a model feature and a label in the saved model.
MAX_LEVELS = 100_000


def number_sql(value: float) -> str:
    return f"({float(value)!r}D)"


def text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def numeric_fill(
    df: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    constant: float = 0.0,
) -> dict[str, float]:
    """Column -> fill value. A column without any value has none and is missing from the result."""
    df = nan_to_null(df)
    columns = list(columns)
    if not columns:
        return {}
    if strategy == "median":
        found = {c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in columns}).items()}
    elif strategy == "mean":
        rows = aggregate_cells(numeric_cells(df, columns), columns, {"v": F.avg("x")})
        found = {r.column: r.v for r in rows.collect()}
    elif strategy == "most_frequent":
        found = _modes(df, columns, numeric=True)
    elif strategy == "constant":
        rows = aggregate_cells(numeric_cells(df, columns), columns, {"n": F.count("x")})
        found = {r.column: float(constant) for r in rows.collect() if r.n}
    else:
        raise ValueError(f"Unknown numeric strategy {strategy!r}. Use mean, median, most_frequent or constant")
    return {c: found[c] for c in columns if found.get(c) is not None}


def _modes(df: DataFrame, columns: Sequence[str], numeric: bool = False) -> dict[str, object]:
    """Most frequent present value per column, the smallest of equally frequent ones.

    Whole numbers are counted as such: a double would merge neighbours above 2^53. One beyond that comes back as an int.
    """
    columns = list(columns)
    whole = [c for c in columns if numeric and isinstance(field_type(df, c), T.IntegralType)]
    if whole:
        counts = value_counts(df, whole).where("value IS NOT NULL").withColumn("v", F.col("value").cast("decimal(20, 0)"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("best"))
        found = {r.column: int(r.v) for r in best.select("column", "best.v").collect()}
        found = {c: float(v) if abs(v) <= 2**53 else v for c, v in found.items()}
        rest = [c for c in columns if c not in whole]
        return {**found, **(_modes(df, rest, True) if rest else {})}
    if numeric:
        counts = numeric_cells(df, columns).where("x IS NOT NULL").groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.select(F.get(F.array(*[F.lit(c) for c in columns]), F.col("c")).alias("column"), F.col("x").alias("value"), "n")
    else:
        counts = value_counts(df, columns).where("value IS NOT NULL")
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("best"))
    return {r.column: r.v for r in best.select("column", "best.v").collect()}


def categorical_fill(
    df: DataFrame, columns: Sequence[str], strategy: str = "most_frequent", constant: str = MISSING_VALUE
) -> dict[str, str]:
    """Column -> fill text."""
    if strategy == "constant":
        return dict.fromkeys(columns, constant)
    if strategy != "most_frequent":
        raise ValueError(f"Unknown categorical strategy {strategy!r}. Use most_frequent or constant")
    return _modes(nan_to_null(df), columns) if columns else {}


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace missing values by the fitted ones."""
    df = nan_to_null(df)
    made = {}
    for c, v in values.items():
        kind = "double" if isinstance(v, float) else "bigint" if isinstance(v, int) else "string"
        made[c] = F.coalesce(col(c).cast(kind), F.lit(v))
    return df.withColumns(made)


def scale_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Column -> (mean, population deviation); a constant column is divided by 1."""
    if not columns:
        return {}
    df = nan_to_null(df)
    rows = aggregate_cells(numeric_cells(df, columns), columns, {"m": F.avg("x"), "s": F.stddev_pop("x")})
    return {r.column: (r.m, r.s or 1.0) for r in rows.collect() if r.m is not None}


def scale(df: DataFrame, statistics: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in statistics.items()}
    )


def level_counts(
    df: DataFrame, columns: Sequence[str], max_levels: int = MAX_LEVELS
) -> dict[str, dict[str | None, int]]:
    """Column -> value -> rows, NULL included, from one pass over all columns.

    The levels live on the driver and in the model, so a column with more than ``max_levels`` is
    refused rather than cut short.
    """
    columns = list(columns)
    if not columns:
        return {}
    most = (max_levels + 1) * len(columns)
    rows = value_counts(nan_to_null(df), columns).limit(most + 1).collect()
    per: dict[str, dict[str | None, int]] = {c: {} for c in columns}
    for r in rows:
        per[r.column][r.value] = r.n
    for c, levels in per.items():
        if sum(v is not None for v in levels) > max_levels or len(rows) > most:
            raise ValueError(
                f"Column {c!r} or another has more than {max_levels} levels: pool rare ones, hash it, or leave it out"
            )
    return per


def _kept_and_rare(levels: Mapping[str, int], min_frequency: float | None) -> tuple[list[str], list[str]]:
    total = sum(levels.values())
    rare = {v for v, n in levels.items() if min_frequency is not None and n < min_frequency * total}
    return sorted(set(levels) - rare), sorted(rare)


def fitted_levels(
    df: DataFrame, columns: Sequence[str], min_frequency: float | None = None, max_levels: int = MAX_LEVELS
) -> dict[str, tuple[list[str], list[str]]]:
    """Column -> (sorted kept levels, sorted infrequent levels) of the present values.

    With ``min_frequency`` a level with a smaller share of the rows is infrequent.
    """
    per = level_counts(df, columns, max_levels)
    return {
        c: _kept_and_rare({v: n for v, n in levels.items() if v is not None}, min_frequency)
        for c, levels in per.items()
    }


def pool_rare_levels(df: DataFrame, column: str, min_frequency: float = 0.01) -> DataFrame:
    """Replace levels with a smaller share of the present rows by ``__infrequent__``."""
    value = col(column).cast("string")
    counts = df.where(value.isNotNull()).groupBy(value.alias("__level")).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    # the levels stay a table, however many there are: the kept ones are 1 / min_frequency at most
    kept = counts.where(F.col("__n") >= min_frequency * total).select("__level")
    if min_frequency >= 1e-4:
        kept = F.broadcast(kept)
    names = df.columns
    joined = df.withColumn("__value", value).join(kept, F.col("__value") == F.col("__level"), "left")
    pooled = F.when(F.col("__value").isNotNull() & F.col("__level").isNull(), INFREQUENT).otherwise(F.col("__value"))
    return joined.withColumn(column, pooled).select(*[col(c) for c in names])


def one_hot(df: DataFrame, column: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Indicator columns ``<column>_<level>`` in level order; an unknown or missing value is all zeros."""
    if levels is None:
        levels = fitted_levels(df, [column])[column][0]
    value = col(column).cast("string")
    return df.withColumns({f"{column}_{v}": F.coalesce((value == v).cast("int"), F.lit(0)) for v in levels})


class Preprocessor:
    """What to do with which columns; ``fit`` turns it into saved stages.

    Numeric columns are imputed and scaled, categorical ones imputed and one-hot encoded, numeric
    block first. Columns not listed are left out; a column without any value is dropped and named in
    ``dropped``.
    """

    def __init__(
        self,
        numeric: Sequence[str] | None = None,
        categorical: Sequence[str] | None = None,
        numeric_strategy: str = "median",
        categorical_strategy: str = "most_frequent",
        scale_numeric: bool = True,
        min_frequency: float | None = None,
        numeric_constant: float = 0.0,
        categorical_constant: str = MISSING_VALUE,
        exclude: Sequence[str] = (),
    ):
        self.numeric, self.categorical = numeric, categorical
        self.numeric_strategy, self.categorical_strategy = numeric_strategy, categorical_strategy
        self.scale_numeric, self.min_frequency = scale_numeric, min_frequency
        self.numeric_constant, self.categorical_constant = numeric_constant, categorical_constant
        self.exclude = list(exclude)
        self.dropped: list[str] = []

    def columns(self, df: DataFrame, target: str | None = None) -> tuple[list[str], list[str]]:
        numeric, categorical = infer_columns(df, target, self.numeric, self.categorical)
        skip = {target, *self.exclude}
        return [c for c in numeric if c not in skip], [c for c in categorical if c not in skip]

    def fit(self, df: DataFrame, target: str | None = None) -> PipelineModel:
        numeric, categorical = self.columns(df, target)
        fill = numeric_fill(df, numeric, self.numeric_strategy, self.numeric_constant)
        filled = impute(df.select(*[col(c) for c in fill]), fill) if fill else df
        stats = scale_statistics(filled, list(fill)) if self.scale_numeric else {}
        text_fill, with_fill = {}, {}
        for c, levels in level_counts(df, categorical).items():
            present = {v: n for v, n in levels.items() if v is not None}
            if self.categorical_strategy == "constant":
                text_fill[c] = self.categorical_constant
            elif self.categorical_strategy != "most_frequent":
                raise ValueError(f"Unknown categorical strategy {self.categorical_strategy!r}")
            elif present:
                text_fill[c] = min(present, key=lambda v: (-present[v], v))
            else:
                continue
            if None in levels:
                present[text_fill[c]] = present.get(text_fill[c], 0) + levels[None]
            with_fill[c] = _kept_and_rare(present, self.min_frequency)
        self.dropped = [c for c in numeric if c not in fill] + [c for c in categorical if c not in text_fill]

        made, num_names, cat_names, labels = [], [], [], []
        for c in numeric:
            if c not in fill:
                continue
            x = f"coalesce(nanvl(CAST({quote(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), {number_sql(fill[c])})"
            if c in stats:
                mean, spread = stats[c]
                x = f"({x} - {number_sql(mean)}) / {number_sql(spread)}"
            made.append(f"{x} AS {quote('num__' + c)}")
            num_names.append(f"num__{c}")
        for c, (kept, rare) in with_fill.items():
            x = f"coalesce(CAST({quote(c)} AS STRING), {text_sql(text_fill[c])})"
            if rare:
                x = f"CASE WHEN {x} IN ({', '.join(text_sql(v) for v in rare)}) THEN '{INFREQUENT}' ELSE {x} END"
            made.append(f"{x} AS {quote('cat__' + c)}")
            cat_names.append(f"cat__{c}")
            labels.append([*kept, *([INFREQUENT] if rare else [])])
        if not made:
            raise ValueError("no usable feature columns")

        stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")]
        inputs = list(num_names)
        if cat_names:
            index_names = [f"idx__{c}" for c in cat_names]
            onehot_names = [f"hot__{c}" for c in cat_names]
            # "keep" gives unseen text a slot of its own, and dropLast removes exactly that slot
            # one indexer per column: label lists of different lengths do not survive one shared array
            for c, index, kept in zip(cat_names, index_names, labels):
                stages.append(StringIndexerModel.from_labels(kept, c, index, "keep"))
            encoder = OneHotEncoder(inputCols=index_names, outputCols=onehot_names, dropLast=True, handleInvalid="error")
            stages.append(encoder.fit(PipelineModel(stages).transform(df.limit(0))))
            inputs += onehot_names
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
        return PipelineModel(stages)


def transformed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The original columns and ``features``, without the stages' own columns."""
    out = model.transform(df)
    return out.select(*[col(c) for c in df.columns], "features")


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, in order."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    return [name for _i, name in slots]


