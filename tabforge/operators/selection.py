"""Cross-validation and parameter search over the whole preprocess-and-fit unit.

Folds are a label column, so each fold is a filter on one frame. Features are computed once
and kept; statistics, encoding and model are fitted again on each fold's training rows.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.foldfits import held_out_predictions
from tabforge.operators.metrics import classification_metrics, compute_metrics, regression_metrics
from tabforge.operators.models import fit_model, score
from tabforge.operators.preprocess import Preprocessor
from tabforge.operators.splits import assign_folds

FOLD = "__fold"


def _parts(df: DataFrame, task: str, i: int) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows of fold i; a time series trains only on what came before."""
    held = F.col(FOLD) == i
    before = F.col(FOLD) < i if task == "timeseries" else ~held
    return df.where(before).drop(FOLD), df.where(held).drop(FOLD)


def _folded(df, target, task, folds, key, order, shuffle, seed) -> DataFrame:
    out = assign_folds(df, task, folds, key, order, target, shuffle, seed)
    return out.withColumnRenamed("fold", FOLD).persist(StorageLevel.MEMORY_AND_DISK)


def _names(value) -> list[str]:
    return [] if value is None else [value] if isinstance(value, str) else list(value)


def _fit(train, target, task, model, params, preprocessor, skip) -> PipelineModel:
    prep = preprocessor() if preprocessor is not None else Preprocessor()
    prep.exclude = [*prep.exclude, *skip]
    return fit_model(train, target, task, model, params, prep)


def _measure(fitted, held, target, task) -> list[tuple[str, float | None]]:
    scored = score(fitted, held)
    if task == "classification":
        rows = classification_metrics(
            scored, target, "prediction", "probability" if "probability" in scored.columns else None
        )
    else:
        rows = compute_metrics(task)(scored, target, "prediction")
    return [(r.metric, r.value) for r in rows.collect()]


def _linear_errors(data, target, task, folds, model, candidates, preprocessor, skip):
    """Rows ``fold, candidate, metric, value`` of a linear model fitted from sums, where that is possible."""
    if any(c.startswith("lag_") and c.endswith("_diff") for c in data.columns):
        return None  # refused where models are fitted
    prep = preprocessor() if preprocessor is not None else Preprocessor()
    prep.exclude = [*prep.exclude, *skip]
    found = held_out_predictions(data, target, task, FOLD, folds, model, candidates, prep)
    return None if found is None else regression_metrics(found, "y", "prediction", ["fold", "candidate"]).collect()


def run_cv(
    df: DataFrame,
    target: str,
    task: str,
    model: str = "random_forest",
    params: Mapping | None = None,
    folds: int = 5,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    shuffle: bool = True,
    seed: int = 42,
    preprocessor=None,
    parallelism: int = 1,
    skip: Sequence[str] | None = None,
) -> DataFrame:
    """Per-fold metrics as rows ``(fold, metric, value)``. ``key`` and ``order`` are not features
    unless ``skip`` names other columns to leave out.

    ``preprocessor`` is a factory of ``Preprocessor``; ``parallelism`` folds are fitted at a time. Linear and ridge
    regressions of bounded width are fitted for all folds from one scan (``foldfits``).
    """
    spark = df.sparkSession
    skip = [*_names(key), *order] if skip is None else list(skip)
    data = _folded(df, target, task, folds, key, order, shuffle, seed)

    def one(i: int):
        train, held = _parts(data, task, i)
        fitted = _fit(train, target, task, model, params, preprocessor, skip)
        return [(i, name, value) for name, value in _measure(fitted, held, target, task)]

    try:
        errors = _linear_errors(data, target, task, folds, model, [params or {}], preprocessor, skip)
        if errors is not None:
            rows = [(r.fold, r.metric, r.value) for r in errors]
            return spark.createDataFrame(rows, "fold int, metric string, value double")
        with ThreadPool(max(1, parallelism)) as pool:
            rows = [r for part in pool.map(one, range(1, folds + 1)) for r in part]
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "fold int, metric string, value double")


def aggregate_cv(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation per metric over the folds that have it."""
    return per_fold.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("n_folds")
    )


def parameter_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of ``model__<param>`` lists, first name varying slowest in sorted order."""
    if not grid:
        raise ValueError("param_grid must be set for tuning")
    wrong = [k for k in grid if not k.startswith("model__")]
    if wrong:
        raise ValueError(f"Only model__<param> can be tuned, not {wrong}")
    names = sorted(grid)
    return [dict(zip(names, values)) for values in product(*(grid[n] for n in names))]


def run_tuning(
    df: DataFrame,
    target: str,
    task: str,
    param_grid: Mapping[str, Sequence],
    model: str = "random_forest",
    params: Mapping | None = None,
    method: str = "grid",
    n_iter: int = 10,
    folds: int = 5,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    shuffle: bool = True,
    seed: int = 42,
    preprocessor=None,
    parallelism: int = 1,
    skip: Sequence[str] | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Grid or random search by weighted f1 or negative MAE; the best is fitted again on all rows.

    Returns the model and one row per candidate: ``rank, params, mean_score, method``, best first.
    """
    candidates = parameter_grid(param_grid)
    if method == "random":
        candidates = random.Random(seed).sample(candidates, min(n_iter, len(candidates)))
    elif method != "grid":
        raise ValueError(f"Unknown tuning method {method!r}. Use grid or random")
    spark = df.sparkSession
    skip = [*_names(key), *order] if skip is None else list(skip)
    data = _folded(df, target, task, folds, key, order, shuffle, seed)

    def merged(candidate: Mapping) -> dict:
        return {**(params or {}), **{k.removeprefix("model__"): v for k, v in candidate.items()}}

    def one(job: tuple[int, int]):
        at, i = job
        train, held = _parts(data, task, i)
        fitted = _fit(train, target, task, model, merged(candidates[at]), preprocessor, skip)
        scored = score(fitted, held)
        if task == "classification":
            rows = classification_metrics(scored, target, "prediction", average="weighted")
            return at, rows.where("metric = 'f1'").first().value
        return at, -compute_metrics(task)(scored, target, "prediction").where("metric = 'mae'").first().value

    try:
        errors = _linear_errors(data, target, task, folds, model, [merged(c) for c in candidates], preprocessor, skip)
        if errors is not None:
            scores = [(r.candidate, -r.value) for r in errors if r.metric == "mae"]
        else:
            with ThreadPool(max(1, parallelism)) as pool:
                scores = pool.map(one, list(product(range(len(candidates)), range(1, folds + 1))))
        mean = [sum(s for a, s in scores if a == at) / folds for at in range(len(candidates))]
        order_best = sorted(range(len(candidates)), key=lambda at: (-mean[at], at))
        best = candidates[order_best[0]]
        fitted = _fit(data.drop(FOLD), target, task, model, merged(best), preprocessor, skip)
    finally:
        data.unpersist()
    rows = [
        (rank + 1, {k: str(v) for k, v in candidates[at].items()}, float(mean[at]), method)
        for rank, at in enumerate(order_best)
    ]
    table = spark.createDataFrame(rows, "rank int, params map<string,string>, mean_score double, method string")
    return fitted, table
