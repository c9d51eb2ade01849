"""Entry points: profile a table, train, score, evaluate, validate, cross-validate, tune, monitor."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.calendar import holiday_days, year_range
from tabforge.functions.columns import timestamp_of
from tabforge.operators import chartdata, metrics, models, profile, selection, splits
from tabforge.operators.drift import PSI_THRESHOLD, check_drift, drift_profile
from tabforge.operators.lags import add_lag_features
from tabforge.operators.preprocess import Preprocessor
from tabforge.session import materialise
from tabforge.sources import registry
from tabforge.sources.tables import check_columns, read_table, write_report, write_table


@dataclass
class Job:
    """What a run is about. Defaults are those of the tabular workflow; ``key`` names the rows."""

    target: str
    task: str = "classification"
    key: Sequence[str] = ()
    date: str | None = None
    series: Sequence[str] = ()
    tie: Sequence[str] = ()
    datetime_columns: Sequence[str] = ()
    cyclical: bool = False
    holiday_country: str | None = None
    holiday_subdiv: str | None = None
    calendar: DataFrame | None = None
    n_lags: Sequence[int] = (1, 7, 14)
    rolling_windows: Sequence[int] = (7, 14)
    rolling_stats: Sequence[str] = ("mean", "std")
    safe_lag_diffs: bool = False
    test_size: float = 0.2
    val_size: float = 0.2
    seed: int = 42
    model: str = "random_forest"
    params: Mapping = field(default_factory=dict)
    numeric_columns: Sequence[str] | None = None
    categorical_columns: Sequence[str] | None = None
    missing_strategy_numeric: str = "median"
    missing_strategy_categorical: str = "most_frequent"
    scale_numeric: bool = True
    min_frequency: float | None = None

    def config(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "calendar"}

    def row_order(self) -> list[str]:
        return [self.date or "date", *self.series, *self.tie]

    def not_features(self) -> list[str]:
        out = [*self.key, *self.series, *self.datetime_columns]
        return [*out, *self.row_order()] if self.task == "timeseries" else out

    def preprocessor(self) -> Preprocessor:
        return Preprocessor(
            self.numeric_columns,
            self.categorical_columns,
            self.missing_strategy_numeric,
            self.missing_strategy_categorical,
            self.scale_numeric,
            self.min_frequency,
            exclude=list(dict.fromkeys(self.not_features())),
        )


@dataclass(frozen=True)
class Task:
    """What differs between the kinds of task."""

    name: str
    split: Callable[[DataFrame, Job], DataFrame]
    features: Callable[[DataFrame, Job], DataFrame]
    measure: Callable[..., DataFrame]
    registry: Mapping


def _same(df: DataFrame, _job: Job) -> DataFrame:
    return df


def _split_keys(df: DataFrame, job: Job) -> Sequence[str]:
    """The key columns; without a key, equal rows are one unit and share a side."""
    return list(job.key) or df.columns


def _lagged(df: DataFrame, job: Job) -> DataFrame:
    return add_lag_features(
        df,
        job.target,
        job.date or "date",
        job.n_lags,
        job.rolling_windows,
        job.rolling_stats,
        safe_lag_diffs=job.safe_lag_diffs,
        cyclical=job.cyclical,
        holiday_country=job.holiday_country,
        holiday_subdiv=job.holiday_subdiv,
        calendar=job.calendar,
        series=job.series,
        tie=job.tie,
    )


TASKS = {
    "classification": Task(
        "classification",
        lambda df, job: splits.split_two_way(df, _split_keys(df, job), job.target, job.test_size, job.seed),
        _same,
        metrics.classification_metrics,
        models.CLASSIFIERS,
    ),
    "regression": Task(
        "regression",
        lambda df, job: splits.split_two_way(df, _split_keys(df, job), None, job.test_size, job.seed),
        _same,
        metrics.regression_metrics,
        models.REGRESSORS,
    ),
    "timeseries": Task(
        "timeseries",
        lambda df, job: splits.split_last(df, job.row_order(), job.test_size),
        _lagged,
        metrics.regression_metrics,
        models.REGRESSORS,
    ),
}


def get_task(name: str) -> Task:
    if name not in TASKS:
        raise ValueError(f"Unknown task {name!r}. Available: {list(TASKS)}")
    return TASKS[name]


def _lead_stages(df: DataFrame, job: Job) -> list:
    """Date features of a tabular task as a model stage; none for a time series."""
    if job.task == "timeseries" or not job.datetime_columns:
        return []
    days: list = []
    if job.holiday_country:
        spans = [year_range(df, timestamp_of(df, c)) for c in job.datetime_columns]
        known = [s for s in spans if s]
        if known:
            # ten more years, so that a served model knows its next holidays
            first, last = min(s[0] for s in known), max(s[1] for s in known) + 10
            table = holiday_days(df.sparkSession, job.holiday_country, job.holiday_subdiv, first, last, job.calendar)
            days = [r.day for r in table.collect()]
    return [models.date_stage(job.datetime_columns, job.cyclical, days)]


def run_eda(df: DataFrame, output_dir: str) -> dict[str, str]:
    """Write the profile and the three standard chart tables; returns their paths."""
    write_report(profile.profile_dataframe(df), f"{output_dir}/report")
    parts = {
        "missing_values": chartdata.missing_shares(df),
        "histograms": chartdata.histograms(df),
        "correlation_heatmap": chartdata.correlation_matrix(df),
    }
    for name, table in parts.items():
        write_report(table, f"{output_dir}/{name}")
    return {name: f"{output_dir}/{name}" for name in ("report", *parts)}


def _measured(task: Task, scored: DataFrame, job: Job, by: Sequence[str] = ()) -> DataFrame:
    if job.task == "classification" and "probability" in scored.columns:
        return task.measure(scored, job.target, "prediction", "probability", by=by)
    return task.measure(scored, job.target, "prediction", by=by)


def prepare(df: DataFrame, job: Job) -> DataFrame:
    """Features and the ``split`` label.

    Lag features are written to the shared scratch folder once: fitting reads them several times,
    and their windows are the one costly shuffle of a run.
    """
    task = get_task(job.task)
    data = task.features(df, job)
    if job.task == "timeseries":
        data = materialise(data, "features")
    return task.split(data, job)


@dataclass
class TrainResult:
    metrics: DataFrame
    model: PipelineModel
    scored: DataFrame
    train: DataFrame
    run_id: str | None = None


def run_training(
    df: DataFrame, job: Job, root: str | None = None, eda_dir: str | None = None
) -> TrainResult:
    """Profile (optional), featurize, split, fit, score the held-out rows, measure, register.

    With ``root`` the run is stored with its metrics, parameters and data profile.
    """
    spark = df.sparkSession
    task = get_task(job.task)
    if eda_dir is not None:
        run_eda(df, eda_dir)
    data = prepare(df, job)
    train, test = data.where("split = 'train'").drop("split"), data.where("split = 'test'").drop("split")
    model = models.fit_model(
        train, job.target, job.task, job.model, job.params, job.preprocessor(), _lead_stages(df, job)
    )
    scored = models.score(model, test)
    found = [(r.metric, r.value) for r in _measured(task, scored, job).collect()]
    table = spark.createDataFrame(found, "metric string, value double")
    run_id = None
    if root is not None:
        reference = drift_profile(train, _profiled(train, job))
        run_id = registry.save_run(spark, root, model, dict(found), job.params, reference, job.config())
        write_report(table, f"{root}/metrics", run_id, mode="append")
    return TrainResult(table, model, scored, train, run_id)


def _profiled(train: DataFrame, job: Job) -> list[str]:
    return [c for c in job.preprocessor().columns(train)[0] if c not in job.not_features()]


def run_baseline(df: DataFrame, job: Job, n_trees: int = 200, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Quick forest baseline: metrics of the held-out rows and the top importances.

    Rare levels under 1 % are pooled; classes are weighted by support. ``job.params`` may bound the
    trees' depth.
    """
    params = {"n_estimators": n_trees, "random_state": job.seed, **job.params}
    quick = Job(**{**job.__dict__, "model": "random_forest", "params": params, "min_frequency": 0.01})
    result = run_training(df, quick)
    if job.task == "classification":
        table = metrics.classification_metrics(result.scored, job.target, "prediction", average="weighted")
    else:
        table = result.metrics.where(F.col("metric").isin("mae", "rmse", "r2"))
    return table, models.feature_importances(result.model, result.train, k)


def forecast_chart(result: TrainResult, job: Job) -> DataFrame:
    """The forecast chart's rows of a trained time series."""
    return chartdata.forecast_series(result.train, result.scored, job.date or "date", job.target)


def score_table(
    model: PipelineModel, df: DataFrame, job: Job, keep: Sequence[str] | None = None
) -> DataFrame:
    """Check the columns, rebuild lags for a time series, and predict.

    The output has the row keys (or every input column without a key), for a time series its date
    and series, and the prediction. A target that happens to be present is not used.
    """
    task = get_task(job.task)
    if job.task == "timeseries":
        check_columns(df, [job.target, job.date or "date", *job.series])
        data, names = task.features(df, job), list(dict.fromkeys(job.row_order()))
    else:
        check_columns(df, models.input_columns(model, job.datetime_columns))
        data, names = df.drop(job.target), [c for c in job.key if c in df.columns] or None
    return models.score(model, data, keep if keep is not None else names)


def run_prediction(
    spark: SparkSession,
    job: Job,
    input_path: str,
    output_path: str,
    root: str | None = None,
    fallback: str | None = None,
    input_format: str | None = None,
    output_format: str | None = None,
) -> str:
    """Score a stored table with the production model, else the one at ``fallback``, and write it."""
    if root is not None:
        model = registry.load_production(spark, root, fallback=fallback)
    elif fallback is not None:
        model = PipelineModel.load(fallback)
    else:
        raise FileNotFoundError("neither a registry root nor a fallback model path was given")
    scored = score_table(model, read_table(spark, input_path, input_format), job)
    return write_table(scored, output_path, output_format)


def run_evaluation(
    df: DataFrame,
    job: Job,
    model: PipelineModel,
    min_metrics: Mapping[str, float] | None = None,
    max_metrics: Mapping[str, float] | None = None,
    output: str | None = None,
    raise_on_failure: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Recreate the split, score its test rows, and hold the metrics against the bounds."""
    test = prepare(df, job).where("split = 'test'").drop("split")
    found = [(r.metric, r.value) for r in _measured(get_task(job.task), models.score(model, test), job).collect()]
    table = df.sparkSession.createDataFrame(found, "metric string, value double")
    gate = metrics.evaluate_gate(table, min_metrics, max_metrics)
    if output is not None:
        write_report(table, f"{output}/metrics")
        write_report(gate, f"{output}/gate")
    if raise_on_failure and not metrics.gate_passed(gate):
        failed = [r.metric for r in gate.where("NOT passed").collect()]
        raise RuntimeError(f"evaluation gate failed: {sorted(failed)}")
    return table, gate


def run_validation(df: DataFrame, job: Job) -> DataFrame:
    """Sizes of the three-way split."""
    data = get_task(job.task).features(df, job)
    if job.task == "timeseries":
        labelled = splits.split_chronological(data, job.row_order(), job.test_size, job.val_size)
    else:
        strata = job.target if job.task == "classification" else None
        labelled = splits.split_three_way(data, _split_keys(data, job), strata, job.test_size, job.val_size, job.seed)
    return splits.split_sizes(labelled)


def _with_dates(df: DataFrame, job: Job) -> DataFrame:
    stages = _lead_stages(df, job)
    return PipelineModel(stages).transform(df) if stages else df


def run_crossval(
    df: DataFrame, job: Job, folds: int = 5, shuffle: bool = True, output: str | None = None, parallelism: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Per-fold metrics and their mean and deviation; a time series gets its lags first."""
    data = _with_dates(get_task(job.task).features(df, job), job)
    per_fold = selection.run_cv(
        data, job.target, job.task, job.model, job.params, folds, _split_keys(data, job),
        job.row_order() if job.task == "timeseries" else list(job.key), shuffle, job.seed, job.preprocessor, parallelism,
        job.not_features(),
    )
    summary = selection.aggregate_cv(per_fold)
    if output is not None:
        write_report(per_fold, f"{output}/per_fold")
        write_report(summary, f"{output}/aggregate")
    return per_fold, summary


def run_tune(
    df: DataFrame,
    job: Job,
    param_grid: Mapping[str, Sequence],
    method: str = "grid",
    n_iter: int = 10,
    folds: int = 5,
    parallelism: int = 1,
) -> tuple[PipelineModel, DataFrame]:
    """Search on the training part of the three-way split."""
    data = _with_dates(get_task(job.task).features(df, job), job)
    if job.task == "timeseries":
        labelled = splits.split_chronological(data, job.row_order(), job.test_size, job.val_size)
    else:
        strata = job.target if job.task == "classification" else None
        labelled = splits.split_three_way(data, _split_keys(data, job), strata, job.test_size, job.val_size, job.seed)
    train = labelled.where("split = 'train'").drop("split")
    return selection.run_tuning(
        train, job.target, job.task, param_grid, job.model, job.params, method, n_iter, folds,
        _split_keys(data, job), job.row_order() if job.task == "timeseries" else list(job.key),
        True, job.seed, job.preprocessor, parallelism, job.not_features(),
    )


def run_monitor(
    spark: SparkSession,
    root: str,
    live: DataFrame,
    threshold: float = PSI_THRESHOLD,
    raise_on_drift: bool = False,
) -> DataFrame:
    """PSI of a live batch against the production run's profile."""
    report = check_drift(registry.load_profile(spark, root), live, threshold)
    if raise_on_drift:
        drifted = [r.column for r in report.where("drifted").collect()]
        if drifted:
            raise RuntimeError(f"drift above {threshold}: {sorted(drifted)}")
    return report
