"""Model factories by name, and fitting one model behind its preprocessing.

Parameters use the names users of in-memory libraries know; each factory maps them to the
distributed estimator with the same objective.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.calendar import holiday_sql
from tabforge.functions.columns import col, field_type, quote
from tabforge.functions.dates import CYCLE_NAMES, PART_NAMES, cycle_sql, parse_sql, part_sql
from tabforge.operators.preprocess import Preprocessor, feature_names, number_sql, text_sql

LABEL, RAW = "__label", "__raw_prediction"
MAX_CLASSES = 10_000


@dataclass(frozen=True)
class TrainingFacts:
    """What an objective needs to know about the training rows."""

    n_rows: int = 1
    target_std: float = 1.0
    n_classes: int = 2


# parameter name -> estimator setting, shared by the tree ensembles
_TREE = {"max_depth": "maxDepth", "max_bins": "maxBins", "min_samples_leaf": "minInstancesPerNode", "random_state": "seed"}
_MAX_DEPTH = 30  # the deepest tree the estimators grow


def _settings(params: Mapping, names: Mapping[str, str], defaults: Mapping) -> dict:
    unknown = sorted(set(params) - set(names))
    if unknown:
        raise ValueError(f"Unknown model parameters {unknown}. Available: {sorted(names)}")
    out = dict(defaults)
    for k, v in params.items():
        if k == "max_depth" and v is None:
            v = _MAX_DEPTH
        if k == "max_features":
            v = "all" if v in (None, 1.0) else str(v)
        out[names[k]] = v
    return out


def _logistic(params, facts: TrainingFacts):
    names = {"C": "C", "max_iter": "maxIter", "fit_intercept": "fitIntercept", "tol": "tol"}
    s = _settings(params, names, {"C": 1.0, "maxIter": 100})
    c = s.pop("C")
    return LogisticRegression(regParam=1.0 / (c * max(facts.n_rows, 1)), standardization=False, **s)


# solver "auto": the normal equation up to 4,096 features, L-BFGS beyond, so width is no limit
def _linear(params, _facts: TrainingFacts):
    return LinearRegression(**_settings(params, {"fit_intercept": "fitIntercept"}, {}))


def _ridge(params, facts: TrainingFacts):
    s = _settings(params, {"alpha": "alpha", "fit_intercept": "fitIntercept"}, {"alpha": 1.0})
    alpha = s.pop("alpha")
    # the estimator scales the target by its deviation before it applies the penalty
    penalty = alpha / max(facts.n_rows, 1) * facts.target_std
    return LinearRegression(elasticNetParam=0.0, standardization=False, regParam=penalty, **s)


def _forest(cls, subset: str):
    def make(params, _facts: TrainingFacts):
        names = {**_TREE, "n_estimators": "numTrees", "max_features": "featureSubsetStrategy", "max_samples": "subsamplingRate"}
        defaults = {"numTrees": 100, "maxDepth": _MAX_DEPTH, "featureSubsetStrategy": subset, "seed": 42}
        return cls(**_settings(params, names, defaults))

    return make


def _bagging(cls):
    def make(params, _facts: TrainingFacts):
        names = {**_TREE, "n_estimators": "numTrees", "max_samples": "subsamplingRate"}
        defaults = {
            "numTrees": 10, "maxDepth": _MAX_DEPTH, "featureSubsetStrategy": "all", "subsamplingRate": 1.0, "seed": 42,
        }
        return cls(**_settings(params, names, defaults))

    return make


def _boosting(cls, histogram: bool):
    def make(params, facts: TrainingFacts):
        rounds = "max_iter" if histogram else "n_estimators"
        names = {**_TREE, rounds: "maxIter", "learning_rate": "stepSize", "subsample": "subsamplingRate"}
        defaults = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5 if histogram else 3, "seed": 42}
        if histogram:
            defaults["maxBins"] = 255
        if histogram and params.get("max_depth", 0) is None:
            params = {**params, "max_depth": 5}
        model = cls(**_settings(params, names, defaults))
        if cls is GBTClassifier and facts.n_classes > 2:
            return OneVsRest(classifier=model)
        return model

    return make


CLASSIFIERS = {
    "logistic_regression": _logistic,
    "random_forest": _forest(RandomForestClassifier, "sqrt"),
    "gradient_boosting": _boosting(GBTClassifier, histogram=False),
    "hist_gradient_boosting": _boosting(GBTClassifier, histogram=True),
    "bagging": _bagging(RandomForestClassifier),
}
REGRESSORS = {
    "linear_regression": _linear,
    "ridge": _ridge,
    "random_forest": _forest(RandomForestRegressor, "all"),
    "gradient_boosting": _boosting(GBTRegressor, histogram=False),
    "hist_gradient_boosting": _boosting(GBTRegressor, histogram=True),
    "bagging": _bagging(RandomForestRegressor),
}


def model_registry(task: str) -> dict:
    return CLASSIFIERS if task == "classification" else REGRESSORS


def build_model(
    name: str, task: str, params: Mapping | None = None, facts: TrainingFacts = TrainingFacts()
):
    """The estimator of a name in the task's family, reading ``features`` and the internal label."""
    table = model_registry(task)
    if name not in table:
        raise ValueError(f"No {task} model is named {name!r}; there are {', '.join(table)}")
    return table[name](dict(params or {}), facts)


def _classes(df: DataFrame, target: str) -> list:
    rows = df.select(col(target)).where(col(target).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"Target {target!r} has more than {MAX_CLASSES} classes")
    return sorted(r[0] for r in rows)


def _label_sql(value, dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return text_sql(value)
    if isinstance(dtype, T.BooleanType):
        return "true" if value else "false"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return number_sql(value)
    return f"CAST('{value}' AS {dtype.simpleString()})"


def fit_model(
    train: DataFrame,
    target: str,
    task: str,
    model: str = "random_forest",
    params: Mapping | None = None,
    preprocessor: Preprocessor | None = None,
    lead_stages: Sequence = (),
) -> PipelineModel:
    """Preprocessing, model and label decoding as one saved unit.

    ``transform`` adds ``prediction`` in the target's type. ``lead_stages`` run before
    preprocessing, e.g. date features as a SQL stage.
    """
    leaky = [c for c in train.columns if c.startswith("lag_") and c.endswith("_diff")]
    if task == "timeseries" and leaky:
        raise ValueError(
            f"{leaky} contain the current target (y[t] - y[t-k]); use safe_lag_diffs instead of lag_diffs"
        )
    if model not in model_registry(task):
        build_model(model, task)
    preprocessor = preprocessor or Preprocessor()
    lead = list(lead_stages)
    train = PipelineModel(lead).transform(train) if lead else train
    train = train.where(col(target).isNotNull())
    dtype = field_type(train, target)
    if task == "classification":
        labels = _classes(train, target)
        listed = ", ".join(_label_sql(v, dtype) for v in labels)
        label = (F.array_position(F.expr(f"array({listed})"), col(target)) - 1).cast("double")
        facts = TrainingFacts(n_rows=train.count(), n_classes=len(labels))
        decode = f"element_at(array({listed}), CAST({RAW} AS INT) + 1)"
    else:
        label = col(target).cast("double")
        row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
        facts = TrainingFacts(n_rows=row.n, target_std=row.s or 1.0)
        decode = RAW
    prepared = preprocessor.fit(train, target)
    estimator = build_model(model, task, params, facts)
    estimator.setLabelCol(LABEL).setPredictionCol(RAW)
    features = prepared.transform(train.withColumn(LABEL, label)).select(LABEL, "features")
    fitted = estimator.setFeaturesCol("features").fit(features)
    output = SQLTransformer(statement=f"SELECT *, {decode} AS prediction FROM __THIS__")
    return PipelineModel([*lead, *prepared.stages, fitted, output])


def input_columns(model: PipelineModel, datetime_columns: Sequence[str] = ()) -> list[str]:
    """Columns a fitted model needs; date features made by its lead stage stand for their date column."""
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)][-1]
    prefixes = ("num__", "hot__cat__")
    names = [n.removeprefix(p) for n in assembler.getInputCols() for p in prefixes if n.startswith(p)]
    parts = (*PART_NAMES, *CYCLE_NAMES, "is_holiday", "days_to_holiday")
    derived = {f"{c}_{p}" for c in datetime_columns for p in parts}
    return [*datetime_columns, *[n for n in names if n not in derived]]


def date_stage(
    columns: Sequence[str],
    cyclical: bool = False,
    holidays: Sequence = (),
    formats: Sequence[str] = (),
) -> SQLTransformer:
    """Date features of ``columns`` as a stage of the saved model, so that batch and stream scoring
    derive them alike. ``holidays`` are the calendar's dates, written into the statement."""
    made = []
    for c in columns:
        ts = parse_sql(c, tuple(formats))
        sql = part_sql(ts)
        if cyclical:
            sql |= cycle_sql(ts)
        if holidays:
            sql |= holiday_sql(ts, list(holidays))
        made += [f"{v} AS {quote(f'{c}_{k}')}" for k, v in sql.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")


def has_probability(df: DataFrame) -> bool:
    return "probability" in df.columns


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), ``prediction``, and for a binary model ``probability`` of
    the second class."""
    out = model.transform(df)
    kept = [col(c) for c in (keep if keep is not None else df.columns) if c not in ("prediction", "probability")]
    made = ["prediction"]
    if has_probability(out) and getattr(_predictor(model), "numClasses", 0) == 2:
        made.append(vector_to_array(F.col("probability"))[1].alias("probability"))
    return out.select(*kept, *made)


def class_labels(model: PipelineModel, spark) -> list:
    """The classes of a fitted classifier, in the order of its scores: what its last stage decodes 0, 1, ... to."""
    fitted = _predictor(model)
    n = len(fitted.models) if isinstance(fitted, OneVsRestModel) else fitted.numClasses
    codes = spark.createDataFrame([(float(i),) for i in range(n)], f"{RAW} double")
    return [r.prediction for r in model.stages[-1].transform(codes).orderBy(RAW).collect()]


def class_probabilities(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), ``prediction``, and ``probability_<class>`` for every class; each row's sum to 1.

    A model of one boosted classifier a class has a margin for each; the chance that a margin gives its class, by the
    logistic function of twice the margin as the boosting defines it, is divided by the sum over the classes.
    """
    out = model.transform(df)
    if isinstance(_predictor(model), OneVsRestModel):
        chance = F.transform(vector_to_array(F.col("rawPrediction")), lambda m: 1 / (1 + F.exp(-2 * m)))
        total = F.aggregate(chance, F.lit(0.0), lambda s, v: s + v)
        out = out.withColumn("__chances", F.transform(chance, lambda v: v / total))
    else:
        out = out.withColumn("__chances", vector_to_array(F.col("probability")))
    made = [F.get("__chances", F.lit(i)).alias(f"probability_{c}") for i, c in enumerate(class_labels(model, df.sparkSession))]
    kept = [col(c) for c in (keep if keep is not None else df.columns) if c != "prediction"]
    return out.select(*kept, "prediction", *made)


def _predictor(model: PipelineModel):
    """The fitted estimator: the last stage that is not SQL."""
    return [s for s in model.stages if not isinstance(s, SQLTransformer)][-1]


def feature_importances(model: PipelineModel, df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k features by importance, from the model's summary and the assembler's slot names."""
    fitted = _predictor(model)
    names = feature_names(model.transform(df.limit(0)))
    pairs = [(n, float(v)) for n, v in zip(names, fitted.featureImportances.toArray())]
    rows = sorted(pairs, key=lambda p: (-p[1], p[0]))[:k]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def linear_coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Intercept and coefficient per feature of a linear model."""
    fitted = _predictor(model)
    names = feature_names(model.transform(df.limit(0)))
    rows = [("(intercept)", float(fitted.intercept))]
    rows += [(n, float(v)) for n, v in zip(names, fitted.coefficients.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
