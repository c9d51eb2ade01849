"""Run registry as append-only tables: ``runs`` and ``promotions`` under one root folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = (
    "run_id string, created_at string, model_path string, metrics map<string,double>, "
    "params map<string,string>, profile_path string, config string"
)
PROMOTIONS = "name string, run_id string, promoted_at string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one before the first append."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def runs(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/runs", RUNS)


def promotions(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/promotions", PROMOTIONS)


def save_run(
    spark: SparkSession,
    root: str,
    model: PipelineModel,
    metrics: Mapping[str, float],
    params: Mapping[str, object] | None = None,
    profile: DataFrame | None = None,
    config: Mapping[str, object] | None = None,
) -> str:
    """Store model and profile, then append the run. Ids are UTC seconds plus a random ending."""
    now = _now()
    run_id = f"{now:%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:8]}"
    model_path = f"{root}/models/{run_id}"
    model.write().save(model_path)
    profile_path = None
    if profile is not None:
        profile_path = f"{root}/profiles/{run_id}"
        profile.write.parquet(profile_path)
    row = (
        run_id,
        now.isoformat(timespec="microseconds"),
        model_path,
        {k: float(v) for k, v in metrics.items() if v is not None},
        {k: str(v) for k, v in (params or {}).items()},
        profile_path,
        json.dumps(dict(config or {}), default=str, sort_keys=True),
    )
    # the row comes last: a run that can be seen is complete
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return run_id


def promote(spark: SparkSession, root: str, run_id: str, name: str = "production") -> None:
    """Make a stored run the one served under ``name``."""
    if runs(spark, root).where(F.col("run_id") == run_id).isEmpty():
        raise FileNotFoundError(f"No such run: {run_id} in {root}")
    row = (name, run_id, _now().isoformat(timespec="microseconds"))
    spark.createDataFrame([row], PROMOTIONS).coalesce(1).write.mode("append").parquet(f"{root}/promotions")


def latest(promoted: DataFrame) -> DataFrame:
    """``name, run_id`` of the newest promotion of each name."""
    return promoted.groupBy("name").agg(F.max_by("run_id", "promoted_at").alias("run_id"))


def production_run(spark: SparkSession, root: str, name: str = "production"):
    """The promoted run's row; FileNotFoundError when nothing was promoted."""
    current = latest(promotions(spark, root)).where(F.col("name") == name).first()
    if current is None:
        raise FileNotFoundError(f"Nothing is promoted as {name!r} under {root}")
    return runs(spark, root).where(F.col("run_id") == current.run_id).first()


def load_production(
    spark: SparkSession, root: str, name: str = "production", fallback: str | None = None
) -> PipelineModel:
    """The promoted model, else the one at the fallback path."""
    try:
        return PipelineModel.load(production_run(spark, root, name).model_path)
    except FileNotFoundError:
        if fallback is None:
            raise
        return PipelineModel.load(fallback)


def load_profile(spark: SparkSession, root: str, name: str = "production") -> DataFrame:
    """The data profile stored with the promoted run."""
    path = production_run(spark, root, name).profile_path
    if path is None:
        raise FileNotFoundError("the promoted run has no profile")
    return spark.read.parquet(path)
