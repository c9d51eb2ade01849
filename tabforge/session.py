"""Session helpers: a tuned local session and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "tabforge", master: str | None = None, cpus: int = 8, scratch: str | None = None
) -> SparkSession:
    """A session with adaptive execution on. On a cluster pass no ``master`` and let spark-submit decide.

    ``scratch`` is the folder for intermediate tables where ``spark.checkpoint.dir`` is not set yet.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master).config("spark.sql.shuffle.partitions", str(cpus))
    session = builder.getOrCreate()
    if scratch and not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", scratch)
    return session


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a machine-local
    path would not survive the loss of an executor, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tabforge-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage like ``checkpoint()`` does, in a columnar format that later scans can prune.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
