"""Named queries over the given tables, each with its oracle SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LINEITEM_NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded_doubles(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Round float columns, so that engines that add in another order compare equal."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(col(f.name), per_column.get(f.name, digits)).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def union_sql(names, template: str) -> str:
    """``template`` per column, joined; ``{c}`` is the column."""
    return "\nUNION ALL\n".join(template.replace("{c}", c) for c in names)


# NULLs are put into two columns the same way in both engines, as the tables have none
INJECTED_SQL = (
    "(SELECT * REPLACE (nullif(l_linenumber, 3) AS l_linenumber, "
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity, "
    "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag) FROM lineitem)"
)


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.withColumns(
        {
            "l_linenumber": F.expr("nullif(l_linenumber, 3)"),
            "l_quantity": F.expr("CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END"),
            "l_returnflag": F.expr("CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_returnflag END"),
        }
    )


# A predictor that is a plain expression, so that metrics can be checked without a fitted model
PREDICTED_SQL = (
    "(SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_discount * 10 AS p, "
    "CASE WHEN l_discount * 10 >= 0.5 THEN 1 ELSE 0 END AS pred, l_quantity * 2100 AS price_pred, "
    "CASE WHEN l_quantity < 15 THEN 'A' WHEN l_quantity < 30 THEN 'N' ELSE 'R' END AS flag_pred FROM lineitem)"
)


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y",
        "l_discount * 10 AS p",
        "CASE WHEN l_discount * 10 >= 0.5 THEN 1 ELSE 0 END AS pred",
        "l_quantity * 2100 AS price_pred",
        "CASE WHEN l_quantity < 15 THEN 'A' WHEN l_quantity < 30 THEN 'N' ELSE 'R' END AS flag_pred",
    )


DAILY_SQL = (
    "(SELECT CAST(l_shipdate AS DATE) AS date, round(sum(l_extendedprice), 2) AS y FROM lineitem GROUP BY 1)"
)


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.round(F.sum("l_extendedprice"), 2).alias("y"))
