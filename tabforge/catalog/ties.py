"""Splits on keys with ties and on many classes, and texts with line breaks in csv."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.registry import query, table
from tabforge.operators import preprocess, splits
from tabforge.session import scratch_dir
from tabforge.sources import tables

_BY_DATE = (
    "(SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS i, count(*) OVER () AS n FROM orders)"
)


def _per_day(df, label):
    """Rows per day and label: which rows of a day fall on a side is open, how many is not."""
    return df.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), label).agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_chrono_ties",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN i >= n - floor(0.2 * n) THEN 'test' "
    f"WHEN i >= n - floor(0.2 * n) - floor(0.2 * n) THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM {_BY_DATE} GROUP BY 1, 2",
)
def split_chrono_ties(spark, sf_dir):
    """Orders by their date alone, of which many share each day."""
    return _per_day(splits.split_chronological(table(spark, sf_dir, "orders"), ["o_orderdate"], task_rows=2000), "split")


@query(
    "folds_expanding_ties",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, ((i >= n - 5 * (n // 6))::INT + (i >= n - 4 * (n // 6))::INT "
    "+ (i >= n - 3 * (n // 6))::INT + (i >= n - 2 * (n // 6))::INT + (i >= n - (n // 6))::INT)::INTEGER AS fold, count(*) AS n "
    f"FROM {_BY_DATE} GROUP BY 1, 2",
)
def folds_expanding_ties(spark, sf_dir):
    out = splits.assign_folds(table(spark, sf_dir, "orders"), "timeseries", 5, order=["o_orderdate"], task_rows=2000)
    return _per_day(out, "fold")


@query(
    "split_many_classes",
    "WITH c AS (SELECT o_custkey AS y, count(*) AS k FROM orders GROUP BY 1), "
    "t AS (SELECT *, (sum(k) OVER ())::BIGINT AS n, ceil(0.2 * (sum(k) OVER ()))::BIGINT AS t FROM c), "
    "f AS (SELECT *, k * t // n AS whole, k * t % n AS rest FROM t), "
    "r AS (SELECT *, row_number() OVER (ORDER BY rest DESC, y) AS place, t - sum(whole) OVER () AS over FROM f) "
    "SELECT y AS o_custkey, (whole + (place <= over)::INT)::BIGINT AS n_test FROM r",
)
def split_many_classes(spark, sf_dir):
    """Test rows of every customer, with the customer as the class."""
    out = splits.split_two_way(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", task_rows=2000)
    return out.groupBy("o_custkey").agg(F.count_if(F.col("split") == "test").alias("n_test"))


@query(
    "pool_many_levels",
    "SELECT CASE WHEN k * 10 >= 0.0002 * n * 10 THEN l_partkey::VARCHAR ELSE '__infrequent__' END AS level, sum(k)::BIGINT AS n FROM ("
    "SELECT l_partkey, count(*) AS k, (SELECT count(*) FROM lineitem) AS n FROM lineitem GROUP BY 1) GROUP BY 1",
)
def pool_many_levels(spark, sf_dir):
    parts = table(spark, sf_dir, "lineitem").select("l_partkey")
    pooled = preprocess.pool_rare_levels(parts, "l_partkey", 0.0002)
    return pooled.groupBy(F.col("l_partkey").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("csv_line_breaks", "SELECT doc_id, text, lang FROM documents")
def csv_line_breaks(spark, sf_dir):
    """Whole texts with line breaks, commas and quotes, written as csv and read back."""
    path = scratch_dir(spark, "documents") + ".csv"
    tables.write_table(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return tables.read_table(spark, path, schema="doc_id long, text string, lang string")
