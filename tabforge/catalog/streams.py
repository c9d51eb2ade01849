"""Streaming queries over the events and lineitem tables, run until everything there is processed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.catalog.registry import query, rounded_doubles, table
from tabforge.operators import drift, models
from tabforge.operators.preprocess import Preprocessor
from tabforge.session import scratch_dir
from tabforge.streaming.lags import ROCKSDB, stream_lag_features
from tabforge.streaming.scoring import REASON, parse_records, score_stream, start_scoring
from tabforge.streaming.sources import read_stream, run_to_end, run_to_table
from tabforge.streaming.windows import stream_drift, stream_volume, with_open_windows


def _events(spark, sf_dir, name: str = "events"):
    # a glob also matches a single file, which a file stream does not accept as such
    return read_stream(spark, f"{sf_dir}/{name}.parque[t]", table(spark, sf_dir, name).schema)


@query(
    "stream_volume",
    "SELECT strftime(ts::DATE, '%Y-%m-%d') AS period_start, count(*) AS n FROM events GROUP BY 1, ts::DATE",
)
def volume(spark, sf_dir):
    out = run_to_table(stream_volume(_events(spark, sf_dir), "ts"), "volume")
    day_after = F.col("period_start") + F.expr("INTERVAL 1 DAY")
    out = with_open_windows(out, table(spark, sf_dir, "events"), "ts", lambda rows: stream_volume(rows, "ts"), day_after)
    return out.select(F.date_format("period_start", "yyyy-MM-dd").alias("period_start"), "n")


_DAYS = "SELECT DISTINCT ts::DATE AS d FROM events"


def _window_psi(c: str) -> str:
    return (
        f"SELECT strftime(d, '%Y-%m-%d') AS window_start, '{c}' AS \"column\", round(psi, 6) AS psi, psi > 0.25 AS drifted FROM ("
        f"WITH q AS (SELECT quantile_cont({c}::DOUBLE, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM events), "
        f"x AS (SELECT ts::DATE AS d, len(list_filter(q.edges, lambda v: v <= {c}::DOUBLE)) AS bin FROM events, q), "
        "b AS (SELECT unnest(range(10)) AS bin), e AS (SELECT bin, count(*) AS n FROM x GROUP BY 1), a AS (SELECT d, bin, count(*) AS n FROM x GROUP BY 1, 2), "
        f"days AS ({_DAYS}), "
        "s AS (SELECT days.d, coalesce(e.n, 0)::DOUBLE / (SELECT sum(n) FROM e) + 1e-6 AS ep, "
        "coalesce(a.n, 0)::DOUBLE / (SELECT sum(n) FROM a z WHERE z.d = days.d) + 1e-6 AS ap "
        "FROM days CROSS JOIN b LEFT JOIN e ON e.bin = b.bin LEFT JOIN a ON a.bin = b.bin AND a.d = days.d) "
        "SELECT d, sum((ap - ep) * ln(ap / ep)) AS psi FROM s GROUP BY d)"
    )


@query("stream_psi", _window_psi("value") + " UNION ALL " + _window_psi("user_id"))
def psi(spark, sf_dir):
    profile = drift.drift_profile(table(spark, sf_dir, "events"), ["value", "user_id"])
    out = run_to_table(stream_drift(_events(spark, sf_dir), profile, "ts"), "psi")
    measure = lambda rows: stream_drift(rows, profile, "ts")
    out = with_open_windows(out, table(spark, sf_dir, "events"), "ts", measure, F.col("window_end"))
    out = out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")).drop("window_end")
    return rounded_doubles(out)


@query(
    "stream_score",
    "WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 3) AS prediction FROM lineitem, m",
)
def score(spark, sf_dir):
    """A model fitted on the batch table scores the same table as a stream."""
    li = table(spark, sf_dir, "lineitem")
    model = models.fit_model(
        li.select("l_quantity", "l_extendedprice"), "l_extendedprice", "regression", "linear_regression", None,
        Preprocessor(["l_quantity"], [], scale_numeric=False),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    stream = score_stream(_events(spark, sf_dir, "lineitem"), model, keys, target="l_extendedprice")
    return rounded_doubles(run_to_table(stream, "score"), 3)


@query(
    "stream_lags",
    "SELECT event_type, event_id, value, lag_1, lag_3, rolling_mean_4 FROM (SELECT event_type, event_id, value, ts, "
    "lag(value, 1) OVER w AS lag_1, lag(value, 3) OVER w AS lag_3, "
    "CASE WHEN count(value) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) = 4 THEN "
    "round(avg(value) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 5) END AS rolling_mean_4 "
    "FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)) "
    "WHERE value IS NOT NULL AND rolling_mean_4 IS NOT NULL AND lag_1 IS NOT NULL AND lag_3 IS NOT NULL",
)
def lag_stream(spark, sf_dir):
    """Every row the batch operator keeps, to the last one of the stream."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        make = lambda s: stream_lag_features(s, "value", "ts", ["event_type"], "event_id", [1, 3], [4], ["mean"])
        out = run_to_end(_events(spark, sf_dir), "ts", make, "lags")
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return rounded_doubles(out.drop("ts_us"), 5)


_RECORD = "CASE o_orderkey % 10 WHEN 0 THEN 'Missing columns: [\"x\"]' WHEN 1 THEN 'a value of the wrong type' WHEN 2 THEN 'not a JSON object' ELSE 'scored' END"


@query("stream_bad_records", f"SELECT {_RECORD} AS reason, count(*) AS n FROM orders GROUP BY 1")
def bad_records(spark, sf_dir):
    """A stream of JSON records, three tenths of them bad in one of three ways: scored ones and those set aside, by reason."""
    base = scratch_dir(spark, "records")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(o_custkey % 50 AS DOUBLE) AS x", "o_totalprice")
    model = models.fit_model(orders.withColumn("y", F.expr("x * 3 + o_totalprice")), "y", "regression", "linear_regression", None,
                             Preprocessor(["x", "o_totalprice"], []))
    key, whole = F.col("o_orderkey") % 10, F.to_json(F.struct("o_orderkey", "x", "o_totalprice"))
    text = (
        F.when(key == 0, F.to_json(F.struct("o_orderkey", "o_totalprice")))
        .when(key == 1, F.to_json(F.struct("o_orderkey", F.lit("many").alias("x"), "o_totalprice")))
        .when(key == 2, F.concat(F.lit("<"), whole))
        .otherwise(whole)
    )
    orders.select(text.alias("value")).write.parquet(f"{base}/in")
    schema = T.StructType.fromDDL("o_orderkey long, x double, o_totalprice double")
    records = parse_records(read_stream(spark, f"{base}/in"), schema, models.input_columns(model))
    start_scoring(records, model, f"{base}/out", f"{base}/bad", f"{base}/checkpoint", ["o_orderkey"], available_now=True).awaitTermination()
    scored = spark.read.parquet(f"{base}/out").where("prediction IS NOT NULL").select(F.lit("scored").alias("reason"))
    aside = spark.read.parquet(f"{base}/bad").select(F.col(REASON).alias("reason"))
    return scored.union(aside).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
