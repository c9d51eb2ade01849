import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabforge.operators import lags, splits, timeprofile
from tabforge.plans import ordering, quantiles
from tabforge.operators.drift import ks_two_sample


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on one value, heavy tails, missing values."""
    return spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.randn(2) * 10).alias("a"),
        F.exp(F.randn(3) * 15).alias("b"),
        F.when(F.rand(4) < 0.9, F.rand(5)).alias("c"),
        F.lit(None).cast("double").alias("empty"),
    )


@pytest.mark.parametrize("together,digits", [(200, (14, 13, 13, 12, 12)), (2, (14, 13, 13, 12, 12)), (3, (8,) * 8)])
def test_quantiles_equal_numpy(hot, monkeypatch, together, digits):
    monkeypatch.setattr(quantiles, "_TOGETHER", together)
    monkeypatch.setattr(quantiles, "_DIGITS", digits)
    data = hot.toPandas()
    probs = {c: [0, 0.1, 0.25, 0.5, 0.75, 0.99, 1] for c in ("a", "b", "c", "empty")}
    got = quantiles.exact_quantiles(hot, probs)
    for c in "abc":
        np.testing.assert_allclose(got[c], np.quantile(data[c].dropna(), probs[c]), rtol=1e-12)
    assert got["empty"] == [None] * 7
    assert quantiles.exact_quantiles(hot.limit(0), probs)["a"] == [None] * 7


def test_order_numbers_sort_like_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2.0), 1e300, np.inf])
    number = quantiles.order_number(x)
    assert (np.diff(number) >= 0).all() and number[4] == number[5] and len(set(number.tolist())) == len(x) - 1
    assert [quantiles.order_value(n) for n in number.tolist()] == (x + 0.0).tolist()


def test_quantiles_of_neighbouring_doubles_need_every_bit(spark):
    """Values that differ in their last bits only, and the greatest and least ones beside them."""
    values = [float(v) for v in np.nextafter(1.0, 2.0) + np.arange(40) * 2.0**-52] + [-1e308, 1e308, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    probs = [i / 42 for i in range(43)]
    assert quantiles.exact_quantiles(df, {"v": probs})["v"] == np.sort(values)[np.arange(43)].tolist()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_quantiles_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.exact_quantiles(df, {"v": [0.0, 0.3, 0.5, 1.0]})["v"]
    np.testing.assert_allclose(got, np.quantile(values, [0.0, 0.3, 0.5, 1.0]), rtol=1e-9, atol=1e-9)


def test_rank_with_hot_key(hot):
    order = ["a", "id"]
    got = ordering.with_global_rank(hot, order, task_rows=500).select("id", "rank")
    want = hot.select("id", F.row_number().over(W.orderBy(*order)).cast("long").alias("rank"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # the tie column cuts the hot value, so no bucket holds it whole
    buckets = ordering.RangeBuckets(hot, order, 9000, 500)
    sizes = hot.groupBy(buckets.column(hot)).count().agg(F.max("count")).first()[0]
    assert sizes < 2000


def test_rank_per_group_with_null_group(hot):
    df = hot.withColumn("g", F.when(F.col("id") % 4 > 0, F.col("id") % 4))
    got = ordering.with_global_rank(df, ["b", "id"], by=["g"], task_rows=300).select("id", "rank")
    want = df.select("id", F.row_number().over(W.partitionBy("g").orderBy("b", "id")).cast("long").alias("rank"))
    assert got.exceptAll(want).isEmpty()


def test_running_totals_and_neighbours(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k"), (F.col("id") % 5).alias("v"))
    got = ordering.running_totals(df, "k", ["v"], task_rows=60).select("k", "upto_v")
    want = df.select("k", F.sum("v").over(W.orderBy("k")).alias("upto_v"))
    assert got.exceptAll(want).isEmpty()
    for step, near in ((1, F.lag), (-1, F.lead)):
        got = ordering.with_previous(df, "k", {"p": F.col("k")}, task_rows=60, step=step).select("k", "p")
        want = df.select("k", near("k", 1).over(W.orderBy("k")).alias("p"))
        assert got.exceptAll(want).isEmpty()


def test_order_cuts_on_text_and_time(load):
    e = load("events")
    for order in (["ts", "event_id"], ["event_type", "event_id"]):
        want = [str(r.event_id) for r in e.orderBy(*order).select("event_id").collect()]
        got = ordering.order_cuts(e, order, [0, 17, 500, 999], task_rows=70)
        assert {k: v[-1] for k, v in got.items()} == {k: want[k] for k in (0, 17, 500, 999)}


def test_order_cuts_of_ties_need_few_literals(spark, monkeypatch):
    made, literals = [], ordering._literals
    monkeypatch.setattr(ordering, "_CUT_SAMPLE", 400)
    monkeypatch.setattr(ordering, "_literals", lambda df, order, rows: made.append(len(rows)) or literals(df, order, rows))
    # a missing key, a hot one, whole rows that repeat
    k = F.when(F.col("id") % 9 == 0, None).when(F.col("id") % 3 == 0, 40).otherwise(F.pmod(F.xxhash64("id"), F.lit(90)))
    df = spark.range(20_000).select(k.alias("k"), F.expr("if(id % 2 = 0, 1, id)").alias("v"))
    df, order = ordering.with_tie(df, ["k"])
    want = [tuple(None if x is None else str(x) for x in r) for r in df.orderBy(*order).select(*order).collect()]
    ranks = [0, 1, 2221, 4000, 9000, 15_000, 19_999]
    assert ordering.order_cuts(df, order, ranks, task_rows=20) == {r: want[r] for r in ranks}
    assert max(made) <= 4 * len(ranks)


def test_halo_equals_one_window(load):
    e = load("events")
    for series in ([], ["event_type"]):
        plain = lags.add_lag_features(e, "value", "ts", [1, 5], [3], ["min", "max"], date_parts=False, tie=["event_id"], series=series, safe_lag_diffs=True)
        halo = lags.add_lag_features(e, "value", "ts", [1, 5], [3], ["min", "max"], date_parts=False, tie=["event_id"], series=series, safe_lag_diffs=True, task_rows=50)
        assert plain.exceptAll(halo).isEmpty() and halo.exceptAll(plain).isEmpty() and plain.count() > 900


def test_exact_splits_do_not_depend_on_the_path(load):
    o = load("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    jobs = [
        lambda n: splits.split_three_way(o, "o_orderkey", "o_orderstatus", task_rows=n),
        lambda n: splits.split_chronological(o, ["o_orderdate", "o_orderkey"], task_rows=n),
        lambda n: splits.assign_folds(o, "classification", 5, "o_orderkey", target="o_orderstatus", task_rows=n),
        lambda n: splits.assign_folds(o, "timeseries", 4, order=["o_orderdate", "o_orderkey"], task_rows=n),
    ]
    for job in jobs:
        assert job(10**6).exceptAll(job(40)).isEmpty()


def test_ks_in_buckets(load):
    li = load("lineitem")
    a, b = li.where("l_linenumber < 4"), li.where("l_linenumber >= 4")
    one = {r.column: round(r.ks, 9) for r in ks_two_sample(a, b).collect()}
    many = {r.column: round(r.ks, 9) for r in ks_two_sample(a, b, task_rows=100).collect()}
    assert one == many


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_one_task_window_beyond_the_limit(load):
    e = load("events")
    plan = physical(lags.add_lag_features(e, "value", "ts", [1], [2], date_parts=False, tie=["event_id"], task_rows=100))
    # the only single-task exchange is the prefix sum over the per-bucket table
    single = plan.index("Exchange SinglePartition")
    assert plan.count("Exchange SinglePartition") == 1
    assert plan[single:].split("\n")[1].strip().startswith("+- HashAggregate(keys=[__bucket")
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_splits_are_projections(load):
    o = load("orders").select("o_orderkey", "o_orderstatus")
    for df in (
        splits.split_two_way(o, "o_orderkey"),
        splits.split_two_way(o, "o_orderkey", "o_orderstatus"),
        splits.split_two_way(o, "o_orderkey", mode="hash"),
        splits.split_chronological(load("orders"), ["o_orderdate", "o_orderkey"]),
    ):
        assert "Exchange hashpartitioning" not in physical(df) and "SinglePartition" not in physical(df)


def test_pruning_and_pushdown(load):
    plan = physical(timeprofile.volume_trend(load("orders"), "o_orderdate", "month"))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan
