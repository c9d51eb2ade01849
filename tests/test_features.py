import datetime
import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import lags, models, preprocess, splits
from tabforge.operators.preprocess import Preprocessor
from tests.conftest import rows

@pytest.fixture(scope="module")
def stamped(spark):
    """Days around the ends of two years, one of them in February of a leap year."""
    days = [datetime.date(2019, 12, 30) + datetime.timedelta(days=17 * i) for i in range(40)]
    return spark.createDataFrame([(d.isoformat(), d) for d in days], "when string, day date")


def test_parts_follow_the_calendar(stamped):
    found = rows(lags.add_datetime_features(stamped, "when", cyclical=True), "when")
    assert len(found) == 40
    for r in found:
        day = r["day"]
        assert (r["when_year"], r["when_month"], r["when_day"]) == (day.year, day.month, day.day)
        assert r["when_dayofweek"] == day.weekday() and r["when_is_weekend"] == (day.weekday() > 4)
        assert r["when_dayofyear"] == day.timetuple().tm_yday and r["when_weekofyear"] == day.isocalendar()[1]
        assert r["when_is_month_end"] == ((day + datetime.timedelta(days=1)).day == 1)
        turn = 2 * math.pi * day.month / 12
        assert abs(r["when_month_sin"] - math.sin(turn)) + abs(r["when_month_cos"] - math.cos(turn)) < 1e-9


def test_holidays_of_a_given_calendar(stamped, spark):
    feasts = [datetime.date(2020, 2, 29), datetime.date(2020, 9, 1), datetime.date(2021, 11, 30)]
    own = spark.createDataFrame([("QQ", None, f, "feast") for f in feasts], "country string, subdiv string, day date, name string")
    found = rows(lags.add_datetime_features(stamped, "when", holiday_country="QQ", calendar=own), "when")
    for r in found:
        ahead = [(f - r["day"]).days for f in feasts if f >= r["day"]]
        assert r["when_days_to_holiday"] == (min(ahead) if ahead else None)
        assert r["when_is_holiday"] == (r["day"] in feasts)
    with pytest.raises(ValueError, match="QX"):
        lags.add_datetime_features(stamped, "when", holiday_country="QX")


def test_us_holidays_by_rule(spark):
    days = [(datetime.date(y, m, d).isoformat(),) for y in (2022, 2027) for m, d in ((1, 1), (12, 25), (3, 3))]
    found = rows(lags.add_datetime_features(spark.createDataFrame(days, "d string"), "d", holiday_country="US"), "d")
    assert [r["d_is_holiday"] for r in found] == [1, 0, 1] * 2


def test_missing_and_bad_dates(spark):
    df = spark.createDataFrame([("2024-12-30",), ("not a date",), (None,)], "d string")
    found = rows(lags.add_datetime_features(df, "d", holiday_country="US"), "d")
    good = next(r for r in found if r["d"] == "2024-12-30")
    assert good["d_weekofyear"] == 1.0 and good["d_days_to_holiday"] == 2
    for r in found:
        if r is not good:
            assert r["d_year"] is None and r["d_days_to_holiday"] is None
            assert (r["d_is_weekend"], r["d_is_month_end"], r["d_is_holiday"]) == (0, 0, 0)


GAPS = [(0, 3.0), (1, None), (2, 8.0), (5, -1.0), (6, 4.5), (9, 4.5), (10, 0.0), (14, 7.25)]


@pytest.fixture(scope="module")
def series(spark):
    """A series with missing days and a missing value, out of order."""
    start = datetime.date(2021, 5, 3)
    made = [(start + datetime.timedelta(days=n), v) for n, v in GAPS]
    return spark.createDataFrame(made[::-1], "date date, y double")


def plain_lags(values, lag, window):
    """Rows (y, lag, past mean) whose columns are all there, from a list."""
    out = []
    for i, y in enumerate(values):
        past = [v for v in values[max(0, i - window) : i]]
        before = values[i - lag] if i >= lag else None
        if y is not None and before is not None and len(past) == window and None not in past:
            out.append((y, before, sum(past) / window))
    return out


@pytest.mark.parametrize("lag,window", [(1, 2), (2, 3), (3, 1)])
def test_lags_look_back_by_rows(series, lag, window):
    out = lags.add_lag_features(series, "y", "date", [lag], [window], ["mean"], date_parts=False)
    got = [(r["y"], r[f"lag_{lag}"], r[f"rolling_mean_{window}"]) for r in rows(out, "date")]
    assert got == plain_lags([v for _, v in GAPS], lag, window)


def test_differences(spark):
    values = [2.0 ** n - 3 * n for n in range(9)]
    df = spark.createDataFrame([(f"2022-03-{n + 1:02d}", v) for n, v in enumerate(values)], "date string, y double")
    raw = rows(lags.add_lag_features(df, "y", "date", [2], [], lag_diffs=True, date_parts=False), "date")
    assert [r["lag_2_diff"] for r in raw] == [b - a for a, b in zip(values, values[2:])]
    safe = rows(lags.add_lag_features(df, "y", "date", [2], [], safe_lag_diffs=True, date_parts=False), "date")
    assert [r["lag_2_diff_safe"] for r in safe] == [b - a for a, b in zip(values, values[2:])][:-1]
    with pytest.raises(ValueError, match="current target"):
        models.fit_model(lags.add_lag_features(df, "y", "date", [2], [], lag_diffs=True, date_parts=False), "y", "timeseries", "ridge")


def test_generated_names(spark):
    df = spark.range(25).selectExpr("date_add(DATE'2023-08-20', CAST(id AS INT)) AS date", "CAST(id * id AS DOUBLE) AS y")
    with pytest.raises(ValueError, match="kurtosis"):
        lags.add_lag_features(df, "y", "date", [1], [3], ["kurtosis"])
    out = lags.add_lag_features(df, "y", "date")
    # fixed values: the column names that users of the features rely on
    assert set(out.columns) == {
        "date", "y", "lag_1", "lag_7", "lag_14", "rolling_mean_7", "rolling_std_7", "rolling_mean_14", "rolling_std_14",
        "year", "month", "day", "dayofweek", "quarter", "weekofyear", "dayofyear", "is_month_end", "is_weekend",
    }
    assert out.count() == 25 - 14


def test_only_generated_columns_drop_rows(spark):
    df = spark.range(7).selectExpr("date_add(DATE'2023-01-30', CAST(id AS INT)) AS date", "id / 2 AS y", "nullif(id % 3, 0) AS note")
    assert lags.add_lag_features(df, "y", "date", [2], [], date_parts=False).count() == 5
    assert lags.add_lag_features(df, "y", "date", [2], [], date_parts=False, strict=True).count() == 3


def test_equal_dates_have_one_order(spark):
    df = spark.range(60).selectExpr("date_add(DATE'2023-01-30', CAST(id % 4 AS INT)) AS date", "CAST(id AS DOUBLE) AS y")
    make = lambda d, n: {tuple(r) for r in lags.add_lag_features(d, "y", "date", [1, 3], [4], date_parts=False, task_rows=n).collect()}
    assert make(df, 1000) == make(df.repartition(5), 1000) == make(df.repartition(3), 7)


def test_featurize_replaces_dates(stamped):
    df = stamped.selectExpr("when", "length(when) AS size", "1 AS target")
    out = lags.featurize(df, "regression", ["when"])
    assert "when" not in out.columns and {"when_quarter", "size", "target"} <= set(out.columns)
    assert lags.featurize(df, "regression", []).columns == lags.featurize(df, "timeseries", ["when"]).columns == df.columns


# -------------------------------------------------------------- preprocess ---


def test_imputers(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, None), (10.0, "b"), (None, "a")], "v double, s string")
    df = df.withColumn("empty", F.lit(None).cast("double"))
    fill = lambda how: preprocess.numeric_fill(df, ["v", "empty"], how)
    assert fill("median") == {"v": 2.5} and fill("mean") == {"v": 4.0}
    assert fill("most_frequent") == {"v": 1.0} and fill("constant") == {"v": 0.0}
    assert preprocess.categorical_fill(df, ["s"]) == {"s": "a"}
    with pytest.raises(ValueError):
        fill("guess")


def test_modes_of_large_ids(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 3, 7)] * 3 + [(big, 7), (big + 1, 5), (big + 2, 5)], "id long, small int")
    fill = preprocess.numeric_fill(df, ["id", "small"], "most_frequent")
    assert fill == {"id": big + 3, "small": 7.0}
    gaps = spark.createDataFrame([(None, 1), (4, 2)], "id long, small int")
    assert {r.id for r in preprocess.impute(gaps, {"id": big + 3}).collect()} == {4, big + 3}


def test_preprocessor_stages(spark, tmp_path):
    df = spark.createDataFrame(
        [(1.0, "b'q", 7.0), (2.0, "a", 7.0), (None, None, 7.0), (4.0, "b'q", 7.0)], "v double, s string, const double"
    ).withColumn("empty", F.lit(None).cast("double"))
    prep = Preprocessor()
    model = prep.fit(df)
    assert prep.dropped == ["empty"]
    out = preprocess.transformed(model, df)
    got = [r.features.toArray().tolist() for r in out.orderBy("v").collect()]
    mean, spread = 2.25, (((1 - 2.25) ** 2 + 2 * (2 - 2.25) ** 2 + (4 - 2.25) ** 2) / 4) ** 0.5
    assert [round(g[0], 9) for g in got] == [round((x - mean) / spread, 9) for x in (2, 1, 2, 4)]
    assert {g[1] for g in got} == {0.0}  # a constant column is divided by 1
    assert preprocess.feature_names(out)[-2:] == ["hot__cat__s_a", "hot__cat__s_b'q"]
    unseen = preprocess.transformed(model, spark.createDataFrame([(1.0, "zz", 7.0, 1.0)], df.schema)).first()
    assert unseen.features.toArray().tolist()[2:] == [0.0, 0.0]


def test_rare_levels(spark):
    df = spark.createDataFrame([("a",)] * 150 + [("b",)] * 60 + [("c",)], "s string")
    kept, rare = preprocess.fitted_levels(df, ["s"], 0.01)["s"]
    assert (kept, rare) == (["a", "b"], ["c"])
    pooled = {r[0] for r in preprocess.pool_rare_levels(df, "s").distinct().collect()}
    assert pooled == {"a", "b", preprocess.INFREQUENT}
    with pytest.raises(ValueError, match="levels"):
        preprocess.fitted_levels(df, ["s"], max_levels=2)


# ------------------------------------------------------------------ splits ---


@pytest.fixture(scope="module")
def thousand(spark):
    return spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 1, 0) AS y")


def test_three_way_sizes_and_balance(thousand):
    out = splits.split_three_way(thousand, "id", "y")
    sizes = {r.split: (r.n, r.share) for r in out.groupBy("split").agg(F.count("*").alias("n"), F.avg("y").alias("share")).collect()}
    assert sizes["test"][0] == 200 and sizes["val"][0] == 200 and sizes["train"][0] == 600
    assert all(abs(share - 0.334) < 0.05 for _n, share in sizes.values())


def test_splits_are_stable(thousand):
    a = splits.split_two_way(thousand, "id", "y")
    b = splits.split_two_way(thousand.repartition(7).orderBy(F.rand()), "id", "y")
    assert a.exceptAll(b).isEmpty()
    other = splits.split_two_way(thousand, "id", "y", seed=7)
    assert not a.exceptAll(other).isEmpty()
    share = splits.split_two_way(thousand, "id", mode="hash").where("split = 'test'").count()
    assert 150 < share < 250


def test_chronological_order(thousand):
    out = splits.split_chronological(thousand, ["id"])
    span = {r.split: (r.lo, r.hi) for r in out.groupBy("split").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    assert span["train"][1] < span["val"][0] <= span["val"][1] < span["test"][0]
    only = splits.split_chronological(thousand, ["id"], 0.2, 0.0)
    assert {r.split: r.n for r in splits.split_sizes(only).collect()} == {"train": 800, "test": 200}
    with pytest.raises(ValueError, match="nothing to train on"):
        splits.split_last(thousand.limit(1), ["id"])


def test_ties_are_cut_to_size(spark):
    df = spark.range(100).selectExpr("id", "date_add(DATE'2020-02-28', CAST(id % 4 AS INT)) AS d")
    for rows_per_task in (1000, 10):
        sizes = {r.split: r.n for r in splits.split_sizes(splits.split_chronological(df, ["d"], task_rows=rows_per_task)).collect()}
        assert sizes == {"train": 60, "val": 20, "test": 20}
        assert splits.split_last(df, ["d"], task_rows=rows_per_task).where("split = 'test'").count() == 20
        folds = splits.assign_folds(df, "regression", 5, order=["d"], shuffle=False, task_rows=rows_per_task)
        assert {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()} == dict.fromkeys(range(1, 6), 20)
    a, b = (splits.split_chronological(x, ["d"]) for x in (df, df.repartition(7)))
    assert a.exceptAll(b).isEmpty()


def test_any_number_of_classes(spark):
    df = spark.range(3000).selectExpr("id", "nullif(id % 700, 5) AS y")
    out = splits.split_two_way(df, "id", "y", 0.25, task_rows=100)
    assert out.where("split = 'test'").count() == 750
    per = {r.y: r.n for r in out.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    whole = {r.y: r.n for r in df.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert all(n // 4 <= per.get(c, 0) <= n // 4 + 1 for c, n in whole.items())
    folds = splits.assign_folds(df, "classification", 3, "id", target="y")
    assert {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()} == {1: 1000, 2: 1000, 3: 1000}


def test_folds(thousand):
    out = splits.assign_folds(thousand, "classification", 4, "id", target="y")
    per = {(r.fold, r.y): r["count"] for r in out.groupBy("fold", "y").count().collect()}
    assert {per[f, 1] for f in range(1, 5)} <= {83, 84} and sum(per.values()) == 1000
    assert {per[f, 0] + per[f, 1] for f in range(1, 5)} == {250}
    with pytest.raises(ValueError):
        splits.assign_folds(thousand, "classification", 4, "id")
    expanding = splits.assign_folds(thousand, "timeseries", 3, order=["id"])
    assert {r.fold: r["count"] for r in expanding.groupBy("fold").count().collect()} == {0: 250, 1: 250, 2: 250, 3: 250}
