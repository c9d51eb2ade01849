"""Feature, preprocessing, split and fold queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.catalog.registry import (
    DAILY_SQL,
    INJECTED_SQL,
    daily_revenue,
    injected,
    query,
    rounded_doubles,
    table,
)
from tabforge.functions.calendar import day_dimension, us_federal_calendar
from tabforge.operators import lags, preprocess, splits
from tabforge.plans.ordering import with_global_rank

# orders with every eleventh date missing, in both engines
DATED_SQL = "(SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders)"


def dated(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS d"
    )


def part_columns(d: str, p: str) -> str:
    """The nine date parts in the other engine's words."""
    return (
        f"year({d})::INT AS {p}year, month({d})::INT AS {p}month, day({d})::INT AS {p}day, "
        f"(isodow({d}) - 1)::INT AS {p}dayofweek, quarter({d})::INT AS {p}quarter, week({d})::DOUBLE AS {p}weekofyear, "
        f"dayofyear({d})::INT AS {p}dayofyear, coalesce(({d}::DATE = last_day({d}))::INT, 0) AS {p}is_month_end, "
        f"coalesce((isodow({d}) >= 6)::INT, 0) AS {p}is_weekend"
    )


@query("date_parts_orders", f"SELECT o_orderkey, {part_columns('d', 'd_')} FROM {DATED_SQL}")
def date_parts_orders(spark, sf_dir):
    return lags.add_datetime_features(dated(spark, sf_dir).drop("o_totalprice"), "d").drop("d")


@query(
    "cyclical_orders",
    "SELECT o_orderkey, round(sin(2 * pi() * month(d) / 12), 9) + 0.0 AS d_month_sin, round(cos(2 * pi() * month(d) / 12), 9) + 0.0 AS d_month_cos, "
    "round(sin(2 * pi() * (isodow(d) - 1) / 7), 9) + 0.0 AS d_dow_sin, round(cos(2 * pi() * (isodow(d) - 1) / 7), 9) + 0.0 AS d_dow_cos "
    f"FROM {DATED_SQL}",
)
def cyclical_orders(spark, sf_dir):
    out = lags.add_datetime_features(dated(spark, sf_dir), "d", cyclical=True)
    names = ["d_month_sin", "d_month_cos", "d_dow_sin", "d_dow_cos"]
    return out.select("o_orderkey", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in names])


def _nth(month: int, iso: int, n: int) -> str:
    """n-th ISO weekday of a month of year ``y``."""
    first = f"make_date(y, {month}, 1)"
    return f"({first} + ((({iso} - isodow({first}) + 7) % 7) + {7 * (n - 1)})::INT)"


_LAST_MONDAY_OF_MAY = "(make_date(y, 5, 31) - ((isodow(make_date(y, 5, 31)) - 1))::INT)"
_FIXED = {"newyear": "1, 1", "juneteenth": "6, 19", "july4": "7, 4", "veterans": "11, 11", "christmas": "12, 25"}
_HOLIDAYS_SQL = (
    "years AS (SELECT unnest(range((SELECT min(year(d)) FROM t), (SELECT max(year(d)) FROM t) + 2))::INT AS y), "
    "fixed AS ("
    + " UNION ALL ".join(
        f"SELECT make_date(y, {md}) AS day FROM years" + (" WHERE y >= 2021" if name == "juneteenth" else "")
        for name, md in _FIXED.items()
    )
    + "), h AS (SELECT day FROM fixed UNION "
    "SELECT CASE WHEN isodow(day) = 6 THEN day - 1 ELSE day + 1 END FROM fixed WHERE isodow(day) >= 6 UNION "
    + " UNION ".join(
        f"SELECT {e} FROM years"
        for e in (
            _nth(1, 1, 3), _nth(2, 1, 3), _LAST_MONDAY_OF_MAY, _nth(9, 1, 1), _nth(10, 1, 2), _nth(11, 4, 4),
        )
    )
    + "), hol AS (SELECT DISTINCT day::DATE AS day FROM h WHERE year(day) BETWEEN (SELECT min(y) FROM years) AND (SELECT max(y) FROM years)) "
)


@query(
    "holiday_features_orders",
    f"WITH t AS (SELECT * FROM {DATED_SQL}), {_HOLIDAYS_SQL} "
    "SELECT o_orderkey, coalesce((SELECT 1 FROM hol WHERE hol.day = t.d::DATE), 0) AS d_is_holiday, "
    "(SELECT min(hol.day) FROM hol WHERE hol.day >= t.d::DATE) - t.d::DATE AS d_days_to_holiday FROM t",
)
def holiday_features_orders(spark, sf_dir):
    out = lags.add_datetime_features(dated(spark, sf_dir), "d", holiday_country="US")
    return out.select("o_orderkey", "d_is_holiday", F.col("d_days_to_holiday").cast("long").alias("d_days_to_holiday"))


@query(
    "holiday_calendar_orders",
    f"WITH t AS (SELECT o_orderdate AS d FROM orders), {_HOLIDAYS_SQL}, "
    "days AS (SELECT unnest(generate_series(make_date((SELECT min(y) FROM years), 1, 1), make_date((SELECT max(y) FROM years), 12, 31), INTERVAL 1 DAY))::DATE AS day) "
    "SELECT days.day, (hol.day IS NOT NULL)::INT AS is_holiday, (SELECT min(h2.day) FROM hol h2 WHERE h2.day >= days.day) - days.day AS days_to_holiday "
    "FROM days LEFT JOIN hol ON hol.day = days.day",
)
def holiday_calendar_orders(spark, sf_dir):
    years = table(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")
    ).first()
    first, last = years.lo, years.hi + 1
    days = us_federal_calendar(spark, first, last).select("day").where(F.year("day").between(first, last)).distinct()
    return day_dimension(days, first, last).select("day", "is_holiday", F.col("days_to_holiday").cast("long"))


@query("featurize_orders", f"SELECT o_orderkey, o_totalprice, {part_columns('d', 'd_')} FROM {DATED_SQL}")
def featurize_orders(spark, sf_dir):
    return lags.featurize(dated(spark, sf_dir), "regression", ["d"])


# -------------------------------------------------------------------- lags ---


def _lag_sql(source: str, y: str, t: str, order: str, part: str, n_lags, windows, stats, extra: str = "", digits: int = 4) -> str:
    over = f"(PARTITION BY {part} ORDER BY {order})" if part else f"(ORDER BY {order})"
    sql = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    cols = [f"lag({y}, {k}) OVER {over} AS lag_{k}" for k in n_lags]
    for w in windows:
        frame = over[:-1] + f" ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        for s in stats:
            cols.append(
                f"CASE WHEN count({y}) OVER {frame} = {w} THEN round({sql[s]}({y}) OVER {frame}, {digits}) END AS rolling_{s}_{w}"
            )
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    keep = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"SELECT * {extra} FROM (SELECT *, {', '.join(cols)} FROM {source}) WHERE {keep} AND {y} IS NOT NULL"


@query(
    "lag_features_daily_revenue",
    "SELECT * REPLACE (date::VARCHAR AS date) FROM ("
    + _lag_sql(DAILY_SQL, "y", "date", "date", "", [1, 7, 14], [7, 14], ["mean", "std"], ", " + part_columns("date", "")) + ")",
)
def lag_features_daily_revenue(spark, sf_dir):
    out = lags.add_lag_features(daily_revenue(spark, sf_dir), "y", "date")
    return rounded_doubles(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")), 4)


@query(
    "rolling_stats_daily",
    "SELECT * REPLACE (date::VARCHAR AS date) FROM ("
    + _lag_sql(DAILY_SQL, "y", "date", "date", "", [2], [3, 30], ["mean", "std", "min", "max"]) + ")",
)
def rolling_stats_daily(spark, sf_dir):
    out = lags.add_lag_features(
        daily_revenue(spark, sf_dir), "y", "date", [2], [3, 30], ["mean", "std", "min", "max"], date_parts=False
    )
    return rounded_doubles(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")), 4)


@query(
    "lag_diffs_daily",
    "SELECT date::VARCHAR AS date, y, lag_1, lag_7, round(y - lag_1, 4) AS lag_1_diff, round(y - lag_7, 4) AS lag_7_diff, "
    "round(lag_1 - l2, 4) AS lag_1_diff_safe, round(lag_1 - l8, 4) AS lag_7_diff_safe FROM ("
    "SELECT *, lag(y, 1) OVER (ORDER BY date) AS lag_1, lag(y, 7) OVER (ORDER BY date) AS lag_7, "
    f"lag(y, 2) OVER (ORDER BY date) AS l2, lag(y, 8) OVER (ORDER BY date) AS l8 FROM {DAILY_SQL}) WHERE l8 IS NOT NULL",
)
def lag_diffs_daily(spark, sf_dir):
    out = lags.add_lag_features(
        daily_revenue(spark, sf_dir), "y", "date", [1, 7], [], lag_diffs=True, safe_lag_diffs=True, date_parts=False
    )
    return rounded_doubles(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")), 4)


_HOURLY_SQL = (
    "(SELECT event_type, date_trunc('hour', ts) AS hour, round(sum(value), 2) AS y FROM events GROUP BY 1, 2)"
)


def hourly(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour"))
        .agg(F.round(F.sum("value"), 2).alias("y"))
    )


@query(
    "lag_features_by_event_type",
    "SELECT * REPLACE (strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour) FROM ("
    + _lag_sql(_HOURLY_SQL, "y", "hour", "hour", "event_type", [1, 24], [3, 24], ["mean", "max"], digits=6) + ")",
)
def lag_features_by_event_type(spark, sf_dir):
    out = lags.add_lag_features(
        hourly(spark, sf_dir), "y", "hour", [1, 24], [3, 24], ["mean", "max"], date_parts=False, series=["event_type"]
    )
    return rounded_doubles(out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss")), 6)


@query(
    "lag_features_events_raw",
    _lag_sql(
        "(SELECT event_id, user_id, ts, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value FROM events)",
        "value", "ts", "ts, event_id", "", [1, 5], [4], ["mean", "min"],
    ).replace("SELECT * ", "SELECT event_id, user_id, value, lag_1, lag_5, rolling_mean_4, rolling_min_4 ", 1),
)
def lag_features_events_raw(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts", "CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value"
    )
    out = lags.add_lag_features(
        e, "value", "ts", [1, 5], [4], ["mean", "min"], date_parts=False, tie=["event_id"]
    )
    return rounded_doubles(out.drop("ts"), 4)


@query(
    "drop_missing_rows",
    f"SELECT count(*) AS n FROM {INJECTED_SQL} WHERE l_linenumber IS NOT NULL AND l_quantity IS NOT NULL AND l_returnflag IS NOT NULL",
)
def drop_missing_rows(spark, sf_dir):
    return injected(spark, sf_dir).na.drop("any").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_missing_strict",
    "SELECT event_id, value, lag_1 FROM (SELECT event_id, value, user_id, lag(value) OVER (ORDER BY ts, event_id) AS lag_1 FROM ("
    "SELECT * REPLACE (CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS value) "
    "FROM events)) WHERE value IS NOT NULL AND user_id IS NOT NULL AND lag_1 IS NOT NULL",
)
def drop_missing_strict(spark, sf_dir):
    """``strict`` leaves out rows that miss a value in any column, also one that no feature is made of."""
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id",
        "CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS value",
    )
    out = lags.add_lag_features(e, "value", "ts", [1], [], date_parts=False, tie=["event_id"], strict=True)
    return out.select("event_id", "value", "lag_1")


# -------------------------------------------------------------- preprocess ---

_FILLED = ["l_linenumber", "l_quantity"]


def _impute_sql(fill: str) -> str:
    sums = [
        f"round(sum(coalesce(CAST({c} AS DOUBLE), (SELECT {fill.replace('{c}', c)} FROM {INJECTED_SQL}))), 4) AS {c}"
        for c in _FILLED
    ]
    return f"SELECT l_orderkey, count(*) AS n, {', '.join(sums)} FROM {INJECTED_SQL} GROUP BY 1"


def _impute_query(strategy: str):
    def run(spark, sf_dir):
        li = injected(spark, sf_dir)
        values = preprocess.numeric_fill(li, _FILLED, strategy, constant=0.0)
        filled = preprocess.impute(li, values)
        sums = filled.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c)).alias(c) for c in _FILLED]
        )
        return rounded_doubles(sums, 4)

    return run


_MODE = (
    "CAST((SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM " + INJECTED_SQL + " WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1) AS DOUBLE)"
)
for _name, _fill in {
    "median": "quantile_cont(CAST({c} AS DOUBLE), 0.5)",
    "mean": "avg(CAST({c} AS DOUBLE))",
    "constant": "any_value(0.0::DOUBLE)",
}.items():
    query(f"impute_{_name}", _impute_sql(_fill))(_impute_query(_name))
query("impute_mode", _impute_sql("any_value(" + _MODE + ")"))(_impute_query("most_frequent"))


@query(
    "impute_category",
    "SELECT l_orderkey, coalesce(l_returnflag, (SELECT v FROM (SELECT l_returnflag AS v, count(*) AS n FROM "
    + INJECTED_SQL + " WHERE l_returnflag IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)) AS mode_filled, "
    "coalesce(l_returnflag, 'missing_value') AS constant_filled, count(*) AS n FROM " + INJECTED_SQL + " GROUP BY 1, 2, 3",
)
def impute_category(spark, sf_dir):
    li = injected(spark, sf_dir)
    modes = preprocess.categorical_fill(li, ["l_returnflag"])
    both = preprocess.impute(
        li.withColumns({"mode_filled": F.col("l_returnflag"), "constant_filled": F.col("l_returnflag")}),
        {"mode_filled": modes["l_returnflag"], "constant_filled": preprocess.MISSING_VALUE},
    )
    return both.groupBy("l_orderkey", "mode_filled", "constant_filled").agg(F.count(F.lit(1)).alias("n"))


@query(
    "standard_scale",
    "SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS o_totalprice FROM orders",
)
def standard_scale(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rounded_doubles(preprocess.scale(o, preprocess.scale_statistics(o, ["o_totalprice"])))


@query(
    "one_hot_flags",
    "SELECT l_orderkey, sum(coalesce((l_returnflag = 'A')::INT, 0))::BIGINT AS l_returnflag_A, "
    "sum(coalesce((l_returnflag = 'N')::INT, 0))::BIGINT AS l_returnflag_N, sum(coalesce((l_returnflag = 'R')::INT, 0))::BIGINT AS l_returnflag_R "
    f"FROM {INJECTED_SQL} GROUP BY 1",
)
def one_hot_flags(spark, sf_dir):
    out = preprocess.one_hot(injected(spark, sf_dir).select("l_orderkey", "l_returnflag"), "l_returnflag")
    names = [c for c in out.columns if c.startswith("l_returnflag_")]
    return out.groupBy("l_orderkey").agg(*[F.sum(c).alias(c) for c in names])


@query(
    "rare_level_pool",
    "WITH c AS (SELECT floor(p_retailprice)::BIGINT % 100 AS level, count(*) AS n FROM part GROUP BY 1) "
    "SELECT p_partkey, CASE WHEN c.n < 0.01 * (SELECT count(*) FROM part) THEN '__infrequent__' ELSE c.level::VARCHAR END AS level "
    "FROM part JOIN c ON floor(p_retailprice)::BIGINT % 100 = c.level",
)
def rare_level_pool(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", "CAST(floor(p_retailprice) AS BIGINT) % 100 AS level")
    return preprocess.pool_rare_levels(part, "level", 0.01)


_SIZE_SQL = "(SELECT p_partkey, p_retailprice, p_brand, p_type, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END AS p_size FROM part)"


@query(
    "preprocess_vector",
    f"WITH t AS (SELECT *, coalesce(p_size::DOUBLE, (SELECT quantile_cont(p_size::DOUBLE, 0.5) FROM {_SIZE_SQL})) AS s FROM {_SIZE_SQL}) "
    "SELECT p_partkey, round((p_retailprice - (SELECT avg(p_retailprice) FROM t)) / (SELECT stddev_pop(p_retailprice) FROM t), 6) AS f0, "
    "round((s - (SELECT avg(s) FROM t)) / (SELECT stddev_pop(s) FROM t), 6) AS f1, "
    "(SELECT count(DISTINCT p_type) FROM t) + 2 AS n_slots, "
    "(SELECT count(*) FROM (SELECT DISTINCT p_type AS o FROM t) WHERE o < p_type) + 2 AS hot_slot FROM t",
)
def preprocess_vector(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_retailprice", "p_type", "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END AS p_size"
    )
    prep = preprocess.Preprocessor(["p_retailprice", "p_size"], ["p_type"])
    out = preprocess.transformed(prep.fit(part), part)
    slots = vector_to_array(F.col("features"))
    hot = F.array_position(F.slice(slots, 3, 1_000_000), F.lit(1.0))
    return rounded_doubles(
        out.select(
            "p_partkey", slots[0].alias("f0"), slots[1].alias("f1"),
            F.size(slots).cast("long").alias("n_slots"), (hot + 1).alias("hot_slot"),
        )
    )


# ------------------------------------------------------------------ splits ---

_HASHED = "(SELECT *, md5(concat_ws('|', '42', o_orderkey::VARCHAR)) AS h FROM orders)"


def _alloc(total: str, strata: str, source: str) -> str:
    """Largest-remainder allocation of ``total`` over strata, as (label, n, take)."""
    return (
        f"(SELECT label, n, base + (row_number() OVER (ORDER BY rem DESC, label) <= tot - sum(base) OVER ())::INT AS take FROM ("
        f"SELECT label, n, tot, (n * tot) // sum(n) OVER () AS base, (n * tot) % sum(n) OVER () AS rem FROM ("
        f"SELECT {strata} AS label, count(*) AS n, {total} AS tot FROM {source} GROUP BY 1)))"
    )


@query(
    "split_two_way",
    f"WITH a AS {_alloc('(SELECT ceil(0.2 * count(*))::BIGINT FROM orders)', 'o_orderstatus', 'orders')} "
    "SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY h) <= a.take THEN 'test' ELSE 'train' END AS split "
    f"FROM {_HASHED} JOIN a ON o_orderstatus = a.label",
)
def split_two_way(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.split_two_way(o, "o_orderkey", "o_orderstatus")


@query(
    "split_two_way_hash",
    f"SELECT o_orderkey, CASE WHEN substr(h, 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split FROM {_HASHED}",
)
def split_two_way_hash(spark, sf_dir):
    return splits.split_two_way(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", mode="hash")


@query(
    "split_three_way",
    "SELECT o_orderkey, CASE WHEN k <= ceil(0.2 * n) THEN 'test' WHEN k <= ceil(0.2 * n) + ceil(0.25 * (n - ceil(0.2 * n))) THEN 'val' ELSE 'train' END AS split "
    f"FROM (SELECT o_orderkey, row_number() OVER (ORDER BY h) AS k, count(*) OVER () AS n FROM {_HASHED})",
)
def split_three_way(spark, sf_dir):
    return splits.split_three_way(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "split_three_way_strat",
    f"WITH a AS {_alloc('(SELECT ceil(0.2 * count(*))::BIGINT FROM orders)', 'o_orderstatus', 'orders')}, "
    f"r AS (SELECT o_orderkey, o_orderstatus, a.take, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h) AS k FROM {_HASHED} JOIN a ON o_orderstatus = a.label), "
    "lft AS (SELECT * FROM r WHERE k > take), "
    f"b AS {_alloc('(SELECT ceil(0.25 * count(*))::BIGINT FROM lft)', 'o_orderstatus', 'lft')} "
    "SELECT o_orderkey, o_orderstatus, CASE WHEN k <= r.take THEN 'test' WHEN k <= r.take + b.take THEN 'val' ELSE 'train' END AS split "
    "FROM r JOIN b ON r.o_orderstatus = b.label",
)
def split_three_way_strat(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.split_three_way(o, "o_orderkey", "o_orderstatus")


_CHRONO = (
    "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER () AS n FROM orders)"
)


@query(
    "split_chrono",
    "SELECT o_orderkey, CASE WHEN k <= n - 2 * (n * 2 // 10) THEN 'train' WHEN k <= n - (n * 2 // 10) THEN 'val' ELSE 'test' END AS split "
    f"FROM {_CHRONO}",
)
def split_chrono(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return splits.split_chronological(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


@query(
    "split_last_daily",
    "SELECT date::VARCHAR AS date, CASE WHEN k <= n - greatest(1, n * 2 // 10) THEN 'train' ELSE 'test' END AS split FROM ("
    f"SELECT date, row_number() OVER (ORDER BY date) - 14 AS k, count(*) OVER () - 14 AS n FROM {DAILY_SQL}) WHERE k > 0",
)
def split_last_daily(spark, sf_dir):
    featured = lags.add_lag_features(daily_revenue(spark, sf_dir), "y", "date")
    out = splits.split_last(featured, ["date"])
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "split")


@query(
    "split_sizes",
    f"WITH a AS {_alloc('(SELECT ceil(0.2 * count(*))::BIGINT FROM orders)', 'o_orderstatus', 'orders')} "
    "SELECT 'test' AS split, label AS o_orderstatus, take::BIGINT AS n FROM a UNION ALL SELECT 'train', label, (n - take)::BIGINT FROM a",
)
def split_sizes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.split_sizes(splits.split_two_way(o, "o_orderkey", "o_orderstatus"), ["o_orderstatus"])


@query(
    "folds_stratified",
    "WITH c AS (SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1), "
    "o AS (SELECT label, n, (sum(n % 5) OVER (ORDER BY label) - n % 5) % 5 AS turn FROM c), "
    "f AS (SELECT label, i + 1 AS fold, n // 5 + ((i - turn + 5) % 5 < n % 5)::INT AS size FROM o, (SELECT unnest(range(5)) AS i)), "
    "g AS (SELECT label, fold, sum(size) OVER (PARTITION BY label ORDER BY fold) AS hi, size FROM f), "
    f"r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h) AS k FROM {_HASHED}) "
    "SELECT o_orderkey, o_orderstatus, g.fold::INT AS fold FROM r JOIN g ON r.o_orderstatus = g.label AND r.k <= g.hi AND r.k > g.hi - g.size",
)
def folds_stratified(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.assign_folds(o, "classification", 5, "o_orderkey", target="o_orderstatus")


_FOLD_SIZES = (
    "g AS (SELECT fold, sum(size) OVER (ORDER BY fold) AS hi, size FROM (SELECT i + 1 AS fold, "
    "(SELECT count(*) FROM orders) // 7 + (i < (SELECT count(*) FROM orders) % 7)::INT AS size FROM (SELECT unnest(range(7)) AS i))) "
)


@query(
    "folds_shuffled",
    f"WITH {_FOLD_SIZES}, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h) AS k FROM {_HASHED}) "
    "SELECT o_orderkey, g.fold::INT AS fold FROM r JOIN g ON r.k <= g.hi AND r.k > g.hi - g.size",
)
def folds_shuffled(spark, sf_dir):
    return splits.assign_folds(table(spark, sf_dir, "orders").select("o_orderkey"), "regression", 7, "o_orderkey")


@query(
    "folds_contiguous",
    f"WITH {_FOLD_SIZES}, r AS (SELECT o_orderkey, k FROM {_CHRONO}) "
    "SELECT o_orderkey, g.fold::INT AS fold FROM r JOIN g ON r.k <= g.hi AND r.k > g.hi - g.size",
)
def folds_contiguous(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return splits.assign_folds(o, "regression", 7, order=["o_orderdate", "o_orderkey"], shuffle=False).drop("o_orderdate")


@query(
    "folds_expanding",
    "SELECT o_orderkey, greatest(0, CAST(floor((k - 1 - (n - 5 * (n // 6)))::DOUBLE / (n // 6)) AS BIGINT) + 1)::INT AS fold "
    f"FROM {_CHRONO}",
)
def folds_expanding(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return splits.assign_folds(o, "timeseries", 5, order=["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "chronological_rank",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rank FROM events",
)
def chronological_rank(spark, sf_dir):
    return with_global_rank(table(spark, sf_dir, "events"), ["ts", "event_id"]).select("event_id", "rank")


