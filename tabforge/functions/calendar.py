"""Holiday calendars as small dimension tables, and the two joins against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALENDAR_SCHEMA = "country string, subdiv string, day date, name string"

# United States federal holidays. kind "date" is a calendar date (month, day);
# kind "nth" is the n-th weekday of a month (weekday 0 = Monday, n = -1 for the last one).
# (name, kind, month, day, weekday, n, first year, last year)
US_RULES = [
    ("New Year's Day", "date", 1, 1, None, None, 1871, 9999),
    ("Martin Luther King Jr. Day", "nth", 1, None, 0, 3, 1986, 9999),
    ("Washington's Birthday", "date", 2, 22, None, None, 1879, 1970),
    ("Washington's Birthday", "nth", 2, None, 0, 3, 1971, 9999),
    ("Memorial Day", "date", 5, 30, None, None, 1888, 1970),
    ("Memorial Day", "nth", 5, None, 0, -1, 1971, 9999),
    ("Juneteenth National Independence Day", "date", 6, 19, None, None, 2021, 9999),
    ("Independence Day", "date", 7, 4, None, None, 1871, 9999),
    ("Labor Day", "nth", 9, None, 0, 1, 1894, 9999),
    ("Columbus Day", "date", 10, 12, None, None, 1937, 1969),
    ("Columbus Day", "nth", 10, None, 0, 2, 1970, 9999),
    ("Veterans Day", "date", 11, 11, None, None, 1938, 1970),
    ("Veterans Day", "nth", 10, None, 0, 4, 1971, 1977),
    ("Veterans Day", "date", 11, 11, None, None, 1978, 9999),
    ("Thanksgiving", "nth", 11, None, 3, 4, 1871, 9999),
    ("Christmas Day", "date", 12, 25, None, None, 1871, 9999),
]
_RULE_SCHEMA = "name string, kind string, month int, day int, weekday int, n int, first_year int, last_year int"


def us_federal_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """US federal holidays; a calendar-date holiday on a weekend adds its observed weekday."""
    rules = spark.createDataFrame(US_RULES, _RULE_SCHEMA).withColumn(
        "y", F.explode(F.expr(f"sequence({int(first_year)}, {int(last_year)})"))
    )
    start = F.expr("make_date(y, month, 1)")
    nth = F.expr(
        "date_add(make_date(y, month, 1), pmod(weekday - weekday(make_date(y, month, 1)), 7) + 7 * (n - 1))"
    )
    last = F.date_sub(F.last_day(start), F.expr("pmod(weekday(last_day(make_date(y, month, 1))) - weekday, 7)"))
    day = (
        F.when(F.col("kind") == "date", F.expr("make_date(y, month, day)"))
        .when(F.col("n") == -1, last)
        .otherwise(nth)
    )
    days = rules.where("y BETWEEN first_year AND last_year").select("name", "kind", day.alias("day"))
    observed = days.where("kind = 'date' AND weekday(day) >= 5").select(
        F.concat("name", F.lit(" (observed)")).alias("name"),
        F.expr("CASE WHEN weekday(day) = 5 THEN date_sub(day, 1) ELSE date_add(day, 1) END").alias("day"),
    )
    return (
        days.select("name", "day")
        .unionByName(observed)
        .select(
            F.lit("US").alias("country"), F.lit(None).cast("string").alias("subdiv"), "day", "name"
        )
    )


def holiday_days(
    spark: SparkSession,
    country: str,
    subdiv: str | None,
    first_year: int,
    last_year: int,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Distinct holiday dates of one country. ``calendar`` is a caller's table (``CALENDAR_SCHEMA``)."""
    if calendar is None:
        if country != "US" or subdiv is not None:
            raise ValueError(
                f"Unknown holiday country {country!r} (subdivision {subdiv!r}). Supported: ['US']; "
                "for others pass a calendar table"
            )
        calendar = us_federal_calendar(spark, first_year, last_year)
    else:
        calendar = calendar.where(F.col("country") == country)
        # country-wide days apply in every subdivision
        in_area = F.col("subdiv").isNull()
        if subdiv is not None:
            in_area = in_area | (F.col("subdiv") == subdiv)
        calendar = calendar.where(in_area)
        if calendar.isEmpty():
            raise ValueError(f"Unknown holiday country {country!r}: not in the calendar table")
    return calendar.select("day").where(F.year("day").between(first_year, last_year)).distinct()


def day_dimension(days: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """One row per calendar day with ``is_holiday`` and ``days_to_holiday`` (0 on the holiday).

    At most 366 rows a year, so the ordered window below never holds more than a calendar.
    """
    spark = days.sparkSession
    spine = spark.range(1).select(
        F.explode(
            F.expr(f"sequence(make_date({first_year}, 1, 1), make_date({last_year}, 12, 31), interval 1 day)")
        ).alias("day")
    )
    joined = spine.join(days.withColumn("holiday", F.col("day")), "day", "left")
    return joined.selectExpr(
        "day",
        "CAST(holiday IS NOT NULL AS INT) AS is_holiday",
        "datediff(min(holiday) OVER (PARTITION BY 0 ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),"
        " day) AS days_to_holiday",
    )


def year_range(df: DataFrame, ts: Column) -> tuple[int, int] | None:
    """First and last year of a timestamp expression; one aggregate, two numbers to the driver."""
    row = df.agg(F.min(F.year(ts)).alias("lo"), F.max(F.year(ts)).alias("hi")).first()
    return None if row.lo is None else (row.lo, row.hi)


def join_holidays(
    df: DataFrame,
    ts: Column,
    prefix: str,
    country: str,
    subdiv: str | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Add ``<prefix>is_holiday`` and ``<prefix>days_to_holiday`` by one equi-join on the day.

    The year after the last one is loaded too, so that December dates find their next holiday.
    A missing date gives 0 and NULL.
    """
    flag, gap = f"{prefix}is_holiday", f"{prefix}days_to_holiday"
    years = year_range(df, ts)
    if years is None:
        holiday_days(df.sparkSession, country, subdiv, 2000, 2000, calendar)
        return df.withColumns({flag: F.lit(0), gap: F.lit(None).cast(T.DoubleType())})
    first, last = years[0], years[1] + 1
    days = holiday_days(df.sparkSession, country, subdiv, first, last, calendar)
    dim = day_dimension(days, first, last).select(
        F.col("day").alias("__day"), F.col("is_holiday").alias(flag), F.col("days_to_holiday").cast("double").alias(gap)
    )
    # A calendar row is about 20 bytes, 366 rows a year: below a megabyte for a century.
    side = F.broadcast(dim) if last - first <= 1000 else dim
    out = df.withColumn("__ts_day", ts.cast("date"))
    out = out.join(side, F.col("__ts_day") == F.col("__day"), "left").drop("__day", "__ts_day")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def holiday_sql(ts: str, days: list) -> dict[str, str]:
    """The same two features for use inside a saved model stage.

    The days until the next holiday are written as one array with a number per calendar day, so a
    row costs one lookup. A date in a year that the calendar doesn't cover is an error, as it would score as an ordinary
    day; a missing date gives 0 and NULL.
    """
    if not days:
        return {"is_holiday": "0", "days_to_holiday": "CAST(NULL AS DOUBLE)"}
    known = sorted(set(days))
    first, gaps, at = known[0].replace(month=1, day=1), [], 0
    for i in range((known[-1] - first).days + 1):
        while (known[at] - first).days < i:
            at += 1
        gaps.append((known[at] - first).days - i)
    table = "array(" + ", ".join(map(str, gaps)) + ")"
    end = known[-1].replace(month=12, day=31)
    day = f"CAST({ts} AS DATE)"
    known_day = f"{day} IS NULL OR {day} BETWEEN DATE'{first.isoformat()}' AND DATE'{end.isoformat()}'"
    far = f"concat({day}, ' is beyond the holiday calendar of the model, {first.year} to {end.year}: train it again')"
    gap = f"IF({known_day}, get({table}, datediff({day}, DATE'{first.isoformat()}')), raise_error({far}))"
    return {
        "is_holiday": f"coalesce(CAST({gap} = 0 AS INT), 0)",
        "days_to_holiday": f"CAST({gap} AS DOUBLE)",
    }
