"""Time columns: detection, gaps and frequency, volume per period, target by time quartile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import (
    col,
    field_type,
    first_columns,
    is_time,
    nan_to_null,
    numeric_columns,
    rounded,
    seconds_between,
    timestamp_of,
)
from tabforge.plans.aggregates import aggregate_cells, numeric_cells, union_all
from tabforge.plans.ordering import TASK_ROWS, order_cuts, running_totals, segment_number, with_previous, with_tie
from tabforge.session import materialise

PERIODS = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month",
           "quarter": "interval 3 months", "year": "interval 1 year"}


def parse_rates(df: DataFrame, formats: Sequence[str] = (), sample: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """``(column, parse_rate)`` of every text column: share of present values that parse as dates.

    Over the whole column, or over its first ``sample`` values if ``order`` says which come first.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, parse_rate double")

    def parsed(c: str) -> Column:
        """1 or 0 for a present value, NULL for a missing one."""
        return F.when(col(c).isNotNull(), timestamp_of(df, c, formats).isNotNull().cast("double"))

    rate = {"parse_rate": F.coalesce(F.avg("x"), F.lit(0.0))}
    if sample is None or not order:
        flags = df.select(*[parsed(c).alias(c) for c in names])
        return aggregate_cells(numeric_cells(flags, names), names, rate)
    parts = []
    for c in names:
        head = df.where(col(c).isNotNull()).orderBy(*[col(o) for o in order]).limit(sample)
        parts.append(aggregate_cells(numeric_cells(head.select(parsed(c).alias(c)), [c]), [c], rate))
    return union_all(parts)


def detect_datetime_columns(
    df: DataFrame,
    forced: str | None = None,
    formats: Sequence[str] = (),
    sample: int | None = None,
    order: Sequence[str] = (),
) -> list[str]:
    """A forced column if it exists; else timestamp columns, then text columns that parse to over 90 %."""
    if forced and forced in df.columns:
        return [forced]
    found = [f.name for f in df.schema if is_time(f.dataType) and not isinstance(f.dataType, T.DateType)]
    found += [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    rates = {r.column: r.parse_rate for r in parse_rates(df, formats, sample, order).collect()}
    return found + [c for c in df.columns if rates.get(c, 0.0) > 0.9]


def time_gaps(
    df: DataFrame,
    column: str,
    formats: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
    n_distinct: int | None = None,
) -> DataFrame:
    """Gaps between neighbouring timestamps as rows ``(gap_seconds, n)``.

    Equal timestamps are counted first, so a hot one is a single row; each distinct value then
    looks back one step without a one-task window. The n-1 zero gaps of a repeated timestamp are
    kept as a weighted row. ``n_distinct`` is an estimate of the distinct timestamps, if known.
    """
    ts = timestamp_of(df, column, formats)
    n_distinct = _about_distinct(df, ts) if n_distinct is None else n_distinct
    counted = df.select(ts.alias("t")).where("t IS NOT NULL").groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    stepped = with_previous(counted, "t", {"previous": F.col("t")}, n_distinct, task_rows)
    gap = seconds_between(F.col("t"), F.col("previous"))
    rows = stepped.select(
        F.explode(
            F.array(
                F.struct(gap.alias("gap_seconds"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit(0.0).alias("gap_seconds"), (F.col("n") - 1).alias("n")),
            )
        ).alias("g")
    )
    return (
        rows.select("g.*")
        .where("gap_seconds IS NOT NULL AND n > 0")
        .groupBy("gap_seconds")
        .agg(F.sum("n").alias("n"))
    )


def _about_distinct(df: DataFrame, ts: Column) -> int:
    """A safe estimate of the number of distinct timestamps."""
    return int(1.2 * df.agg(F.approx_count_distinct(ts)).first()[0]) + 1


def gap_summary(gaps: DataFrame, few: bool, task_rows: int = TASK_ROWS) -> tuple[float | None, float | None]:
    """Weighted median and maximum of the gaps. ``few`` says that one task can hold them."""
    longest, total = F.max("gap_seconds").alias("longest"), F.sum("n").alias("total")
    if few:
        row = gaps.agg(longest, F.percentile("gap_seconds", F.lit(0.5), F.col("n")).alias("median")).first()
        return row.median, row.longest
    row = gaps.agg(longest, total, F.count(F.lit(1)).alias("rows")).first()
    if not row.total:
        return None, None
    summed = running_totals(gaps, "gap_seconds", ["n"], n_rows=row.rows, task_rows=task_rows)
    ranks = [(row.total - 1) // 2, row.total // 2]
    at = [(F.col("upto_n") > r) & (F.col("upto_n") - F.col("n") <= r) for r in ranks]
    low, high = summed.agg(*[F.max(F.when(a, F.col("gap_seconds"))) for a in at]).first()
    return (low + high) / 2, row.longest


MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
_DAY, _HOUR = 86400, 3600


def infer_frequency(
    df: DataFrame, column: str, formats: Sequence[str] = (), task_rows: int = TASK_ROWS, gaps: DataFrame | None = None
) -> str | None:
    """Frequency of the whole column by pandas' names, or None.

    ``D``/``h``/``min``/``s``/``ms``/``us`` and ``W-...`` with a multiple; month, quarter and year starts and ends (``MS``,
    ``QE-DEC``, ``2YS-JAN``) and their business forms; ``B``, ``bh`` and ``WOM-...``. Repeated or fewer than three timestamps
    have none. ``gaps`` is the result of ``time_gaps``, if there is one already.
    """
    gaps = time_gaps(df, column, formats, task_rows) if gaps is None else gaps
    gap = F.col("gap_seconds")
    g = gaps.agg(
        F.sum("n").alias("n"),
        F.min(gap).alias("least"),
        F.max(gap).alias("most"),
        F.count_if(gap % _DAY != 0).alias("broken_days"),
        F.sum(F.when(gap == 3 * _DAY, F.col("n")).otherwise(0)).alias("threes"),
        F.count_if(~gap.isin(1.0 * _DAY, 3.0 * _DAY)).alias("not_business"),
        F.count_if(~gap.isin(1.0 * _HOUR, 17.0 * _HOUR, 65.0 * _HOUR)).alias("not_hours"),
    ).first()
    if not g.n or g.n < 2 or g.least <= 0:
        return None
    if not g.broken_days:
        return _calendar_frequency(df, timestamp_of(df, column, formats), g)
    if g.least == _HOUR < g.most and not g.not_hours:
        return "bh"
    if g.least != g.most:
        return None
    micros = round(g.least * 1_000_000)
    for size, name in ((_HOUR * 1_000_000, "h"), (60_000_000, "min"), (1_000_000, "s"), (1000, "ms"), (1, "us")):
        if micros % size == 0:
            return _times(micros // size, name)
    return None


def _times(count: int, name: str) -> str:
    return name if count == 1 else f"{count}{name}"


def _calendar_frequency(df: DataFrame, ts: Column, g) -> str | None:
    """Frequency of timestamps whose gaps, summed up in ``g``, are whole days."""
    dated = df.select(ts.alias("t")).where("t IS NOT NULL")
    t = F.col("t")
    day, weekday, left = F.dayofmonth(t), F.weekday(t), F.dayofmonth(F.last_day(t)) - F.dayofmonth(t)
    number = F.year(t) * 12 + F.month(t) - 1
    c = dated.agg(
        F.min(t).alias("first"),
        F.min(number).alias("lo"),
        F.max(number).alias("hi"),
        F.count_distinct(number).alias("months"),  # no more than the calendar has
        F.bool_and(day == 1).alias("S"),
        F.bool_and((day == 1) | ((day <= 3) & (weekday == 0))).alias("BS"),
        F.bool_and(left == 0).alias("E"),
        F.bool_and((left == 0) | ((left < 3) & (weekday == 4))).alias("BE"),
        F.count_if(weekday > 4).alias("weekends"),
        F.count_if(weekday == 0).alias("mondays"),
        F.min(weekday).alias("weekday"),
        F.max(weekday).alias("last_weekday"),
        F.min((day - 1).cast("int") / 7).cast("int").alias("week"),
        F.max((day - 1).cast("int") / 7).cast("int").alias("last_week"),
    ).first()
    step, rest = divmod(c.hi - c.lo, g.n)
    steady = c.months == g.n + 1 and not rest
    if steady and step > 1:
        steady = not dated.agg(F.count_if((number - c.lo) % step != 0)).first()[0]
    place = next((p for p in ("S", "BS", "E", "BE") if c[p]), None)
    if steady and place:
        business, edge = place[:-1], place[-1]
        if step % 12 == 0:
            return _times(step // 12, f"{business}Y{edge}-{MONTHS[c.first.month - 1]}")
        if step % 3 == 0:
            return _times(step // 3, f"{business}Q{edge}-{MONTHS[(c.first.month - 1) % 3 + 9]}")
        return _times(step, f"{business}M{edge}")
    names = "MON TUE WED THU FRI SAT SUN".split()
    if g.least == g.most:
        days = int(g.least) // _DAY
        return _times(days, "D") if days % 7 else _times(days // 7, f"W-{names[c.first.weekday()]}")
    # among weekdays a step of three days that doesn't end on a Monday leaves a day out
    if g.least == _DAY and not g.not_business and not c.weekends and g.threes == c.mondays - (c.first.weekday() == 0):
        return "B"
    if steady and step == 1 and c.weekday == c.last_weekday and c.week == c.last_week < 4:
        return f"WOM-{c.week + 1}{names[c.weekday]}"
    return None


def datetime_summary(
    df: DataFrame, column: str, formats: Sequence[str] = (), task_rows: int = TASK_ROWS
) -> DataFrame:
    """One row: min, max, missing or unparseable count, median and longest gap in seconds, frequency."""
    ts = timestamp_of(df, column, formats)
    row = df.agg(
        F.min(ts).cast("string").alias("min"),
        F.max(ts).cast("string").alias("max"),
        F.count_if(ts.isNull()).alias("n_nat"),
        F.approx_count_distinct(ts).alias("d"),
    ).first()
    about = int(1.2 * row.d) + 1
    gaps = materialise(time_gaps(df, column, formats, task_rows, about), "gaps")
    median, longest = gap_summary(gaps, about <= task_rows, task_rows)
    found = (row.min, row.max, row.n_nat, median, longest, infer_frequency(df, column, formats, task_rows, gaps))
    return df.sparkSession.createDataFrame(
        [found],
        "min string, max string, n_nat long, median_gap_seconds double, max_gap_seconds double, inferred_freq string",
    )


def volume_trend(
    df: DataFrame, column: str, rule: str | None = None, formats: Sequence[str] = (), task_rows: int = TASK_ROWS
) -> DataFrame:
    """``(period, n)`` with empty periods as 0. No rule: months if the median gap is 20 days or more.

    A month, quarter or year is labelled by its last day, a day or week by its first.
    """
    if rule is None:
        about = _about_distinct(df, timestamp_of(df, column, formats))
        gaps = time_gaps(df, column, formats, task_rows, about)
        median, _longest = gap_summary(gaps, about <= task_rows, task_rows)
        rule = "month" if median is not None and median >= 20 * 86400 else "day"
    if rule not in PERIODS:
        raise ValueError(f"Unknown rule {rule!r}. Use one of {sorted(PERIODS)}")
    ts = timestamp_of(df, column, formats)
    counts = (
        df.select(F.date_trunc(rule, ts).cast("date").alias("start"))
        .where("start IS NOT NULL")
        .groupBy("start")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # O(periods) rows from here on
    spine = counts.agg(F.min("start").alias("lo"), F.max("start").alias("hi")).select(
        F.explode(F.expr(f"sequence(lo, hi, {PERIODS[rule]})")).alias("start")
    )
    last = {
        "day": F.col("start"),
        "week": F.col("start"),
        "month": F.last_day("start"),
        "quarter": F.last_day(F.add_months("start", 2)),
        "year": F.last_day(F.add_months("start", 11)),
    }[rule]
    return (
        spine.join(counts, "start", "left")
        .select(last.alias("period"), F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("period")
    )


def time_quartile_means(
    df: DataFrame,
    date: str,
    target: str,
    tie: Sequence[str] = (),
    k: int | None = None,
    buckets: int = 4,
    digits: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Mean of the target and of the first k (all by default) numeric columns per equal-count stretch of time.

    The stretches are cut at the ranks where a quantile cut of the ranks puts them; the cuts are
    found without sorting the table and applied as literals.
    """
    df = nan_to_null(df)
    dated = df.where(col(date).isNotNull())
    n = dated.count()
    dated, order = with_tie(dated, [date, *tie])
    ranks = [q * (n - 1) // buckets + 1 for q in range(1, buckets)]
    cuts = order_cuts(dated, order, ranks, n, task_rows)
    numeric = first_columns(numeric_columns(df, [target]), k)
    names = list(dict.fromkeys(([target] if isinstance(field_type(df, target), T.NumericType) else []) + numeric))
    labelled = dated.withColumn("quartile", segment_number(dated, order, [cuts[r] for r in sorted(set(ranks)) if r in cuts]) + 1)
    return aggregate_cells(
        numeric_cells(labelled, names, [F.col("quartile")]), names, {"mean": rounded(F.avg("x"), digits)}, by=["quartile"]
    ).select(F.concat(F.lit("Q"), F.col("quartile").cast("string")).alias("quartile"), "column", "mean")
