"""Time-series features that never see the current row's target, and date features for tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.functions import dates
from tabforge.functions.calendar import join_holidays
from tabforge.functions.columns import col, flat_columns, nan_to_null, timestamp_of
from tabforge.plans.ordering import TASK_ROWS, TIE, sort_keys, with_global_rank, with_tie

ROLLING_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def add_datetime_features(
    df: DataFrame,
    column: str,
    prefix: str | None = None,
    cyclical: bool = False,
    holiday_country: str | None = None,
    holiday_subdiv: str | None = None,
    calendar: DataFrame | None = None,
    formats: Sequence[str] = (),
) -> DataFrame:
    """Add ``<prefix>_year`` ... ``<prefix>_is_weekend``, optionally circle coordinates and holidays.

    ``prefix`` is the column name unless given; an empty one gives bare names. A value that does
    not parse gives NULL parts, 0 in the three flags and NULL days to the next holiday.
    """
    lead = f"{column}_" if prefix is None else (f"{prefix}_" if prefix else "")
    out = df.withColumn("__ts", timestamp_of(df, column, formats))
    sql = dates.part_sql("__ts")
    if cyclical:
        sql |= dates.cycle_sql("__ts")
    out = out.withColumns({f"{lead}{k}": F.expr(v) for k, v in sql.items()})
    if holiday_country:
        out = join_holidays(out, F.col("__ts"), lead, holiday_country, holiday_subdiv, calendar)
    return out.drop("__ts")


def featurize(
    df: DataFrame,
    task: str,
    datetime_columns: Sequence[str] | None = None,
    cyclical: bool = False,
    holiday_country: str | None = None,
    holiday_subdiv: str | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Replace datetime columns of a tabular task by their date features.

    Does nothing for a time series, whose lag features own the date, or without such columns.
    """
    if task not in ("classification", "regression") or not datetime_columns:
        return df
    for c in datetime_columns:
        df = add_datetime_features(
            df, c, None, cyclical, holiday_country, holiday_subdiv, calendar
        ).drop(c)
    return df


def lag_names(
    n_lags: Sequence[int],
    rolling_windows: Sequence[int],
    rolling_stats: Sequence[str],
    lag_diffs: bool,
    safe_lag_diffs: bool,
    prefix: str = "",
) -> list[str]:
    names = [f"{prefix}lag_{k}" for k in n_lags]
    if lag_diffs:
        names += [f"{prefix}lag_{k}_diff" for k in n_lags]
    if safe_lag_diffs:
        names += [f"{prefix}lag_{k}_diff_safe" for k in n_lags]
    return names + [f"{prefix}rolling_{s}_{w}" for w in rolling_windows for s in ROLLING_STATS if s in rolling_stats]


def add_lag_features(
    df: DataFrame,
    target: str,
    date: str,
    n_lags: Sequence[int] = (1, 7, 14),
    rolling_windows: Sequence[int] = (7, 14),
    rolling_stats: Sequence[str] = ("mean", "std"),
    lag_diffs: bool = False,
    safe_lag_diffs: bool = False,
    date_parts: bool = True,
    cyclical: bool = False,
    holiday_country: str | None = None,
    holiday_subdiv: str | None = None,
    calendar: DataFrame | None = None,
    prefix: str = "",
    series: Sequence[str] = (),
    tie: Sequence[str] = (),
    strict: bool = False,
    formats: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Lags, leak-free rolling statistics and date parts of one or many series.

    A rolling statistic covers the ``w`` rows before the current one and is NULL unless all of
    them are present. Rows without a full history are dropped: those NULL in a generated column,
    the target or the date (``strict=True``: in any column).

    ``lag_k_diff`` is ``y[t] - y[t-k]`` and so contains the current target; it is off by default
    and training refuses it as a feature. ``lag_k_diff_safe`` is ``y[t-1] - y[t-1-k]``.

    ``series`` names the key of each series, ``tie`` orders rows of equal date. Series that fit one
    task are one window each; a longer one is cut into blocks, each carrying the last rows of the
    block before it, so no task holds a whole series.
    """
    unknown = sorted(set(rolling_stats) - set(ROLLING_STATS))
    if unknown:
        raise ValueError(f"No rolling statistic named {', '.join(unknown)}; there are {', '.join(sorted(ROLLING_STATS))}")
    df = nan_to_null(df).withColumn(date, timestamp_of(df, date, formats)).where(col(date).isNotNull())
    # rows of equal date and tie still need one fixed order
    df, order = with_tie(df, [date, *tie])
    reach = max([0, *n_lags, *rolling_windows]) + (1 if safe_lag_diffs else 0)
    keys = [col(s) for s in series]

    sizes = df.groupBy(*keys).count() if keys else None
    longest = (sizes.agg(F.max("count")).first()[0] or 0) if keys else df.count()
    if longest <= task_rows:
        w = W.partitionBy(*(keys or [F.lit(0)])).orderBy(*sort_keys(df, order))
        out = _lag_columns(df, target, w, n_lags, rolling_windows, rolling_stats, lag_diffs, safe_lag_diffs, prefix)
    else:
        block_rows = max(task_rows, reach, 1)
        ranked = with_global_rank(df, order, "__i", by=series, task_rows=task_rows)
        home = F.floor((F.col("__i") - 1) / block_rows)
        # the last `reach` rows of a block also go to the next one
        late = F.pmod(F.col("__i") - 1, F.lit(block_rows)) >= block_rows - reach
        blocks = ranked.withColumn("__home", home).withColumn(
            "__block",
            F.explode(F.when(late, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home"))),
        )
        w = W.partitionBy(*keys, "__block").orderBy("__i")
        out = _lag_columns(blocks, target, w, n_lags, rolling_windows, rolling_stats, lag_diffs, safe_lag_diffs, prefix)
        out = out.where("__block = __home").drop("__i", "__home", "__block")

    out = out.drop(TIE)
    if date_parts:
        out = add_datetime_features(out, date, "", cyclical, holiday_country, holiday_subdiv, calendar)
    if strict:
        return out.na.drop("any", subset=[f"`{c}`" if "." in c else c for c in flat_columns(out)])
    made = lag_names(n_lags, rolling_windows, rolling_stats, lag_diffs, safe_lag_diffs, prefix)
    return out.na.drop("any", subset=[*made, target, date])


def _lag_columns(df, target, w, n_lags, windows, stats, lag_diffs, safe_lag_diffs, prefix):
    y = col(target)
    made = {f"{prefix}lag_{k}": F.lag(y, k).over(w) for k in n_lags}
    if lag_diffs:
        made |= {f"{prefix}lag_{k}_diff": y - F.lag(y, k).over(w) for k in n_lags}
    if safe_lag_diffs:
        made |= {f"{prefix}lag_{k}_diff_safe": F.lag(y, 1).over(w) - F.lag(y, k + 1).over(w) for k in n_lags}
    for size in windows:
        frame = w.rowsBetween(-size, -1)
        full = F.count(y).over(frame) == size
        for name, fn in ROLLING_STATS.items():
            if name in stats:
                made[f"{prefix}rolling_{name}_{size}"] = F.when(full, fn(y).over(frame))
    return df.withColumns(made)
