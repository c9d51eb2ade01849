"""Event-time windows: volume per period and drift against a frozen profile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col, nan_to_null
from tabforge.operators.drift import PSI_THRESHOLD, psi_value


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """A watermark needs a zoned timestamp; a zone-free one is read in the session's zone."""
    return stream.withColumn(column, col(column).cast("timestamp")).withWatermark(column, delay)


def stream_volume(stream: DataFrame, column: str, period: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """``period_start, n`` per tumbling window, final once the watermark has passed its end.

    Rows later than the watermark are dropped. Counts combine per task before the shuffle, so a
    busy window costs one row per task.
    """
    timed = with_event_time(stream.where(col(column).isNotNull()), column, delay)
    counted = timed.groupBy(F.window(col(column), period)).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("period_start"), "n")


def with_open_windows(
    closed: DataFrame, source: DataFrame, column: str, compute: Callable[[DataFrame], DataFrame], end: Column
) -> DataFrame:
    """The windows a stopped stream has finished, and those its watermark left open, computed from the rows since.

    ``closed`` is the stream's output, ``end`` the end of a window in it, ``source`` the stored rows the stream read and
    ``compute`` what the stream did with them.
    """
    last = closed.agg(F.max(end)).first()[0]
    rest = source if last is None else source.where(col(column).cast("timestamp") >= F.lit(last))
    return closed.unionByName(compute(rest))


def stream_drift(
    stream: DataFrame,
    profile: DataFrame,
    column: str,
    window: str = "1 day",
    slide: str | None = None,
    delay: str = "1 hour",
    threshold: float = PSI_THRESHOLD,
) -> DataFrame:
    """``window_start, window_end, column, psi, drifted`` per finished window.

    The profile's bins are literals; state is one row of bin counts per open window. A window
    without a value in a column has no row for it.
    """
    known = {r.column: r for r in profile.collect() if r.column in stream.columns}
    if not known:
        raise ValueError("no column of the stream has a reference in the profile")
    timed = with_event_time(nan_to_null(stream).where(col(column).isNotNull()), column, delay)
    frame = F.window(col(column), window, slide) if slide else F.window(col(column), window)
    names = list(known)
    # count at or above every edge; neighbouring differences are the bins
    aggs, slots = [], {}
    for i, c in enumerate(names):
        x = col(c).cast("double")
        aggs.append(F.count(x).alias(f"n{i}"))
        slots[c] = [f"n{i}"]
        for j, e in enumerate(known[c].edges):
            aggs.append(F.count_if(x >= float(e)).alias(f"e{i}_{j}"))
            slots[c].append(f"e{i}_{j}")
    counted = timed.groupBy(frame).agg(*aggs)

    def bins(c: str) -> Column:
        reached = [*[F.col(s) for s in slots[c]], F.lit(0).cast("long")]
        return F.array(*[a - b for a, b in zip(reached, reached[1:])])

    rows = counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"n{i}").alias("n"),
                        psi_value(F.array(*[F.lit(v).cast("long") for v in known[c].counts]), bins(c)).alias("psi"),
                    )
                    for i, c in enumerate(names)
                ]
            )
        ).alias("r"),
    ).where("r.n > 0")
    return rows.select("window_start", "window_end", "r.column", "r.psi", (F.col("r.psi") > threshold).alias("drifted"))
