"""Lag and rolling features of a stream, per series, from keyed state that no series can overload.

Rows wait in state by series *and* stretch of time, so that a busy series is spread over many keys and tasks. When the watermark
passes the end of a stretch its rows are sorted and get their features at once; only the first few, whose history lies
before the stretch, and the last few values go on as one record to a second keyed state, which holds a series' last
values and carries them from stretch to stretch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tabforge.functions.columns import col
from tabforge.operators.lags import ROLLING_STATS, lag_names
from tabforge.streaming.sources import FLUSH
from tabforge.streaming.windows import with_event_time

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of one state element and of one batch of results.
_CHUNK = 10_000
_EDGE = ("head_us", "head_tie", "head_y", "tail_y")


def series_features(y: np.ndarray, n_lags: Sequence[int], windows: Sequence[int], stats: Sequence[str]) -> np.ndarray:
    """A column a feature for every value of ``y`` from those before it; NaN where they are not all there."""
    out = [np.r_[np.full(min(k, len(y)), np.nan), y[:-k] if len(y) > k else y[:0]] for k in n_lags]
    for w in windows:
        for name in ROLLING_STATS:
            if name not in stats:
                continue
            made = np.full(len(y), np.nan)
            if len(y) > w and (name != "std" or w > 1):
                last = np.lib.stride_tricks.sliding_window_view(y[:-1], w)
                made[w:] = np.std(last, axis=1, ddof=1) if name == "std" else getattr(np, name)(last, axis=1)
            out.append(made)
    return np.stack(out, axis=1) if out else np.zeros((len(y), 0))


class StretchProcessor(StatefulProcessor):
    """Per series and stretch of time: the rows waiting for its end."""

    def __init__(self, width_us: int, reach: int, n_series: int, plan: tuple, names: list[str]):
        self.width_us, self.reach, self.n_series, self.plan, self.names = width_us, reach, n_series, plan, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us array<long>, tie array<long>, y array<double>")

    def _end_ms(self, key) -> int:
        return -(-(int(key[-1]) + 1) * self.width_us // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if not self.waiting.exists():
            self.handle.registerTimer(self._end_ms(key))
        for part in rows:
            y = part["row_y"].astype(float).tolist()
            us, tie = part["row_us"].tolist(), part["row_tie"].tolist()
            for at in range(0, len(us), _CHUNK):
                piece = slice(at, at + _CHUNK)
                self.waiting.appendValue((us[piece], tie[piece], y[piece]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = list(self.waiting.get())
        self.waiting.clear()
        us, tie, y = (np.concatenate([np.array(f[i], t) for f in found]) for i, t in enumerate((np.int64, np.int64, float)))
        order = np.lexsort((tie, us))
        us, tie, y = us[order], tie[order], y[order]
        closed = pd.Timestamp(self._end_ms(key) + 1, unit="ms")
        for at in range(self.reach, len(y), _CHUNK):
            to = min(at + _CHUNK, len(y))
            made = series_features(y[at - self.reach : to], *self.plan)[self.reach :]
            whole = ~np.isnan(np.c_[y[at:to], made]).any(axis=1)
            if whole.any():
                yield self._records(key, closed, False, us[at:to][whole], tie[at:to][whole], y[at:to][whole], made[whole])
        head = slice(0, self.reach)
        edge = [us[head].tolist(), tie[head].tolist(), y[head].tolist(), y[-self.reach :].tolist()]
        none = np.full((1, len(self.names) - self.n_series - 6 - len(_EDGE)), np.nan)
        out = self._records(key, closed, True, us[:1], tie[:1], np.array([np.nan]), none)
        for name, value in zip(_EDGE, edge):
            out[name] = pd.Series([value], dtype=object)
        yield out

    def _records(self, key, closed, edge: bool, us, tie, y, made) -> pd.DataFrame:
        out = pd.DataFrame({"row_us": us, "row_tie": tie, "row_y": y})
        head = {**dict(zip(self.names, key[:-1])), "closed": closed, "edge": edge, "stretch": int(key[-1])}
        for i, (name, value) in enumerate(head.items()):
            out.insert(i, name, pd.Series([value] * len(out), dtype=object if name != "closed" else None))
        for k, name in enumerate(self.names[self.n_series + 6 : -len(_EDGE)]):
            out[name] = made[:, k]
        for name in _EDGE:
            out[name] = None
        return out[self.names]

    def close(self) -> None:
        pass


class EdgeProcessor(StatefulProcessor):
    """Per series: its last values, for the rows at the beginning of the next stretch; finished rows pass through."""

    def __init__(self, reach: int, n_series: int, plan: tuple, names: list[str], ttl_ms: int | None):
        self.reach, self.n_series, self.plan, self.names, self.ttl_ms = reach, n_series, plan, names, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tail = handle.getValueState("tail", "ys array<double>, last_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        edges = []
        for part in rows:
            if key[self.n_series]:
                edges += part[["stretch", "row_us", *_EDGE]].to_dict("records")
            else:
                yield part[self.names[: self.n_series] + ["row_us", "row_tie", "row_y"] + self.names[self.n_series + 3 :]].set_axis(self.names, axis=1)
        if not edges:
            return
        ys, last_ms = self.tail.get() if self.tail.exists() else ([], 0)
        history = np.array(ys, float)
        out = []
        for e in sorted(edges, key=lambda e: e["stretch"]):
            y = np.array(e["head_y"], float)
            made = series_features(np.r_[history, y], *self.plan)[len(history) :]
            for us, tie, v, f in zip(e["head_us"], e["head_tie"], y.tolist(), made.tolist()):
                if not np.isnan([v, *f]).any():
                    out.append((*key[: self.n_series], int(us), int(tie), v, *f))
            history = np.r_[history, np.array(e["tail_y"], float)][-self.reach :]
            last_ms = max([last_ms, *(int(u) // 1000 for u in e["head_us"])])
        self.tail.update((history.tolist(), last_ms))
        if self.ttl_ms is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last_ms + self.ttl_ms)
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.tail.clear()  # nothing came for the whole time to live: forget the series
        return iter([])

    def close(self) -> None:
        pass


def stream_lag_features(
    stream: DataFrame,
    target: str,
    date: str,
    series: Sequence[str],
    tie: str,
    n_lags: Sequence[int] = (1, 7, 14),
    rolling_windows: Sequence[int] = (7, 14),
    rolling_stats: Sequence[str] = ("mean", "std"),
    delay: str = "1 hour",
    ttl: str | None = None,
    stretch: str = "1 day",
) -> DataFrame:
    """``series..., <date>_us, tie, target`` and the batch operator's lag and rolling columns.

    Rows without a full history are dropped as in the batch. ``tie`` is an integer column that orders rows of equal time.
    ``stretch`` (a pandas duration) is the time whose rows are finished together: results come that much later at most, and
    one task holds the rows that one series has in it. ``ttl`` forgets a series that stays silent in event time, from the
    first rows of its last stretch on. A stream from ``with_flush`` is finished to its last row. Needs the RocksDB state store.
    """
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    unknown = sorted(set(rolling_stats) - set(ROLLING_STATS))
    if unknown:
        raise ValueError(f"No rolling statistic named {', '.join(unknown)}; there are {', '.join(sorted(ROLLING_STATS))}")
    duration = lambda text: int(pd.Timedelta(text).total_seconds() * 1000)
    width_us, ttl_ms = duration(stretch) * 1000, None if ttl is None else duration(ttl)
    timed = with_event_time(stream.where(col(date).isNotNull()), date, delay)
    us = F.unix_micros(col(date))
    if FLUSH in stream.columns:
        # the condition names the time, so that it isn't moved below the watermark
        timed = timed.where(~(col(FLUSH) & (us > F.lit(-(1 << 62)))))
    # plain names: the rows reach Python as named tuples, which rename leading underscores
    keys = [f"series_{i}" for i in range(len(series))]
    rows = timed.select(
        *[col(s).alias(k) for s, k in zip(series, keys)],
        F.floor(us / F.lit(width_us)).alias("stretch"),
        col(date).alias("at"),
        us.alias("row_us"),
        col(tie).cast("long").alias("row_tie"),
        col(target).cast("double").alias("row_y"),
    )
    made = lag_names(n_lags, rolling_windows, rolling_stats, False, False)
    plan, reach = (list(n_lags), list(rolling_windows), list(rolling_stats)), max([1, *n_lags, *rolling_windows])
    kinds = [T.StructField(k, stream.schema[s].dataType) for s, k in zip(series, keys)]
    mid = "closed timestamp, edge boolean, stretch long, row_us long, row_tie long, row_y double"
    features = [T.StructField(f"feature_{i}", T.DoubleType()) for i in range(len(made))]
    edge = "head_us array<long>, head_tie array<long>, head_y array<double>, tail_y array<double>"
    between = T.StructType([*kinds, *T.StructType.fromDDL(mid), *features, *T.StructType.fromDDL(edge)])
    finished = rows.groupBy(*keys, "stretch").transformWithStateInPandas(
        statefulProcessor=StretchProcessor(width_us, reach, len(keys), plan, between.names), outputStructType=between,
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="closed",
    )
    plain = T.StructType.fromDDL("row_us long, row_tie long, row_y double")
    schema = T.StructType([*kinds, *plain, *features])
    lane = F.when(F.col("edge"), F.lit(0)).otherwise(F.col("stretch")).alias("lane")
    out = finished.select("*", lane).groupBy(*keys, "edge", "lane").transformWithStateInPandas(
        statefulProcessor=EdgeProcessor(reach, len(keys), plan, schema.names, ttl_ms), outputStructType=schema,
        outputMode="Append", timeMode="EventTime",
    )
    names = [*series, f"{date}_us", tie, target, *made]
    return out.select(*[col(a).alias(b) for a, b in zip(schema.names, names)])
