"""Exact quantiles by radix selection: one path for any size, in at most five scans.

A double's bits, with those of a negative turned over, sort as a whole number. The first scan counts every column by the
leading bits of that number, on the map side; the bin that holds a wanted rank is then counted by the next bits, and so
on. Each bin also knows its least and greatest value, so a rank is settled as soon as its bin holds one value or the rank is
its first or last, which for most data is after two or three scans; after five no bit is left. What is
shuffled are counts, at most ``2 ** max(_DIGITS)`` a task and open bin, never values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.functions.columns import col

#: Bits that each scan adds; together they are the 64 of a double.
_DIGITS = (14, 13, 13, 12, 12)
#: Columns, or later open bins, counted by one scan: a task holds three numbers a bin of each.
_TOGETHER = 200
_SKETCH = 20_000
_SKETCH_CHUNK = 40
_LOW = np.iinfo(np.int64).min
_HIGH = np.iinfo(np.int64).max


def exact_quantiles(
    df: DataFrame, probs: Mapping[str, Sequence[float]], approx: bool = False
) -> dict[str, list[float | None]]:
    """Column -> quantiles (linear interpolation, missing left out; all-missing gives ``None``).

    The result is O(columns x probabilities) numbers on the driver, ready to be used as literals. ``approx`` is one scan
    with a sketch instead.
    """
    probs = {c: list(p) for c, p in probs.items()}
    if approx:
        return _sketch_quantiles(df, probs) if probs else {}
    names, out = list(probs), {}
    for at in range(0, len(names), _TOGETHER):
        some = names[at : at + _TOGETHER]
        sizes, found = _select(df, some, [(i, float(p)) for i, c in enumerate(some) for p in sorted(set(probs[c]))])
        for i, c in enumerate(some):
            out[c] = [_between(found, i, p, sizes[i]) if i in sizes else None for p in probs[c]]
    return out


def _between(found: Mapping[tuple[int, int], float], i: int, p: float, size: int) -> float:
    at = p * (size - 1)
    low, high = found[i, math.floor(at)], found[i, math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


def present_counts(df: DataFrame, names: Sequence[str], chunk: int = 60) -> dict[str, int]:
    """Column -> number of present values."""
    out: dict[str, int] = {}
    for start in range(0, len(names), chunk):
        group = names[start : start + chunk]
        row = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(group)]).first()
        out |= {c: row[i] for i, c in enumerate(group)}
    return out


def order_number(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles ``x``; both zeros are one."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & _HIGH)


def order_value(number: int) -> float:
    """The double whose ``order_number`` this is."""
    number = np.int64(number)
    return float((number ^ ((number >> np.int64(63)) & np.int64(_HIGH))).view(np.float64))


def _select(df: DataFrame, names: Sequence[str], asked: Sequence[tuple[int, float]]):
    """Present values by column number, and the values at the ranks that the asked (column, probability) pairs need."""
    spark = df.sparkSession
    doubles = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    sizes: dict[int, int] = {}
    found: dict[tuple[int, int], float] = {}
    counted = _histogram(doubles, [(i, 0) for i in range(len(names))], 0)
    upto, each = W.partitionBy("c").orderBy("bin"), W.partitionBy("c")
    counted = counted.withColumns({"upto": F.sum("n").over(upto), "size": F.sum("n").over(each)})
    at = F.col("p") * (F.col("size") - 1)
    wanted = F.broadcast(spark.createDataFrame(list(asked), "c int, p double"))
    hits = counted.join(wanted, "c").withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))))
    hits = hits.where("rank >= upto - n AND rank < upto").select("c", "bin", "n", "lo", "hi", "size", "rank", F.expr("rank - upto + n").alias("k"))
    open_: dict[tuple[int, int], dict[int, int]] = {}

    def settle(rows) -> None:
        open_.clear()
        for r in rows:
            if r.lo == r.hi or r.k == 0:
                found[r.c, r["rank"]] = order_value(r.lo)
            elif r.k == r.n - 1:
                found[r.c, r["rank"]] = order_value(r.hi)
            else:
                open_.setdefault((r.c, r.bin), {})[r["rank"]] = r.k

    first = hits.distinct().collect()
    sizes |= {r.c: r["size"] for r in first}
    settle(first)
    for level in range(1, len(_DIGITS)):
        bins, rows = sorted(open_), []
        for start in range(0, len(bins), _TOGETHER):
            some = bins[start : start + _TOGETHER]
            ranks = [(g, rank, k) for g, b in enumerate(some) for rank, k in open_[b].items()]
            counted = _histogram(doubles, some, level).withColumn("upto", F.sum("n").over(W.partitionBy("g").orderBy("bin")))
            wanted = F.broadcast(spark.createDataFrame(ranks, "g int, rank long, at long"))
            hits = counted.join(wanted, "g").where("at >= upto - n AND at < upto")
            rows += hits.select("c", "bin", "n", "lo", "hi", "rank", F.expr("at - upto + n").alias("k")).collect()
        if not bins:
            break
        settle(rows)
    return sizes, found


def _histogram(doubles: DataFrame, bins: Sequence[tuple[int, int]], level: int) -> DataFrame:
    """Rows ``g, c, bin, n, lo, hi``: the values of each of ``bins`` (column, leading bits) by the bits that come next."""
    width = _DIGITS[level]
    before = 64 - sum(_DIGITS[:level])
    after = before - width
    size = 1 << width
    columns = sorted({c for c, _ in bins})
    schema = pa.schema([("g", pa.int32()), ("c", pa.int32()), *[(x, pa.int64()) for x in ("bin", "n", "lo", "hi")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(bins), size), np.int64)
        lo, hi = np.full(n.shape, _HIGH), np.full(n.shape, _LOW)
        groups = {c: [(g, top) for g, (k, top) in enumerate(bins) if k == c] for c in columns}
        for batch in batches:
            for place, c in enumerate(columns):
                x = batch.column(place).to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)] if x.dtype == np.float64 else np.zeros(0)
                number = order_number(x)
                for g, top in groups[c]:
                    some = number if level == 0 else number[number >> before == top]
                    digit = (some >> after) + (size >> 1) if level == 0 else (some >> after) & (size - 1)
                    n[g] += np.bincount(digit, minlength=size)
                    np.minimum.at(lo[g], digit, some)
                    np.maximum.at(hi[g], digit, some)
        g, digit = np.nonzero(n)
        top = np.array([t for _, t in bins], np.int64)[g]
        full = digit - (size >> 1) if level == 0 else (top << width) + digit
        c = np.array([c for c, _ in bins], np.int32)[g]
        yield pa.RecordBatch.from_arrays([g.astype(np.int32), c, full, n[g, digit], lo[g, digit], hi[g, digit]], schema=schema)

    found = doubles.select(*[f"x{c}" for c in columns]).mapInArrow(count, "g int, c int, bin long, n long, lo long, hi long")
    return found.groupBy("g", "c", "bin").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _sketch_quantiles(df: DataFrame, probs: Mapping[str, list[float]]) -> dict[str, list[float | None]]:
    """One aggregate with a sketch a column; a chunk of columns at a time."""
    out: dict[str, list[float | None]] = {}
    names = list(probs)
    for begin in range(0, len(names), _SKETCH_CHUNK):
        some = names[begin : begin + _SKETCH_CHUNK]
        row = df.agg(*[F.percentile_approx(col(c).cast("double"), probs[c], _SKETCH).alias(f"q{i}") for i, c in enumerate(some)]).first()
        out |= {c: [None] * len(probs[c]) if q is None else list(q) for c, q in zip(some, row)}
    return out
