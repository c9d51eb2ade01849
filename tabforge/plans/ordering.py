"""Order over a whole table without a one-task window.

A bounded sample gives cut points of the full order key (all its columns, so a single hot
timestamp is cut by the tie column too). The cut points become literals, which makes the bucket
of a row a pure function of the row: a lost executor recomputes the same bucket. Ranks, prefix
sums and neighbours are then computed per bucket and joined with a small per-bucket table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tabforge.functions.columns import col

TASK_ROWS = 2_000_000
MAX_BUCKETS = 4096
_SAMPLE_PER_BUCKET = 20
_CUT_SAMPLE = 40_000  # keys that close in the wanted ranks, for all of them together
_BUCKET = "__bucket"
TIE = "__tie"


def sort_keys(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Order columns in a form that can be written as literals and read back exactly."""
    out = []
    for name in order:
        zoned = isinstance(df.schema[name].dataType, T.TimestampType)
        out.append(F.unix_micros(col(name)) if zoned else col(name))
    return out


def _key(df: DataFrame, order: Sequence[str]) -> Column:
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys(df, order))])


def _literals(df: DataFrame, order: Sequence[str], rows) -> list[Column]:
    types = [f.dataType for f in df.select(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys(df, order))]).schema]
    return [
        F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(row, types))]) for row in rows
    ]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often and wherever the result is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _text_rows(frame: DataFrame) -> list[tuple]:
    return [tuple(r) for r in frame.select(*[F.col(c).cast("string") for c in frame.columns]).collect()]


def with_tie(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a hash of the whole row in ``TIE``, and ``order`` with it as the last key.

    It gives rows of equal keys a fixed order that survives a retry, so that a hot key can be cut. Only rows that are
    equal in every column stay together.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    plain = [col(f.name) for f in df.schema if not isinstance(f.dataType, nested)]
    deep = [F.to_json(F.struct(col(f.name))) for f in df.schema if isinstance(f.dataType, nested)]
    return df.withColumn(TIE, F.xxhash64(*plain, *deep)), [*order, TIE]


class RangeBuckets:
    """A frozen mapping of the order key to bucket numbers 0, 1, ... in key order."""

    def __init__(
        self,
        df: DataFrame,
        order: Sequence[str],
        n_rows: int,
        task_rows: int = TASK_ROWS,
        largest: int | None = None,
    ):
        """``largest`` is the row count of the largest group when ranks are taken per group."""
        self.order = list(order)
        wanted = min(MAX_BUCKETS, math.ceil(n_rows / max(task_rows, 1)))
        self.edges: list[tuple] = []
        if wanted > 1 and (largest is None or largest > task_rows):
            keys = df.select(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys(df, order))])
            keep = min(1.0, 2.0 * wanted * _SAMPLE_PER_BUCKET / n_rows)
            sample = keys.sample(fraction=keep, seed=42) if keep < 1.0 else keys
            ordered = _text_rows(sample.orderBy(*sample.columns))
            step = max(1, len(ordered) // wanted)
            self.edges = list(dict.fromkeys(ordered[step::step]))[: MAX_BUCKETS - 1]

    @property
    def single(self) -> bool:
        return not self.edges

    def column(self, df: DataFrame) -> Column:
        """Bucket number: how many cut points are at or below the key, found in two short steps."""
        if self.single:
            return F.lit(0)
        key = _key(df, self.order)
        width = max(1, math.isqrt(len(self.edges)))
        blocks = [self.edges[i : i + width] for i in range(0, len(self.edges), width)]
        starts = F.array(*_literals(df, self.order, [b[0] for b in blocks]))
        fine = F.array(*[F.array(*_literals(df, self.order, b)) for b in blocks])

        def place(k: Column) -> Column:
            inner = lambda block: (block - 1) * width + F.size(F.filter(F.element_at(fine, block), lambda e: e <= k))
            block = F.size(F.filter(starts, lambda e: e <= k))
            return _once(block, lambda b: F.when(b == 0, F.lit(0)).otherwise(inner(b)))

        return _once(key, place)


def _small_offsets(counts: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Prefix sums over the per-bucket table; at most ``MAX_BUCKETS`` rows per group."""
    before = W.partitionBy(*(group or [F.lit(0)])).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        *group, _BUCKET, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"__before_{s}") for s in sums]
    )


def _attach(parts: DataFrame, small: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Join the per-bucket table. Without a group it has at most ``MAX_BUCKETS`` rows, so it is
    broadcast; with one, the join finds the rows already partitioned by (group, bucket)."""
    return parts.join(small if group else F.broadcast(small), [*group, _BUCKET], "left")


def with_global_rank(
    df: DataFrame,
    order: Sequence[str],
    name: str = "rank",
    by: Sequence[str] = (),
    n_rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the 1-based row number in ``order`` (over the whole table, or per ``by`` group)."""
    n_rows = df.count() if n_rows is None else n_rows
    buckets = RangeBuckets(df, order, n_rows, task_rows)
    # a struct key keeps rows with a NULL group together in the join below
    group = ["__group"] if by else []
    parts = df.withColumn(_BUCKET, buckets.column(df))
    if by:
        parts = parts.withColumn("__group", F.struct(*[col(b) for b in by]))
    inside = F.row_number().over(W.partitionBy(*group, _BUCKET).orderBy(*sort_keys(df, order)))
    ranked = parts.withColumn(name, inside.cast("long"))
    if buckets.single:
        return ranked.drop(_BUCKET, *group)
    counts = parts.groupBy(*group, _BUCKET).agg(F.count(F.lit(1)).alias("n"))
    out = _attach(ranked, _small_offsets(counts, group, ["n"]), group)
    return out.withColumn(name, F.col(name) + F.col("__before_n")).drop(_BUCKET, "__before_n", *group)


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    n_rows: int | None = None,
    task_rows: int = TASK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Add ``upto_<s>``, the inclusive prefix sum in ``order``; ``order`` must be unique per group.

    ``n_rows`` may be an estimate; ``largest`` is the size of the largest group, if known.
    """
    n_rows = df.count() if n_rows is None else n_rows
    buckets = RangeBuckets(df, [order], n_rows, task_rows, largest)
    group = ["__group"] if by else []
    parts = df.withColumn(_BUCKET, buckets.column(df))
    if by:
        parts = parts.withColumn("__group", F.struct(*[col(b) for b in by]))
    inside = W.partitionBy(*group, _BUCKET).orderBy(*sort_keys(df, [order])).rowsBetween(W.unboundedPreceding, 0)
    out = parts.withColumns({f"upto_{s}": F.sum(col(s)).over(inside) for s in sums})
    if buckets.single:
        return out.drop(_BUCKET, *group)
    counts = parts.groupBy(*group, _BUCKET).agg(*[F.sum(col(s)).alias(s) for s in sums])
    out = _attach(out, _small_offsets(counts, group, sums), group)
    return out.withColumns({f"upto_{s}": F.col(f"upto_{s}") + F.col(f"__before_{s}") for s in sums}).drop(
        _BUCKET, *group, *[f"__before_{s}" for s in sums]
    )


def with_previous(
    df: DataFrame,
    order: str,
    value: Mapping[str, Column],
    n_rows: int | None = None,
    task_rows: int = TASK_ROWS,
    step: int = 1,
) -> DataFrame:
    """Add columns taken from the row before (``step=1``) or after (``step=-1``) in ``order``.

    Inside a bucket it is a window; the first row of a bucket takes the edge row of the nearest
    non-empty bucket from a table with one row per bucket. ``order`` must be unique.
    """
    n_rows = df.count() if n_rows is None else n_rows
    buckets = RangeBuckets(df, [order], n_rows, task_rows)
    packed = F.struct(*[v.alias(k) for k, v in value.items()])
    parts = df.withColumns({_BUCKET: buckets.column(df), "__packed": packed})
    key = sort_keys(df, [order])[0]
    near = F.lag("__packed", 1) if step > 0 else F.lead("__packed", 1)
    out = parts.withColumn("__near", near.over(W.partitionBy(_BUCKET).orderBy(key)))
    if not buckets.single:
        pick = F.max_by if step > 0 else F.min_by
        edge = parts.groupBy(_BUCKET).agg(pick(F.col("__packed"), key).alias("__edge"))
        one = W.partitionBy(F.lit(0)).orderBy(_BUCKET)
        carried = (F.lag if step > 0 else F.lead)("__edge", 1).over(one)
        out = _attach(out, edge.select(_BUCKET, carried.alias("__carried")))
        out = out.withColumn("__near", F.coalesce("__near", "__carried")).drop("__carried")
    return out.select(*[col(c) for c in df.columns], *[F.col(f"__near.{k}").alias(k) for k in value])


def order_cuts(
    df: DataFrame,
    order: Sequence[str],
    ranks: Sequence[int],
    n_rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> dict[int, tuple]:
    """Order keys (as text) of the rows at the given 0-based ranks.

    Each rank is closed in between sampled keys, a few for each whatever the table's size: one scan samples the stretches
    that hold a rank, the next counts the rows between the sampled keys on the map side. Only stretches of up to
    ``task_rows`` are sorted; larger ones are closed in further. A key that reaches over a rank is its answer, so equal
    rows end the search. With the keys as literals a table can be cut by a pure projection.
    """
    n_rows = df.count() if n_rows is None else n_rows
    inside = sorted({r for r in ranks if 0 <= r < n_rows})
    found: dict[int, tuple] = {}
    if not inside:
        return found
    keys = df.select(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys(df, order))])
    names = keys.columns
    bounds: list[tuple] = []
    # stretch -> its first rank, its size, the ranks in it
    wanted = {0: (0, n_rows, inside)}
    while any(size > task_rows for _, size, _ in wanted.values()):
        bounds = _closer(df, order, keys, bounds, wanted)
        at = _stretch(df, order, bounds)
        sizes = {r[0]: r[1] for r in keys.groupBy(at.alias("at")).count().collect()}
        wanted, start = {}, 0
        for s in sorted(sizes):
            here = [r for r in inside if r not in found and start <= r < start + sizes[s]]
            if s % 2:
                found |= {r: bounds[s // 2] for r in here}
            elif here:
                wanted[s] = (start, sizes[s], here)
            start += sizes[s]
    if wanted:
        some = keys.withColumn("at", _stretch(df, order, bounds)).where(F.col("at").isin(list(wanted)))
        numbered = some.withColumn("rn", F.row_number().over(W.partitionBy("at").orderBy(*names)))
        places = [(s, r - start + 1, r) for s, (start, _, here) in wanted.items() for r in here]
        match = df.sparkSession.createDataFrame(places, "at int, rn int, rank long")
        rows = numbered.join(F.broadcast(match), ["at", "rn"]).select("rank", *[F.col(c).cast("string") for c in names])
        found |= {r.rank: tuple(r[1:]) for r in rows.collect()}
    return found


def _stretch(df: DataFrame, order: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """Number of a row's stretch: ``2 * i`` between the bounds before and at ``i``, ``2 * i + 1`` at bound ``i``."""
    if not bounds:
        return F.lit(0)
    key, edges = F.struct(*[F.col(f"k{i}") for i in range(len(order))]), F.array(*_literals(df, order, bounds))
    return _once(key, lambda k: F.size(F.filter(edges, lambda e: e <= k)) + F.size(F.filter(edges, lambda e: e < k)))


def _closer(df: DataFrame, order: Sequence[str], keys: DataFrame, bounds: Sequence[tuple], wanted: Mapping) -> list[tuple]:
    """Sampled keys closely before and after each wanted rank, and the ends of the stretches that hold them."""
    most = max(1, _CUT_SAMPLE // len(wanted))
    shares = [most / wanted[s][1] if s in wanted else 0.0 for s in range(2 * len(bounds) + 1)]
    share = F.get(F.array(*[F.lit(x) for x in shares]), F.col("at"))
    some = keys.withColumn("at", _stretch(df, order, bounds)).where(F.rand() < share)
    sample: dict[int, list[tuple]] = {s: [] for s in wanted}
    for row in _text_rows(some.orderBy("at", *keys.columns).select("at", *keys.columns)):
        sample[int(row[0])].append(row[1:])
    out: list[tuple] = []
    for s in sorted(wanted):
        start, size, here = wanted[s]
        m = len(sample[s])
        # four standard deviations of a rank in the sample
        slack = min(2 * math.isqrt(m) + 1, m // 4)
        near = [(r - start) * m // size for r in here]
        places = sorted({max(p - slack, 0) for p in near} | {min(p + slack, m - 1) for p in near}) if m else []
        i = s // 2
        out += [*bounds[max(i - 1, 0) : i], *[sample[s][p] for p in places], *bounds[i : i + 1]]
    return list(dict.fromkeys(out))


def at_or_after(df: DataFrame, order: Sequence[str], cut: tuple) -> Column:
    """Whether a row is at or after ``cut`` in ``order``; NULL keys sort first."""
    return _key(df, order) >= _literals(df, order, [cut])[0]


def segment_number(df: DataFrame, order: Sequence[str], cuts: Sequence[tuple]) -> Column:
    """How many of the cuts a row is at or after."""
    if not cuts:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [at_or_after(df, order, c).cast("int") for c in cuts])
