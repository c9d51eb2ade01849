"""Best-fit packing of token sequences by large-item matching.

A null text is an empty one; an empty text is the end id alone. Only documents longer than a sequence are cut. Equal
lengths are interchangeable, so ties are broken by the id's hash and repeated rows simply take two places. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, step
from tabforge.llm.wordids import worker_table


def pieces(
    df: DataFrame, tokenizer_file: str, capacity: int, end_id: int, id_col: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, the ``ids`` themselves."""
    small_batches(df.sparkSession)
    kind = "piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    @F.pandas_udf(f"array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>")
    def cut(batches: pd.Series) -> pd.Series:
        encode = worker_table(tokenizer_file).encode
        end = int(end_id).to_bytes(4, "little")
        result = []
        for raw in encode([t or "" for t in batches]):
            raw += end
            rows = []
            for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[at : at + 4 * capacity]
                row = {"piece": k, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                rows.append(row | {"ids": part} if with_ids else row)
            result.append(rows)
        return pd.Series(result)

    return df.select(
        F.col(f"`{id_col}`").alias(id_col), F.explode(cut(F.col(f"`{text}`").cast("string"))).alias("__p")
    ).select(id_col, "__p.*")


@dataclass
class Plan:
    """Placements of runs of equal lengths; a run's members fill neighbouring bins, ``each`` of them a bin."""

    length: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    used: list[int] = field(default_factory=list)
    bins: int = 0

    def place(self, length: int, first: int, bin_: int, each: int, used: int) -> None:
        for name, value in zip(("length", "first", "bin", "each", "used"), (length, first, bin_, each, used), strict=True):
            getattr(self, name).append(value)


def plan_bins(counts: dict[int, int], capacity: int) -> Plan:
    """Pack ``counts`` (length -> how many) into as few bins as the method finds.

    Lengths above a third of the capacity go at most two to a bin: from the longest down, each is matched with the longest
    other large one that still fits. The smaller ones, longest first, then fill the tightest gap that holds them.
    All bins that look alike are handled as one run, so the work depends on the number of lengths, not of pieces.
    """
    plan = Plan()
    left = {k: n for k, n in counts.items() if n > 0}
    done = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first bin, bins)
    order: list[int] = []  # gaps in use, ascending

    def open_gap(gap: int, run: tuple[int, int]) -> None:
        if run[1] and gap:
            if gap not in gaps:
                bisect.insort(order, gap)
                gaps[gap] = []
            gaps[gap].append(run)

    def take(length: int, n: int, bin_: int, each: int, used: int) -> None:
        plan.place(length, done[length], bin_, each, used)
        done[length] += n
        left[length] -= n

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        longest = large[-1]
        n = left[longest]
        at = bisect.bisect_right(large, capacity - longest) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        mate = large[at] if at >= 0 else None
        if mate is None:
            take(longest, n, plan.bins, 1, 0)
            open_gap(capacity - longest, (plan.bins, n))
            plan.bins += n
        elif mate == longest:
            pairs = n // 2
            if pairs:
                take(longest, 2 * pairs, plan.bins, 2, 0)
                open_gap(capacity - 2 * longest, (plan.bins, pairs))
                plan.bins += pairs
            if left[longest]:  # one is over: the next shorter one is its mate, if there is any
                at = bisect.bisect_left(large, longest) - 1
                take(longest, 1, plan.bins, 1, 0)
                if at >= 0:
                    take(large[at], 1, plan.bins, 1, longest)
                open_gap(capacity - longest - (large[at] if at >= 0 else 0), (plan.bins, 1))
                plan.bins += 1
        else:
            pairs = min(n, left[mate])
            take(longest, pairs, plan.bins, 1, 0)
            take(mate, pairs, plan.bins, 1, longest)
            open_gap(capacity - longest - mate, (plan.bins, pairs))
            plan.bins += pairs
        large = [k for k in large if left[k]]

    for length in sorted((k for k in left if left[k] and 3 * k <= capacity), reverse=True):
        while n := left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                each = capacity // length
                full, rest = divmod(n, each)
                for bins, k in ((full, each), (1 if rest else 0, rest)):
                    if bins:
                        take(length, bins * k, plan.bins, k, 0)
                        open_gap(capacity - k * length, (plan.bins, bins))
                        plan.bins += bins
                continue
            gap = order[at]
            first, bins = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            each = gap // length
            full = min(bins, n // each)
            if full:
                take(length, full * each, first, each, capacity - gap)
                open_gap(gap - each * length, (first, full))
            rest = 0
            if full < bins and left[length]:  # fewer are left than one bin takes
                rest = left[length]
                take(length, rest, first + full, rest, capacity - gap)
                open_gap(gap - rest * length, (first + full, 1))
            open_gap(gap, (first + full + bool(rest), bins - full - bool(rest)))
    return plan


def pack(items: DataFrame, key: list[str], capacity: int, length: str = "length", bucket_rows: int = 100_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of ``length`` 1 to ``capacity``.

    The driver sees one count per length (at most ``capacity``) and returns a plan of runs. Each piece then finds its rank
    among those of its length: lengths are dealt into hashed buckets, a bucket's first rank comes from bucket sums, so
    that even a length shared by most pieces is ranked by many tasks. ``key`` must tell the pieces apart; pieces it does
    not tell apart share a bucket.
    """
    spark = items.sparkSession
    total = items.count()
    buckets = max(1, total // bucket_rows)
    dealt = items.withColumn("__b", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    sums = step(dealt.groupBy(F.col(length).alias("__l"), F.col("__b").alias("__k")).agg(F.count("*").alias("__n")), "lengths")
    counts = {r[0]: r[1] for r in sums.groupBy("__l").agg(F.sum("__n")).collect()}  # at most `capacity` rows
    plan = plan_bins(counts, capacity)
    runs = [np.array(x, np.int64) for x in (plan.length, plan.first, plan.bin, plan.each, plan.used)]
    sort = np.lexsort((runs[1], runs[0]))
    runs = [x[sort] for x in runs]
    # a few runs a length: bounded by the capacity, not by the rows
    shared = spark.sparkContext.broadcast((runs[0] << 44 | runs[1], *runs))
    # window of one row a bucket, not one a piece
    base = sums.selectExpr("*", "sum(__n) over (partition by __l order by __k) - __n as __base")
    dealt = dealt.join(base.drop("__n"), (F.col(length) == F.col("__l")) & (F.col("__b") == F.col("__k")))
    order = ", ".join(f"`{k}`" for k in key)
    ranked = dealt.selectExpr("*", f"__base + row_number() over (partition by {length}, __b order by {order}) - 1 as __rank")

    @F.pandas_udf("sequence_id long, offset long")
    def locate(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        where, length_, first, bin_, each, used = shared.value
        n, r = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        at = np.searchsorted(where, n << 44 | r, "right") - 1
        nth = r - first[at]
        return pd.DataFrame({"sequence_id": bin_[at] + nth // each[at], "offset": used[at] + nth % each[at] * n})

    return ranked.withColumn("__at", locate(F.col(length), F.col("__rank"))).select(
        *[F.col(f"`{c}`") for c in items.columns], "__at.*"
    )


def pack_documents(
    df: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Tokenise, cut what exceeds ``capacity``, and pack: a row per piece with its sequence and offset."""
    cut = step(pieces(df, tokenizer_file, capacity, end_id, id_col, text, with_ids), "pieces")
    return pack(cut, [id_col, "piece"], capacity)
