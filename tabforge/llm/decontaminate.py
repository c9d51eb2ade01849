"""Benchmark decontamination: q-gram lemma filter in overlapping diagonal bands, verified by banded alignment.

Texts and items are compared in lower case with runs of white space as one space. An item is found where a piece of a text
lies within the item's edit budget. Null, empty and white items and texts match nothing. Of overlapping places the one with
the fewest edits counts, then the first. Texts of any length are read whole, in overlapping pieces. Repeated rows are
judged alike; an item given twice is found twice. Empty tables give empty results; extra columns are ignored or carried.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches

#: Characters of items that are searched for in one pass over the texts.
BLOCK_CHARS = 8_000_000
#: Positions of a text whose hits are in memory at once.
PIECE = 1 << 15
_TABLE_BITS = 22
_BASE = 0x9E3779B97F4A7C15


def normal(text: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Code points in lower case with single spaces, and for each its place in ``text`` (None: the same)."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[0] for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    white = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0xA0)
    keep = np.ones(len(points), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    places = None
    if not keep.all():
        places = np.flatnonzero(keep)
        points, white = points[keep], white[keep]
    if white.any():
        points = np.where(white, np.uint32(32), points)
    return points, places


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every ``q`` neighbouring code points; ``q`` is a power of two."""
    out, width = points.astype(np.uint64), 1
    while width < q:
        if len(out) <= width:
            return np.zeros(0, np.uint64)
        out = out[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + out[width:]
        width *= 2
    return out


def budget(length: int, q: int, rate: float) -> int:
    """Edits an item of this length may have: ``rate`` of it, but few enough that one q-gram must stay whole."""
    return max(0, min(int(rate * length), (length - q) // q))


@dataclass
class Index:
    """Items by their q-grams."""

    ids: list
    points: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    tiny: list[int]
    q: int
    reach: int
    least: int

    @classmethod
    def of(cls, items: list[tuple], q: int = 8, rate: float = 0.1) -> Index:
        kept = [(k, p) for k, t in items if t and len(p := _trim(normal(t)[0]))]
        lengths = [len(p) for _, p in kept]
        found = [grams(p, q) for _, p in kept]
        codes = np.concatenate([np.zeros(0, np.uint64), *found])
        item = np.repeat(np.arange(len(kept)), [len(g) for g in found])
        place = np.concatenate([np.zeros(0, int), *[np.arange(len(g)) for g in found]])
        sort = np.argsort(codes, kind="stable")
        unique, first = np.unique(codes[sort], return_index=True)
        edits = np.array([budget(n, q, rate) for n in lengths], np.int64)
        need = np.array(lengths, np.int64) - q + 1 - q * edits
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[_slot(unique)] = True
        return cls(
            [k for k, _ in kept], [p for _, p in kept], edits, need, unique, np.append(first, len(codes)),
            item[sort], place[sort].astype(np.int64), table, [i for i, n in enumerate(lengths) if n < q], q,
            int(max(lengths, default=0) * 1.25) + 2 * q, int(need[need > 0].min(initial=1 << 40)),
        )


def _trim(points: np.ndarray) -> np.ndarray:
    solid = np.flatnonzero(points != 32)
    return points[solid[0] : solid[-1] + 1] if len(solid) else points[:0]


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes ^ (codes >> np.uint64(29))) * np.uint64(_BASE)) >> np.uint64(64 - _TABLE_BITS)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """Best place of ``item`` in ``text`` on the diagonals ``low`` to ``high``: (edits, start, end) within the budget.

    Dynamic programming by rows of the item over the band, with the start carried beside the distance: fewest
    edits first, then the first start, then the first end.
    """
    width = high - low + 1
    one = np.int64(1) << 32
    steps = np.arange(width, dtype=np.int64) * one
    big = np.int64(1) << 60
    starts = np.arange(low, high + 1, dtype=np.int64)
    row = np.where((starts >= 0) & (starts <= len(text)), np.clip(starts, 0, None), big)
    padded = np.zeros(len(item) + width, np.int64) - 1
    a, b = max(0, low), min(len(text), low + len(padded))
    if b > a:
        padded[a - low : b - low] = text[a:b]
    for i, c in enumerate(item.tolist()):
        here = padded[i : i + width]
        new = np.where(here >= 0, row + np.where(here == c, 0, one), big)  # match or replace
        new[:-1] = np.minimum(new[:-1], row[1:] + one)  # the item's character is missing in the text
        row = np.minimum.accumulate(new - steps) + steps  # extra characters in the text
        if int(row.min() >> 32) > edits:
            return None
    ends = starts + len(item)
    row = np.where((ends >= 0) & (ends <= len(text)), row, big)
    best = int(row.argmin())
    distance = int(row[best] >> 32)
    return (distance, int(row[best] & (one - 1)), int(ends[best])) if distance <= edits else None


def matches(text: str | None, index: Index) -> list[tuple[int, int, int, int]]:
    """(item number, start, end, edits) of every place in ``text``; offsets count its code points."""
    if not text or not index.ids:
        return []
    points, places = normal(text)
    out: set[tuple[int, int, int, int]] = set()
    for k in index.tiny:
        word, n = index.points[k], len(index.points[k])
        same = np.ones(max(0, len(points) - n + 1), bool)
        for i in range(n):
            same &= points[i : len(points) - n + 1 + i] == word[i]
        out |= {(k, int(s), int(s) + n, 0) for s in np.flatnonzero(same)}
    codes = grams(points, index.q)
    hits = np.flatnonzero(index.table[_slot(codes)])
    at = np.searchsorted(index.codes, codes[hits])
    at = np.minimum(at, len(index.codes) - 1) if len(index.codes) else at[:0]
    if len(at):
        exact = index.codes[at] == codes[hits]
        hits, at = hits[exact], at[exact]
    if len(hits) >= index.least:
        reach = index.reach
        step = max(PIECE, 2 * reach)
        for begin in range(0, max(1, len(points)), step):
            lo, hi = np.searchsorted(hits, [begin, begin + step + reach])
            if hi > lo:
                out |= _region(points, hits[lo:hi], at[lo:hi], index)
    best: list[tuple[int, int, int, int]] = []
    for k, s, e, d in sorted(out, key=lambda m: (m[0], m[3], m[1], m[2])):
        if not any(b[0] == k and s < b[2] and b[1] < e for b in best):
            best.append((k, s, e, d))
    if places is not None:
        ends = np.append(places, len(text))
        best = [(k, int(ends[s]), int(ends[e - 1]) + 1, d) for k, s, e, d in best]
    return sorted(best, key=lambda m: (m[1], m[0], m[2]))


def _region(points: np.ndarray, hits: np.ndarray, at: np.ndarray, index: Index) -> set[tuple[int, int, int, int]]:
    """Places found from these hits: bands with enough shared q-grams, aligned."""
    counts = index.first[at + 1] - index.first[at]
    total = int(counts.sum())
    flat = np.repeat(index.first[at] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(total)
    item, place = index.item[flat], index.place[flat]
    diagonal = np.repeat(hits, counts) - place
    enough = np.bincount(item, minlength=len(index.ids)) >= index.need
    kept = enough[item]
    item, place, diagonal = item[kept], place[kept], diagonal[kept]
    width = index.edits[item] + 1
    band = diagonal // width
    found: set[tuple[int, int, int, int]] = set()
    if not len(item):
        return found
    # a band of two widths, and the next one begins a width later: any run of diagonals an alignment spans is whole in one
    item, place, band = np.r_[item, item], np.r_[place, place], np.r_[band, band - 1]
    low = int(band.min())
    key = (item.astype(np.int64) << 40) + (band - low)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (place[1:] != place[:-1])]  # an item's q-gram counts once
    key = key[new]
    bands, shared = np.unique(key, return_counts=True)
    items = bands >> 40
    bands = bands[shared >= index.need[items]].tolist()
    at = 0
    while at < len(bands):
        # neighbouring bands see the same place and are aligned as one
        k, b = bands[at] >> 40, (bands[at] & ((1 << 40) - 1)) + low
        more = 1 + (at + 1 < len(bands) and bands[at + 1] == bands[at] + 1)
        at += more
        edits = int(index.edits[k])
        place_of = align(index.points[k], points, b * (edits + 1) - edits, (b + 1 + more) * (edits + 1) - 1 + edits, edits)
        if place_of:
            found.add((int(k), place_of[1], place_of[2], place_of[0]))
    return found


def item_blocks(items: DataFrame, id_col: str, text: str):
    """The items in blocks of about ``BLOCK_CHARS`` characters, so that no block grows with their number."""
    rows = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t")).where("t is not null")
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == k).orderBy("id", "t")
        yield [(r.id, r.t) for r in part.collect()]


def _places(shared, item_id: str, kind: str):
    """Arrow function: text to its matches as an array of structs."""
    names = (item_id, "start", "end", "edits")

    @F.pandas_udf(f"array<struct<{item_id}:{kind},start:long,end:long,edits:int>>")
    def places(texts: pd.Series) -> pd.Series:
        index = shared.value
        found = ([(index.ids[k], s, e, d) for k, s, e, d in matches(t, index)] for t in texts)
        return pd.Series([[dict(zip(names, m, strict=True)) for m in ms] for ms in found], dtype=object)

    return places


def _free(shared):
    """Arrow function: whether a text has no match."""

    @F.pandas_udf("boolean")
    def free(texts: pd.Series) -> pd.Series:
        return pd.Series([not matches(t, shared.value) for t in texts], dtype=bool)

    return free


def find(
    df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", q: int = 8, rate: float = 0.1,
) -> DataFrame:
    """One row per place of an item in a text: ids, ``start``, ``end`` (code points of the text) and ``edits``.

    Items come in blocks of bounded size; every block is one scan of the texts, without a shuffle.
    """
    spark = df.sparkSession
    small_batches(spark)
    kind = items.schema[item_id].dataType.simpleString()
    out = None
    for block in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(Index.of(block, q, rate))  # BLOCK_CHARS bounds it
        body = F.col(f"`{text}`").cast("string")
        found = df.select(F.col(f"`{id_col}`").alias("__id"), F.explode(_places(shared, item_id, kind)(body)).alias("__m"))
        found = found.select(F.col("__id").alias(id_col), "__m.*")
        out = found if out is None else out.unionByName(found)
    return out


def clean(
    df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    q: int = 8, rate: float = 0.1,
) -> DataFrame:
    """The rows of ``df`` whose text holds no item."""
    spark = df.sparkSession
    small_batches(spark)
    for block in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(Index.of(block, q, rate))
        df = df.where(_free(shared)(F.col(f"`{text}`").cast("string")))
    return df
