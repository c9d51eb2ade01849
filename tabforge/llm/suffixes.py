"""Exact removal of repeated byte strings by a distributed merge sort of sparse suffixes.

A null text is empty. Texts shorter than the string length keep all bytes. Repeated rows repeat each other wholly. Texts
of any length are worked on in overlapping chunks. A null id is an id like any other. An empty table gives an empty
result; extra columns are ignored.

Method. Every window of ``length`` bytes has an anchor: the ``k``-gram in it with the smallest hash, leftmost first. Equal
windows have equal anchors at equal places, so it suffices to sort the suffixes at anchors, as far as the windows of the
anchor reach, and only at anchors whose k-gram hash occurs twice. Two such suffixes that agree on ``r`` bytes to
the right and ``l`` to the left of their anchors share windows if ``l + r >= length``. Tasks sort their suffixes (and the
mirrored ones) into runs, front-code them, cut them at sampled splitters and exchange them; a loser tree merges the runs of
a range and compares no byte that a known common prefix covers. The sorted neighbours give each suffix its longest match to
either side. Where the neighbours don't settle both sides, the windows in question are compared by 128-bit digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, step

_BASE = 0x2545F4914F6CDD1D | 1
#: Bytes of a text that are hashed at once, without the overlap.
CHUNK = 1 << 22
#: No byte of UTF-8, so it ends a side of a suffix.
STOP = b"\xff"
#: Suffixes of a run, and bytes of a front-coded block before compression.
RUN, BLOCK = 50_000, 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POWERS.get(0, ([],))[0]):
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            steps = np.full(size, np.uint64(base), np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[0] = (both[0], both[1])
    return _POWERS[0]


def _chunk_anchors(data: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(data * up[:n], out=sums[1:])
    codes = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    codes ^= codes >> np.uint64(33)
    codes *= np.uint64(0xFF51AFD7ED558CCD)
    codes ^= codes >> np.uint64(29)
    low = np.uint64((1 << 24) - 1)
    ranked = (codes & ~low) | np.arange(len(codes), dtype=np.uint64)
    width, windows = length - k + 1, n - length + 1
    padded = np.full(-(-len(ranked) // width) * width, np.uint64(2**64 - 1))
    padded[: len(ranked)] = ranked
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[first[1:], windows] - 1
    at = least[first]
    return codes[at].view(np.int64), first, at, last + length


def anchors(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every anchor: hash of its k-gram, first byte of its windows, its place, and the end of its windows."""
    raw = np.frombuffer(data, np.uint8)
    parts = []
    for begin in range(0, max(0, len(raw) - length + 1), CHUNK):
        # windows that begin in this chunk; an anchor on a border comes twice, with its share of the windows each time
        part = _chunk_anchors(raw[begin : begin + CHUNK + length - 1], length, k)
        parts.append((part[0], *(x + begin for x in part[1:])))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes needn't be looked at."""
    end = min(len(a), len(b))
    at, step = known, 16
    while at < end:
        stop = min(end, at + step)
        if a[at:stop] != b[at:stop]:
            while stop - at > 1:
                middle = (at + stop) // 2
                if a[at:middle] == b[at:middle]:
                    at = middle
                else:
                    stop = middle
            return at
        at, step = stop, step * 2
    return end


def front_code(strings: list[tuple[bytes, bytes]]) -> Iterator[bytes]:
    """Blocks of a sorted run of (string, id of 16 bytes): each string without what it shares with the one before."""
    parts, size, before = [], 0, b""
    for text, name in strings:
        shared = common(before, text, 0)
        parts.append(struct.pack("<HH16s", shared, len(text) - shared, name) + text[shared:])
        size += len(parts[-1])
        before = text
        if size >= BLOCK:
            yield zlib.compress(b"".join(parts), 1)
            parts, size = [], 0
    if parts:
        yield zlib.compress(b"".join(parts), 1)


def unfold(blocks: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """(bytes shared with the string before, string, id) of a run's blocks."""
    before = b""
    for block in blocks:
        raw, at = zlib.decompress(block), 0
        while at < len(raw):
            shared, more, name = struct.unpack_from("<HH16s", raw, at)
            before = before[:shared] + raw[at + 20 : at + 20 + more]
            at += 20 + more
            yield shared, before, name


def merge(runs: list[Iterator[tuple[int, bytes, bytes]]]) -> Iterator[tuple[int, bytes, bytes]]:
    """Merge sorted runs with a loser tree; yields (bytes shared with the string before, string, id).

    Every contender knows how many bytes it shares with the last string given out. The one that shares more is smaller;
    only on a draw are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[tuple[int, bytes, bytes] | None] = [next(r, None) for r in runs] + [None] * (size - len(runs))
    shared = [0] * size
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        if heads[a] is None:
            return b, a
        if heads[b] is None:
            return a, b
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        n = common(x, y, shared[a])
        a_first = n == len(x) or (n < len(y) and x[n] < y[n])
        winner, loser = (a, b) if a_first else (b, a)
        shared[loser] = n  # from now on against the winner, which goes out before
        return winner, loser

    winners = list(range(size))
    level = size
    while len(winners) > 1:
        level //= 2
        nxt = []
        for i in range(0, len(winners), 2):
            winner, losers[level + i // 2] = play(winners[i], winners[i + 1])
            nxt.append(winner)
        winners = nxt
    top = winners[0]
    while heads[top] is not None:
        yield shared[top], heads[top][1], heads[top][2]
        heads[top] = next(runs[top], None)
        if heads[top] is not None:
            shared[top] = heads[top][0]
        node, mover = (top + size) // 2, top
        while node:
            mover, losers[node] = play(mover, losers[node])
            node //= 2
        top = mover


def _sides(key: bytes) -> tuple[bytes, bytes]:
    cut = key.index(STOP)
    return key[:cut], key[cut + 1 : -1]


def neighbours(merged: Iterator[tuple[int, bytes, bytes]]) -> Iterator[tuple[bytes, int, int, bool]]:
    """(id, longest match on the leading side, most on the other side beside it, whether a neighbour is unknown).

    The longest match of a sorted string is with the one before or after. At the ends of a range one of them is unknown.
    """
    before = None

    def settle(item, match_before, match_after, edge):
        best = max(match_before, match_after)
        return item, best[0], best[1], edge

    for shared, key, name in merged:
        lead, other = _sides(key)
        if before is None:
            before = (name, lead, other, (0, 0), True)
            continue
        name0, lead0, other0, match0, edge0 = before
        match = (min(shared, len(lead0), len(lead)), common(other0, other, 0))
        yield settle(name0, match0, match, edge0)
        before = (name, lead, other, match, False)
    if before is not None:
        yield settle(before[0], before[3], (0, 0), True)


KEYS = ["id", "version"]
_PLACE = "s binary, h long, first long, at long, stop long"


def _suffix(data: bytes, first: int, at: int, stop: int) -> tuple[bytes, bytes]:
    """Sort keys of one anchor: right side then mirrored left side, and the other way round."""
    right, left = data[at:stop], data[first:at][::-1]
    return right + STOP + left + STOP, left + STOP + right + STOP


def _equi(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on id (nulls are equal) and version."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in KEYS})
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__version"))
    return left.join(right, same, how).drop("__id", "__version")


def spans(df: DataFrame, id_col: str, text: str, length: int, k: int) -> tuple[DataFrame, DataFrame]:
    """``id``, ``version``, ``start``, ``stop`` of covered runs (they may overlap), and the texts they lie in."""
    spark = df.sparkSession
    small_batches(spark)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(body).alias("version"), body.cast("binary").alias("data"))
    docs = docs.where(F.length("data") >= length)

    # k-grams of anchors that occur in two texts, or twice in one
    listed = _code_rows(docs, length, k)
    twice = listed.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    wanted = listed.select(*KEYS, "h").join(twice, "h", "left_semi").groupBy(*KEYS).agg(F.collect_set("h").alias("hs"))
    texts = step(_equi(docs, wanted), "repeat-texts")

    def places(batches):
        for batch in batches:
            out = []
            for id_, version, data, hs in zip(batch["id"], batch["version"], batch["data"], batch["hs"], strict=True):
                data = bytes(data)
                code, first, at, stop = anchors(data, length, k)
                for i in np.flatnonzero(np.isin(code, np.asarray(hs, np.int64))).tolist():
                    a, b, c = int(first[i]), int(at[i]), int(stop[i])
                    name = hashlib.blake2b(struct.pack("<I", b - a) + data[a:c], digest_size=16).digest()
                    out.append((id_, version, name, int(code[i]), a, b, c))
            yield pd.DataFrame(out, columns=["id", "version", "s", "h", "first", "at", "stop"])

    kind = f"id {texts.schema['id'].dataType.simpleString()}, version long, {_PLACE}"
    found = step(texts.mapInPandas(places, kind), "suffixes")
    one = F.struct(*KEYS, "first", "at", "stop")
    distinct = found.groupBy("s", "h").agg(F.count("*").alias("n"), F.min(one).alias("r"))
    distinct = step(distinct.select("s", "h", "n", "r.*"), "distinct-suffixes")
    total = distinct.count()
    parts = max(1, min(total // 10_000, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    lists = distinct.groupBy(*KEYS).agg(F.collect_list(F.struct("s", "first", "at", "stop")).alias("places"))
    source = _equi(texts.drop("hs").dropDuplicates(KEYS), lists)

    def keys_of(batches):
        for batch in batches:
            for data, rows in zip(batch["data"], batch["places"], strict=True):
                data = bytes(data)
                for r in rows:
                    yield bytes(r["s"]), *_suffix(data, r["first"], r["at"], r["stop"])

    # splitters: a sample of documents whose size follows the number of ranges, never the input
    share = max(1, total // (parts * 32))
    sample = source.where(F.pmod(F.xxhash64("id", "version"), F.lit(share)) == 0)

    def sampled(batches):
        for batch in batches:
            rows = [(x, y) for _, x, y in keys_of([batch])]
            yield pd.DataFrame({"x": [r[0] for r in rows], "y": [r[1] for r in rows]})

    drawn = sample.mapInPandas(sampled, "x binary, y binary").limit(parts * 128).collect() if parts > 1 else []
    cuts = []
    for c in range(2):
        keys = sorted(bytes(r[c]) for r in drawn)
        cuts.append([keys[len(keys) * i // parts] for i in range(1, parts)] if keys else [])

    def runs(batches):
        from pyspark import TaskContext

        nth, held = 0, []

        def flush():
            nonlocal nth, held
            out = []
            for order in range(2):
                ordered = sorted((x[1 + order], x[0]) for x in held)
                begin = 0
                for part in range(len(cuts[order]) + 1):
                    end = bisect_right(ordered, (cuts[order][part], b"")) if part < len(cuts[order]) else len(ordered)
                    for j, block in enumerate(front_code(ordered[begin:end])):
                        out.append((order, part, TaskContext.get().partitionId(), nth, j, block))
                    begin = end
            nth, held = nth + 1, []
            return pd.DataFrame(out, columns=["ord", "part", "task", "run", "block", "data"])

        for item in keys_of(batches):
            held.append(item)
            if len(held) >= RUN:
                yield flush()
        if held:
            yield flush()

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["task", "run", "block"])
        streams = [unfold([bytes(b) for b in g["data"]]) for _, g in part.groupby(["task", "run"], sort=False)]
        rows = list(neighbours(merge(streams)))
        out = pd.DataFrame(rows, columns=["s", "lead", "beside", "edge"])
        out["ord"] = int(part["ord"].iloc[0])
        return out

    dealt = source.mapInPandas(runs, "ord int, part int, task int, run int, block int, data binary")
    sorted_ = dealt.groupBy("ord", "part").applyInPandas(merged, "s binary, lead int, beside int, edge boolean, ord int")
    sorted_ = step(sorted_, "sorted-suffixes")
    right = sorted_.where("ord = 0").selectExpr("s", "lead as r", "beside as r_l", "edge as r_edge")
    left = sorted_.where("ord = 1").selectExpr("s", "lead as l", "beside as l_r", "edge as l_edge")
    sides = distinct.join(right, "s").join(left, "s")
    sides = sides.selectExpr(
        "*", "if(r_edge, stop - at, r) as r_max", "if(l_edge, at - first, l) as l_max",
        f"not r_edge and r + r_l >= {length} as r_sure", f"not l_edge and l + l_r >= {length} as l_sure",
    )
    sides = sides.selectExpr("*", f"n > 1 or r_max + l_max < {length} or (r_sure and l_sure) as settled")
    sides = step(sides, "suffix-matches")
    sure = sides.where("settled").selectExpr(
        "s", "if(n > 1, at - first, l_max) as l", "if(n > 1, stop - at, r_max) as r"
    ).where(f"l + r >= {length}")
    open_ = sides.where("not settled").select("h").distinct()
    # the windows that could match, of all suffixes with such a k-gram
    asked = sides.join(open_, "h", "left_semi").where(f"r_max + l_max >= {length} or n > 1")
    asked = asked.selectExpr(
        *KEYS, "named_struct('s', s, 'at', at, 'lo', if(n > 1, 0, 1), 'o1', greatest(length_ - if(n > 1, stop - at, r_max), 0),"
        " 'o2', if(n > 1, at - first, l_max)) as q".replace("length_", str(length))
    )
    asked = asked.groupBy(*KEYS).agg(F.collect_list("q").alias("qs"))

    def windows(batches):
        for batch in batches:
            out = []
            for data, qs in zip(batch["data"], batch["qs"], strict=True):
                data = bytes(data)
                for q in qs:
                    for o in range(q["o1"], q["o2"] + 1):
                        window = data[q["at"] - o : q["at"] - o + length]
                        out.append((hashlib.blake2b(window, digest_size=16).digest(), bytes(q["s"]), o, q["lo"]))
            yield pd.DataFrame(out, columns=["w", "s", "o", "lo"])

    tested = _equi(texts.drop("hs").dropDuplicates(KEYS), asked).mapInPandas(windows, "w binary, s binary, o int, lo int")
    tested = step(tested, "windows")
    again = tested.groupBy("w").count().where("count > 1").select("w")
    checked = tested.where("lo = 1").join(again, "w", "left_semi").groupBy("s")
    checked = checked.agg(F.max("o").alias("l"), (F.lit(length) - F.min("o")).alias("r"))
    both = sure.union(checked.join(sides.where("not settled").select("s"), "s", "left_semi").select("s", "l", "r"))
    out = found.select(*KEYS, "s", "at").join(both, "s").selectExpr(*KEYS, "at - l as start", "at + r as stop")
    return out, texts


def _code_rows(docs: DataFrame, length: int, k: int) -> DataFrame:
    """``id``, ``version``, ``h`` and how many anchors of the text have that hash."""

    def rows(batches):
        for batch in batches:
            ids, versions, hashes, counts = [], [], [], []
            for id_, version, data in zip(batch["id"], batch["version"], batch["data"], strict=True):
                code, _, at, _ = anchors(bytes(data), length, k)
                if len(at):
                    unique, n = np.unique(code[np.r_[True, at[1:] != at[:-1]]], return_counts=True)
                    ids += [id_] * len(unique)
                    versions += [version] * len(unique)
                    hashes.append(unique)
                    counts.append(n)
            empty = np.zeros(0, np.int64)
            yield pd.DataFrame(
                {"id": ids, "version": versions, "h": np.concatenate([empty, *hashes]), "n": np.concatenate([empty, *counts])}
            )

    return docs.mapInPandas(rows, f"id {docs.schema['id'].dataType.simpleString()}, version long, h long, n long")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 400, k: int = 128) -> DataFrame:
    """One row per row of ``df``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the kept ``runs``.

    ``runs`` lists (start, stop) of the bytes that stay; it is null where all do.
    """
    covered, texts = spans(df, id_col, text, length, k)
    lists = covered.groupBy(*KEYS).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def cut(batches):
        for batch in batches:
            out = []
            for id_, version, data, found in zip(batch["id"], batch["version"], batch["data"], batch["spans"], strict=True):
                data = bytes(data)
                runs, at, spans_n, removed = [], 0, 0, 0
                end = -1
                for start, stop in sorted((int(s["start"]), int(s["stop"])) for s in found):
                    if start > end:  # touching runs are one
                        spans_n += 1
                        if start > at:
                            runs.append({"start": at, "stop": start})
                        at = end = start
                    if stop > end:
                        removed += stop - max(end, start)
                        at = end = stop
                if at < len(data):
                    runs.append({"start": at, "stop": len(data)})
                digest = hashlib.sha256()
                for r in runs:
                    digest.update(data[r["start"] : r["stop"]])
                out.append((id_, version, removed, spans_n, digest.hexdigest(), runs))
            yield pd.DataFrame(out, columns=["id", "version", "n_removed", "n_spans", "kept", "runs"])

    kind = f"id {texts.schema['id'].dataType.simpleString()}, version long, n_removed long, n_spans long, kept string"
    kind += ", runs array<struct<start:long,stop:long>>"
    changed = _equi(texts.drop("hs").dropDuplicates(KEYS), lists).mapInPandas(cut, kind)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = df.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(body).alias("version"),
        F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("whole"),
    )
    out = _equi(base, changed, "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept", "whole").alias("kept_sha256"), "runs",
    )
