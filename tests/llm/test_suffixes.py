"""Repeated byte strings: the merge sort and the whole operator against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tabforge.llm import suffixes


def brute(texts, length):
    where = {}
    raws = [(t or "").encode() for t in texts]
    for d, raw in enumerate(raws):
        for p in range(len(raw) - length + 1):
            where.setdefault(raw[p : p + length], []).append((d, p))
    covered = [bytearray(len(r)) for r in raws]
    for places in where.values():
        if len(places) > 1:
            for d, p in places:
                covered[d][p : p + length] = b"\x01" * length
    out = []
    for raw, c in zip(raws, covered, strict=True):
        spans = sum(1 for i, x in enumerate(c) if x and (i == 0 or not c[i - 1]))
        kept = bytes(b for b, x in zip(raw, c, strict=True) if not x)
        out.append((len(raw), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_merge_is_sorted_and_shares_are_right(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) + b"\xff" + b"\xff" for _ in range(rng.randint(0, 200))]
    runs = [[] for _ in range(rng.randint(1, 7))]
    for i, s in enumerate(strings):
        rng.choice(runs).append((s, b"%016d" % i))
    coded = [list(suffixes.front_code(sorted(r))) for r in runs]
    got = list(suffixes.merge([suffixes.unfold(c) for c in coded]))
    assert [g[1] for g in got] == sorted(strings)
    assert sorted(g[2] for g in got) == [b"%016d" % i for i in range(len(strings))]
    for before, now in zip(got, got[1:], strict=False):
        assert now[0] == suffixes.common(before[1], now[1], 0)


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(5)
    a = bytes(rng.choices(b"abc ", k=900))
    b = bytes(rng.choices(b"abc ", k=300)) + a[100:700] + bytes(rng.choices(b"abc ", k=200))

    def of(data, p):
        code, first, at, stop = suffixes.anchors(data, 100, 32)
        i = int(np.searchsorted(first, p, "right")) - 1
        assert first[i] <= p <= stop[i] - 100 and first[i] <= at[i]
        return code[i], at[i] - p

    for p in range(100, 600):
        assert of(a, p) == of(b, p + 200)


def test_chunks(monkeypatch):
    rng = random.Random(6)
    data = bytes(rng.choices(b"abcdef", k=5000))
    whole = suffixes.anchors(data, 60, 20)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    parts = suffixes.anchors(data, 60, 20)
    assert set(whole[2].tolist()) == set(parts[2].tolist())
    assert sum(whole[3] - whole[1] - 59) == sum(parts[3] - parts[1] - 59) == 5000 - 59


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choices("abcdefgé ", k=n))
    shared = [word(rng.randint(30, 120)) for _ in range(6)]
    texts = [None, "", "short", "aaaa" * 60]
    for _ in range(60):
        parts = [rng.choice(shared)[rng.randint(0, 20) :] if rng.random() < 0.5 else word(rng.randint(1, 80)) for _ in range(5)]
        texts.append("".join(parts))
    texts += [texts[10], texts[10], texts[11][:-5]]
    rows = [(i if i != 7 else None, t, 9) for i, t in enumerate(texts)] + [(10, texts[10], 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed int")
    got = suffixes.deduplicate(df, length=40, k=13).collect()
    want = brute([t for _, t, _ in rows], 40)
    expect = sorted((str(i), *w) for (i, _, _), w in zip(rows, want, strict=True))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expect
    texts_by = {i: t for i, t, _ in rows}
    for r in got:
        if r.runs is not None and r.doc_id is not None:
            raw = (texts_by[r.doc_id] or "").encode()
            assert hashlib.sha256(b"".join(raw[x.start : x.stop] for x in r.runs)).hexdigest() == r.kept_sha256


def test_many_contexts_of_one_passage(spark):
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefgh", k=55))
    rows = [(i, "".join(rng.choices("xyzw", k=rng.randint(0, 60))) + passage + "".join(rng.choices("xyzw", k=30))) for i in range(300)]
    got = {r.doc_id: r for r in suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), length=40, k=13).collect()}
    for (i, _), w in zip(rows, brute([t for _, t in rows], 40), strict=True):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == w


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.deduplicate(df).count() == 0
