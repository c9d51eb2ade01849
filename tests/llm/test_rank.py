"""Lexical search, language identification and importance resampling against brute force and held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tabforge.llm import importance, langid, lexical, wordgrams
from tabforge.llm.common import step

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def vocabulary(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcéß7ÄZ", k=rng.randint(1, 9))) for _ in range(n)] + ["x" * 40, "ab" * 60]


def texts_of(seed, n):
    rng = random.Random(seed)
    words = vocabulary(seed)
    likely = [1 / (i + 1) for i in range(len(words))]
    gaps = [" ", ", ", "\n", "-", "\t.", "\u0000"]
    out = ["".join(w + rng.choice(gaps) for w in rng.choices(words, likely, k=rng.choice([0, 1, 5, 30, 200]))) for _ in range(n)]
    return [None, "", " .,", *out, out[0], "solo", "y" * 300 + " " + "z" * 300]


# ---- spans


@pytest.mark.parametrize("limit", [1, 40, 10**6])
def test_pieces_hold_every_word_once(limit):
    texts = texts_of(3, 40)
    for overlap in (0, 1, 3):
        got = [[] for _ in texts]
        for words, again in wordgrams.pieces(texts, limit, overlap):
            assert again <= overlap
            raw = words.data.tobytes()
            spans = [(r, raw[a:b].decode()) for a, b, r in zip(words.start, words.end, words.row, strict=True)]
            for r, w in spans[:again]:
                assert w in got[r][-overlap:]
            for r, w in spans[again:]:
                got[r].append(w)
        assert got == [terms(t) for t in texts]


def test_span_table_tells_equal_hashes_apart(monkeypatch):
    rng = random.Random(5)
    raw = [bytes(rng.choices(range(256), k=rng.choice([0, 1, 3, 5, 8, 12, 31, 32, 33, 64, 65, 300]))) for _ in range(800)]
    raw += raw[:300]
    data = np.frombuffer(b"".join(raw) + b" " * 32, np.uint8)
    length = np.array([len(x) for x in raw])
    start = np.cumsum(length) - length
    assert wordgrams.hashes(data, start, length, 42).tolist() == [xxhash.xxh64_intdigest(x, 42) for x in raw]
    assert wordgrams.crc32s(data, start, length).tolist() == [zlib.crc32(x) for x in raw]
    for weak in (False, True):
        if weak:  # all hashes fall on four values: bytes alone tell the spans apart
            monkeypatch.setattr(wordgrams, "hashes", lambda d, s, n: (n % 4).astype(np.uint64))
        table = wordgrams.SpanTable(data, start, length)
        assert sorted(table.spans()) == sorted(set(raw))
        name = dict(zip(table.used.tolist(), table.spans(), strict=True))
        assert [name[s] for s in table.slot.tolist()] == raw


# ---- lexical search


def brute_search(rows, items, k):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        found = []
        for i, c, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, q in asked.items() if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,block,run,limit", [(10**6, 128, 4096, 10**6), (3000, 4, 16, 10**6), (3000, 2, 7, 50)])
def test_search(spark, monkeypatch, shard, block, run, limit):
    monkeypatch.setattr(lexical, "RUN", run)
    texts = texts_of(1, 300)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, texts[5])]
    items = [(1, texts[4]), (2, texts[9]), (3, None), (4, "no such terms"), (5, "solo"), (6, texts[4]), (7, " ".join(vocabulary(1)) * 2)]
    want = brute_search(rows, items, 5)
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, score int, term string").repartition(3)
    asked = spark.createDataFrame(items, "item_id int, text string")
    got = sorted([tuple(r) for r in lexical.search(df, asked, 5).collect()], key=str)
    assert got == want
    # the whole index, small shards and blocks, in this process
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "pieces", lambda t: wordgrams.pieces(t, limit))
    shards, one = [], lexical._Shard()
    for i, t in [r for r in rows if r[1] is not None]:
        one.add([i], [t], None)
        if one.size > shard:
            shards.append(one.rows())
            one = lexical._Shard()
    shards.append(one.rows())
    n_docs, n_terms = sum(s["df"][0] for s in shards), sum(s["n_terms"][0] for s in shards)
    df_of = Counter()
    for s in shards:
        df_of.update(dict(zip(s["term"][1:], s["df"][1:], strict=True)))
    heaps = {}
    for s in shards:
        length = np.frombuffer(s["lengths"][0], "<u4").astype(np.int64)
        damp_of = lambda n: lexical.damping(n, n_docs, n_terms)
        lists = {
            t: lexical.Postings(b, i, p, damp_of(length), damp_of)
            for t, b, i, p in zip(s["term"][1:], s["blocks"][1:], s["impacts"][1:], s["postings"][1:], strict=True)
        }
        ids = [(i is None, i or 0) for i in s["ids"][0]]
        rank = np.empty(len(ids), int)
        rank[sorted(range(len(ids)), key=lambda k: ids[k])] = np.arange(len(ids))
        for item, text in items:
            asked_for = [(n * lexical.term_weight(n_docs, df_of[t]), lists[t]) for t, n in Counter(terms(text)).items() if t in lists]
            docs, scores = lexical.best([x for x in asked_for if x[0]], len(ids), rank, 5)
            heaps.setdefault(item, []).extend((-v, *ids[d]) for d, v in zip(docs.tolist(), scores.tolist(), strict=True))
    merged = [(i, r + 1, None if n else d, -v) for i, h in heaps.items() for r, (v, n, d) in enumerate(sorted(h)[:5])]
    assert sorted(merged, key=str) == want


def test_blocks_are_rejected_before_they_are_unpacked():
    n = 20_000
    rare, common = np.arange(0, n, 997), np.arange(n)
    doc = np.r_[rare, common]
    term = np.r_[np.zeros(len(rare), int), np.ones(n, int)]
    length = np.full(n, 100)
    packed = lexical.pack(term, doc, np.ones(len(doc), int), length[doc])
    damp_of = lambda x: lexical.damping(x, n, 100 * n)
    lists = [lexical.Postings(b, i, p, damp_of(length), damp_of) for b, i, p in zip(packed["blocks"], packed["impacts"], packed["postings"], strict=True)]
    docs, scores = lexical.best([(9000, lists[0]), (1, lists[1])], n, np.arange(n), 3)
    assert docs.tolist() == [0, 997, 1994] and len(set(scores.tolist())) == 1
    assert len(lists[1].open) < 50 < len(lists[1].rows)


def test_search_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(some, items.limit(0)).count() == 0
    assert lexical.search(some, items).count() == 1


def test_search_ids_of_text(spark):
    df = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three"), ("d", "four")], "name string, body string")
    items = spark.createDataFrame([("q", "two")], "q string, body string")
    got = lexical.search(df, items, 5, "name", "body", "q", "body").orderBy("rank").collect()
    assert [(r.q, r["rank"], r.name) for r in got] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


# ---- language identification


def brute_features(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != " ":
                    out[padded[i : i + n]] += 1
    return out


@pytest.mark.parametrize("piece", [7, 1 << 19])
def test_features_are_those_of_the_words(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    texts = [None, "", "123 !", "Ab cd", "été, ÉTÉ 4you", "a b  c\n" * 20, "İstanbul ﬁ ǅ", "ab"]
    # a hash that keeps n-grams apart stands for the n-grams themselves
    want = [brute_features(t or "") for t in texts]
    got = [Counter() for _ in texts]
    for row, bucket in langid.features(texts, 1 << 40):
        for r, b in zip(row.tolist(), bucket.tolist(), strict=True):
            got[r][b] += 1
    if piece > 7:  # letters beyond a piece's size are cut, which changes the n-grams there alone
        assert [sorted(g.values()) for g in got] == [sorted(w.values()) for w in want]
    else:
        assert [sum(g.values()) for g in got[:4]] == [sum(w.values()) for w in want[:4]]


def test_identify(spark, load):
    out = langid.identify(load("documents")).join(load("documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert {r.held_out for r in out if zlib.crc32(str(r.doc_id).encode()) % 3 == 1} == {True}
    assert {r.held_out for r in out if zlib.crc32(str(r.doc_id).encode()) % 3 != 1} == {False}
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_identify_edges(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", 1.5) for i in range(40)]
    rows += [(100, None, "en", 0.0), (101, "", "en", 0.0), (102, "123 ... 4", "de", 0.0), (103, "the dog", None, 0.0), (None, "und die", "de", 0.0), (3, "the cat", "en", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = langid.identify(df).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for i in (100, 101, 102) for r in got[i])
    assert got[103][0].lang_pred == "en" and got[None][0].lang_pred == "de" and len(got[3]) == 2
    assert all(got[i][0].lang_pred == ("en" if i % 2 else "de") for i in range(40))
    assert langid.identify(df.limit(0)).count() == 0
    unlabelled = langid.identify(df.select("doc_id", "text", "score").selectExpr("*", "cast(null as string) lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_equal_posteriors_take_the_first_label():
    model = langid.Model(["aa", "bb"], np.array([5.0, 5.0]), np.ones((langid.BUCKETS, 2)))
    assert model.predict(["some text"])[0] == ["aa"]


# ---- importance resampling


def brute_resample(rows, aims, percent=25, least=20):
    def grams(text):
        w = terms(text)
        return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]

    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(bucket, grams(x)))
    for x in aims:
        t.update(map(bucket, grams(x)))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    out = []
    for i, x in rows:
        g = grams(x)
        weight = sum(gain(bucket(f)) for f in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(x))])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("limit", [30, 10**6])
def test_resample(spark, monkeypatch, limit):
    texts = texts_of(2, 200)
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[8]), (None, texts[9]), (None, None)]
    aims = [None, "", *texts_of(2, 10)[5:]]
    # workers import the module anew: the piece size goes with the function
    monkeypatch.setattr(importance, "pieces", lambda t, overlap: wordgrams.pieces(t, limit, overlap))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, weight string, n int").repartition(3)
    got = importance.resample(df, spark.createDataFrame([(a,) for a in aims], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resample(rows, aims)


def test_resample_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30), (2, "c")], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    out = {r.doc_id: r for r in importance.resample(some, none, percent=100).collect()}
    assert out[1]["rank"] == 1 and out[2]["rank"] is None and out[1].n_features == 119


def test_counts_are_written_once(spark):
    df = spark.createDataFrame([(1, "a b a")], "doc_id long, text string")
    counts = step(importance.bucket_counts(df), "counts")
    assert sum(r.n for r in counts.collect()) == 5
