"""Lines, SimHash and decontamination against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabforge.llm import decontaminate, lines, simhash
from tabforge.llm.components import components


def brute_lines(rows):
    """Removed line numbers per row, the rows as (id, text) in any order."""
    seen, out = [], {}
    spot = sorted({(i is not None, i if i is not None else 0, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n"))})
    removed = set()
    for has, i, n, line in spot:
        words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)
        if not words:
            continue
        if any((h, j, m) < (has, i, n) and 5 * len(words & o) >= 4 * len(words | o) for h, j, m, o in seen):
            removed.add((has, i, n, line))
        seen.append((has, i, n, words))
    for i, t in rows:
        key = (i is not None, i if i is not None else 0)
        out.setdefault((i, t), [n for n, line in enumerate((t or "").split("\n")) if t is not None and (*key, n, line) in removed])
    return out


def line_rows(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    pool = [" ".join(rng.choices(vocab, k=rng.randint(1, 25))) for _ in range(30)]

    def line():
        words = rng.choice(pool).split() if rng.random() < 0.5 else rng.choices(vocab, k=rng.randint(0, 30))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocab)
        return rng.choice([" ", "\t", "  "]).join(words)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 7)))) for i in range(60)]
    rows += [(None, pool[0]), (100, None), (101, ""), (102, "\n \n"), (3, rows[3][1]), (3, pool[1] + "\nother " + pool[2])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, seed):
    rows = line_rows(seed)
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, removed string, n_lines int")
    want = brute_lines(rows)
    cleaned = lines.clean(df)
    assert cleaned.columns == df.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in cleaned.collect())
    expect = []
    for i, t in rows:
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[i, t])
        expect.append((str(i), str(kept)))
    assert got == sorted(expect)
    summed = sorted((str(r.doc_id), r.n_lines, list(r.removed)) for r in lines.summary(df).collect())
    assert summed == sorted((str(i), 0 if t is None else len(t.split("\n")), want[i, t] if t is not None else []) for i, t in rows)
    assert all(r.n_removed == len(r.removed) for r in lines.summary(df).collect())


def test_families_of_like_lines(spark, monkeypatch):
    """Many lines near each other: all but the first go, also where the nearest mark belongs to a line that isn't similar."""
    base = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]])) for i in range(120)]
    rows += [(200 + i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in lines.summary(df).collect()}
    assert got == {i: int(0 < i < 120) for i, _ in rows}
    # marks of two bits tell almost nothing: the other pairs of a set decide
    monkeypatch.setattr(lines, "MARK", 2)
    assert {r.doc_id: r.n_removed for r in lines.summary(df).collect()} == got


def test_a_family_makes_pairs_by_its_lines(spark, monkeypatch):
    """No step of a family of like lines holds its pairs, also where lines drift away from the first one."""
    base = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]])) for i in range(150)]
    rows += [(500 + i, " ".join(f"d{k}" for k in range(i, i + 30))) for i in range(30)]
    made, write = {}, lines.step

    def counted(df, name):
        out = write(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(lines, "step", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lines.summary(df).collect()} == {i: int(i not in (0, 500)) for i, _ in rows}
    assert max(made.values()) <= 8 * len(rows), made


def test_posts_are_dealt_in_passes(spark):
    """A pass deals a part of the prefixes' words, and all passes together each word of each set once."""
    rows = [(i, " ".join(f"w{k}" for k in range(9 * i, 9 * i + 40))) for i in range(60)]
    found = lines.classes(lines.sets(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"))
    passes = [lines.posts(found, turn).collect() for turn in range(lines.PASSES)]
    assert max(map(len, passes)) < 0.5 * sum(map(len, passes))
    want = found.selectExpr("mark", "explode(slice(head, 1, 9)) as w").collect()
    assert sorted((r.mark, r.w) for p in passes for r in p) == sorted((r.mark, r.w) for r in want)


def test_filters_are_no_text_in_the_plan(spark):
    """A filter passes all wanted keys and few others, and its bits don't stand in the plan, which the driver holds as text."""
    df = spark.range(3000).withColumn("v", F.lit("x"))
    kept = lines.sieve(df, ["id", "v"], df.where("id % 10 = 3"))
    assert len(kept._jdf.queryExecution().toString()) < 20_000
    got = {r.id for r in kept.collect()}
    assert got >= set(range(3, 3000, 10)) and len(got) < 400


def test_open_sets_go_without_their_lines(spark, monkeypatch):
    """What is dealt for the join has no line of a set, and only lines that go are gathered by document."""
    seen, write = {}, lines.step
    monkeypatch.setattr(lines, "step", lambda df, name: seen.setdefault(name, write(df, name)))
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}\nsame line in each of them") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r.id: list(r.removed) for r in lines.removals(df).collect()}
    assert gone == {i: [1] for i in range(1, 9)}
    assert set(seen["open-sets"].columns) == {"mark", "more", "n", "head", "late"}


def test_fine_marks_bound_the_words_apart(spark):
    """The bits that the marks of long sets differ in, halves of classes told apart, are no more than the words."""
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(words[i : i + 150 - i % 7])) for i in range(0, 120, 6)]
    found = lines.sets(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    texts = {i: set(t.split()) for i, t in rows}
    for a in found:
        for b in found:
            apart, finer = a.mark ^ b.mark, a.more ^ b.more
            bits = ((apart ^ finer) & (1 << 64) - 1).bit_count() + finer.bit_count()
            assert bits <= len(texts[a.id] ^ texts[b.id])


def test_long_lines_meet_on_the_word_alone(spark):
    words = [f"t{k}" for k in range(5000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:4200])), (3, " ".join(words[:3900]))]
    got = {r.doc_id: r.n_removed for r in lines.summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1}  # 3 is like 2


def test_lines_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lines.clean(df).count() == 0 and lines.summary(df).count() == 0


def test_lines_run_without_python(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    plan = lines.clean(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("seed", range(20))
def test_fingerprint(seed):
    rng = random.Random(seed)
    text = "".join(rng.choices(["Ab", "é", "É", "c", " ", "\n", "\x0b", "\u00a0", "zz "], k=rng.randint(0, 80)))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("distance,depth", [(0, 12), (1, 12), (2, 12), (3, 20)])
def test_trie_join(distance, depth):
    rng = np.random.default_rng(depth + distance)
    values = np.unique(rng.integers(0, 1 << depth, 300, dtype=np.uint64))
    got = [(int(a), int(b)) for x, y in simhash.trie_join(values, np.zeros(len(values), int), depth, distance, room=64) for a, b in zip(x, y, strict=True)]
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(apart <= distance, 1)), strict=True)}
    assert len(got) == len(set(got)) and {(min(p), max(p)) for p in got} == want


@pytest.mark.parametrize("blocks,split", [(None, 100_000), (6, 100_000), (None, 50)])
def test_links_lose_none(spark, blocks, split):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, rng.integers(1, 6), replace=False))) for b in base for _ in range(4)]
    near_zero = np.array([1 << i | 1 << j for i in range(0, 64, 5) for j in range(0, 64, 7)], np.uint64)  # a crowded block
    values = np.unique(np.r_[base, np.array(flips, np.uint64), near_zero])
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.links(df, 3, blocks, split).collect()}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    signed = values.view(np.int64).tolist()
    want = {tuple(sorted((signed[a], signed[b]))) for a, b in zip(*np.nonzero(np.triu(apart <= 3, 1)), strict=True)}
    assert got == want


def test_near_duplicates(spark):
    rows = [(5, None), (4, ""), (9, " \n"), (7, "one two three four"), (2, "One two THREE four"), (None, "alone is this one"), (7, "one two three four"), (3, "x")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, component_id int")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
    zero = "0" * 16
    assert [g for g in got if g[1] == zero] == [("4", zero, 4), ("5", zero, 4), ("9", zero, 4)]
    assert {g[0]: g[2] for g in got} == {"4": 4, "5": 4, "9": 4, "7": 2, "2": 2, "3": 3, "None": None}
    assert len(got) == len(rows)
    assert sorted(str(r.doc_id) for r in simhash.representatives(df).collect()) == ["2", "3", "4", "None"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7), (None, 3)]
    root = {n: n for p in pairs if None not in p for n in p}
    for _ in range(200):
        for a, b in pairs:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {n for a, b in pairs if a is not None and a != b for n in (a, b)}
    assert got == {n: root[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def sellers(item, text):
    row = np.zeros(len(text) + 1, int)
    steps = np.arange(len(text) + 1)
    for i, c in enumerate(item):
        new = np.r_[i + 1, np.minimum(row[:-1] + (text != c), row[1:] + 1)]
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


@pytest.mark.parametrize("seed", range(12))
def test_matches(seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(decontaminate, "PIECE", 64)
    letters = "ab " if seed % 3 == 0 else "abcdefgh "
    for _ in range(12):
        items = [(k, "".join(rng.choices(letters, k=rng.randint(1, 120)))) for k in range(5)]
        index = decontaminate.Index.of([*items, (9, None), (10, " ")])
        planted = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, max(1, len(planted) // 8))):
            at = rng.randrange(len(planted) + 1)
            planted[at : at + rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 1))
        text = "".join(rng.choices(letters, k=rng.randint(0, 500))) + "".join(planted) + "".join(rng.choices(letters, k=300))
        points = decontaminate.normal(text)[0].astype(int)
        want = {index.ids[k] for k, p in enumerate(index.points) if sellers(p.astype(int), points) <= index.edits[k]}
        assert {index.ids[m[0]] for m in decontaminate.matches(text, index)} == want


def test_find_and_clean(spark):
    item = "The quick brown fox jumps over the lazy dog and runs away into the dark forest at night."
    edited = item.upper().replace("QUICK", "QUIKC").replace(" ", "  ")
    texts = ["nothing of it", f"before it {item} after", f"x\n{edited}\ny", None, "", item[:60]]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    items = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find(df, items).collect()}
    assert set(got) == {1, 2} and got[1].edits == 0 and texts[1][got[1].start : got[1]["end"]] == item
    assert texts[2][got[2].start : got[2]["end"]] == edited and got[2].edits == 2
    assert sorted(r.doc_id for r in decontaminate.clean(df, items).collect()) == [0, 3, 4, 5]
    assert decontaminate.find(df.limit(0), items).count() == 0
    assert decontaminate.find(df, items.where(F.lit(False))).count() == 0
    assert decontaminate.clean(df, items.where(F.lit(False))).count() == 6


def test_representatives_are_one_row_a_component(spark):
    a, b, c = ("".join(f"{w}{i} " for i in range(80)) for w in ("left", "right", "other"))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (1, a, "x"), (3, c, "y"), (3, c, "z"), (None, c, "x"), (None, "alone " * 9, None), (4, None, "x"), (5, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __fp string").repartition(3)
    out = simhash.representatives(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (None, "alone " * 9), (4, None)], key=str)
    assert simhash.representatives(df.limit(0)).count() == 0
