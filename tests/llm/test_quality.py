"""Weak supervision: base figures by brute force, votes and EM on known truth."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


@pytest.mark.parametrize("seed", range(25))
def test_features(seed):
    rng = random.Random(seed)
    text = "".join(rng.choices(["a", "b b", " ", "\n", "\t", "é#", "\x0b", " ", "c\n", "$"], k=rng.randint(0, 200)))
    assert quality.features(text)[:5] == plain(text)


def test_estimate_finds_the_accuracies():
    """Documents with at most one main fault, whose rule mostly sees it while the others err now and then."""
    rng = np.random.default_rng(1)
    n, rules = 40_000, 4
    fault = rng.choice(rules + 1, n, p=[0.8, 0.08, 0.06, 0.04, 0.02])  # 0: none
    bad = rng.random((n, rules)) < np.where(fault[:, None] == 0, 0.001, 0.05)
    for t in range(rules):
        mine = fault == t + 1
        bad[mine, t] = rng.random(mine.sum()) < 0.97
    votes = np.where(bad, -1, 1)
    votes[rng.random(votes.shape) < 0.1] = 0
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, on_good, on_bad, share = quality.estimate(patterns, counts)
    kept = posterior[which.ravel()] > 0.5
    assert abs(share - 0.8) < 0.04 and (on_good >= 0.995).all()
    assert (kept == (fault == 0)).mean() > 0.96
    assert np.all(np.diff(on_bad) < 0.05)  # the commoner its fault, the more of the bad documents a rule sees


@pytest.mark.parametrize("share", [0.003, 0.01, 0.05, 0.1, 0.3])
@pytest.mark.parametrize("abstain", [0.0, 0.1])
def test_a_rule_that_errs_alone_rejects_nothing(share, abstain):
    """One rule votes bad on a share of clean documents; one in a hundred documents has three faults, its own among them."""
    rng = np.random.default_rng(2)
    n, rules = 200_000, 8
    bad = np.zeros((n, rules), bool)
    faulty = rng.random(n) < 0.01
    bad[:, 2] = rng.random(n) < share
    bad[np.ix_(faulty, [2, 4, 5])] = True
    votes = np.where(bad, -1, 1)
    votes[rng.random(votes.shape) < abstain] = 0
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, on_good, _, good = quality.estimate(patterns, counts)
    kept = posterior[which.ravel()] > 0.5
    told = (votes[:, [4, 5]] != 0).any(axis=1)  # where both abstain, nothing tells a fault from the whim
    assert kept[~faulty & told].all() and not kept[faulty & told].any()
    assert abs(on_good[2] - (1 - share)) < 0.003 and abs(good - 0.99) < 0.003


SHARES = [0.003, 0.01, 0.05, 0.1, 0.3]


# any two faults at a whim's share of 0.05, or where rules also abstain, are numbers that independent rules could give: not told apart
@pytest.mark.parametrize(
    "share,abstain,pairs", [(s, a, False) for s in SHARES for a in (0.0, 0.1)] + [(s, 0.0, True) for s in SHARES if s != 0.05]
)
def test_a_rule_that_errs_alone_beside_documents_with_two_faults(share, abstain, pairs):
    """One document in twenty has two faults, always the same two or any two; one rule also votes bad on clean ones."""
    rng = np.random.default_rng(3)
    n, rules = 200_000, 8
    bad = np.zeros((n, rules), bool)
    faulty = rng.random(n) < 0.05
    bad[:, 2] = rng.random(n) < share
    if pairs:
        both = np.argsort(rng.random((faulty.sum(), rules)), axis=1)[:, :2]
        bad[np.flatnonzero(faulty)[:, None], both] = True
    else:
        bad[np.ix_(faulty, [2, 4])] = True
    votes = np.where(bad, -1, 1)
    votes[rng.random(votes.shape) < abstain] = 0
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, *_ = quality.estimate(patterns, counts)
    kept = posterior[which.ravel()] > 0.5
    assert kept[~faulty].mean() > 0.9999
    seen = (votes == -1).sum(axis=1) >= 2  # where a rule abstains, one of the faults may be unseen
    assert not kept[faulty & seen].any()


def test_a_lone_fault_that_shows_in_abstentions_stays_a_fault():
    """A twentieth of the documents has a fault that one rule sees; another rule often abstains there."""
    rng = np.random.default_rng(4)
    n = 20_000
    votes = np.ones((n, 5), int)
    faulty = rng.random(n) < 0.05
    votes[faulty, 1] = -1
    votes[faulty & (rng.random(n) < 0.2), 3] = 0
    votes[rng.random(n) < 0.02, 3] = 0
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, *_ = quality.estimate(patterns, counts)
    assert ((posterior[which.ravel()] > 0.5) == ~faulty).all()


def test_operator(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit("x").alias("kept"))
    extra = spark.createDataFrame([(None, None, "x"), (-1, "", "x"), (-2, " \n ", "x")], "doc_id long, text string, kept string")
    voted = quality.votes(df.union(extra))
    out = {r.doc_id: r for r in quality.judge(voted, quality.posteriors(voted)).collect()}
    for r in out.values():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert not any(out[k].kept for k in (None, -1, -2))


def test_held_out_labels(spark):
    """Accuracy on labels that the rules never see: bad documents go, good ones stay."""
    sf = "/root/testdata/sf0.01"
    voted = quality.votes(spark.read.parquet(f"{sf}/documents.parquet"))
    judged = quality.judge(voted, quality.posteriors(voted)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = [(r.quality, r.kept) for r in judged.where("n_words >= 50").collect()]
    good, bad = [k for q, k in rows if q == 1], [k for q, k in rows if q == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def test_empty(spark):
    voted = quality.votes(spark.createDataFrame([], "doc_id long, text string"))
    assert quality.judge(voted, quality.posteriors(voted)).count() == 0
