"""Quality rules as weak supervision: rules vote or abstain, EM learns their accuracies, a posterior decides.

Nulls and empty texts have no words, so they fail the base check. Texts of any length are read whole. Equal rows get
equal verdicts. An empty table gives an empty result. Extra columns are carried along; a column named like a result
gives way to the result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, with_columns

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_closed", "n_upper",
            "n_distinct"]
#: Accuracy that a rule is trusted to have on good documents until the counts speak against it, and on its own fault.
LEAST_GOOD, LEAST_SEEN = 0.995, 0.9
#: Prior odds, as a logarithm, that a rule's lone votes are a fault and not its whim: counts add to them or outweigh them.
TRUST = 15.0
#: Statistic of a test with one degree of freedom that holds in 999 of 1,000 cases.
FITS = 10.83
#: Documents with two other bad votes or more that such a test must expect, or it has nothing to test.
LEAST_EXPECTED = 5.0
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_CLOSERS = (".", "!", "?", '"', "'", ")", ":", ";", "…", "”", "»", "。")


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three words which the text holds at least twice."""
    if len(ids) < 4:
        return 0
    _, pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
    triple = pair[:-1].astype(np.int64) * (int(ids.max()) + 1) + ids[2:]
    _, which, count = np.unique(triple, return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def features(text: str | None) -> tuple[int, ...]:
    """The values of ``FEATURES`` for one text; words are runs without ASCII white space."""
    if not text:
        return (0,) * len(FEATURES)
    raw = text.encode()
    words = raw.split()  # bytes.split() knows the six ASCII white space characters and no others
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.encode().split()]
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in " \t\n\v\f\r"),
        len(_SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        sum(line.rstrip().endswith(_CLOSERS) for line in lines),
        upper,
        len(known),
    )


def feature_columns(text: Column) -> Column:
    """Struct of ``FEATURES``."""

    @F.pandas_udf(", ".join(f"{c} long" for c in FEATURES))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(t) for t in texts], columns=FEATURES, dtype="int64")

    return of(text.cast("string"))


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) or good (1) on ``value``; abstains (0) between the two bounds and where ``applies`` is false."""

    name: str
    value: Column
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0)


def rules(f: str = "f") -> list[Rule]:
    """The voting rules over the feature struct ``f``. The bounds."""
    c = {n: F.col(f"{f}.{n}").cast("double") for n in FEATURES}
    words, lines = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["n_lines"], F.lit(1.0))

    def rule(name: str, value: Column, bad, good) -> Rule:
        return Rule(name, value, bad(value), good(value))

    return [
        rule("length", c["n_words"], lambda v: v < 20, lambda v: v >= 100),
        rule("word_length", c["word_chars"] / words, lambda v: (v < 3) | (v > 12), lambda v: (v >= 4) & (v <= 8)),
        rule("symbols", c["n_symbols"] / words, lambda v: v > 0.2, lambda v: v < 0.05),
        rule("repeated_lines", c["n_dup_lines"] / lines, lambda v: v > 0.4, lambda v: v < 0.1),
        rule("repeated_words", c["n_repeat_words"] / words, lambda v: v > 0.5, lambda v: v < 0.1),
        rule("upper_case", c["n_upper"] / words, lambda v: v > 0.4, lambda v: v < 0.1),
        rule("open_lines", c["n_closed"] / lines, lambda v: (v < 0.2) & (c["n_lines"] >= 3), lambda v: v > 0.6),
        rule("vocabulary", c["n_distinct"] / words, lambda v: (v < 0.1) & (c["n_words"] < 2000), lambda v: v > 0.3),
    ]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300, tol: float = 1e-9):
    """EM over vote patterns: what each document's votes say about it, and how often each rule is right.

    ``patterns`` is patterns x rules of -1/0/1 and ``counts`` the documents of each. A good document is of one kind, a bad
    one has a main fault, one kind for each rule. Given its kind, every rule that votes is right or wrong with a
    probability of its own. Rules are at first trusted to spare good documents (accuracy ``LEAST_GOOD`` or more) and to see
    their own fault (``LEAST_SEEN`` or more). Where the counts outweigh that trust (``fault_odds``), the documents that a rule
    alone votes bad are its whim: its kind is given up, where it is alone it counts as abstaining, and its accuracy on good documents is
    estimated without a bound. Returns the probability of "good" for each pattern, the rules' accuracies on good and
    on bad documents, and the share of good documents.
    """
    trusted = np.array([fault_odds(patterns, counts, r) + TRUST >= 0 for r in range(patterns.shape[1])])
    bad = patterns == -1
    whims = (bad & ~trusted).any(axis=1) & (bad.sum(axis=1) == 1)
    heard = np.where(whims[:, None] & bad, 0, patterns)  # where it is alone, such a rule is taken to abstain
    kind, says_good, share = _fit(heard, counts, trusted, rounds, tol)
    faulty = share[1:] / max(share[1:].sum(), 1e-300)
    mass = kind[:, 0] * counts
    on_good = (mass @ (patterns == 1) + 9) / (mass @ (patterns != 0) + 10)
    return kind[:, 0], np.where(trusted, says_good[0], on_good), 1 - faulty @ says_good[1:], float(share[0])


def _fit(patterns: np.ndarray, counts: np.ndarray, trusted: np.ndarray, rounds: int, tol: float):
    """EM with a kind for the fault of each trusted rule: kinds of each pattern, rules' chances to say good, shares."""
    n = patterns.shape[1]
    good, bad, weight = (patterns == 1).astype(float), (patterns == -1).astype(float), counts.astype(float)
    says_good = np.full((n + 1, n), 0.9)  # by kind of document and rule; kind 0 is good
    says_good[0] = LEAST_GOOD
    own = np.flatnonzero(trusted)
    says_good[own + 1, own] = 1 - LEAST_SEEN
    there = np.r_[True, trusted]
    share = np.where(there, np.r_[0.8, np.full(n, 0.2 / n)], 0.0)
    kind = np.zeros((len(patterns), n + 1))
    for _ in range(rounds):
        score = np.log(np.maximum(share, 1e-300)) + good @ np.log(says_good).T + bad @ np.log1p(-says_good).T
        score[:, ~there] = -np.inf
        score -= score.max(axis=1, keepdims=True)
        before, kind = kind[:, 0], np.exp(score)
        kind /= kind.sum(axis=1, keepdims=True)
        if np.abs(kind[:, 0] - before).max(initial=0) < tol:
            break
        mass = kind * weight[:, None]
        # Beta(9, 1) priors keep the probabilities inside (0, 1)
        says_good = (mass.T @ good + 9) / (mass.T @ (good + bad) + 10)
        says_good[0, own] = np.maximum(says_good[0, own], LEAST_GOOD)
        says_good[own + 1, own] = np.minimum(says_good[own + 1, own], 1 - LEAST_SEEN)
        share = np.where(there, mass.sum(axis=0) + 1, 0.0) / (weight.sum() + there.sum())
    return kind, says_good, share


def fault_odds(patterns: np.ndarray, counts: np.ndarray, rule: int) -> float:
    """Logarithm of the odds that the documents which ``rule`` votes bad have a fault of their own, and not its whim.

    If the number of other bad votes beside it is that of independent rules, where enough of them vote bad to tell, these documents are one kind: it is a fault if
    other rules vote bad or abstain on them at other rates than elsewhere. If not, those on which no other rule votes
    bad are a kind by themselves: it is a fault if other rules abstain on them at other rates than on documents without
    any bad vote. Every rate is compared by its evidence: the chance of the counts under a rate of which nothing is known,
    against that under the rate elsewhere.
    """
    others = np.delete(patterns, rule, axis=1)
    bad, abstains = others == -1, others == 0
    mine = patterns[:, rule] == -1
    n = counts[mine].sum()
    if not n:
        return 0.0
    rates = lambda votes, where: counts[where] @ votes[where] / max(counts[where].sum(), 1)
    beside = np.zeros(bad.shape[1] + 1)  # chances of so many other bad votes, were the rules independent
    beside[0] = 1.0
    for q in rates(bad, mine):
        beside[1:] = beside[1:] * (1 - q) + beside[:-1] * q
        beside[0] *= 1 - q
    want = n * np.array([beside[0], beside[1:2].sum(), beside[2:].sum()])
    number = np.minimum(bad.sum(axis=1), 2)
    have = np.array([counts[mine & (number == k)].sum() for k in range(3)])
    some = have > 0
    misfit = 2 * (have[some] * np.log(have[some] / np.maximum(want[some], 1e-300))).sum()
    if misfit < FITS and want[2] >= LEAST_EXPECTED:
        return _evidence(bad, counts, mine, ~mine) + _evidence(abstains, counts, mine, ~mine)
    alone = number == 0
    # a rule that mostly votes bad beside this one abstains on a part of those documents, which then look alone
    usual = rates(bad, mine & ~alone) <= 0.5
    return _evidence(abstains[:, usual], counts, mine & alone, ~mine & alone)


def _evidence(votes: np.ndarray, counts: np.ndarray, here: np.ndarray, there: np.ndarray) -> float:
    """Logarithm of the odds that rules cast ``votes`` at other rates ``here`` than ``there``, summed over the rules."""
    n, m = float(counts[here].sum()), float(counts[there].sum())
    out = 0.0
    for k, usual in zip(counts[here] @ votes[here], (counts[there] @ votes[there] + 0.5) / (m + 1), strict=True):
        out += math.lgamma(k + 1) + math.lgamma(n - k + 1) - math.lgamma(n + 2)
        out -= k * math.log(usual) + (n - k) * math.log1p(-usual)
    return out


def votes(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__features`` (struct) and ``__pattern``: the rules' votes as one number in base three."""
    small_batches(df.sparkSession)
    out = with_columns(df, {"__features": feature_columns(F.col(f"`{text}`"))})
    number = F.lit(0)
    for rule in rules("__features"):
        number = number * 3 + rule.vote() + 1
    return with_columns(out, {"__pattern": number.cast("int")})


def posteriors(voted: DataFrame) -> dict[int, float]:
    """Pattern -> probability that its documents are good, from the counts of all rows.

    Only the counts come to the driver: at most 3 to the number of rules, whatever the input.
    """
    rows = sorted((r[0], r[1]) for r in voted.groupBy("__pattern").count().collect())
    if not rows:
        return {}
    n = len(rules())
    matrix = np.array([[(p // 3**k) % 3 - 1 for k in range(n - 1, -1, -1)] for p, _ in rows])
    posterior, *_ = estimate(matrix, np.array([c for _, c in rows]))
    return {p: float(x) for (p, _), x in zip(rows, posterior, strict=True)}


def judge(voted: DataFrame, table: dict[int, float], threshold: float = 0.5) -> DataFrame:
    """Turn the votes into the base figures, ``base_failed``, ``posterior`` and ``kept``."""
    f = {c: F.col(f"__features.{c}") for c in FEATURES[:5]}
    # one entry a pattern: bounded by the number of rules
    chance = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.col("__pattern")] if table else F.lit(0.0)
    base_failed = (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
    out = with_columns(voted, f | {"base_failed": base_failed, "posterior": chance.cast("double")})
    out = with_columns(out, {"kept": ~F.col("base_failed") & (F.col("posterior") >= threshold)})
    return out.drop("__features", "__pattern")
