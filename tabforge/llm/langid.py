"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and every run of characters that are not letters becomes one blank; its features are the n-grams of
one to ``ORDERS`` characters of its words, blanks round them included, hashed into ``BUCKETS``. Class totals, a number
a language and bucket, are all that training gathers; tasks score batches of texts sparsely against the matrix of
logarithms of probabilities, whose size is languages times buckets.

A null text or one without a letter is ``und`` with score 0. Training leaves out null labels and such texts. Equal
posteriors go to the label that sorts first. Repeated rows count and are judged one by one. Without any training text all
rows are ``und``. An empty table gives an empty result. Texts of any length are read whole, in pieces cut at a
blank; only a run of over ``PIECE`` letters without any blank is cut inside. Extra columns are ignored or carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, step

ORDERS = 3
BUCKETS = 1 << 16
#: Characters whose features are in memory at once.
PIECE = 1 << 19
#: Languages of a model: more would make the broadcast matrix exceed 256 MB, and are refused.
MOST_LANGUAGES = 500
UNKNOWN = "und"
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter (surrogates are not)."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def _parts(points: np.ndarray, letter: np.ndarray) -> Iterator[slice]:
    """Pieces of a text, each ending where a blank begins if there is one in it."""
    at = 0
    while len(points) - at > PIECE:
        free = np.flatnonzero(~letter[at + 1 : at + PIECE])
        to = at + 1 + int(free[-1]) if len(free) else at + PIECE
        yield slice(at, to)
        at = to
    yield slice(at, len(points))


def features(texts: list[str | None], buckets: int = BUCKETS, orders: int = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse features of a batch, a piece at a time: row number and bucket of every n-gram, rows in order."""
    table = _letters()
    held: list[np.ndarray] = []
    rows: list[tuple[int, int]] = []
    size = 0
    blank = np.array([32], np.uint32)
    for n, text in enumerate(texts):
        if not text:
            continue
        points = _points(text)
        letter = table[points]
        if not letter.any():
            continue
        for part in _parts(points, letter):
            one, solid = points[part], letter[part]
            if held and size + len(one) > PIECE:
                yield _hashed(held, rows, buckets, orders)
                held, rows, size = [], [], 0
            kept = solid | np.r_[False, solid[:-1]]
            held += [blank, np.where(solid, one, 32)[kept].astype(np.uint32), blank]
            rows.append((n, 2 + int(kept.sum())))
            size += len(one)
    if held:
        yield _hashed(held, rows, buckets, orders)


def _hashed(held: list[np.ndarray], rows: list[tuple[int, int]], buckets: int, orders: int) -> tuple[np.ndarray, np.ndarray]:
    points, row = np.concatenate(held), np.repeat(*np.array(rows).T)
    # blanks of neighbouring pieces fall together
    twice = np.r_[False, (points[1:] == 32) & (points[:-1] == 32) & (row[1:] == row[:-1])]
    points, row = points[~twice].astype(np.uint64), row[~twice]
    letter = points != 32
    found_row, found = [], []
    code = np.zeros(len(points), np.uint64)
    shift = np.uint64(64 - (buckets - 1).bit_length())
    for n in range(1, orders + 1):
        # of the n-gram that begins here; blanks may only be its first and last character
        head, tail = slice(0, len(points) - n + 1), slice(n - 1, None)
        code = (code[head] + points[tail]) * np.uint64(_MIX[n % len(_MIX)])
        code ^= code >> np.uint64(31)
        on = row[head] == row[tail]
        if n <= 2:
            on &= letter[head] | letter[tail]
        for k in range(1, n - 1):
            on &= letter[k : len(points) - n + 1 + k]
        found_row.append(row[head][on])
        found.append(((code[on] * np.uint64(_MIX[0])) >> shift).astype(np.int64))
    return np.concatenate(found_row), np.concatenate(found)


def counts(df: DataFrame, label: str, text: str = "text", buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """Training totals: ``label``, ``bucket`` and ``n``; the row of bucket -1 has the number of texts."""
    small_batches(df.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch["label"].tolist()
            distinct = sorted(set(names))
            code = np.array([distinct.index(x) for x in names], np.int64) if len(distinct) < 50 else np.searchsorted(distinct, names)
            seen = np.zeros(len(names), bool)
            for x in distinct:
                sums.setdefault(x, np.zeros(buckets + 1, np.int64))
            for row, bucket in features(batch["text"].tolist(), buckets, orders):
                seen[row] = True
                own = code[row]
                for c in np.unique(own).tolist():
                    sums[distinct[c]][1:] += np.bincount(bucket[own == c], minlength=buckets)
            for c, n in enumerate(np.bincount(code[seen], minlength=len(distinct)).tolist()):
                sums[distinct[c]][0] += n
            if len(sums) > 64:  # many labels: send what there is instead of holding a matrix of all of them
                yield from _rows(sums)
                sums = {}
        yield from _rows(sums)

    body = df.select(F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{text}`").cast("string").alias("text"))
    body = body.where("label is not null and text is not null")
    found = body.mapInPandas(count, "label string, bucket long, n long")
    return found.groupBy("label", "bucket").agg(F.sum("n").alias("n"))


def _rows(sums: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
    for label, n in sums.items():
        some = np.flatnonzero(n)
        yield pd.DataFrame({"label": label, "bucket": some - 1, "n": n[some]})


class Model:
    """Log-probabilities: ``matrix`` has a row a bucket and a column a label."""

    def __init__(self, labels: list[str], texts: np.ndarray, totals: np.ndarray, alpha: float = 1.0):
        self.labels = labels
        self.prior = np.log(texts / texts.sum()) if len(labels) else np.zeros(0)
        smooth = totals + alpha
        self.matrix = np.log(smooth / smooth.sum(axis=0)) if len(labels) else smooth

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Label and posterior probability of each text."""
        sums, seen = np.zeros((len(texts), len(self.labels))), np.zeros(len(texts), bool)
        orders = ORDERS
        for row, bucket in features(texts, len(self.matrix), orders):
            seen[row] = True
            # a sparse row is a text's distinct buckets and their counts
            key, n = np.unique(row * len(self.matrix) + bucket, return_counts=True)
            row, bucket = key // len(self.matrix), key % len(self.matrix)
            step = max(1, (1 << 22) // max(1, len(self.labels)))
            for at in range(0, len(row), step):
                some = row[at : at + step]
                starts = np.flatnonzero(np.r_[True, some[1:] != some[:-1]])
                part = self.matrix[bucket[at : at + step]] * n[at : at + step, None]
                sums[some[starts]] += np.add.reduceat(part, starts, axis=0)
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        sums += self.prior
        best = sums.argmax(axis=1)
        top = sums[np.arange(len(texts)), best]
        score = 1.0 / np.exp(sums - top[:, None]).sum(axis=1)
        return [self.labels[b] if s else UNKNOWN for b, s in zip(best.tolist(), seen.tolist(), strict=True)], np.where(seen, score, 0.0)


def train(df: DataFrame, label: str, text: str = "text", buckets: int = BUCKETS, orders: int = ORDERS) -> Model:
    """A model of all rows of ``df`` with a label and a letter."""
    found = step(counts(df, label, text, buckets, orders), "language-counts")
    classes = found.where("bucket = -1").orderBy("label").limit(MOST_LANGUAGES + 1).collect()
    if len(classes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    labels = [r.label for r in classes]
    totals = np.zeros((buckets, len(labels)))
    for k, x in enumerate(labels):  # a label at a time: no more than one number a bucket
        part = found.where((F.col("label") == x) & (F.col("bucket") >= 0)).toPandas()
        totals[part["bucket"], k] = part["n"]
    return Model(labels, np.array([r.n for r in classes], float), totals)


def predict(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column ``lang_pred``, ``score`` of each text, for use on ``df``."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MOST_LANGUAGES x buckets numbers

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        label, score = shared.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": label, "score": score})

    return judge(F.col(f"`{text}`").cast("string"))


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: the crc32 of its id as text leaves 1 when divided by 3. A null id isn't."""
    return F.coalesce(F.crc32(F.encode(F.col(f"`{id_col}`").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Every row's id, ``held_out``, ``lang_pred`` and ``score``; learned from the rows that are not held out."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label"))
    rows = rows.withColumn("held_out", held_out("id"))
    model = train(rows.where(~F.col("held_out")), "label")
    return rows.select(F.col("id").alias(id_col), "held_out", predict(rows, model).alias("__p")).select(id_col, "held_out", "__p.*")
