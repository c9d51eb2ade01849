"""Importance resampling towards a target: hashed word n-gram models weigh documents, Gumbel noise draws them.

Words are lower-cased in A-Z only; features are runs of one to ``orders`` words. The features of a batch are interned in an
open-addressed table, whose slots hold each feature's bucket and count; the slot of every occurrence then gathers its gain.

A null, empty or wordless text has no feature and weight 0. A null id is hashed as an empty string and comes last among
equal scores. Repeated rows are weighed and drawn one by one. Empty tables give an empty result; with no target text
every gain comes from the smoothing alone. Texts of any length are read whole, in pieces that repeat the words an
n-gram needs. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, step
from tabforge.llm.wordgrams import SpanTable, Words, crc32s, pieces

BUCKETS = 10_000
ORDERS = 2


def occurrences(words: Words, again: int, orders: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of every n-gram; those within the first ``again`` words were counted before."""
    start, length, row = [], [], []
    for n in range(1, orders + 1):
        if len(words.start) < n:
            break
        head, tail = slice(0, len(words.start) - n + 1), slice(n - 1, None)
        on = words.row[head] == words.row[tail]
        on[: max(0, again - n + 1)] = False
        start.append(words.start[head][on])
        length.append(words.end[tail][on] - words.start[head][on])
        row.append(words.row[head][on])
    if not start:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(start), np.concatenate(length), np.concatenate(row)


def slots(words: Words, again: int, orders: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece's n-grams: slot and row of each occurrence, and by slot the bucket and the count."""
    start, length, row = occurrences(words, again, orders)
    table = SpanTable(words.data, start, length)
    bucket = np.zeros(len(table.first), np.int64)
    own = table.first[table.used]
    bucket[table.used] = crc32s(words.data, start[own], length[own]) % buckets
    count = np.bincount(table.slot, minlength=len(table.first))
    return table.slot, row, bucket, count


def bucket_counts(df: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """How many features of all texts fall into each ``bucket``: column ``n``. Tasks send one row a bucket."""
    small_batches(df.sparkSession)

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for words, again in pieces(batch["text"], overlap=orders - 1):
                _, _, bucket, n = slots(words, again, orders, buckets)
                np.add.at(total, bucket[n > 0], n[n > 0])
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    body = df.select(F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    return body.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A bucket's gain in thousandths of a nat, from two tables of ``bucket_counts``, of ``buckets`` rows at most."""
    both = []
    for counts in (source, target):
        n = np.zeros(buckets)
        for r in counts.collect():
            n[r.bucket] = r.n
        both.append(n)
    s, t = both
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(df: DataFrame, gain: np.ndarray, text: str = "text", orders: int = ORDERS) -> DataFrame:
    """``df`` with a column ``__w`` of ``n_words``, ``n_features`` and ``weight``, the floored mean gain."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(gain)  # one number a bucket

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        gain, rows = shared.value, len(texts)
        n_words, n, total = (np.zeros(rows, np.int64) for _ in range(3))
        for words, again in pieces(texts, overlap=orders - 1):
            n_words += np.bincount(words.row[again:], minlength=rows)
            slot, row, bucket, _ = slots(words, again, orders, len(gain))
            n += np.bincount(row, minlength=rows)
            np.add.at(total, row, gain[bucket][slot])
        return pd.DataFrame({"n_words": n_words, "n_features": n, "weight": total // np.maximum(n, 1)})

    return df.withColumn("__w", weigh(F.col(f"`{text}`").cast("string")))


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = 25, least_words: int = 20, seed: int = 7, orders: int = ORDERS, buckets: int = BUCKETS,
) -> DataFrame:
    """Every row's id, ``n_features``, ``weight``, ``score`` and ``rank`` (null if it is not drawn).

    A score is the weight plus Gumbel noise that the id alone decides, so the highest scores are a draw without
    replacement by weight. Scores are whole numbers of a bounded range (gains below 44,000, noise below 23,000 in size),
    so ranks need no sort of the whole table: a table of one row a score gives each score its first rank, and rows are
    numbered within a score.
    """
    gain = gains(bucket_counts(df, text, orders, buckets), bucket_counts(target, target_text, orders, buckets), buckets)
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = weights(rows, gain, "text", orders).select("id", "__w.*", (F.col("__w.weight") + noise).alias("score"))
    rows = step(rows, "scores")
    fit = rows.where(F.col("n_words") >= least_words)
    levels = fit.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    every = Window.orderBy(F.desc("score"))  # over one row a score
    levels = levels.select("score", (F.sum("n").over(every) - F.col("n")).alias("__before"), F.sum("n").over(Window.partitionBy()).alias("__all"))
    levels = levels.select("score", "__before", F.expr(f"__all * {int(percent)} div 100").alias("__take")).where("__before < __take")
    ties = Window.partitionBy("score").orderBy(F.asc_nulls_last("id"), "n_features", "weight")
    rows = rows.join(F.broadcast(levels), "score", "left")
    out = ["id", "n_features", "weight", "score"]
    drawable = F.col("__take").isNotNull() & (F.col("n_words") >= least_words)
    ranked = rows.where(drawable).withColumn("__rank", F.col("__before") + F.row_number().over(ties))
    ranked = ranked.select(*out, F.when(F.col("__rank") <= F.col("__take"), F.col("__rank")).alias("rank"))
    rest = rows.where(~drawable).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.union(rest).withColumnRenamed("id", id_col)
