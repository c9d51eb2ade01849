"""Train / validation / test splits and folds as one label column.

Random membership is decided by a hash of the row key, so it does not depend on row order,
partitioning or a retry. ``mode="hash"`` compares the hash with a fixed threshold: sizes are met
on average, and it is a pure projection. ``mode="exact"`` meets them exactly: two light scans
find the hash value at which each class reaches its share, then the label is again a comparison.
The table itself is never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.functions.columns import col
from tabforge.plans.ordering import TASK_ROWS, TIE, order_cuts, running_totals, segment_number, with_global_rank, with_tie
from tabforge.session import materialise

_ALL = "g"  # above every hexadecimal digit
_HASH = "__hash"
_LEAD = 4  # leading hash digits that rows are counted by


def key_hash(key: str | Sequence[str], seed: int) -> Column:
    """128-bit hex hash of the seed and the key columns."""
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in names]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _threshold(share: float) -> str:
    return format(min(int(share * 2**32), 2**32 - 1), "08x") if share < 1 else _ALL


def _hash_label(h: Column, shares: Sequence[tuple[str, float]], rest: str) -> Column:
    out, upto = F, 0.0
    for name, share in shares:
        upto += share
        out = out.when(F.substring(h, 1, 8) < _threshold(upto), name)
    return out.otherwise(rest)


def _allot(classes: DataFrame, total: int, of: str, name: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add ``name``: ``total`` dealt over the classes in proportion to ``of``, largest remainders first."""
    rows, n = classes.agg(F.count(F.lit(1)), F.sum(of)).first()
    if not n:
        return classes.withColumn(name, F.lit(0).cast("long"))
    share = f"cast({of} as decimal(38, 0)) * {total}"
    dealt = classes.withColumns(
        {name: F.expr(f"cast({share} div {n} as long)"), "__less": F.expr(f"-cast({share} % {n} as long)")}
    )
    ranked = with_global_rank(dealt, ["__less", "y"], "__place", n_rows=rows, task_rows=task_rows)
    over = dealt.agg((F.lit(total) - F.sum(name)).alias("__over"))  # one row
    ranked = ranked.crossJoin(F.broadcast(over))
    return ranked.withColumn(name, F.col(name) + (F.col("__place") <= F.col("__over")).cast("long")).drop("__less", "__place", "__over")


def _exact_number(
    df: DataFrame, key, seed: int, y: str | None, sizes: Callable[[DataFrame], DataFrame], name: str, task_rows: int
) -> DataFrame:
    """Add ``name`` = how many of its class's cuts a row's hash is above.

    ``sizes`` adds ``ks``, the cumulative rank of each cut in hash order, to the table of classes (``y`` and ``n``).

    One scan counts every class by leading hash digits, on the map side; the sizes of the classes and the group of rows that
    holds each cut come from those counts. A second scan sorts the hashes of these groups alone: the hash is uniform, so
    a group is a 65,536th of its class. Classes stay tables, so a column may have any number of them.
    """
    label, h = col(y) if y is not None else F.lit(0), key_hash(key, seed)
    hashed = df.select(label.alias("y"), h.alias("h"), F.substring(h, 1, _LEAD).alias("lead"))
    counts = materialise(hashed.groupBy("y", "lead").agg(F.count(F.lit(1)).alias("n")), "hash-counts")
    ranks = sizes(counts.groupBy("y").agg(F.sum("n").alias("n")))
    cuts = ranks.select(F.col("y").alias("cy"), F.posexplode("ks").alias("cut", "rank"))
    upto = counts.withColumn("upto", F.sum("n").over(W.partitionBy("y").orderBy("lead")))
    inside = F.col("y").eqNullSafe(F.col("cy")) & (F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto"))
    at = cuts.join(upto, inside, "left")
    at = materialise(at.select("cy", "cut", "rank", F.col("lead").alias("clead"), F.expr("rank - upto + n").alias("k")), "cut-groups")
    same = F.col("y").eqNullSafe(F.col("cy")) & (F.col("lead") == F.col("clead"))
    some = hashed.join(at.where("k IS NOT NULL"), same, "left_semi")
    ranked = some.withColumn("rn", F.row_number().over(W.partitionBy("y", "lead").orderBy("h")))
    placed = at.join(ranked, same & (F.col("rn") == F.col("k")), "left")
    cut = F.when(F.col("rank") > 0, F.coalesce("h", F.lit(_ALL))).otherwise("")
    listed = placed.groupBy("cy").agg(F.sort_array(F.collect_list(F.struct("cut", cut.alias("h")))).alias("c"))
    levels = materialise(listed.select(F.col("cy").alias("__cy"), F.col("c.h").alias("__cuts")), "levels")

    def above(values) -> Column:
        return F.size(F.filter(values, lambda t: F.col(_HASH) > t))

    hashed = df.withColumn(_HASH, key_hash(key, seed))
    if y is None:
        only = levels.first()
        values = F.array(*[F.lit(v) for v in only["__cuts"]]) if only and only["__cuts"] else F.array().cast("array<string>")
        return hashed.withColumn(name, above(values)).drop(_HASH)
    # a row a class: broadcast while the table is small, shuffled beyond
    joined = hashed.join(levels, col(y).eqNullSafe(F.col("__cy")), "left")
    cuts = F.coalesce("__cuts", F.array().cast("array<string>"))
    return joined.withColumn(name, above(cuts)).drop(_HASH, "__cy", "__cuts")


def _rows(classes: DataFrame) -> int:
    return classes.agg(F.sum("n")).first()[0] or 0


def split_two_way(
    df: DataFrame,
    key: str | Sequence[str],
    stratify: str | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    mode: str = "exact",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``split`` = ``train`` / ``test``; with ``stratify`` each class keeps its share.

    ``exact`` gives ``ceil(n * test_size)`` test rows in all. ``key`` should be unique: rows of
    equal key stay on the same side.
    """
    if mode == "hash":
        return df.withColumn("split", _hash_label(key_hash(key, seed), [("test", test_size)], "train"))

    def sizes(classes):
        out = _allot(classes, math.ceil(test_size * _rows(classes)), "n", "test", task_rows)
        return out.withColumn("ks", F.array("test"))

    out = _exact_number(df, key, seed, stratify, sizes, "split", task_rows)
    return out.withColumn("split", F.when(F.col("split") == 0, "test").otherwise("train"))


def split_three_way(
    df: DataFrame,
    key: str | Sequence[str],
    stratify: str | None = None,
    test_size: float = 0.2,
    val_size: float = 0.2,
    seed: int = 42,
    mode: str = "exact",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``split`` = ``train`` / ``val`` / ``test``; validation is ``val / (1 - test)`` of what test leaves."""
    if mode == "hash":
        shares = [("test", test_size), ("val", val_size)]
        return df.withColumn("split", _hash_label(key_hash(key, seed), shares, "train"))

    def sizes(classes):
        n = _rows(classes)
        n_test = math.ceil(test_size * n)
        out = _allot(classes, n_test, "n", "test", task_rows).withColumn("left", F.col("n") - F.col("test"))
        out = _allot(out, math.ceil(val_size / (1 - test_size) * (n - n_test)), "left", "val", task_rows)
        return out.withColumn("ks", F.array(F.col("test"), F.col("test") + F.col("val")))

    out = _exact_number(df, key, seed, stratify, sizes, "split", task_rows)
    return out.withColumn(
        "split", F.when(F.col("split") == 0, "test").when(F.col("split") == 1, "val").otherwise("train")
    )


def split_chronological(
    df: DataFrame,
    order: Sequence[str],
    test_size: float = 0.2,
    val_size: float = 0.2,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``split`` by position in ``order``: train, then ``int(n*val)`` rows, then ``int(n*test)`` rows.

    Rows of equal keys are put in a fixed order of their own, so the sizes hold whatever the ties.
    """
    n = df.count()
    df, order = with_tie(df, order)
    n_test, n_val = int(n * test_size), int(n * val_size)
    starts = [n - n_val - n_test, n - n_test]
    cuts = order_cuts(df, order, starts, n, task_rows)
    number = segment_number(df, order, [cuts[s] for s in starts if s in cuts])
    names = ["train"] + (["val"] if n_val else []) + (["test"] if n_test else [])
    if not n_val and n_test:
        number = segment_number(df, order, [cuts[starts[1]]])
    return df.withColumn("split", F.element_at(F.array(*[F.lit(x) for x in names]), number + 1)).drop(TIE)


def split_last(
    df: DataFrame, order: Sequence[str], test_size: float = 0.2, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add ``split`` with the last ``max(1, int(n * test_size))`` rows as test; for featured time series."""
    n = df.count()
    start = n - max(1, int(n * test_size))
    if start <= 0:
        raise ValueError(f"{n} rows leave nothing to train on beside {n - start} test rows")
    df, order = with_tie(df, order)
    cut = order_cuts(df, order, [start], n, task_rows)[start]
    return df.withColumn("split", F.when(segment_number(df, order, [cut]) == 1, "test").otherwise("train")).drop(TIE)


def assign_folds(
    df: DataFrame,
    task: str,
    folds: int = 5,
    key: str | Sequence[str] | None = None,
    order: Sequence[str] = (),
    target: str | None = None,
    shuffle: bool = True,
    seed: int = 42,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``fold`` 1..k, the fold in which a row is held out.

    classification: each class spread evenly over the folds. regression: shuffled, or contiguous
    in ``order``. timeseries: k equal blocks at the end of ``order``; fold i trains on every row of
    a smaller number, and 0 marks rows that are only ever trained on.
    """
    if task == "timeseries":
        n = df.count()
        size = n // (folds + 1)
        if size == 0:
            raise ValueError(f"Cannot make {folds} folds from {n} rows")
        starts = [n - (folds - i) * size for i in range(folds)]
        df, order = with_tie(df, order)
        cuts = order_cuts(df, order, starts, n, task_rows)
        return df.withColumn("fold", segment_number(df, order, [cuts[s] for s in starts]).cast("int")).drop(TIE)
    if task == "classification" and not target:
        raise ValueError("classification folds need a target")
    if not shuffle and task != "classification":
        if not order:
            raise ValueError("contiguous folds need an order")
        n = df.count()
        starts, at = [], 0
        for i in range(folds - 1):
            at += n // folds + (1 if i < n % folds else 0)
            starts.append(at)
        df, order = with_tie(df, order)
        cuts = order_cuts(df, order, starts, n, task_rows)
        number = segment_number(df, order, [cuts[s] for s in starts if s in cuts]) + 1
        return df.withColumn("fold", number.cast("int")).drop(TIE)

    def sizes(classes):
        # the extra rows of a class go on where those of the class before stopped
        out = classes.withColumns({"extra": F.col("n") % folds, "whole": F.expr(f"n div {folds}")})
        out = running_totals(out, "y", ["extra"])
        turn = F.col("upto_extra") - F.col("extra")
        held = [F.col("whole") + (F.pmod(F.lit(i) - turn, F.lit(folds)) < F.col("extra")).cast("long") for i in range(folds)]
        upto = [reduce(lambda a, b: a + b, held[: i + 1]) for i in range(folds - 1)]
        return out.withColumn("ks", F.array(*upto) if upto else F.array().cast("array<long>"))

    out = _exact_number(df, key, seed, target if task == "classification" else None, sizes, "fold", task_rows)
    return out.withColumn("fold", (F.col("fold") + 1).cast("int"))


def split_sizes(df: DataFrame, by: Sequence[str] = (), label: str = "split") -> DataFrame:
    """Rows per split (and per ``by`` group)."""
    return df.groupBy(col(label), *[col(b) for b in by]).agg(F.count(F.lit(1)).alias("n"))
