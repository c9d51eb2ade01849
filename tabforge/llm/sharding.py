"""Resharding with the fewest bytes moved: a min-cost flow over shards, carried out on files.

A null text has no bytes; every row counts one byte more than its text, so empty rows have a size. Repeated rows are rows
of their own. Rows of a null shard key go to shard 0. An empty table has empty shards. Extra columns are written along; one
named like a result gives way to it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import with_columns
from tabforge.session import materialise, scratch_dir


def min_cost_flow(n: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each (from, to, capacity, cost) edge of a maximum flow of least cost, by successive shortest paths."""
    to, room, cost = [], [], []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, c, w in edges:
        for x, y, r, z in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(z)
    height = [0] * n
    while True:
        far, via = [None] * n, [-1] * n
        far[source], queue = 0, [(0, source)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            for e in out[x]:
                if room[e]:
                    y, new = to[e], d + cost[e] + height[x] - height[to[e]]
                    if far[y] is None or new < far[y]:
                        far[y], via[y] = new, e
                        heapq.heappush(queue, (new, y))
        if far[sink] is None:
            return [room[2 * k + 1] for k in range(len(edges))]
        worst = max(d for d in far if d is not None)
        height = [h + (d if d is not None else worst) for h, d in zip(height, far, strict=True)]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        step = min(room[e] for e in path)
        for e in path:
            room[e] -= step
            room[e ^ 1] += step


@dataclass(frozen=True)
class Transfer:
    """Bytes ``lo`` to ``hi`` of an old shard go to ``new``."""

    old: int
    new: int
    lo: int
    hi: int


def transfers(sizes: dict[int, int], capacities: dict[int, int]) -> list[Transfer]:
    """What each old shard keeps and sends, with the fewest bytes moved.

    Staying costs nothing and moving one a byte, by way of a hub, so the graph has a few edges a shard. Flow through the
    hub is paired off in shard order.
    """
    if sum(capacities.values()) < sum(sizes.values()):
        raise ValueError("the new capacities are too small")
    old, new = sorted(sizes), sorted(capacities)
    node = {("old", s): i for i, s in enumerate(old)} | {("new", s): len(old) + i for i, s in enumerate(new)}
    hub, source, sink = len(node), len(node) + 1, len(node) + 2
    edges, labels = [], []
    for s in old:
        edges.append((source, node["old", s], sizes[s], 0))
        labels.append(None)
        if s in capacities:
            edges.append((node["old", s], node["new", s], sizes[s], 0))
            labels.append(("keep", s))
        edges.append((node["old", s], hub, sizes[s], 1))
        labels.append(("send", s))
    for s in new:
        edges.append((hub, node["new", s], capacities[s], 0))
        labels.append(("get", s))
        edges.append((node["new", s], sink, capacities[s], 0))
        labels.append(None)
    flow = {x: f for x, f in zip(labels, min_cost_flow(len(node) + 3, edges, source, sink), strict=True) if x}
    plan, at = [], {}
    for s in old:
        at[s] = flow.get(("keep", s), 0)
        if at[s]:
            plan.append(Transfer(s, s, 0, at[s]))
    room = [[s, flow["get", s]] for s in new]
    for s in old:
        left = flow["send", s]
        while left:
            while not room[0][1]:
                room.pop(0)
            step = min(left, room[0][1])
            plan.append(Transfer(s, room[0][0], at[s], at[s] + step))
            at[s], left, room[0][1] = at[s] + step, left - step, room[0][1] - step
    return plan


def equal_capacities(total: int, shards: int) -> dict[int, int]:
    """``total`` bytes over ``shards``, one apart at most."""
    return {s: total // shards + (s < total % shards) for s in range(shards)}


def write_shards(df: DataFrame, shard: Column, size: Column, path: str, rows_per_file: int = 100_000) -> None:
    """Write ``df`` as files of one shard each, with the row's size in ``size``."""
    out = with_columns(df, {"size": size.cast("long"), "__shard": F.coalesce(shard.cast("int"), F.lit(0))})
    out.write.option("maxRecordsPerFile", rows_per_file).partitionBy("__shard").parquet(path)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumns({"__file": F.col("_metadata.file_path"), "__at": F.col("_metadata.row_index")})


def reshard(spark: SparkSession, path: str, capacities: dict[int, int] | int, out: str) -> DataFrame:
    """Move rows between the shards under ``path`` until every shard holds what its capacity allows.

    Files are the blocks: in the order of their names they line up in their shard, a transfer takes the files that lie
    whole in its byte range, and a file on a boundary is cut between two rows, the longer rows first and
    each row going where its middle lies. Only affected files are read and written again, to ``out``; the others stay.
    Returns the new layout, one row per file part: ``shard``, ``path`` (where it lies now), ``rows``, ``bytes``,
    ``first_slot`` (rows of the shard before it) and ``rewritten``. ``capacities`` may be a number of equal shards.
    """
    rows = _rows(spark, path)
    files = rows.groupBy(F.col("__shard").alias("old"), F.col("__file").alias("path"))
    files = materialise(files.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")), "files")
    sizes = {r[0]: r[1] for r in files.groupBy("old").agg(F.sum("bytes")).collect()}  # one row a shard
    if isinstance(capacities, int):
        capacities = equal_capacities(sum(sizes.values()), capacities)
    plan = transfers(sizes, capacities)
    kind = "old int, new int, lo long, hi long"
    moves = spark.createDataFrame([(t.old, t.new, t.lo, t.hi) for t in plan], kind)  # at most 3 a shard
    # windows over one row a file
    placed = files.selectExpr("*", "sum(bytes) over (partition by old order by path) - bytes as start")
    parts = placed.join(F.broadcast(moves), "old").where("lo < start + bytes and hi > start")
    parts = materialise(parts.selectExpr("*", "lo <= start and hi >= start + bytes as whole"), "file-parts")
    moved = parts.where("whole and new <> old or not whole")
    cut = parts.where("not whole").select(F.col("path").alias("__p"), "start", "new", "lo", "hi")
    cut_files = [r[0] for r in cut.select("__p").distinct().collect()]  # at most 2 a transfer
    whole_moves = parts.where("whole and new <> old").select(F.col("path").alias("__p"), "new")

    def plain(found: DataFrame) -> DataFrame:
        return found.drop("__shard", "__file", "__at", "__p").withColumnRenamed("new", "__shard")

    rewritten = plain(rows.join(whole_moves, F.col("__file") == F.col("__p")))
    if cut_files:
        # the rows of a boundary file, in one order: bounded by the size of a file
        some = _rows(spark, path).where(F.col("__file").isin(cut_files)).select("__file", "__at", "size")
        some = some.selectExpr(
            "*", "sum(size) over (partition by __file order by size desc, __at rows unbounded preceding) - size / 2 as middle"
        )
        some = some.join(F.broadcast(cut), F.col("__file") == F.col("__p"))
        some = some.where("start + middle >= lo and start + middle < hi").select(
            F.col("__file").alias("__p"), F.col("__at").alias("__q"), "new"
        )
        pieces = rows.where(F.col("__file").isin(cut_files))
        pieces = pieces.join(some, (F.col("__file") == F.col("__p")) & (F.col("__at") == F.col("__q"))).drop("__q")
        rewritten = rewritten.unionByName(plain(pieces))
    rewritten.write.option("compression", "zstd").partitionBy("__shard").parquet(out)
    layout = parts.where("whole and new = old").select(F.col("new").alias("shard"), "path", "rows", "bytes", F.lit(False).alias("rewritten"))
    if not moved.isEmpty():
        fresh = spark.read.parquet(out).withColumn("__file", F.col("_metadata.file_path"))
        fresh = fresh.groupBy(F.col("__shard").alias("shard"), F.col("__file").alias("path"))
        fresh = fresh.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        layout = layout.unionByName(fresh.withColumn("rewritten", F.lit(True)))
    return materialise(
        layout.selectExpr("*", "sum(rows) over (partition by shard order by rewritten, path) - rows as first_slot"), "layout"
    )


def read_layout(spark: SparkSession, layout: DataFrame, *roots: str) -> DataFrame:
    """The rows of a layout with their ``shard`` and ``slot``; files that the layout doesn't name are left out."""
    out = None
    for root in roots:
        if not spark.read.parquet(root).columns:
            continue
        part = _rows(spark, root).drop("__shard")
        out = part if out is None else out.unionByName(part)
    names = layout.select(F.col("path").alias("__file"), "shard", "first_slot")
    found = out.drop("shard").join(names, "__file")
    return found.withColumn("slot", F.col("first_slot") + F.col("__at")).drop("__file", "__at", "first_slot")


def text_size(text: str) -> Column:
    """UTF-8 bytes of a text, plus one."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)) + 1).cast("long")


def balance(df: DataFrame, shards: int, old_shard: Column, text: str = "text") -> DataFrame:
    """Write ``df`` in its old shards, reshard to ``shards`` of near equal bytes, and read the new layout back."""
    spark = df.sparkSession
    old, new = scratch_dir(spark, "shards-old"), scratch_dir(spark, "shards-new")
    write_shards(df, old_shard, text_size(text), old)
    empty = df.isEmpty()
    if empty:
        return with_columns(df, {"size": text_size(text), "shard": F.lit(0), "slot": F.lit(0).cast("long")})
    layout = reshard(spark, old, shards, new)
    roots = [old, new] if not layout.where("rewritten").isEmpty() else [old]
    return read_layout(spark, layout, *roots)


def spread(values: np.ndarray) -> float:
    """Largest over mean, a figure for how near shards are to equal."""
    return float(values.max() / values.mean()) if len(values) and values.sum() else 1.0
