"""URL filter: path-template trees per host with smoothed labelled purity, under explicit host and path rules.

A url that is null or has no ``://`` has an empty host and path. Empty segments count like others. Repeated rows are judged
alike. With no labels at all every url is allowed. An empty table gives an empty result; extra columns are ignored. All
steps are DataFrame functions; what is joined back is one row per template, formed by grouped sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import step

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path prefix."""

    verdict: str
    host: str
    path: str

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith(f".{self.host}")
        return own & path.startswith(self.path)

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """Bounds of the template tree: a segment is variable where over ``fan`` kinds have under ``reuse`` urls each; branches
    are alike below ``z2`` (chi-square); ``weight`` pseudo-labels at the overall rate smooth a template's purity; above
    ``reject`` it is blocked."""

    fan: int = 20
    reuse: int = 3
    z2: float = 3.84
    weight: float = 10.0
    reject: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty where there is no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (
        F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def templates(urls: DataFrame, tree: Tree) -> DataFrame:
    """Templates of the distinct ``host``, ``shape`` in ``urls`` (with the number of urls, ``n``).

    A shape has its digit runs replaced by ``#``. A segment becomes ``*`` where its parent has too many kinds of it. Parents
    are compared as the levels above left them, so what is below a ``*`` is pooled. Only levels where some host has kinds
    enough are looked at, one after the other.
    """
    rows = step(urls.select("host", "shape", "n", F.split("shape", "/", -1).alias("segs")), "url-shapes")
    rows = rows.withColumn("way", F.col("segs"))
    each = rows.select("host", F.posexplode("segs").alias("d", "s")).distinct().groupBy("host", "d").count()
    levels = sorted(r[0] for r in each.where(F.col("count") > tree.fan).select("d").distinct().collect())
    for d in levels:
        here = rows.withColumn("parent", F.when(F.size("segs") > d, F.array_join(F.slice("way", 1, d), "/")))
        kinds = here.where("parent is not null").groupBy("host", "parent", F.col("segs")[d].alias("s")).agg(F.sum("n").alias("n"))
        fans = kinds.groupBy("host", "parent").agg(F.count("*").alias("kinds"), F.sum("n").alias("urls"))
        fans = fans.where((F.col("kinds") > tree.fan) & (F.col("urls") < F.col("kinds") * tree.reuse))
        here = here.join(fans.select("host", "parent", F.lit(True).alias("wild")), ["host", "parent"], "left")
        way = F.transform("way", lambda x, k: F.when(F.col("wild") & (k == d), "*").otherwise(x))  # noqa: B023
        rows = step(here.withColumn("way", way).select("host", "shape", "n", "segs", "way"), f"url-level-{d}")
    return rows.select("host", "shape", F.array_join("way", "/").alias("template"))


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[Rule], tree: Tree = Tree(), id_col: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, ``rule`` or null, ``verdict`` and ``template``, the deciding branch.

    ``labels`` has ``host``, ``path`` and ``bad`` (boolean) of labelled urls. The tree of a host holds its templates by
    segment. A branch whose share of bad labels doesn't differ from that of its siblings merges into its parent; a url is
    judged by the deepest branch above it that does differ, or by its host.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    shape = F.regexp_replace(path, "[0-9]+", "#")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"), shape.alias("shape"))
    known = labels.select("host", F.regexp_replace("path", "[0-9]+", "#").alias("shape"), F.col("bad").cast("long").alias("bad"))
    known = known.where("bad is not null").groupBy("host", "shape")
    known = known.agg(F.count("*").alias("labelled"), F.sum("bad").alias("bad"))
    shapes = rows.groupBy("host", "shape").agg(F.count("*").alias("n"))
    shapes = shapes.join(known, ["host", "shape"], "full").na.fill(0, ["n", "labelled", "bad"])
    shapes = shapes.join(templates(shapes, tree), ["host", "shape"])
    leaves = shapes.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    path_to = leaves.select("host", "template", "labelled", "bad", F.posexplode(F.split("template", "/", -1)).alias("d", "s"))
    path_to = path_to.withColumn("branch", F.expr("array_join(slice(split(template, '/', -1), 1, d + 1), '/')"))
    path_to = path_to.withColumn("above", F.expr("array_join(slice(split(template, '/', -1), 1, d), '/')"))
    branches = path_to.groupBy("host", "d", "above", "branch").agg(F.sum("labelled").alias("n1"), F.sum("bad").alias("b1"))
    parents = branches.groupBy("host", "d", "above").agg(F.sum("n1").alias("n0"), F.sum("b1").alias("b0"))
    tested = branches.join(parents, ["host", "d", "above"])
    tested = tested.selectExpr("*", "cast(n0 - n1 as double) as n2", "cast(b0 - b1 as double) as b2")
    differs = f"n1 > 0 and n2 > 0 and (b1 * n2 - b2 * n1) * (b1 * n2 - b2 * n1) * n0 >= {tree.z2}D * b0 * (n0 - b0) * n1 * n2"
    differs += " and b0 > 0 and b0 < n0"
    tested = tested.where(differs).select("host", "d", "branch", "n1", "b1")
    deepest = path_to.join(tested, ["host", "d", "branch"]).groupBy("host", "template")
    deepest = deepest.agg(F.max(F.struct("d", "branch", "n1", "b1")).alias("own"))
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("nh"), F.sum("bad").alias("bh"))
    overall = leaves.agg(F.sum("labelled").alias("na"), F.sum("bad").alias("ba"))  # one row
    decided = leaves.select("host", "template").join(deepest, ["host", "template"], "left").join(hosts, "host")
    decided = decided.join(F.broadcast(overall), F.lit(True))
    decided = decided.selectExpr(
        "host",
        "template as leaf",
        "coalesce(own.branch, '') as template",
        f"(coalesce(own.b1, bh) + {tree.weight}D * ba / greatest(na, 1)) / (coalesce(own.n1, nh) + {tree.weight}D) > {tree.reject}D as bad",
    )
    decided = shapes.select("host", "shape", F.col("template").alias("leaf")).join(decided, ["host", "leaf"]).drop("leaf")
    out = rows.join(decided, ["host", "shape"])
    by_length = sorted(rules, key=lambda r: (-len(r.name), r.name))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("bad"), "block").otherwise("allow")
    for r in reversed(by_length):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template")
