"""Line deduplication by an exact set-similarity join, in DataFrame functions throughout.

A line is the set of its words. Lines without words (and null or empty texts) are never removed. A line is removed if an
earlier line, by (id, line number), has an equal set or one of Jaccard similarity ``4/5`` or more. Rows that repeat the id
share positions, so none of their lines is earlier than its twin. A null id comes first. Results have a row for every
input row, a null text with no lines. An empty table gives an empty result; extra columns are carried along, one named like
a result gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import forget, step, with_columns

#: Buckets of the word count sketch: its size, whatever the vocabulary.
BUCKETS = 1 << 18
#: Steps of the sketch's counts a power of e, so that counts of any size keep their order.
STEPS = 100
#: Bits of a set's parity mark, a power of two.
MARK = 64
#: Bits of the rest of the mark, which fit into a post beside the set's size and the word's place.
MORE = 40
#: Sets of so many words have a finer mark; the one of smaller sets tells them apart.
FINE = 64
#: Bits of the filter on rows that a join can't want.
FETCH = 1 << 20
#: Sizes from here on are not told apart by the filters; nor are places, of which smaller sets have fewer.
LONG = 4095
#: Passes over the words of the sets' prefixes, a power of two: the posts of one pass are on the disks at a time.
PASSES = 4
#: Words kept beyond the prefix, and signs made of the words kept, to find the families of like lines.
BEYOND, SIGNS = 3, 4
# Jaccard of at least NUM / DEN; below SMALL words only an equal set reaches it.
NUM, DEN, SMALL = 4, 5, 4


def blanks(text: Column) -> Column:
    """The text's words one or more blanks apart; line breaks stay."""
    spaced = text
    for c in "\t\v\f\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.when(text.rlike("[\t\x0B\f\r]"), spaced).otherwise(text)


def words(line: Column) -> Column:
    """Hashes of the distinct words of a line."""
    each = F.transform(F.split(blanks(line), " "), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(each), F.xxhash64(F.lit("")))


def dense(rows: DataFrame, size: int) -> DataFrame:
    """The numbers ``n`` of ``rows`` at their places ``at``, zero elsewhere, as the one array ``all`` of ``size`` numbers."""
    zero = F.lit(0).cast(rows.schema["n"].dataType).alias("n")
    rows = rows.union(rows.sparkSession.range(size).select(F.col("id").cast("int").alias("at"), zero))
    rows = rows.groupBy("at").agg(F.bit_or("n").alias("n"))
    return rows.agg(F.sort_array(F.collect_list(F.struct("at", "n"))).getField("n").alias("all"))


def word_counts(hashed: DataFrame) -> Column:
    """Count sketch of all lines' words: the logarithm of the lines by hash bucket. ``BUCKETS`` numbers come to the driver, as one text."""
    sums = hashed.select(F.explode("h").alias("w")).groupBy(F.col("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("at")).count()
    counts = dense(sums.select("at", F.floor(STEPS * F.log1p("count")).cast("int").alias("n")), BUCKETS)
    return F.from_json(F.lit(counts.select(F.to_json("all")).first()[0]), "array<int>")


def split_lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id``, ``version`` (hash of the text, to tell rows of one id apart), ``nth`` and ``line``."""
    body = F.col(f"`{text}`").cast("string")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(body).alias("version"), F.split(body, "\n", -1).alias("lines"))
    return rows.select("id", "version", F.posexplode("lines").alias("nth", "line"))


def prefix_size(n: str) -> Column:
    """The rarest words of a set of ``n`` of which two similar sets share one."""
    return F.expr(f"{n} - ({n} * {NUM} + {DEN - 1}) div {DEN} + 1")


def line_hashes(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """A row per line: ``id``, ``version`` and ``nth``, and ``h``, the hashes of its words in order."""
    return split_lines(df, id_col, text).select("id", "version", "nth", F.sort_array(words(F.col("line"))).alias("h"))


def sets(df: DataFrame, id_col: str, text: str, hashed: DataFrame | None = None) -> DataFrame:
    """A row per line: its set as a hash, a parity mark and a size, and its ``head``: the prefix and ``BEYOND`` words more.

    Words are ordered by their sketched count, rarest first, then by hash; the prefix is long enough that two similar
    sets share a word of it. The ``mark`` holds, for each of ``MARK`` classes of words, whether the set has an odd number of
    them: the marks of two sets differ in no more bits than the sets do in words. For sets of ``FINE`` words, ``more`` holds the same of a
    half of each of the first ``MORE`` classes, for smaller ones a second hash.
    ``hashed``: the ``line_hashes`` of ``df``, if they are written.
    """
    lines = line_hashes(df, id_col, text) if hashed is None else hashed
    counts = word_counts(lines)
    zero, one, size = F.lit(0).cast("long"), F.lit(1).cast("long"), F.size("h")
    # a part of the hash that the buckets and the wide marks don't use alone
    bit = lambda x, half=one: F.call_function("shiftleft", half, F.shiftright(x, 20).bitwiseAND(F.lit(MARK - 1)).cast("int"))
    finer = F.aggregate("h", zero, lambda a, x: a.bitwiseXOR(bit(x, F.shiftright(x, 27).bitwiseAND(one))))
    order = F.transform(
        "h",
        lambda x: F.shiftleft(F.get(counts, x.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).cast("long"), 40).bitwiseOR(
            x.bitwiseAND(F.lit((1 << 40) - 1))
        ),
    )
    head = F.slice(F.sort_array(order), 1, (prefix_size("size(h)") + BEYOND).cast("int"))
    return lines.select(
        "id",
        "version",
        "nth",
        size.alias("n"),
        F.xxhash64("h").alias("k"),
        F.aggregate("h", zero, lambda a, x: a.bitwiseXOR(bit(x))).alias("mark"),
        F.when(size >= FINE, finer.bitwiseAND(F.lit((1 << MORE) - 1))).otherwise(F.shiftrightunsigned(F.xxhash64(F.lit(MORE), "h"), 64 - MORE)).alias("more"),
        F.when(size >= SMALL, head).alias("head"),
    )


#: What tells sets apart: 128 bits of hash and mark, and the size.
SET = ["k", "mark", "n"]


def classes(lines: DataFrame) -> DataFrame:
    """Equal sets as one row, with the first line that has it, their number, the head and its signs."""
    found = lines.where("n > 0").groupBy(*SET).agg(
        F.min(F.struct("id", "nth", "version")).alias("first"), F.count("*").alias("lines"), F.any_value("more").alias("more"), F.any_value("head").alias("head")
    )
    return found.withColumn("signs", signs(F.col("head")))


def sifted(keys: list[str], wanted: DataFrame) -> Column:
    """Whether a row's keys may be among ``wanted``: true for all that are, and for a few others.

    A fixed number of bits says which hashed keys are wanted, whatever the sizes; the fuller, the more rows pass.
    """
    bucket = F.xxhash64(*keys).bitwiseAND(F.lit(FETCH - 1))
    place = F.shiftright(bucket, 6).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), bucket.bitwiseAND(F.lit(63)).cast("int"))
    marked = wanted.select(place.alias("at"), bit.alias("n")).groupBy("at").agg(F.bit_or("n").alias("n"))
    # a subquery, as the driver holds the text of all numbers in a plan
    return F.get(dense(marked, FETCH >> 6).scalar(), place).bitwiseAND(bit) != 0


def sieve(df: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """Leave out most rows of ``df`` whose keys aren't among ``wanted``, before a join that leaves out all."""
    return df.where(sifted(keys, wanted))


def signs(head: Column) -> Column:
    """A few hashes of words that follow each other in the order of rarity; most are the same in a family of like sets."""
    pairs = F.transform(head, lambda w, i: F.xxhash64(w, F.get(head, i + 1)))
    return F.slice(F.sort_array(F.slice(pairs, 1, F.greatest(F.size(head) - 1, F.lit(0)))), 1, SIGNS)


def budget(n: str) -> str:
    """Similar sets of ``n`` words together differ in no more words than this, and their marks in no more bits."""
    return f"({n} - 2 * (({NUM} * ({n}) + {NUM + DEN - 1}) div {NUM + DEN}))"


def leaders(found: DataFrame) -> DataFrame:
    """Of each set and the earliest that shares a sign with it: ``f1`` and ``f2``, the ``late`` set and their words ``n``.

    A pair a sign at most, however large the family.
    """
    each = found.where(f"n >= {SMALL}").select(F.struct(*SET).alias("c"), "first", F.explode("signs").alias("s"))
    shared = step(each.groupBy("s").count().where("count > 1").select("s"), "shared-signs")
    each = step(sieve(each, ["s"], shared), "signed-sets")
    lead = each.groupBy("s").agg(F.min(F.struct("first", "c")).alias("p"))
    pairs = each.join(lead, "s").where(F.struct("p.first.id", "p.first.nth") < F.struct("first.id", "first.nth"))
    pairs = pairs.select(F.col("first").alias("f1"), F.col("p.first").alias("f2"), F.col("c").alias("late"), F.col("p.c").alias("lead"))
    pairs = pairs.where(
        f"{NUM} * late.n <= {DEN} * lead.n and {NUM} * lead.n <= {DEN} * late.n"
        f" and bit_count(late.mark ^ lead.mark) <= {budget('late.n + lead.n')}"
    )
    return pairs.select("f1", "f2", "late", F.expr("late.n + lead.n").alias("n")).distinct()


#: The rest of the mark with the size.
SIZED = f"(shiftleft(more, 12) | least(n, {LONG}))"


def posts(some: DataFrame, turn: int, *flags: str) -> DataFrame:
    """A post for each word of a set's prefix that has its ``turn``: the word ``w``, ``m`` of ``more``, the set's size and the word's place, and the mark; its ``flags`` go along."""
    each = some.where(f"n >= {SMALL}").withColumn("prefix", F.slice("head", 1, prefix_size("n").cast("int")))
    each = each.select("mark", *flags, F.expr(SIZED).alias("s"), F.posexplode("prefix").alias("p", "w")).where(f"w & {PASSES - 1} = {turn}")
    # no nulls, so that every join wants the same posts and they are dealt once
    columns = {"w": "w", "m": f"shiftleft(s, 12) | least(p, {LONG})", "mark": "mark"}
    return each.selectExpr(*[f"coalesce({e}, 0L) as {c}" for c, e in columns.items()], *[f"coalesce({c}, 0) as {c}" for c in flags])


def candidates(some: DataFrame) -> DataFrame:
    """Pairs of sets that pass the prefix, length, positional and mark filters, by mark ``l`` and the rest of it with the size, ``s``.

    The pairs are those of sets that are open (``late`` is 0), and of a late set with an open one; a late set needs no further
    proof, so that two of them make no pair. Posts are dealt by word once and joined with themselves, some of the words at a time.
    Only the first common word of a pair need pass, so what follows it in the smaller set must suffice alone. Sets of
    ``LONG`` words or more meet on the word alone. Different sets with the same marks and size are a pair without a join.
    """
    x, y, i, j = (f"(({e}) & {LONG})" for e in ("m1 >> 12", "m2 >> 12", "m1", "m2"))
    need = f"(({NUM} * ({x} + {y}) + {NUM + DEN - 1}) div {NUM + DEN})"
    # of a class in halves, both may differ while the whole doesn't
    other = "shiftrightunsigned(m1 ^ m2, 24)"
    apart = f"if(least({x}, {y}) >= {FINE}, bit_count(l1 ^ l2 ^ {other}) + bit_count({other}), bit_count(l1 ^ l2))"
    passes = (
        f"{NUM} * greatest({x}, {y}) <= {DEN} * least({x}, {y}) and (greatest({x}, {y}) = {LONG}"
        f" or (least({x} - {i}, {y} - {j}) >= {need} and {apart} <= {x} + {y} - 2 * {need}))"
    )
    s1, s2 = (f"(shiftright({e}, 12) & {(1 << 52) - 1})" for e in ("m1", "m2"))
    pair = ["l1", f"{s1} as s1", "l2", f"{s2} as s2"]
    side = lambda p, k: p.select("w", *[F.col(c).alias(f"{n}{k}") for c, n in (("m", "m"), ("mark", "l"), ("late", "late"))])
    # one condition, no part of which holds for a side alone and would make its posts others
    turned = f"(late2 < late1 or (late1 + late2 = 0 and ({x} < {y} or ({x} = {y} and (l1 < l2 or (l1 = l2 and {s1} < {s2}))))))"
    # two sets of one size differ in a word each at least
    twins = some.where(f"{DEN} * (n - 1) >= {NUM} * (n + 1)").groupBy("mark", F.expr(SIZED).alias("s"))
    twins = twins.agg(F.count("*").alias("sets"), F.min("late").alias("late")).where("sets > 1 and late = 0")
    found = twins.selectExpr("mark", "s", "mark", "s").toDF("l1", "s1", "l2", "s2")
    for turn in range(PASSES):
        own = posts(some, turn, "late")
        pairs = side(own, 1).join(side(own, 2), "w").where(f"{turned} and {passes}")
        found = found.union(step(pairs.selectExpr(*pair).distinct(), "word-pairs"))
    return found.distinct()


def line_words(df: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """``f`` (id, line and version) of the ``wanted`` lines, their words ``w`` and a parity mark of ``4 * MARK`` classes."""
    keys = ["id", "nth", "version"]
    same = F.lit(True)
    right = wanted.select(*[F.col(k).alias(f"_{k}") for k in keys])
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    some = sieve(split_lines(df, id_col, text), ["id", "nth"], wanted)
    # words go by their 64-bit hashes, as in the sets, at half the bytes
    texts = some.join(right, same, "left_semi").dropDuplicates(keys).select(F.struct(*keys).alias("f"), words(F.col("line")).alias("w"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    part = lambda k: F.aggregate(
        F.filter("w", lambda x: F.shiftright(x, 32).bitwiseAND(F.lit(3)) == k),
        zero,
        lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", one, F.shiftright(x, 40).bitwiseAND(F.lit(MARK - 1)).cast("int"))),
    )
    return step(texts.withColumn("wide", F.array(*[part(k) for k in range(4)])), "line-words")


def similar(named: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``late`` sets of those pairs in ``named`` whose first lines ``f1`` and ``f2`` are similar, judged on the words."""
    sided = named.join(texts.selectExpr("f as f1", "w as w1"), "f1").drop("f1")
    sided = sided.join(texts.selectExpr("f as f2", "w as w2"), "f2")
    common = F.size(F.array_intersect("w1", "w2"))
    good = sided.where(DEN * common >= NUM * (F.size("w1") + F.size("w2") - common))
    return step(good.select("late").distinct(), "late-sets")


def proven(df: DataFrame, named: DataFrame, id_col: str, text: str) -> DataFrame:
    """The ``late`` sets of those pairs in ``named`` that are similar, verified on the words; ``named`` is used up.

    One similar set is enough, so each set is first compared with the one whose mark is nearest; only where that
    fails, which the marks make rare, are all its other pairs compared. Of the paired lines wider marks are made first,
    which tell long lines apart, too.
    """
    texts = line_words(df, named.select(F.explode(F.array("f1", "f2")).alias("f")).select("f.*").distinct(), id_col, text)
    near = named.join(texts.selectExpr("f as f1", "wide as m1"), "f1").join(texts.selectExpr("f as f2", "wide as m2"), "f2")
    apart = sum((F.bit_count(F.get("m1", F.lit(k)).bitwiseXOR(F.get("m2", F.lit(k)))) for k in range(4)), F.lit(0))
    near = near.select("late", "f1", "f2", apart.alias("d"), F.expr(budget("n")).alias("most"))
    near = step(near.where("d <= most").drop("most"), "near-pairs")
    forget(named)
    nearest = near.groupBy("late").agg(F.min(F.struct("d", "f1", "f2")).alias("p")).select("late", "p.f1", "p.f2")
    done = similar(nearest, texts)
    rest = step(near.join(done, "late", "left_anti").drop("d"), "other-pairs")
    if not rest.isEmpty():
        done = done.union(similar(rest, texts))
    forget(near)
    return done.select("late.*")


def earlier(df: DataFrame, found: DataFrame, heads: DataFrame, id_col: str, text: str) -> DataFrame:
    """Sets for which a similar set has an earlier first line; ``found`` is used up.

    Sets are compared with the earliest of their families first. Those proven late there are paired only with sets that
    are still open, so that a family of like lines makes pairs by its number of lines.
    """
    done = proven(df, step(leaders(found), "leader-pairs"), id_col, text)
    columns = ["mark", "more", "n", F.slice("head", 1, prefix_size("n").cast("int")).alias("head")]
    # most sets are open, and need not be dealt to see it
    sides = found.withColumn("maybe", sifted(SET, done))
    some = sides.where("maybe").join(done.withColumn("late", F.lit(1)), SET, "left").select(*columns, F.coalesce("late", F.lit(0)).alias("late"))
    some = step(sides.where("not maybe").select(*columns, F.lit(0).alias("late")).union(some), "open-sets")
    forget(found)
    pairs = step(candidates(some), "line-pairs")
    forget(some)
    if pairs.isEmpty():
        return done
    few = sieve(heads, ["mark"], pairs.select(F.explode(F.array("l1", "l2")).alias("mark")))
    few = step(few.join(done.withColumn("late", F.lit(True)), SET, "left"), "paired-sets")
    side = lambda k: few.select(
        F.col("mark").alias(f"l{k}"), F.expr(SIZED).alias(f"s{k}"), F.struct(*SET).alias(f"c{k}"),
        F.col("first").alias(f"f{k}"), F.col("late").alias(f"late{k}"),
    )
    named = pairs.join(side(1), ["l1", "s1"]).join(side(2), ["l2", "s2"]).where("c1 <> c2")
    first, second = F.struct("f1.id", "f1.nth"), F.struct("f2.id", "f2.nth")
    # of each pair the set that is late, if the pair is one and the set isn't known to be
    late = F.when((first < second) & F.col("late2").isNull(), F.col("c2")).when((second < first) & F.col("late1").isNull(), F.col("c1"))
    named = named.select("f1", "f2", late.alias("late"), F.expr("c1.n + c2.n").alias("n")).where("late is not null")
    return done.union(proven(df, step(named, "named-pairs"), id_col, text))


def removals(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per id and text that loses lines: ``id``, ``version`` and the numbers of the ``removed`` lines, from 0, in order."""
    hashed = step(line_hashes(df, id_col, text), "line-hashes")
    full = step(sets(df, id_col, text, hashed), "line-sets")
    forget(hashed)
    found = step(classes(full), "line-classes")
    # what comes later needs no heads
    lines = step(full.drop("head", "more"), "lines")
    forget(full)
    heads = step(found.select(*SET, "more", "first", "lines"), "line-heads")
    late = earlier(df, found, heads, id_col, text).withColumn("late", F.lit(True))
    verdicts = heads.join(late, SET, "left").where("late or lines > 1")
    verdicts = step(verdicts.select(*SET, F.struct("first.id", "first.nth").alias("first"), "late"), "verdicts")
    judged = sieve(lines, SET, verdicts).join(verdicts, SET)
    gone = judged.where(F.coalesce(F.col("late"), F.lit(False)) | (F.struct("id", "nth") > F.col("first")))
    return gone.groupBy("id", "version").agg(F.sort_array(F.collect_set("nth")).alias("removed"))


def summary(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: its id, ``n_lines``, ``n_removed`` and the numbers of the ``removed`` lines, from 0."""
    found = removals(df, id_col, text).select(F.col("id").alias("__id"), F.col("version").alias("__version"), "removed")
    body = F.col(f"`{text}`").cast("string")
    n_lines = F.when(body.isNull(), 0).otherwise(F.size(F.split(body, "\n", -1)))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.when(body.isNotNull(), F.xxhash64(body)).alias("version"), n_lines.alias("n_lines"))
    out = rows.join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__version")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select(F.col("id").alias(id_col), "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))


def clean(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the removed lines cut out of ``text``; all rows stay."""
    found = removals(df, id_col, text)
    found = found.select(F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("removed").alias("__removed"))
    body = F.col(f"`{text}`").cast("string")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(body) == F.col("__version"))
    joined = df.join(found, same, "left")
    kept = F.filter(F.split(body, "\n", -1), lambda line, i: ~F.array_contains("__removed", i))
    new = F.when(F.col("__removed").isNull(), body).otherwise(F.array_join(kept, "\n"))
    out = with_columns(joined, {text: new})
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
