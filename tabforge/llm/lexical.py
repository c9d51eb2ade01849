"""Ranked lexical search: Block-Max MaxScore over sharded, compressed posting lists.

The index is a table of one row a shard and term: postings in blocks, each packed to whole bytes, with the block's first and
last document and its *impacts*, the pairs of term frequency and document length that no other pair of the block beats.
Impacts make a block's greatest score computable under any corpus statistics, so that the index is written in one pass over
the texts. A shard is a run of documents of about ``SHARD_BYTES``; every shard is searched by itself, the heaps are merged.

Scores are whole numbers (see ``part`` and ``term_weight``), so results are exact. Equal scores rank by ascending id, a null id
last. Null, empty and wordless texts are in no list and never found; such an item finds nothing. Repeated rows are documents
of their own, a repeated item is searched again. Empty tables give empty results; extra columns are ignored. Texts of
any length are read whole, in pieces.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabforge.llm.common import small_batches, step
from tabforge.llm.decontaminate import item_blocks
from tabforge.llm.wordgrams import SpanTable, pieces

#: Bytes of the texts of one shard, which bounds the memory of indexing and of searching it.
SHARD_BYTES = 32_000_000
#: Postings of a block.
BLOCK = 128
#: Documents whose scores are gathered at once; the bar to pass is raised after each such run.
RUN = 4096
_BLOCK_ROW = np.dtype([("first", "<u4"), ("last", "<u4"), ("at", "<u4"), ("n", "<u2"), ("gap_width", "u1"), ("tf_width", "u1")])
_IMPACT = np.dtype([("block", "<u4"), ("tf", "<u4"), ("length", "<u4")])


def term_weight(n_docs: int, df: int) -> int:
    """Rarity of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """How much a document's length damps its term frequencies."""
    return 100 - 75 + (75 * length * n_docs) // max(n_terms, 1)


def part(tf: np.ndarray, damp: np.ndarray) -> np.ndarray:
    """What one posting adds to a score, before the term's weight: it grows with ``tf`` and falls with the length."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * damp)


# ---- index


def _bytes_of(values: np.ndarray) -> np.ndarray:
    """Whole bytes each value takes: 1, 2 or 4."""
    return np.where(values < 1 << 8, 1, np.where(values < 1 << 16, 2, 4))


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    for k in range(4):
        on = width > k
        out[at[on] + k] = (values[on] >> (8 * k)) & 255


def pack(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, length: np.ndarray) -> dict[str, list]:
    """Posting lists of one shard: postings sorted by term and document; ``length`` is each posting's document length."""
    n = len(term)
    start = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    size = np.diff(np.r_[start, n])
    inside = np.arange(n) - np.repeat(start, size)
    opens = inside % BLOCK == 0
    block = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], n] - 1
    gap = doc - np.r_[0, doc[:-1]]
    gap[first] = 0
    gap_width = np.maximum.reduceat(_bytes_of(gap), first)
    tf_width = np.maximum.reduceat(_bytes_of(tf), first)
    count = last - first + 1
    bytes_of = count * (gap_width + tf_width)
    begins = np.r_[0, np.cumsum(bytes_of)]
    data = np.zeros(begins[-1], np.uint8)
    k = np.arange(n) - first[block]
    _put(data, begins[block] + k * gap_width[block], gap, gap_width[block])
    _put(data, begins[block] + (count * gap_width)[block] + k * tf_width[block], tf, tf_width[block])
    # impacts: by falling tf, then rising length; a pair stays if it is shorter than every pair before it in its block
    order = np.lexsort((length, -tf, block))
    step_down = length[order] - block[order] * (np.int64(1) << 33)
    best = np.minimum.accumulate(step_down)
    stays = np.r_[True, step_down[1:] < best[:-1]]
    pairs = order[stays]
    own = np.searchsorted(first, start)  # first block of each term
    rows = np.empty(len(first), _BLOCK_ROW)
    rows["first"], rows["last"], rows["n"], rows["gap_width"], rows["tf_width"] = doc[first], doc[last], count, gap_width, tf_width
    term_of_block = np.repeat(np.arange(len(start)), np.diff(np.r_[own, len(first)]))
    rows["at"] = begins[:-1] - begins[own][term_of_block]
    impacts = np.empty(len(pairs), _IMPACT)
    impacts["block"], impacts["tf"], impacts["length"] = block[pairs] - own[term_of_block[block[pairs]]], tf[pairs], length[pairs]
    upto, cut = np.r_[own, len(first)], np.searchsorted(block[pairs], np.r_[own, len(first)])
    ends = begins[upto]
    lists = range(len(start))
    return {
        "df": size.tolist(),
        "blocks": [rows[upto[i] : upto[i + 1]].tobytes() for i in lists],
        "impacts": [impacts[cut[i] : cut[i + 1]].tobytes() for i in lists],
        "postings": [data[ends[i] : ends[i + 1]].tobytes() for i in lists],
    }


class _Shard:
    """Postings of the documents read since the last shard was written."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids: list = []
        self.lengths: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, texts: list[str], wanted: frozenset[bytes] | None) -> None:
        lengths = np.zeros(len(ids), np.int64)
        for words, _ in pieces(texts):
            lengths += np.bincount(words.row, minlength=len(ids))
            table = SpanTable(words.data, words.start, words.end - words.start)
            number = np.full(len(table.first), -1, np.int64)
            spans = table.spans()
            if wanted is None:
                number[table.used] = [self.terms.setdefault(s, len(self.terms)) for s in spans]
            else:
                number[table.used] = [self.terms.setdefault(s, len(self.terms)) if s in wanted else -1 for s in spans]
            term, doc = number[table.slot], words.row + len(self.ids)
            key, tf = np.unique((term * (np.int64(1) << 32) + doc)[term >= 0], return_counts=True)
            self.found.append((key >> 32, key & 0xFFFFFFFF, tf))
        self.lengths.append(lengths)
        self.ids += ids
        self.size += sum(map(len, texts))

    def rows(self) -> dict[str, list]:
        name, length = uuid.uuid4().hex, np.concatenate([np.zeros(0, np.int64), *self.lengths])
        head = {
            "shard": name, "term": None, "df": int((length > 0).sum()), "n_terms": int(length.sum()), "blocks": None,
            "impacts": None, "postings": None, "ids": self.ids, "lengths": length.astype("<u4").tobytes(),
        }
        body: dict[str, list] = {"df": []}
        if self.terms:
            term, doc, tf = (np.concatenate(x) for x in zip(*self.found, strict=True))
            # a document read in pieces has a count from each
            key, place = np.unique(term * (np.int64(1) << 32) + doc, return_inverse=True)
            tf = np.bincount(place, weights=tf).astype(np.int64)
            doc = key & 0xFFFFFFFF
            body = pack(key >> 32, doc, tf, length[doc])
            body["term"] = [t.decode("utf-8", "surrogatepass") for t in self.terms]
        n = len(body["df"])
        body["shard"] = [name] * n
        return {c: [v, *body.get(c, [None] * n)] for c, v in head.items()}


def index(df: DataFrame, id_col: str = "doc_id", text: str = "text", terms: frozenset[bytes] | None = None) -> DataFrame:
    """Posting lists of all texts, or of some ``terms`` only: one row a shard and term.

    A row without a term heads its shard: the documents' ids and lengths in ``ids`` and ``lengths``, their number with any term in
    ``df``, all their terms in ``n_terms``. No shuffle: a shard holds documents of one input task. Write it before it is
    searched, since a shard's name is drawn anew each time it is made.
    """
    spark = df.sparkSession
    small_batches(spark)
    wanted = spark.sparkContext.broadcast(terms) if terms is not None else None
    kind = df.schema[id_col].dataType
    schema = T.StructType.fromDDL(
        "shard string, term string, df long, n_terms long, blocks binary, impacts binary, postings binary, ids string, lengths binary"
    )
    schema["ids"].dataType = T.ArrayType(kind)
    arrow = to_arrow_schema(schema)

    def build(batches):
        shard, only = _Shard(), wanted.value if wanted else None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at, size = 0, 0
            for n, t in enumerate(texts):
                if shard.size + size + len(t) > SHARD_BYTES and n > at:
                    shard.add(ids[at:n], texts[at:n], only)
                    at, size = n, 0
                if shard.size and shard.size + len(t) > SHARD_BYTES:
                    yield pa.RecordBatch.from_pydict(shard.rows(), arrow)
                    shard = _Shard()
                size += len(t)
            shard.add(ids[at:], texts[at:], only)
        if shard.ids:
            yield pa.RecordBatch.from_pydict(shard.rows(), arrow)

    body = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return body.where("text is not null").mapInArrow(build, schema)


# ---- search


class Postings:
    """One term's list in a shard; blocks are unpacked when they are first asked for."""

    def __init__(self, blocks: bytes, impacts: bytes, data: bytes, damp: np.ndarray, damp_of):
        self.rows, pairs = np.frombuffer(blocks, _BLOCK_ROW), np.frombuffer(impacts, _IMPACT)
        self.first, self.last = self.rows["first"].astype(np.int64), self.rows["last"].astype(np.int64)
        parts = part(pairs["tf"].astype(np.int64), damp_of(pairs["length"].astype(np.int64)))
        self.most = np.maximum.reduceat(parts, np.searchsorted(pairs["block"], np.arange(len(self.rows))))
        self.top = int(self.most.max())
        self.data, self.damp = data, damp
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and parts of a block."""
        if k not in self.open:
            _, _, at, n, gap, tf = self.rows[k].tolist()
            gaps = np.frombuffer(self.data, f"<u{gap}", n, at)
            tfs = np.frombuffer(self.data, f"<u{tf}", n, at + n * gap).astype(np.int64)
            docs = self.first[k] + np.cumsum(gaps, dtype=np.int64)
            self.open[k] = docs, part(tfs, self.damp[docs])
        return self.open[k]

    def between(self, low: int, high: int):
        """Documents in [low, high) and their parts, block by block."""
        a, b = int(self.last.searchsorted(low)), int(self.first.searchsorted(high))
        for k in range(a, b):
            docs, parts = self.block(k)
            if docs[0] < low or docs[-1] >= high:
                i, j = np.searchsorted(docs, [low, high])
                docs, parts = docs[i:j], parts[i:j]
            yield docs, parts


def best(lists: list[tuple[int, Postings]], n_docs: int, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a shard for one item's (weight, list) pairs, and their scores; ``rank`` breaks ties.

    Lists are sorted by their greatest score. Those whose bounds together stay below the bar, the kth best score so far, are
    not essential: a document in none of the others can't pass. The others are read in runs of documents; what the first
    ones can add at most to a document is bounded by the blocks it falls into, and rejects it before any of those blocks
    is unpacked. Only bounds strictly below the bar reject, so ties are never lost.
    """
    lists = sorted(lists, key=lambda x: x[0] * x[1].top)
    bounds = np.cumsum([w * p.top for w, p in lists])
    docs, scores, bar = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for low in range(0, n_docs, RUN):
        high = min(n_docs, low + RUN)
        split = int(np.searchsorted(bounds, bar))  # lists before it are not essential
        if split == len(lists):
            break
        total, seen = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
        for w, p in lists[split:]:
            for d, v in p.between(low, high):
                total[d - low] += w * v
                seen[d - low] = True
        found = np.flatnonzero(seen)
        if split:
            found = found[total[found] + bounds[split - 1] >= bar]
        some = found + low
        total = total[found]
        maxima, places = [], []
        for w, p in lists[:split]:
            at = np.minimum(np.searchsorted(p.last, some), len(p.last) - 1)
            inside = (p.first[at] <= some) & (some <= p.last[at])
            maxima.append(np.where(inside, w * p.most[at], 0))
            places.append(np.where(inside, at, -1))
        most = total + sum(maxima) if maxima else total
        alive = most >= bar
        for i in range(split - 1, -1, -1):
            w, p = lists[i]
            at = places[i]
            for b in np.unique(at[alive & (at >= 0)]).tolist():
                on = np.flatnonzero(alive & (at == b))
                d, v = p.block(b)
                j = np.minimum(np.searchsorted(d, some[on]), len(d) - 1)
                total[on] += np.where(d[j] == some[on], w * v[j], 0)
                most[on] += np.where(d[j] == some[on], w * v[j], 0)
            most = most - maxima[i]
            alive &= most >= bar
        some, total = some[alive], total[alive]
        if len(some):
            docs, scores = np.r_[docs, some], np.r_[scores, total]
            order = np.lexsort((rank[docs], -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(docs) == k:
                bar = max(1, int(scores[-1]))
    return docs, scores


def _terms(texts: list[str]) -> list[dict[bytes, int]]:
    """Terms of each text with their number."""
    out: list[dict[bytes, int]] = [{} for _ in texts]
    for words, _ in pieces(texts):
        raw = words.data.tobytes()
        for a, b, r in zip(words.start.tolist(), words.end.tolist(), words.row.tolist(), strict=True):
            out[r][raw[a:b]] = out[r].get(raw[a:b], 0) + 1
    return out


def search_block(postings: DataFrame, items: list[dict[bytes, int]], k: int, id_col: str) -> DataFrame:
    """The ``k`` best documents of every shard for each of ``items``: ``item`` (its place in the list), id and ``score``."""
    spark = postings.sparkSession
    total = postings.where("term is null").agg(F.sum("df"), F.sum("n_terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    # no more rows than the block of items has terms
    rarity = {r.term: term_weight(n_docs, r.df) for r in postings.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    asked = []
    for terms in items:
        known = [(t.decode("utf-8", "surrogatepass"), n) for t, n in terms.items()]
        asked.append([(t, n * rarity[t]) for t, n in known if rarity.get(t, 0) > 0])
    shared = spark.sparkContext.broadcast(asked)  # as large as the block of items
    kind = postings.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField(id_col, kind), T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)

    def one(shard: pa.Table) -> pa.Table:
        rows = shard.select(["term", "blocks", "impacts", "postings"]).to_pydict()
        head = rows["term"].index(None)
        ids = shard.column("ids")[head].as_py()
        damp_of = lambda n: damping(n, n_docs, n_terms)
        damp = damp_of(np.frombuffer(shard.column("lengths")[head].as_py(), "<u4").astype(np.int64))
        rank = np.empty(len(ids), np.int64)
        rank[sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))] = np.arange(len(ids))
        found = zip(rows["term"], rows["blocks"], rows["impacts"], rows["postings"], strict=True)
        lists = {t: Postings(b, i, p, damp, damp_of) for t, b, i, p in found if t is not None}
        out: dict[str, list] = {"item": [], id_col: [], "score": []}
        for n, terms in enumerate(shared.value):
            docs, scores = best([(w, lists[t]) for t, w in terms if t in lists], len(ids), rank, k)
            out["item"] += [n] * len(docs)
            out[id_col] += [ids[d] for d in docs.tolist()]
            out["score"] += scores.tolist()
        return pa.Table.from_pydict(out, arrow)

    return postings.groupBy("shard").applyInArrow(one, schema)


def search(
    df: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of ``df`` for each row of ``items``: item id, ``rank`` (from 1), id and ``score``.

    Items come in blocks of bounded size. A block's terms are pushed into the index, which is then all that the search reads.
    """
    spark, out = df.sparkSession, None
    names = T.StructType([T.StructField("item", T.LongType()), T.StructField(item_id, items.schema[item_id].dataType)])
    for block in item_blocks(items, item_id, item_text):
        counted = _terms([t for _, t in block])
        postings = step(index(df, id_col, text, frozenset().union(*counted)), "postings")
        found = search_block(postings, counted, k, "__id")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("__id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = F.broadcast(spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], names))
        found = found.join(named, "item").select(item_id, "rank", F.col("__id").alias(id_col), "score")
        out = found if out is None else out.union(found)
    return out
