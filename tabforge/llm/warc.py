"""WARC archives: written as text records, read back in splits whose record chain is verified.

A null payload is an empty one. Repeated rows are written each; of equal payloads all rows with the largest id are
responses. A null id is smaller than any other. An empty table gives an archive without records. Extra columns are ignored.
A record may be longer than a split, and a payload may hold the magic string, even whole records.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import small_batches, step

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
#: The standard's profile of a revisit record.
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ROWS_PER_FILE = 50_000


def records(df: DataFrame, id_col: str, uri: str, payload: str, least: int = 1000, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """One ``record`` string per row, without its closing empty lines.

    Among equal payloads of at least ``least`` bytes the one with the largest id is a response and the others revisit it.
    Payloads are told apart by SHA-1 and length; only digests that occur twice are joined back.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{uri}`").cast("string").alias("uri"), body.alias("body"))
    rows = rows.withColumns({"size": F.octet_length("body").cast("long"), "digest": F.sha1(F.encode("body", "UTF-8"))})
    groups = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    # written first: where repeats are few, the payloads needn't be shuffled to meet them
    groups = step(groups.where("n > 1").select(F.col("digest").alias("d"), F.col("size").alias("s"), "first"), "repeats")
    rows = rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("d").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END)
    )
    rows = rows.withColumn("block", F.when(revisit, http).otherwise(F.concat(http, "body")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("id")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("uri", "[\\x00-\\x1f]", " ")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("first"))),
        F.when(revisit, F.lit(f"WARC-Profile: {IDENTICAL}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    return rows.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(END), F.col("block")).alias("record"))


def write(rows: DataFrame, path: str) -> None:
    """Write ``record`` strings as archive files, one or more a task."""
    rows.write.option("lineSep", END).option("maxRecordsPerFile", ROWS_PER_FILE).text(path)


def _declared(value: bytes) -> int:
    """Length of the record whose magic comes right before ``value``, with its closing lines; 0 if it isn't a header."""
    end = value.find(b"\r\n\r\n")
    head = value[:end] if 0 <= end else b""
    for line in head.split(b"\r\n"):
        key, colon, number = line.partition(b":")
        if not colon or not key or key.strip() != key:
            return 0
        if key.lower() == b"content-length":
            number = number.strip()
            return len(MAGIC) + end + 4 + int(number) + 4 if number.isdigit() else 0
    return 0


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magic strings: ``file``, ``split`` and the bytes (the same splits in every scan, as files and settings are the same). Spark's line reader finds the magic."""
    small_batches(spark)
    raw = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary")
    )


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Per split, of what lies between magic strings: ``file``, ``split``, bytes before it in the split (``at``), ``size`` and
    the ``declared`` record length."""

    def number(batches):
        here, at = None, 0
        for batch in batches:
            out = []
            for file, split, value in zip(batch["file"], batch["split"], batch["value"], strict=True):
                value = bytes(value)
                if here != (file, split):
                    here, at = (file, split), 0
                out.append((file, split, at, len(value), _declared(value)))
                at += len(value) + len(MAGIC)
            yield pd.DataFrame(out, columns=["file", "split", "at", "size", "declared"])

    return _raw(spark, path).mapInPandas(number, "file string, split long, at long, size long, declared long")


def chain(pieces: DataFrame) -> DataFrame:
    """A row a split, of the verified records: ``file``, ``split``, its place ``base`` in the file and its end ``stop``, ``entry``
    and ``until`` (where its first record starts and its last one ends), ``open`` and ``due`` (start and end of the record that
    comes before them). Offsets are those of the magic; what there is none of is -1.

    A split's place in its file follows from the sizes of the splits before. Each task emits the successor of every
    candidate and shortens it to the first offset outside its split; pointer jumping from offset 0 of every file then
    doubles its step each round.
    """
    splits = pieces.groupBy("file", "split").agg(F.max(F.col("at") + F.col("size") + len(MAGIC)).alias("total"))
    # one row a split
    base = splits.selectExpr("file", "split", "sum(total) over (partition by file order by split) - total as base", "total")
    base = step(base, "splits")
    placed = pieces.join(base, ["file", "split"]).withColumn("off", F.expr(f"base + at - {len(MAGIC)}"))
    placed = step(placed.withColumn("next", F.expr("if(declared > 0 and off >= 0, off + declared, -1)")), "candidates")

    def shorten(part: pd.DataFrame) -> pd.DataFrame:
        part = part[part["next"] >= 0].sort_values("off", ascending=False)
        if not len(part):
            return pd.DataFrame({"file": [], "off": [], "next": []})
        last = int(part["base"].iloc[0] + part["total"].iloc[0]) - len(MAGIC)
        exits: dict[int, int] = {}
        for off, succ in zip(part["off"].tolist(), part["next"].tolist(), strict=True):
            exits[off] = exits.get(succ, -1) if succ < last else succ
        return pd.DataFrame({"file": part["file"].iloc[0], "off": list(exits), "next": list(exits.values())})

    def follow(part: pd.DataFrame) -> pd.DataFrame:
        succ = dict(zip(part["off"].tolist(), part["next"].tolist(), strict=True))
        entry = at = int(part["entry"].iloc[0])
        last = until = -1
        while succ.get(at, -1) >= 0:
            last, at = at, succ[at]
            until = at
        names = ["file", "split", "entry", "last", "until"]
        return pd.DataFrame([(part["file"].iloc[0], part["split"].iloc[0], entry, last, until)] if last >= 0 else [], columns=names)

    jumps = placed.groupBy("file", "split").applyInPandas(shorten, "file string, off long, next long").where("next >= 0")
    jumps = step(jumps, "jumps")
    reached = placed.select("file", F.lit(0).cast("long").alias("off")).distinct()
    while True:
        reached = step(reached, "reached")
        onward = reached.join(jumps, ["file", "off"]).select("file", F.col("next").alias("off"))
        more = reached.union(onward).distinct()
        if more.count() == reached.count():
            break
        reached = more
        far = jumps.select("file", F.col("off").alias("next"), F.col("next").alias("far"))
        jumps = step(jumps.join(far, ["file", "next"]).select("file", "off", F.col("far").alias("next")), "jumps")
    # the chain enters a split once
    entries = base.join(reached, "file").where(f"off >= base - {len(MAGIC)} and off < base + total - {len(MAGIC)}")
    entries = entries.groupBy("file", "split").agg(F.min("off").alias("entry"))
    followed = placed.join(entries, ["file", "split"]).groupBy("file", "split")
    followed = followed.applyInPandas(follow, "file string, split long, entry long, last long, until long")
    known = base.join(followed, ["file", "split"], "left")
    # one row a split
    before = lambda c: f"coalesce(last({c}, true) over (partition by file order by split rows between unbounded preceding and 1 preceding), -1)"
    return known.selectExpr(
        "file", "split", "base", f"base + total - {len(MAGIC)} as stop", "coalesce(entry, -1) as entry", "coalesce(until, -1) as until",
        f"{before('last')} as open", f"{before('until')} as due",
    )


def _fields(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in raw.split(b"\r\n"))
    return {k.decode("utf-8", "replace").strip().lower(): v.decode("utf-8", "replace").strip() for k, c, v in pairs if c}


def _parse(value: bytes, declared: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, http headers and payload of a record without its magic."""
    head, _, block = value[: declared - len(MAGIC) - 4].partition(b"\r\n\r\n")
    headers = _fields(head)
    http, payload = {}, block
    if headers.get("content-type", "").startswith("application/http"):
        first, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(first)
    return headers, http, payload


def _cut(raw: DataFrame, whole: bool) -> DataFrame:
    """The records that lie whole in one split, parsed, or else one row for each split's part of the others.

    ``raw`` has the columns of ``_raw`` and ``chain``, in the order of the files. What lies beyond a record's declared end is
    garbage between records.
    """
    names = ["headers", "http", "payload"] if whole else ["file", "record", "off", "declared", "value"]

    def cut(batches):
        here, out = None, []
        # the open record's start and end, its first offset in the split and its pieces there; the offset and the next start
        record, end, since, held, off, due = -1, -1, 0, [], 0, -1

        def emit():
            inside = record == since and off >= end
            if held and inside == whole:
                value = MAGIC.join(held)
                out.append(_parse(value, end - record) if whole else (here[0], record, since, end - record, value))
            held.clear()

        for batch in batches:
            for file, split, value, base, entry, start, until in zip(*(batch[c] for c in ("file", "split", "value", "base", "entry", "open", "due")), strict=True):
                if here != (file, split):
                    emit()
                    here, off, due = (file, split), base - len(MAGIC), entry
                    record, end, since = start, until, off
                value = bytes(value)
                if off == due and off >= 0:
                    declared = _declared(value)
                    due = off + declared if declared else -1
                    if declared:
                        record, end, since = off, due, off
                if record >= 0 and off < end:
                    held.append(value)
                off += len(value) + len(MAGIC)
                if off >= end:
                    emit()
            yield pd.DataFrame(out, columns=names)
            out.clear()
        emit()
        yield pd.DataFrame(out, columns=names)

    parsed = "headers map<string,string>, http map<string,string>, payload binary"
    return raw.mapInPandas(cut, parsed if whole else "file string, record long, off long, declared long, value binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``: ``headers`` (lower-cased names), ``http`` headers and ``payload``.

    A split's task cuts its own records by the chain's row of the split; only parts of records that lie in several splits
    are moved.
    """
    splits = step(chain(step(_scan(spark, path), "pieces")), "chain")
    found = _raw(spark, path)
    # one row a split; its broadcast keeps the pieces in order
    inside = _cut(found.join(F.broadcast(splits.where("entry >= 0")), ["file", "split"]), True)
    crossed = splits.where(f"(open >= 0 and due > base - {len(MAGIC)}) or until > stop")
    parts = _cut(found.join(F.broadcast(crossed), ["file", "split"]), False).groupBy("file", "record")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("off", "value"))).alias("p"), F.max("declared").alias("declared"))
    magic = F.lit(MAGIC)
    joined = F.aggregate(F.slice("p", F.lit(2), F.size("p")), F.col("p")[0]["value"], lambda a, x: F.concat(a, magic, x["value"]))

    def parse(batches):
        for batch in batches:
            out = [_parse(bytes(value), declared) for value, declared in zip(batch["value"], batch["declared"], strict=True)]
            yield pd.DataFrame(out, columns=["headers", "http", "payload"])

    return inside.union(parts.select(joined.alias("value"), "declared").mapInPandas(parse, inside.schema))
