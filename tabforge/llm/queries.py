"""The training-data queries, one per operator, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import (
    decontaminate,
    htmltext,
    importance,
    langid,
    lexical,
    lines,
    packing,
    quality,
    sharding,
    simhash,
    suffixes,
    urls,
    warc,
)
from tabforge.llm.common import read
from tabforge.session import materialise, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_file() -> str:
    """The public vocabulary the contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # the layout to start from: a source is a shard's, so a hot source makes one far too large
    old = F.pmod(F.xxhash64("source"), F.lit(8))
    out = sharding.balance(docs, 8, old)
    return out.select(
        "doc_id",
        "size",
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(read(spark, sf_dir, "documents")).drop("runs")


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = quality.votes(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    voted = materialise(voted, "votes")
    return quality.judge(voted, quality.posteriors(voted))


RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]

_URL_SQL = """
WITH p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)
), r AS (SELECT *, regexp_replace(path, '[0-9]+', '#', 'g') AS shape FROM p),
k AS (
  SELECT host, shape, count(*) AS labelled, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM r JOIN labels ON doc_id = TRY_CAST(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT) GROUP BY ALL
), sh AS (
  SELECT host, shape, coalesce(n, 0) AS n, coalesce(labelled, 0) AS labelled, coalesce(bad, 0) AS bad
  FROM (SELECT host, shape, count(*) AS n FROM r GROUP BY ALL) FULL JOIN k USING (host, shape)
), pt AS (
  SELECT host, shape, n, unnest(range(0, len(segs))) AS d, segs FROM (SELECT *, string_split(shape, '/') AS segs FROM sh)
), pt2 AS (SELECT host, shape, n, d, segs[d + 1] AS s, array_to_string(segs[1:d], '/') AS parent FROM pt),
fan AS (
  SELECT host, d, parent FROM (SELECT host, d, parent, s, sum(n) AS n FROM pt2 GROUP BY ALL)
  GROUP BY ALL HAVING count(*) > 20 AND sum(n) < 3 * count(*)
), tm AS (
  SELECT host, shape, string_agg(CASE WHEN fan.host IS NULL THEN s ELSE '*' END, '/' ORDER BY d) AS template
  FROM pt2 LEFT JOIN fan USING (host, d, parent) GROUP BY host, shape
), lf AS (
  SELECT host, template, sum(labelled) AS labelled, sum(bad) AS bad FROM sh JOIN tm USING (host, shape) GROUP BY ALL
), pa AS (
  SELECT host, template, labelled, bad, d, array_to_string(segs[1:d + 1], '/') AS branch, array_to_string(segs[1:d], '/') AS above
  FROM (SELECT *, unnest(range(0, len(segs))) AS d FROM (SELECT *, string_split(template, '/') AS segs FROM lf))
), br AS (SELECT host, d, above, branch, sum(labelled) AS n1, sum(bad) AS b1 FROM pa GROUP BY ALL),
ts AS (
  SELECT *, CAST(n0 - n1 AS DOUBLE) AS n2, CAST(b0 - b1 AS DOUBLE) AS b2
  FROM br JOIN (SELECT host, d, above, sum(n1) AS n0, sum(b1) AS b0 FROM br GROUP BY ALL) USING (host, d, above)
), df AS (
  SELECT host, d, branch, n1, b1 FROM ts WHERE n1 > 0 AND n2 > 0 AND b0 > 0 AND b0 < n0
    AND (b1 * n2 - b2 * n1) * (b1 * n2 - b2 * n1) * n0 >= 3.84::DOUBLE * b0 * (n0 - b0) * n1 * n2
), dp AS (
  SELECT host, template, arg_max(branch, d) AS branch, arg_max(n1, d) AS n1, arg_max(b1, d) AS b1
  FROM pa JOIN df USING (host, d, branch) GROUP BY host, template
), dc AS (
  SELECT host, template AS leaf, coalesce(branch, '') AS template,
    (coalesce(b1, bh) + 10::DOUBLE * ba / greatest(na, 1)) / (coalesce(n1, nh) + 10::DOUBLE) > 0.5 AS bad
  FROM lf LEFT JOIN dp USING (host, template)
    JOIN (SELECT host, sum(labelled) AS nh, sum(bad) AS bh FROM lf GROUP BY host) USING (host)
    CROSS JOIN (SELECT sum(labelled) AS na, sum(bad) AS ba FROM lf)
), jd AS (
  SELECT page_id, host, path, dc.template AS template, bad,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM r JOIN tm USING (host, shape) JOIN dc ON dc.host = r.host AND dc.leaf = tm.template
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow' WHEN bad THEN 'block' ELSE 'allow' END AS verdict, template
FROM jd
"""


@query("op4_url_filters", _URL_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = read(spark, sf_dir, "pages").select("page_id", "url"), read(spark, sf_dir, "labels")
    # the corpus's pages are numbered after their documents, whose labels hold for them
    host, path = urls.host_and_path(F.col("url"))
    number = F.regexp_extract("path", "([0-9]+)[^0-9]*$", 1).try_cast("long")
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).alias("bad")
    labelled = pages.select(host.alias("host"), path.alias("path")).withColumn("doc", number)
    labelled = labelled.join(labels.select("doc_id", bad), F.col("doc") == F.col("doc_id"))
    return urls.judge(pages, labelled.select("host", "path", "bad"), RULES)


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.summary(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_file())


@query("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).select("page_id", "url", "text", "n_chars")


@query(
    "op10_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
    ), q AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS first_id, sha1(body) AS payload_digest FROM p)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
    FROM q
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write(warc.records(read(spark, sf_dir, "pages"), "page_id", "url", "html"), path)
    found = warc.read(spark, path)
    kind, header = F.col("headers")["warc-type"], F.col("headers")
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    revisit = kind == "revisit"
    return found.select(
        number(header["warc-record-id"]).alias("page_id"),
        F.when(revisit, F.col("http")["content-length"].cast("long")).otherwise(F.octet_length("payload")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(header["warc-payload-digest"], ":", -1)).otherwise(F.sha1("payload")).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(revisit, number(header["warc-refers-to"])).alias("refers_to"),
    )


@query(
    "op11_lexical_search",
    r"""
    WITH q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    d AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
    g AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
    p AS (SELECT doc_id, term, count(*) AS tf FROM w SEMI JOIN q USING (term) GROUP BY ALL),
    r AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
          FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
    s AS (SELECT item_id, doc_id, sum(r.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS score
          FROM q JOIN r USING (term) JOIN p USING (term) JOIN d USING (doc_id), g GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


#: The words of a table, the n-grams of one and two words, and the crc32 of a string, whose byte steps SQL can fold.
_WORDS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_GRAMS_SQL = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2),
    lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))), lambda a, b:
    list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x // 2, 3988292384 * (x % 2)))), 4294967295)"""


@query(
    "op13_importance_resampling",
    f"""
    WITH docs AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
    grams AS (SELECT doc_id, unnest({_GRAMS_SQL}) AS g FROM docs),
    aims AS (SELECT unnest({_GRAMS_SQL}) AS g FROM (SELECT coalesce({_WORDS_SQL}, []) AS w FROM benchmark)),
    names AS (SELECT g, hex(encode(g)) AS h FROM (SELECT g FROM grams UNION SELECT g FROM aims)),
    b AS (SELECT g, {_CRC_SQL} % 10000 AS bucket FROM names),
    sc AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS s FROM grams JOIN b USING (g) GROUP BY bucket),
    tc AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS t FROM aims JOIN b USING (g) GROUP BY bucket),
    al AS (SELECT (SELECT coalesce(sum(s), 0) FROM sc) AS sa, (SELECT coalesce(sum(t), 0) FROM tc) AS ta),
    gn AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (sa + 10000) / ((s + 1) * (ta + 10000)))) AS BIGINT) AS gain
           FROM sc LEFT JOIN tc USING (bucket), al),
    wt AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM grams JOIN b USING (g) JOIN gn USING (bucket) GROUP BY doc_id),
    x AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0
          ELSE (total - ((total % n) + n) % n) // n END AS weight,
          CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS hash FROM docs LEFT JOIN wt USING (doc_id)),
    y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((hash + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM x),
    z AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS fit FROM y WHERE n_words >= 20)
    SELECT y.doc_id, CAST(y.n_features AS BIGINT) AS n_features, CAST(y.weight AS BIGINT) AS weight, CAST(y.score AS BIGINT) AS score,
      CASE WHEN r <= 25 * fit // 100 THEN r END AS rank FROM y LEFT JOIN z USING (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
