"""Packing, page text, archives, url filter and the pipeline."""

from __future__ import annotations

import hashlib
import importlib.util
import random
import time
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import pytest

from tabforge.llm import htmltext, packing, urls, warc
from tabforge.llm.queries import RULES, tokenizer_file
from tabforge.llm.wordids import WordTable
from tabforge.session import scratch_dir


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def places(plan, counts):
    """Bin -> sorted (offset, length) of all pieces of a plan."""
    out = {}
    runs = sorted(zip(plan.length, plan.first, plan.bin, plan.each, plan.used, strict=True))
    for length, n in counts.items():
        for rank in range(n):
            _, first, bin_, each, used = [r for r in runs if r[0] == length and r[1] <= rank][-1]
            out.setdefault(bin_ + (rank - first) // each, []).append((used + (rank - first) % each * length, length))
    return {b: sorted(v) for b, v in out.items()}


@pytest.mark.parametrize("seed", range(40))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.randint(3, 60)
    counts = {rng.randint(1, capacity): rng.randint(1, 12) for _ in range(rng.randint(0, 12))}
    plan = packing.plan_bins(counts, capacity)
    bins = places(plan, counts)
    assert len(bins) == plan.bins
    for pieces in bins.values():
        at = 0
        for offset, length in pieces:
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * n > capacity for _, n in pieces) <= 2
    total = sum(k * n for k, n in counts.items())
    assert plan.bins <= max(1, 1.5 * total / capacity + 1) or any(3 * k > capacity for k in counts)


def test_large_items_are_matched_as_well_as_possible():
    plan = packing.plan_bins({60: 3, 40: 3, 35: 2, 50: 1}, 100)
    assert plan.bins == 5  # three of 60 + 40, and 35 + 50, 35


def test_word_table(monkeypatch):
    t = tokenizer()
    table = WordTable(tokenizer_file())
    texts = ["", " ", "a b a.", "x.. y, z,. 1. 2, é. e\u0301. it's. <|endoftext|>. ²", "İI ΑΣ ΑΣ. \t\r\n q\x00 q", " , . ,", "\n\n"]
    rng = random.Random(2)
    texts += ["".join(rng.choices(["ab", "c", "é", ".", ",", " ", " ", "\n", "9", "ß"], k=400)) for _ in range(30)]
    want = [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert table.encode(texts) == want == table.encode(texts)
    monkeypatch.setattr("tabforge.llm.wordids.WORDS", 5)
    monkeypatch.setattr("tabforge.llm.wordids.CHUNK", 100)
    assert table.encode(texts) == want


def test_word_table_over_all_alphabets():
    """Every letter, digit and mark below U+3000, and some above, at the end of a word with a stop or comma."""
    t, table = tokenizer(), WordTable(tokenizer_file())
    some = [chr(c) for c in [*range(0x21, 0x3000), *range(0x3000, 0x20000, 97)] if not 0xD800 <= c < 0xE000]
    some = [c for c in some if not c.isspace() and unicodedata.category(c) not in ("Cn", "Cc", "Zs", "Zl", "Zp")]
    rng = random.Random(4)
    texts = [" ".join(f"{h}{c}{e}" for c in some for h, e in (("a", "."), ("", ","))), "BELEDİYESİ. क़. ড়,"]
    texts += ["".join(rng.choices([*some[::7], ".", ",", " ", "a"], k=300)) for _ in range(60)]
    want = [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert table.encode(texts) == want


def test_pack_documents(spark):
    rng = random.Random(1)
    texts = [None, "", "word " * 700] + [" ".join(rng.choices(["alpha", "beta", "x"], k=rng.randint(0, 40))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)] + [(5, texts[5], 3), (None, "x", 3)], "doc_id long, text string, offset int")
    out = packing.pack_documents(df, tokenizer_file(), capacity=64, with_ids=True).collect()
    t = tokenizer()
    by_doc = {}
    for r in out:
        assert 1 <= r.length <= 64 and len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        pieces = pieces[: len(pieces) // 2] if i == 5 else pieces
        assert np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist() == ids
        assert [r.start for r in pieces] == list(range(0, len(ids), 64))
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.1 * sum(r.length for r in out) / 64 + 1
    assert packing.pack_documents(df.limit(0), tokenizer_file()).count() == 0


PAGES = [
    (None, ""),
    ("", ""),
    ("plain &lt;text&gt;", "plain <text>"),
    ("<p>a<p>b", "a\nb"),
    ("<article><h1>T</h1><p>x <b>y</b>z<br>w</p></article>", "T\nx yz w"),
    ("<head><title>no</title><body><nav><a href=x>menu</a></nav><div class=content><p>One, two, three.</p><p>Four &amp; five\u00a0six.</p></div><footer>f</footer>", "One, two, three.\nFour & five six."),
    ("<header>Site</header><main><p>Text of the page.</p><aside>side</aside><form><p>Name</p></form><script>if (a<b) {}</script></main>", "Text of the page."),
    ("<article><p>Kept.</p><div class='ad-box'>Buy</div><section id=comments><p>Nice, good, fine, well, yes.</p></section></article>", "Kept."),
    ("<div id=cookie-notice><p>We, use, many, cookies, here, and, there, always.</p></div><article><p>Short.</p></article>", "Short."),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre> e  f </pre></article>", "a\nb\nc\nd\ne f"),
    ("<!-- <p>no</p> --><article><p>yes<!-- x --> sir</p></article>", "yes sir"),
    ("<article><p>1 < 2 &unknown; &#233; &eacute;</p></article>", "1 < 2 &unknown; é é"),
    ("<div>" * 3000 + "deep", "deep"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert htmltext.main_text(page) == text


def test_main_text_is_whole():
    long = [f"Paragraph {i}, with, some, commas, and " + "words " * 30 + "." for i in range(30)]
    body = lambda xs: "".join(f"<p>{x}</p>" for x in xs)
    links = "<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"
    rest = f"<div>{body(['a, b.', 'c.'])}</div><p>Short end.</p><blockquote>Said.</blockquote><pre>x = 1</pre>"
    want = [" ".join(x.split()) for x in long] + ["a, b.", "c.", "Short end.", "Said.", "x = 1"]
    page = "<body><div>{menu}</div>{open}<div>{long}</div>{rest}{links}{close}</body>"
    for tag in ("article", "main"):
        whole = page.format(menu=links, open=f"<{tag}>", long=body(long), rest=rest, links=links, close=f"</{tag}>")
        assert htmltext.main_text(whole).split("\n") == [*want, "One", "Two", "Three"]
    plain = page.format(menu=links, open="Bare text.", long=body(long), rest=rest, links=links, close="")
    assert htmltext.main_text(plain).split("\n") == ["Bare text.", *want]
    both = f"<main><article>{body(long)}</article>{links}<p>End.</p></main>"
    assert htmltext.main_text(both).split("\n") == [*want[:30], "End."]


ARTICLE = "<p>One, two, three, four, five, and some more words to read.</p><p>Six.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<div id="page" class="has-sidebar">{ARTICLE}</div>',
        f'<div class="content no-sidebar">{ARTICLE}</div>',
        f'<div class="post share-enabled">{ARTICLE}</div>',
        f'<div id="search-results">{ARTICLE}</div>',
        f'<form action=x><div class=content>{ARTICLE}</div><div class=sidebar><p>Beside.</p></div></form>',
        f'<div class=search><main>{ARTICLE}</main><div class=widget><p>Beside.</p></div></div>',
        f'<div class=social><article>{ARTICLE}</article></div><p>x</p>',
        f'<div class=sidebar><div>{ARTICLE}</div></div>',
        f'<div class="hidden md:block" title="the hidden side">{ARTICLE}</div><div hidden><p>no</p></div><div HIDDEN=""><p>no</p></div>',
        f'<article>{ARTICLE}<div class="sidebar-left"><p>no</p></div><ul id="comments--open"><li>no</ul><form><p>no</p></form></article>',
    ],
)
def test_noise_words_spare_the_page(page):
    assert "One, two" in htmltext.main_text(page) and htmltext.main_text(page).split("\n")[1] == "Six."
    assert not {"no", "Beside."} & set(htmltext.main_text(page).split("\n"))


def test_extract(spark):
    df = spark.createDataFrame([(i, p, "old", 1) for i, (p, _) in enumerate(PAGES)], "page_id long, html string, text string, n_chars int")
    out = htmltext.extract(df)
    assert out.columns == ["page_id", "text", "n_chars"]
    got = {r.page_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES)}
    assert htmltext.extract(df.limit(0)).count() == 0


def test_extract_finds_the_articles(spark, sf):
    """Held-out truth: the lines of the document a page was made of, whose number its url has."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    hits = total = 0
    for r in htmltext.extract(pages).collect():
        number = int("".join(c for c in r.url.split("://")[1].split("?")[0].split("#")[0].rstrip("/").split("/")[-1] if c.isdigit()))
        if number in docs:
            want = [" ".join(x.split()) for x in docs[number].split("\n") if x.strip()]
            total += 1
            hits += r.text.split("\n")[-len(want) :] == want
    assert total and hits / total > 0.95


def archive(spark, rows, split=None):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    path = scratch_dir(spark, "warc")
    warc.write(warc.records(df.repartition(2), "page_id", "url", "html"), path)
    return path


@pytest.mark.parametrize("split", [None, 3000])
def test_warc_round_trip(spark, split):
    whole = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rng = random.Random(1)
    rows = [(1, "http://a/", "same " * 300), (2, "http://b/", "same " * 300), (3, None, None), (4, "http://c/\r\nX: y", "")]
    rows += [(5, "u", whole * 40), (6, "u", "WARC/1.0\r\n" * 50 + "é"), (7, "u", "short"), (8, "u", "short"), (None, "u", "same " * 300)]
    rows += [(20 + i, f"http://h/{i}", "".join(rng.choices("abcé \r\n", k=rng.randint(0, 2500)))) for i in range(120)]
    path = archive(spark, [(*r, "x") for r in rows])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = {r.headers["warc-record-id"]: r for r in warc.read(spark, path).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == len(rows)
    for i, _, html in rows:
        r = got[f"<urn:page:{'null' if i is None else i}>"]
        raw = (html or "").encode()
        assert r.headers["warc-payload-digest"] == "sha1:" + hashlib.sha1(raw).hexdigest()
        assert int(r.http["content-length"]) == len(raw)
        if i in (1, None):
            assert r.headers["warc-type"] == "revisit" and r.headers["warc-refers-to"] == "<urn:page:2>" and not r.payload
        else:
            assert r.headers["warc-type"] == "response" and bytes(r.payload) == raw


def test_warc_payloads_stay_with_their_split(spark):
    """Only parts of records in several splits are shuffled, by file and record; no join deals the payloads out."""
    path = archive(spark, [(i, "u", f"text {i} " * 40, "x") for i in range(50)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = warc.read(spark, path)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1, plan
        assert found.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_warc_garbage_and_cut_files(spark, tmp_path):
    """Files not written here: garbage after a record ends its chain, a cut record keeps what is there."""
    one = b"WARC/1.0\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a").write_bytes(one + one + b"junk" + one)
    (tmp_path / "b").write_bytes(one + one[:-7])
    (tmp_path / "c").write_bytes(b"junk" + one)
    got = sorted(bytes(r.payload) for r in warc.read(spark, str(tmp_path)).collect())
    assert got == [b"he", b"hello", b"hello", b"hello"]


def test_warc_empty(spark):
    assert warc.read(spark, archive(spark, [])).count() == 0


def test_urls(spark):
    rows = [
        (1, "HTTP://Sub.Example.NET/en/x?a#b"), (2, "http://example.net/de/"), (3, "x://a.example.com/de/1"), (4, "http://b.org/fr/"),
        (5, "http://b.org/fr"), (6, None), (7, "no scheme/here"), (8, "http://net"), (9, "http://notexample.com/de/"), (9, "http://notexample.com/de/"),
        (10, "a://b://c/d"), (None, "http://UPPER.É/ü#x"), (11, ""),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, template string")
    labels = spark.createDataFrame([], "host string, path string, bad boolean")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, labels, RULES).collect()}
    assert got == {
        (1, "sub.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.net", "/de/", "net/", "block"),
        (3, "a.example.com", "/de/1", "example.com/de/", "block"), (4, "b.org", "/fr/", "org/fr/", "allow"),
        (5, "b.org", "/fr", None, "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "net", "", None, "allow"),
        (9, "notexample.com", "/de/", None, "allow"), (10, "b:", "//c/d", None, "allow"), (None, "upper.É", "/ü", None, "allow"),
        (11, "", "", None, "allow"),
    }
    assert urls.judge(pages, labels, RULES).count() == len(rows)
    assert urls.judge(pages.limit(0), labels, RULES).count() == 0


def test_url_purity(spark):
    good = [f"/news/{i}" for i in range(60)]
    bad = [f"/spam/{i}/x" for i in range(60)]
    free = [f"/tag/{c}{d}" for c in "abcdefghij" for d in "klmno"]
    rows = [(i, f"http://h.test{p}") for i, p in enumerate([*good, *bad, *free])]
    labels = [("h.test", p, False) for p in good[:40]] + [("h.test", p, True) for p in bad[:40]] + [("h.test", "/x", None)]
    out = urls.judge(
        spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "host string, path string, bad boolean"), []
    ).collect()
    by = {r.path: r for r in out}
    assert all(by[p].verdict == "allow" for p in good) and all(by[p].verdict == "block" for p in bad)
    assert by["/spam/3/x"].template == "/spam" and len({by[p].template for p in free}) == 1


def test_urls_pool_below_wildcards(spark):
    """Names vary, and so do the few slugs of each: one template, whose purity blocks a page without labels of its own."""
    word = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(3))
    paths = [f"/u/{word(k)}/p/{word(2 * k + j)}" for k in range(600) for j in range(2)]
    labels = [("h.test", p, k % 10 > 0) for k, p in enumerate(paths[:1000])] + [("h.test", "/ok/a", False)] * 400
    rows = [(k, f"http://h.test{p}") for k, p in enumerate([*paths, "/ok/a"])]
    out = urls.judge(
        spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "host string, path string, bad boolean"), []
    ).collect()
    pooled = [r for r in out if r.path.startswith("/u/")]
    assert len(pooled) == 1200 and all(r.verdict == "block" for r in pooled) and len({r.template for r in pooled}) == 1
    assert [r.verdict for r in out if r.path == "/ok/a"] == ["allow"]


def load_pipeline():
    path = Path(__file__).resolve().parents[2] / "corpus_pipeline.py"
    spec = importlib.util.spec_from_file_location("corpus_pipeline", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    pipeline = load_pipeline()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_dedup", "benchmark_decontamination", "best_fit_packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    steps = [docs]
    for name, stage in pipeline.STAGES:
        path = scratch_dir(spark, name)
        stage(spark, steps[-1], sf).write.parquet(path)
        steps.append(spark.read.parquet(path))
    assert all(s.columns == docs.columns for s in steps[:-1])
    raw, judged, lined, near, clean = [{r.doc_id: r for r in s.collect()} for s in steps[:-1]]
    assert set(judged) < set(raw) and all(judged[i].text == raw[i].text for i in judged)
    assert sum(labels[i] for i in labels if i in judged) > 0.85 * sum(labels.values())
    assert set(lined) == set(judged) and any(lined[i].text != judged[i].text for i in lined)
    assert all(r.n_chars == len(r.text) for r in lined.values())
    assert set(near) <= set(lined)
    leaky = {i for i, r in near.items() if any(x in " ".join(r.text.lower().split()) for x in items)}
    assert leaky and not leaky & set(clean) and len(set(near) - set(clean) - leaky) < 0.01 * len(near)
    assert {r.doc_id for r in steps[-1].collect()} == set(clean)


def test_pipeline_on_odd_rows(spark, tmp_path):
    pipeline = load_pipeline()
    prose = " ".join(f"word{i % 83} other{i}" for i in range(60)) + "."
    schema = "doc_id long, text string, lang string, source string, n_chars long, __features string"
    rows = [(1, None, None, None, None, None), (2, "", "en", "s", 0, "x"), (3, prose, "en", "s", 9, "x"), (3, prose, "en", "s", 9, "x"),
            (None, prose + " tail " * 3, None, "s", 1, None)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        items = spark.createDataFrame([(1, "some benchmark passage that no document has in it at all")], "item_id long, text string")
        folder = str(tmp_path / f"t{len(part)}")
        items.write.parquet(f"{folder}/benchmark.parquet")
        for name, stage in pipeline.STAGES:
            path = scratch_dir(spark, name)
            stage(spark, docs, folder).write.parquet(path)
            docs = spark.read.parquet(path)
        assert {r.doc_id for r in docs.collect()} == ({3, None} if part else set())


LONG = {
    "open brackets": "<a " * 350_000,
    "a quote before the only end": "<a " * 300_000 + '">',
    "nested blocks": "<div>text" * 100_000,
    "end tags of nothing": "<div>" * 100_000 + "</p>" * 100_000,
    "end tags of an outer inline element": "<b><div>" + "<i>" * 120_000 + "</b>" * 120_000 + "x",
    "a long attribute": "<p " + "a" * 1_000_000 + ">x",
    "nested mains in noise": "<div class=sidebar>" + "<main>x " * 100_000,
    "nested menus": "<ul><li><a href=1>x</a>" * 40_000,
    "nested adverts": "<article><div class='ad'>x" * 40_000,
    "declarations": "<!" * 500_000,
    "one tag name": "<a" * 500_000 + " ",
}


@pytest.mark.parametrize("name", LONG)
def test_main_text_takes_linear_time(name):
    began = time.process_time()
    htmltext.main_text(LONG[name])
    assert time.process_time() - began < 15  # a page of 1 MB; the square of it would take an hour


def test_main_text_keeps_wrappers_beside_the_best_one():
    prose = "".join(f"<p>Words, and more words {i}, and commas, and so on, for as long as it takes to read.</p>" for i in range(6))
    page = f"<div id=page><div><div>{prose}</div></div><div><div>{prose.replace('Words', 'Others')}<span>bare</span></div></div></div>"
    got = htmltext.main_text(f"<nav><a href=1>n</a></nav>{page}<footer>f</footer>").split("\n")
    assert len(got) == 13 and got[0].startswith("Words") and got[6].startswith("Others") and got[-1] == "bare"


def test_main_text_keeps_formulas():
    assert htmltext.main_text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>") == "So x=1 holds."
