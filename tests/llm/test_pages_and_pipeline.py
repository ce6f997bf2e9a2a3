"""WARC archives, HTML extraction, the pipeline and the registry."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF
from kestrel.llm import html_extract, warc
from kestrel.llm.common import shared_folder

PAGE_SCHEMA = "page_id long, url string, html string, payload string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "p", "d") for i, u, h in rows], PAGE_SCHEMA)


BIG = "<p>" + "long text " * 200 + "</p>"
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2\r\nX: y%0A", BIG), (3, None, BIG), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", None), (7, "u", ""),
        (8, "u", "é" * 600), (None, "u", "nameless"), (9, "u", "x" * 300_000), (9, "u", "x" * 300_000)]


# ---------------------------------------------------------------- WARC

def test_archive_round_trip(spark):
    got = warc.archive_pages(pages(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append((r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
    for i, _, h in ROWS:
        raw = (h or "").encode()
        assert all(x[:2] == (len(raw), hashlib.sha1(raw).hexdigest()) for x in by[i])
    assert [by[i][0][2:] for i in (1, 2, 3)] == [("revisit", 3), ("revisit", 3), ("response", None)]
    assert by[4][0][2:] == by[5][0][2:] == ("response", None) and len(by[9]) == 2
    assert warc.archive_pages(pages(spark, ROWS).limit(0)).count() == 0


@pytest.mark.parametrize("split", [37, 1000, 1 << 20])
def test_every_record_is_read_once_whatever_the_splits(spark, split):
    rows = [(i, f"http://x/{i}", "".join(chr(97 + (i * k) % 26) for k in range(i * 13))) for i in range(60)]
    planned = warc.plan_records(pages(spark, rows).coalesce(2), "page_id", "url", "html", 100)
    manifest = warc.write_warc(planned, shared_folder(spark, "w"), roll_bytes=3000)
    got = warc.read_warc(manifest, split_bytes=split).collect()
    assert sorted(r.record_id for r in got) == sorted(f"<urn:page:{i}>" for i in range(60))
    assert {r.record_id: r.payload.decode() for r in got if r.payload is not None and r.record_type == "response"} == \
        {f"<urn:page:{i}>": h for i, _, h in rows}
    assert {r.url for r in got} == {u for _, u, _ in rows}


def test_text_ids_come_back_as_text(spark):
    rows = [("a>b", "u", "x" * 1500), ("page:7", "u", "x" * 1500), ("zé", "u", "short"), (None, "u", "other")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.archive_pages(df).collect()}
    assert got == {("a>b", "revisit", "page:7"), ("page:7", "response", None), ("zé", "response", None), (None, "response", None)}


def test_reader_ignores_magic_that_is_no_record(tmp_path):
    record = warc._member(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), 3, None, "2024-01-01T00:00:00Z", 4)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    other = z.compress(b"no record at all") + z.flush()
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"junk" + warc.MAGIC + b"\x00junk" + other + record + warc.MAGIC)
    found = list(warc.scan_range(f"file://{path}", 0, path.stat().st_size))
    assert [r["payload"] for r in found] == [b"abc"]


def test_damaged_payload_is_an_error():
    record = warc._member(1, "u", b"abc", "0" * 40, 3, None, "2024-01-01T00:00:00Z", 4)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(zlib.decompress(record, 31))


# ---------------------------------------------------------------- HTML

@pytest.fixture(scope="module")
def trees(spark):
    return html_extract.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def article(page):
    """What the synthetic pages' own markup states."""
    import html
    import re
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(x for x in lines if x)


def test_extracts_the_article_of_unseen_pages(spark, trees):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 1000 AND page_id < 1400")
    got = {r.page_id: r for r in html_extract.extract_pages(rows, trees).collect()}
    want = {r.page_id: article(r.html) for r in rows.collect()}
    assert sum(got[i].text == want[i] for i in want) >= 0.99 * len(want)
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_pages_without_stated_parts(trees):
    page = ('<html><body><div class="topbar"><a href=x>home</a></div><div id="content"><h1>Title here</h1><p>First paragraph of the text, with '
            'many words in it. It goes on &amp; on, for a while.</p><ul><li>one point</li><li>another point</li></ul></div>'
            '<div class="sidebar"><ul><li><a>x</a></li><li><a>y</a></li></ul></div><div class="cookie-notice">We use cookies</div>'
            '<form><label>Mail</label><input><button>Send</button></form><div class="comments"><p>Nice text, thanks.</p></div>'
            '<script>var a = "</p>";</script><div class="footer">Copyright</div>')
    text, = html_extract.extract([page], trees)
    assert text.startswith("Title here\nFirst paragraph") and "on & on, for a while." in text
    assert not any(x in text for x in ("home", "cookies", "Mail", "Nice", "Copyright", "var a"))


def test_awkward_pages(spark, trees):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "plain words only"), (4, "u", "<"), (5, "u", "<p><b>open <i>never closed"), (6, "u", "<div" * 2000),
            (7, "u", "<div>" * 3000 + "deep text here" + "</p>" * 50), (8, "u", "a &am"), (None, None, "<p>x</p>"), (9, "u", "<table><tr><td>1<td>2")]
    got = html_extract.extract_pages(pages(spark, rows), trees)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {r.page_id: r for r in got.collect()}
    assert len(by) == len(rows) and by[1].text == by[2].text == "" and by[3].text == "plain words only"
    assert html_extract.extract_pages(pages(spark, rows).limit(0), trees).count() == 0
    assert html_extract.train(pages(spark, rows).limit(0)) is None


def test_no_text_is_lost_and_deep_pages_are_read(trees):
    """Unknown and block-level elements in links, formulas, drawings, nesting."""
    import time
    plain = "This paragraph belongs to the article, it is long enough and has no links in it, as one would expect of it."
    page = ("<html><body><nav><a href=x>home</a></nav><article><p>See <a href=y><x-term>the term</x-term> <picture>shown</picture></a> and "
            "<math><mi>x</mi><mo>=</mo><mn>2</mn></math> here, <svg><text>label</text></svg> too. " + plain + "</p><ul><li><a><li>first</a><li>second</ul>"
            "<p>" + plain + "</p></article><footer><p>Copyright</p></footer></body></html>")
    text = html_extract.extract([page], trees)[0]
    assert "See the term shown and x=2 here, label too." in text and "second" in text and "Copyright" not in text
    root, nodes = html_extract.read_page(page)
    assert "first" in html_extract.page_text(root, html_extract.named_parts(nodes)).split("\n")
    deep = "<article>" + "<div>" * 1500 + "<p>deep words</p>" + "</div>" * 1500 + "</article>"
    assert html_extract.training_rows([deep, page], 1, 1) is not None            # no recursion limit
    times = []
    for n in (4000, 32000):
        began = time.process_time()
        root, nodes = html_extract.read_page("<table><p>" + "<center>x" * n)
        times.append(time.process_time() - began)
        assert len(nodes) == n + 3 or len(nodes) == n + 2
    assert times[1] < 32 * max(times[0], 0.01)                                    # in proportion, not its square


def test_pages_without_a_stated_article_teach_by_other_signs():
    import numpy as np
    long = "A long paragraph of the story that goes on for a while so that it counts as one, with several words more in it."
    page = "<div class=menu><a href=x>home</a><a href=y>news</a></div><div><p>%s</p><p>%s</p></div><div class=footer><p>Copyright</p></div><form><p>%s</p></form>"
    pages = [page % (f"{i} {long}", long[:90 + i], long) for i in range(60)]
    data = html_extract.training_rows(pages, 2, 1)
    assert data is not None and set(data[1].tolist()) == {0.0, 1.0}
    text = html_extract.extract(pages[:1], html_extract.Trees.fit(*data, rounds=40, depth=3))[0]
    assert text == f"0 {long}\n{long[:90]}"
    root, nodes = html_extract.read_page(pages[0])
    assert html_extract.page_text(root, html_extract.named_parts(nodes)) == text and np.all(html_extract.named_parts(nodes)[:1])


def test_decoding_never_keeps_below_a_dropped_parent(trees):
    root, nodes = html_extract.read_page("<div><div><p>a</p></div><p>b</p></div><div><p>c</p></div>")
    import numpy as np
    keep = html_extract.decode(nodes, np.array([0, -1, -5, 3, 2, -9, 4], float))
    assert keep.tolist() == [True, True, False, False, True, False, False]


def test_trees_learn_from_distinct_pages_at_any_size(spark, monkeypatch):
    """Copies of one page hold most of the rows: the sample still has as many pages as asked for."""
    taught = []
    monkeypatch.setattr(html_extract, "training_rows", lambda found, copies, seed: taught.append(found))
    some = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").where("length(html) <= 20000")
    first = some.orderBy(F.xxhash64("html")).limit(1)
    many = some.unionByName(first.crossJoin(spark.range(2000).select()))
    with pytest.warns(UserWarning, match="all visible text"):
        html_extract.train(many, sample=40)
    assert len(taught[0]) == len(set(taught[0])) == 40
    want = {r.html for r in some.select("html").distinct().orderBy(F.xxhash64("html")).limit(40).collect()}
    assert set(taught[0]) == want


def test_pages_that_teach_nothing_are_reported(spark):
    with pytest.warns(UserWarning, match="all visible text"):
        assert html_extract.train(pages(spark, [(1, "u", "<p>" + "x" * 30_000)])) is None


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline
    base = " ".join(f"word{i}" for i in range(300))
    bench = " ".join(f"item{i}" for i in range(30))
    rows = [(1, "English words and the text of it " * 5), (2, "english WORDS and the text of it " * 5), (3, "1234 %% !!"), (4, None), (5, base),
            (6, base + " more"), (7, "some text before " + bench + " and after"), (8, "Ein Satz und der Text von ihm"), (8, "Ein Satz und der Text von ihm")]
    docs = spark.createDataFrame([(i, t, "de" if i == 8 else "en", "src", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    folder = shared_folder(spark, "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == [2, 5, 8] and all(r.round_trip for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "decontaminate", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), folder).count() == 0


def test_pipeline_equals_brute_force_on_the_given_table(spark):
    from test_dedup_ops import brute_components, brute_contained, plain_fingerprint
    import corpus_pipeline
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    last = {}
    for i, t in docs.items():
        last[t.translate({c: c + 32 for c in range(65, 91)})] = max(i, last.get(t.translate({c: c + 32 for c in range(65, 91)}), -1))
    kept = {i: docs[i] for i in last.values()}
    roots = brute_components({i: plain_fingerprint(t, 4) for i, t in kept.items()}, 4)
    kept = {i: t for i, t in kept.items() if roots[i] == i}
    leaked = {d for d, *_ in brute_contained(list(kept.items()), items)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(kept) - leaked and all(r.round_trip for r in got)


def test_registry_names_every_operator():
    from __spark_entry__ import oracle_sql, queries
    names = queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert {"op4_exact_dedup", "op6_warc", "op10_decontaminate", "op12_hard_negatives", "op13_lexical_search"} <= set(oracle_sql())
