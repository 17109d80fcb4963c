"""Web pages: archives written, normalised and read back; main text extracted."""

import gzip
import hashlib
import io
import json
import zlib

import pytest
from pyspark.sql import functions as F

from riskspark.llm import html_extract, warc
from riskspark.llm.common import filesystem, new_folder, table, uri
from riskspark.llm.layouts import compose
from riskspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def messy_pages(spark):
    long = "<article><p>" + "Prose, and more of it. " * 9000 + "</p></article>"
    rows = [
        (1, "http://a", None), (2, None, ""), (3, "u\r\nWARC-Type: x", "<p>\r\n\r\nWARC/1.1\r\n\r\nx"), (4, "é", "<p>日本</p>" * 200),
        (5, "u", long), (6, "u", long), (7, "u", long), (7, "u", long), (6, "u", long), (None, "u", long), (8, "u", "same"), (9, "u", "same"),
        (None, None, None), (10, "u", "x" * 1000), (11, "u", "x" * 1000), (12, "u", "x" * 999), (13, "u", "x" * 999), (14, "u", "a\x00b<"),
    ]
    names = "digest payload largest path records text n_chars html_ label".split()
    schema = "page_id long, url string, html string" + "".join(f", {c} int" for c in names)
    return spark.createDataFrame([(*r, *range(len(names))) for r in rows], schema)


def test_warc_equals_its_sql(spark, duck):
    got = sorted(map(tuple, QUERIES["op5_warc"](spark, SF).collect()))
    assert got == sorted(duck.execute(ORACLES["op5_warc"]).fetchall())


@pytest.mark.parametrize("size", [32 << 20, 3000])
def test_warc_round_trip(spark, monkeypatch, size):
    pages = messy_pages(spark).repartition(3)
    raw, own = new_folder(spark, "raw"), new_folder(spark, "own")
    written = warc.write(pages, raw, size)
    done = warc.normalise(written, own)
    got = sorted((repr(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, repr(r.refers_to)) for r in warc.read(done).collect())
    body = lambda r: (r.html or "").encode()
    rows = pages.collect()
    largest = {}
    for r in rows:
        if r.page_id is not None:
            largest[body(r)] = max(largest.get(body(r), r.page_id), r.page_id)
    want = []
    for r in rows:
        refers = largest.get(body(r)) if len(body(r)) >= 1000 and r.page_id != largest.get(body(r)) else None
        want.append((repr(r.page_id), len(body(r)), hashlib.sha1(body(r)).hexdigest(), "response" if refers is None else "revisit", repr(refers)))
    assert got == sorted(want)
    # the archives themselves: one stream as written, a member per record as rewritten, the index by heart
    for r in written.collect():
        fs, at = filesystem(r.path)
        data = fs.open_input_stream(at, compression=None).read()
        engine = zlib.decompressobj(31)
        assert engine.decompress(data).count(b"WARC/1.1\r\nWARC-Type") >= r.records and not engine.unused_data
    for r in done.collect():
        fs, at = filesystem(r.path)
        data = fs.open_input_stream(at, compression=None).read()
        fs, at = filesystem(r.index_path)
        index = [json.loads(x) for x in fs.open_input_stream(at, compression=None).read().decode().splitlines()]
        assert len(index) == r.records and sum(x["length"] for x in index) == len(data)
        for x in index:
            alone = gzip.decompress(data[x["offset"] : x["offset"] + x["length"]])
            assert alone.startswith(b"WARC/1.1\r\n") and alone.endswith(b"\r\n\r\n")
            assert warc.headers(alone)["warc-record-id"] == x["id"]
        assert list(warc.records(io.BytesIO(data))) == [gzip.decompress(data[x["offset"] : x["offset"] + x["length"]]) for x in index]


def test_a_second_attempt_leaves_the_first_ones_archives(spark):
    pages = messy_pages(spark).coalesce(1)
    raw, sizes = new_folder(spark, "raw"), (3000, 2000)
    first, second = (warc.write(pages.orderBy(order), raw, size) for order, size in zip((F.asc("page_id"), F.desc("page_id")), sizes))
    want = sorted(repr(r.page_id) for r in pages.collect())
    for k, written in enumerate((first, second)):
        got = warc.read(warc.normalise(written, new_folder(spark, f"own{k}"))).collect()
        assert sorted(repr(r.page_id) for r in got) == want
    assert not first.join(second, "path").count()


def test_warc_of_nothing(spark):
    assert warc.round_trip(messy_pages(spark).limit(0)).isEmpty()


def test_damaged_archives_are_refused():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse(data)["page_id"] == 1
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(data.replace(b"payload\r\n", b"pailoyd\r\n"))
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records(io.BytesIO(gzip.compress(data[:-9]))))
    assert uri is not None


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.fit(table(spark, SF, "pages"))


def test_extraction_of_the_whole_table(spark):
    """In the given pages the article element holds the text; its blocks, one per line."""
    import html
    import re

    rows = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    got = QUERIES["op2_html_extract"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(rows)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", rows[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


def test_extraction_of_other_layouts(model):
    """Composed pages that the fit has not seen."""
    right = 0
    pages = compose(120, ["Some words of prose, that go on for a while and then end."], seed=99)
    for source, text in zip(pages, html_extract.extract(pages, model), strict=True):
        page = html_extract.Page(source)
        inside, out, want = [], [], []
        for k, t in enumerate(page.text):
            up = page.parent[k]
            inside.append("xanswer" in page.tokens[k] or (up >= 0 and inside[up]))
            out.append("xnoise" in page.tokens[k] or (up >= 0 and out[up]))
            if t and inside[k] and not out[k]:
                want.append(t)
        right += text == "\n".join(want)
    assert right >= 114


PAGES = [
    ("<article><p>Main text here, with enough words to read.<p>Second &amp; &lt;last&gt;&nbsp;part</article><footer>f</footer>",
     "Main text here, with enough words to read.\nSecond & <last> part"),
    ("<nav><a href=x>Menu</a></nav><article><h1>Title  of\n it</h1><div class=ad>Buy now, friends, buy now.</div><p>One <b>bold</b> word.</p></article>",
     "Title of it\nOne bold word."),
    ("<body><article><p>Text, before the script.<script>var a='<p>no</p>'</script></p><style>x</style></article><div id='comments'><p>I, too, think so, reader.</p></div>",
     "Text, before the script."),
    ("<article><!-- <p>gone</p> --><p>Here it is, all of it.</p></article><form><p>Your mail, please, here</p></form>", "Here it is, all of it."),
    ("", ""), ("<nav><ul><li><a href=/>only</a></li></ul></nav>", ""),
]


@pytest.mark.parametrize(("source", "want"), PAGES)
def test_extraction_of_small_pages(model, source, want):
    assert html_extract.extract([source], model) == [want]


@pytest.mark.parametrize("source", ["<", "<p", "<p class='", "</", "<!--", "<!doctype", "&#xZZ; &bogus; &#0;", "<script>", "<p>" * 500, "<div>" * 3000 + "x", "</p></div>x", "<a <b>c</a>", "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "<table><tr><td>a<td>b<tr><td>c</table>"])
def test_broken_markup(model, source):
    text = html_extract.extract([source, source * 2], model)
    assert len(text) == 2 and all("\n\n" not in t and t == t.strip() for t in text)


def test_decoding_never_contradicts_itself():
    import numpy as np

    r = np.random.default_rng(3)
    for _ in range(50):
        n = int(r.integers(1, 9))
        parent = np.array([0] + [int(r.integers(0, k)) for k in range(1, n)])
        odds = r.normal(0, 2, n)
        taken = html_extract.decode(odds, parent, None)
        valid = [m for m in range(1 << n) if m & 1 and all(m >> parent[k] & 1 for k in range(n) if m >> k & 1)]
        best = max(valid, key=lambda m: sum(odds[k] for k in range(n) if m >> k & 1))
        assert [bool(best >> k & 1) for k in range(n)] == taken.tolist()


def test_extraction_of_awkward_rows(spark, model):
    pages = messy_pages(spark)
    got = html_extract.main_text(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == pages.count()
    assert all(r.text == "" and r.n_chars == 0 for r in got.where("page_id in (1, 2)").collect())
    assert {r.text for r in got.where("page_id in (5, 6, 7)").collect()} == {("Prose, and more of it. " * 9000).strip()}
    empty = pages.limit(0)
    assert html_extract.main_text(empty, html_extract.fit(empty)).isEmpty()
