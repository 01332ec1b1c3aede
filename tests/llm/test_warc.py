import glob
import gzip
import json
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from shelfspark.llm import markup, warc

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><meta name="author" content="x&lt;y"></head><body>'
    "<script>var a = '<p>no</p>';</script><h1>Head</h1><p>One &eacute; <b>bold</b><br>two</p><!-- gone -->"
    '<a href="/x?a=1&amp;b=2">link</a><a href=plain>p</a></body></html>'
)


def pages(spark):
    rows = [(1, "http://a.example/", PAGE, "x"), (2, None, None, "x"), (3, "http://b\r\nX: y", "", "x"), (None, "http://c", "<p>text", "x"), (1, "http://a.example/", PAGE, "x")]
    rows.append((4, "http://long", "<p>" + "word " * 200_000 + "</p>", "x"))
    return spark.createDataFrame(rows, "page_id long, url string, html string, block string")


def test_derivatives(spark):
    made = warc.responses(pages(spark))
    responses = {r.record_id: r for r in made.collect()}
    rows = warc.derivatives(made).collect()
    assert len(rows) == 12
    for r in rows:
        source = responses[r.refers_to]
        assert (r.target_uri, r.date, r.payload_digest) == (source.target_uri, source.date, source.payload_digest)
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        assert f"WARC-Refers-To: {source.record_id}" in r.headers and "X: y\r\n" not in r.headers.replace("http://b X: y", "")
    text = next(r for r in rows if r.page_id == 1 and r.warc_type == "conversion").block
    assert text == "Head\nOne é bold\ntwo\nlinkp"
    meta = json.loads(next(r for r in rows if r.page_id == 1 and r.warc_type == "metadata").block)
    assert meta["html"] == {"title": "A & B", "lang": "en", "metas": [{"name": "author", "content": "x<y"}], "links": ["/x?a=1&b=2", "plain"]}
    assert meta["http"]["status"] == "HTTP/1.1 200 OK"
    assert meta["warc"]["block_digest"] == responses[meta["warc"]["record_id"]].block_digest
    assert meta["http"]["headers"] == [["Content-Type", "text/html; charset=utf-8"], ["Content-Length", str(len(PAGE.encode()))]]
    # Repeated rows give equal records; another run gives the same ones.
    again = warc.derivatives(warc.responses(pages(spark))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert len({r.record_id for r in rows}) == 10


def test_payload_digest_is_of_the_page(spark):
    for r in warc.responses(pages(spark)).where("page_id = 1").collect():
        assert r.payload_digest == warc.digest(PAGE.encode())
        assert r.block.endswith("\r\n\r\n" + PAGE)


def test_files(spark, tmp_path):
    made = warc.derivatives(warc.responses(pages(spark)))
    warc.write_warc(made, f"{tmp_path}/out")
    read = []
    for name in glob.glob(f"{tmp_path}/out/*.gz"):
        with gzip.open(name) as f:
            data = f.read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
            block = data[end + 4 : end + 4 + int(head["Content-Length"])]
            assert head["WARC-Block-Digest"] == warc.digest(block)
            at = end + 4 + len(block)
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
            read.append((head["WARC-Record-ID"], head["WARC-Type"], block.decode()))
    assert sorted(read) == sorted((r.record_id, r.warc_type, r.block) for r in made.collect())


class Plain(HTMLParser):
    """Another parser, for well-formed pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden, self.title = [], 0, None
        self.found = {"title": None, "lang": None, "metas": [], "links": []}

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        self.hidden += tag in markup.HIDDEN
        self.title = [] if tag == "title" else self.title
        if tag == "html":
            self.found["lang"] = own.get("lang")
        if tag == "meta" and "name" in own and "content" in own:
            self.found["metas"].append({"name": own["name"], "content": own["content"]})
        if tag == "a" and "href" in own:
            self.found["links"].append(own["href"])
        self.out.append("\n" if tag in markup.BLOCKS else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in markup.HIDDEN
        if tag == "title":
            self.found["title"] = " ".join("".join(self.title).split())
            self.title = None
        self.out.append(" " if tag in markup.HIDDEN else "\n" if tag in markup.BLOCKS else "")

    def handle_data(self, data):
        if self.title is not None:
            self.title.append(data)
        if not self.hidden:
            self.out.append(data)

    def handle_comment(self, data):
        self.out.append("" if self.hidden else " ")

    def text(self):
        lines = (" ".join(x.split()) for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)


def test_against_another_parser(spark):
    given = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    for page in [PAGE, PAGE * 3, *given]:
        other = Plain()
        other.feed(page)
        other.close()
        assert warc.plain_text(page) == other.text()
        if page.lower().count("<title") < 2:
            assert warc.facts(page) == other.found


def test_long_and_unclosed_markup_takes_linear_time():
    for unit in ("<meta name=a ", "<meta name=a content=", "<script>", "<!--", "<", "<a href='", '<a href="x', "<html lang ", "<head", "</script", "<p <", "a = ' b "):
        page = unit * (1_000_000 // len(unit))
        began = time.perf_counter()
        warc.plain_text(page), warc.facts(page), markup.bare_text(page)
        assert time.perf_counter() - began < 5, unit
    assert warc.plain_text("a < b <i>c</i> <p x<y>d<script>e <!-- f") == "a < b c\nde <!-- f"
    assert warc.facts('<META content="a > b" NAME=x><a data-href=no href=yes><!-- <a href=no> -->')["metas"] == [{"name": "x", "content": "a > b"}]
    assert warc.facts("<a data-href=no href=yes><!-- <a href=no> -->")["links"] == ["yes"]


def test_repeated_headers_and_odd_rows(spark):
    made = warc.responses(pages(spark)).where("page_id = 1").limit(1)
    block = F.lit("HTTP/1.1 200 OK\r\nSet-Cookie: a\r\nSet-Cookie: b\r\n\r\n<p>x")
    meta = [json.loads(r.block) for r in warc.derivatives(made.withColumn("block", block)).collect() if r.warc_type == "metadata"]
    assert meta[0]["http"]["headers"] == [["Set-Cookie", "a"], ["Set-Cookie", "b"]]
    rows = [(None, None, None), (1, "", " \n"), (2, "http://x", "no markup \u0130 at all"), (3, "u", "<meta " * 1000)]
    got = warc.derivatives(warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    texts = {r.page_id: r.block for r in got if r.warc_type == "conversion"}
    assert len(got) == 8 and texts[None] == texts[1] == "" and texts[2] == "no markup \u0130 at all"


def test_empty(spark):
    assert warc.derivatives(warc.responses(pages(spark).where("false"))).count() == 0
