"""WARC derivatives: files read back record by record, links to the source, odd rows."""

import glob
import gzip
import hashlib
import re

from cohort_engine.llm.warc import derivatives, responses, write_records


def parse(data):
    """Records of a WARC file by their Content-Length, and nothing between them."""
    out, at = [], 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        block = data[head_end + 4:head_end + 4 + n]
        assert len(block) == n and data[head_end + 4 + n:head_end + 8 + n] == b"\r\n\r\n"
        out.append((head, block))
        at = head_end + 8 + n
    return out


def test_files_read_back(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = responses(pages)
    made = derivatives(source)
    write_records(made.repartition(3), str(tmp_path / "w"))
    records = [r for f in glob.glob(str(tmp_path / "w" / "part-*.gz")) for r in parse(gzip.open(f).read())]
    rows = made.collect()
    assert len(records) == len(rows) == 2 * pages.count()
    payloads = {r.record_id: r.payload for r in source.collect()}
    by_id = {r.record_id: r for r in rows}
    assert len(by_id) == len(rows)
    for head, block in records:
        r = by_id[head["WARC-Record-ID"]]
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", head["WARC-Record-ID"])
        assert head["WARC-Refers-To"] == r.refers_to and r.refers_to in payloads
        assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        source_digest = "sha256:" + hashlib.sha256(payloads[r.refers_to].encode()).hexdigest()
        if head["WARC-Type"] == "metadata":
            assert f"source-record: {r.refers_to}\r\n".encode() in block and f"source-payload-digest: {source_digest}\r\n".encode() in block
            assert b"source-header: HTTP/1.1 200 OK\r\nsource-header: Content-Type: text/html" in block
        else:
            assert b"<p>" not in block and r.source_digest == source_digest


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None, "x"), (2, "http://a/", "", "x"), (3, "http://b/", "a &amp;lt; b<p>c<br>d\r\n<script>no</script>", "x"),
                                (3, "http://b/", "a &amp;lt; b<p>c<br>d\r\n<script>no</script>", "x"), (4, "http://c/", "<p>z</p>" * 20_000, "x")],
                               "page_id long, url string, html string, block string")
    got = derivatives(responses(df)).where("warc_type = 'conversion'").collect()
    text = {r.page_id: r.block for r in got}
    assert len(got) == 5 and text[None] == "" and text[2] == "" and text[3] == "a &lt; b\nc\nd" and text[4].count("z") == 20_000
    assert len({r.record_id for r in got}) == 4
    assert derivatives(responses(df.limit(0))).count() == 0


def test_references_and_link_quotings(spark):
    page = """<head><title>It&#8217;s caf&eacute; &ndash; &#x27;x&#X27;&hellip;</title></head><p>a&nbsp;b&#160;c &amp;eacute; &mdash; &lt;b&gt; &#8364;5 &copy 1 &nope;
      <p><a class=x href='/single?a=1&amp;b=2'>s</a> <a href=/bare>u</a> <A HREF = "/space">v</A> <a data-href="/no" title="a b" href="/after">w</a>
      <a href="/p?a=1&copy=2&amp;lang=&eacute;">x</a> <a name=y>no</a> <abbr href="/no">n</abbr> <a href="">e</a>"""
    rows = derivatives(responses(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))).collect()
    block = {r.warc_type: r.block for r in rows}
    fields = block["metadata"].split("\r\n")
    assert "title: It’s café – 'x'…" in fields
    assert [x[9:] for x in fields if x.startswith("outlink: ")] == ["/single?a=1&b=2", "/bare", "/space", "/after", "/p?a=1&copy=2&lang=é", ""]
    assert block["conversion"] == "a b c &eacute; — <b> €5 © 1 &nope;\ns u v w\nx no n e"


def converted(spark, page):
    rows = derivatives(responses(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))).collect()
    block = {r.warc_type: r.block for r in rows}
    return block["conversion"], [x[9:] for x in block["metadata"].split("\r\n") if x.startswith("outlink: ")]


def test_no_text_is_lost_and_no_markup_kept(spark):
    assert converted(spark, "<p>if 1 < 2 then</p><p>second paragraph text</p><p>third <b>bold</b></p>")[0] == "if 1 < 2 then\nsecond paragraph text\nthird bold"
    assert converted(spark, '<p>x <img alt="a > b" src=x>text</p>')[0] == "x text"
    assert converted(spark, "<p>shown</p><script>var a = 1; if (a<b) {")[0] == "shown"
    assert converted(spark, "<p>shown</p><!-- never closed <a href='/c'>no</a>") == ("shown", [])
    text, links = converted(spark, """<!-- <a href="/comment">c</a> --><script>x = '<a href="/script">s</a>';</script><style>a[href="/style"]{}</style>
      <p><a href="/a?x=1>2">one</a> &lt;<a title='>' href=/b>two</a></p><template><a href="/t">t</a></template>""")
    assert text == "one <two" and links == ["/a?x=1>2", "/b"]
    assert converted(spark, "<title>A <b>title</b></title>a<br/>b<BR>c<td>d</td>e")[0] == "a\nb\nc\nd\ne"


def test_hostile_pages(spark):
    for page in ("<" * 50_000, "<a href='" * 20_000, "<p>" * 30_000 + "x", "&" * 50_000, "<script>" * 20_000):
        assert len(converted(spark, page)[1]) <= 1
