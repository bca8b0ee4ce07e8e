"""WARC derivatives: metadata and plain-text conversion records of archived responses.

Every response gets two derivative records.  The ``metadata`` record keeps the source's
headers and digest, its title and its outlinks as ``application/warc-fields``; the
``conversion`` record holds the page's plain text.  Character references are decoded in text, title and
outlinks; links are read in every attribute quoting.  Both refer to the response by its
record id, carry a digest of their own block, and keep the target URI and date.  Record
ids are derived from their content, so a retried task writes the same records.

Text, title and links come from one scan of the page's tags (the one of ``html_text``): a
bare ``<`` is text, quoted ``>`` belong to their attribute, and comments, scripts, styles
and templates hold neither text nor links, also where they never end.

``write_records`` writes them as WARC/1.1 files with Spark's text writer: two CRLFs end
a WARC record, which is what the writer puts after every row.

Defined results: a NULL or empty payload gives a conversion record of zero bytes and a
metadata record without title or links; NULL URIs are written as empty; repeated rows
give equal records; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import prepare, table
from cohort_engine.llm.html_text import ATTRIBUTE, NAME, TOKEN

CRLF = "\r\n"
CAPTURED = "2024-01-01T00:00:00Z"        # capture date of tables that hold none
#: Elements that start and end a line of the conversion (fixed values).
LINES = frozenset("address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre "
                  "section table td th tr ul".split())
#: Elements whose contents are no text of the page (fixed values); a title is read for the metadata.
SILENT = frozenset("script style title template iframe noembed noframes".split())


def urn(*parts: Column) -> Column:
    """A record id that depends on ``parts`` alone."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)")
def decoded(text: str) -> str:
    """Text with its character references read; a no-break space counts as a space."""
    return REFERENCE.sub(lambda m: unescape(m[0]).replace("\xa0", " "), text) if "&" in text else text


def decoded_value(value: str) -> str:
    """An attribute's value; there a name without its semicolon is a reference only if no ``=`` follows."""
    def one(m: re.Match) -> str:
        name = m[0][1:]
        if name[0] != "#" and (name not in html5 or name[-1] != ";" and value[m.end():m.end() + 1] == "="):
            return m[0]
        return unescape(m[0])

    return REFERENCE.sub(one, value) if "&" in value else value


def link_target(tag: str) -> str | None:
    """The target of an ``a`` tag, if it has one."""
    for m in ATTRIBUTE.finditer(tag, 2):
        if m[1].lower() == "href":
            value = next((x for x in m.groups()[1:] if x is not None), None)
            return None if value is None else re.sub(r"[\t\r\n]", "", decoded_value(value)).strip()
    return None


def read_one(page: str) -> tuple[str, str, list[str]]:
    """Title, text lines and link targets of a page."""
    parts: list[str] = []
    links: list[str] = []
    title, in_head, at, end = None, False, 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not in_head:
            parts.append(page[at:m.start() if m else end])
        if not m:
            break
        at, tag = m.end(), m[0]
        name_m = NAME.match(tag)
        if not name_m:
            continue
        name, closing = name_m[1].lower(), tag[1] == "/"
        if name in SILENT:
            if not closing:
                close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
                if name == "title" and title is None:
                    title = page[at:close.start() if close else end]
                at = close.end() if close else end
                parts.append(" ")
        elif name == "head":
            in_head = not closing
            parts.append(" ")
        elif name == "a" and not closing and (target := link_target(tag)) is not None:
            links.append(target)
        if name in LINES:
            in_head = in_head and name != "body"
            parts.append("\n")
    text = re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\r\f]+", " ", decoded("".join(parts)))).strip(" \n")
    return re.sub(r"[ \t\r\n\f]+", " ", decoded(title or "")).strip(" "), text, links


def read_page(page: pd.Series) -> pd.DataFrame:
    read = [read_one(p) for p in page]
    return pd.DataFrame({"title": [t for t, _, _ in read], "text": [t for _, t, _ in read],
                         "links": ["".join(f"outlink: {u}{CRLF}" for u in links) for _, _, links in read]})


def responses(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """Response records of a page table."""
    page, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(page).cast("string"))
    return pages.select("page_id", urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url).alias("record_id"),
                        url.alias("target_uri"), F.lit(captured).alias("warc_date"), http.alias("http_headers"), page.alias("payload"))


def derivatives(source: DataFrame) -> DataFrame:
    """The metadata and conversion record of every response (``record_id, target_uri, warc_date, http_headers, payload``)."""
    headers = F.concat(F.lit("source-header: "), F.replace("http_headers", F.lit(CRLF), F.lit(f"{CRLF}source-header: ")), F.lit(CRLF))
    fields = F.concat(F.lit("source-record: "), F.col("record_id"), F.lit(f"{CRLF}source-payload-digest: "), digest(F.col("payload")),
                      F.lit(CRLF), headers, F.lit("title: "), F.col("read.title"), F.lit(CRLF), F.col("read.links"))
    both = F.array(F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
                   F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                            F.col("read.text").alias("block")))
    read = source.withColumn("read", F.pandas_udf(read_page, "title string, text string, links string")("payload"))
    made = read.withColumn("source_digest", digest(F.col("payload"))).withColumn("made", F.explode(both)).select("*", "made.*")
    return made.select("page_id", "warc_type", urn(F.col("warc_type"), F.col("record_id")).alias("record_id"),
                       F.col("record_id").alias("refers_to"), "target_uri", "warc_date", "content_type",
                       F.octet_length("block").cast("long").alias("content_length"), digest(F.col("block")).alias("block_digest"),
                       "source_digest", "block")


def record_text(r: DataFrame) -> Column:
    """A whole record, but for the two CRLFs that end it."""
    lines = (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
             ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"))
    head = [F.concat(F.lit(f"{name}: "), r[column].cast("string"), F.lit(CRLF)) for name, column in lines]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *head, F.lit(CRLF), r["block"])


def write_records(records: DataFrame, path: str) -> None:
    """The records as gzip-compressed WARC files, one for each partition."""
    records.select(record_text(records).alias("record")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return derivatives(responses(table(spark, sf_dir, "pages")))


#: The SQL twin is written with patterns, on another principle than the scan, and reads plainly written pages alone:
#: tags without quoted ``>``, eight references, double-quoted links.
DROPPED = r"(?is)<!--.*?-->|<head\b.*?</head\s*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BREAKS = rf"(?i)</?(?:{'|'.join(sorted(LINES))})\b[^>]*>"
TAGS = r"<[^>]*>"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
TITLE = r"(?is)<title\b[^>]*>([^<]*)"
LINK = r'(?i)<a\b[^>]*?href="([^"]*)"'


def _sql_decoded(text: str) -> str:
    for a, b in ENTITIES:
        text = "replace({}, '{}', '{}')".format(text, a, b.replace("'", "''"))
    return text


def _sql_urn(*parts: str) -> str:
    h = f"md5(concat_ws('|', {', '.join(parts)}))"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


_LINES = _sql_decoded(f"regexp_replace(regexp_replace(regexp_replace(payload, '{DROPPED}', ' ', 'g'), '{BREAKS}', chr(10), 'g'), '{TAGS}', '', 'g')")
ORACLE_SQL = f"""
WITH src AS (
  SELECT page_id, {_sql_urn("'response'", "coalesce(CAST(page_id AS VARCHAR), '')", "coalesce(url, '')")} AS record_id, coalesce(url, '') AS target_uri,
         coalesce(html, '') AS payload FROM pages),
made AS (
  SELECT page_id, record_id, target_uri, payload, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
         'source-record: ' || record_id || chr(13) || chr(10) || 'source-payload-digest: sha256:' || sha256(payload) || chr(13) || chr(10)
         || 'source-header: HTTP/1.1 200 OK' || chr(13) || chr(10) || 'source-header: Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
         || 'source-header: Content-Length: ' || strlen(payload) || chr(13) || chr(10)
         || 'title: ' || trim(regexp_replace({_sql_decoded(f"regexp_extract(payload, '{TITLE}', 1)")}, '[ \\t\\r\\n\\f]+', ' ', 'g')) || chr(13) || chr(10)
         || coalesce(array_to_string([('outlink: ' || u || chr(13) || chr(10)) for u in regexp_extract_all(payload, '{LINK}', 1)], ''), '') AS block
  FROM src
  UNION ALL
  SELECT page_id, record_id, target_uri, payload, 'conversion', 'text/plain; charset=utf-8',
         regexp_replace(regexp_replace(regexp_replace({_LINES}, '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g') FROM src)
SELECT page_id, warc_type, {_sql_urn("warc_type", "record_id")} AS record_id, record_id AS refers_to, target_uri, '{CAPTURED}' AS warc_date, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, 'sha256:' || sha256(payload) AS source_digest, block
FROM made
"""
