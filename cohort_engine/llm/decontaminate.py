"""Benchmark decontamination by a distributed positional inverted index.

Words are runs of ASCII digits, ASCII letters (lower-cased) and characters beyond ASCII.
A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window.

1. Test terms: all words of the benchmark.  How often the corpus holds each is counted
   over all documents (one exploding scan, counted map-side).
2. Anchors: in every window the two rarest positions.  Every occurrence of a window holds
   both, so their posting lists are enough to find it.
3. Index: the postings (term, document, position) of the anchor terms, from all
   documents, written to the shared folder.
4. Intersection: a posting's position less the anchor's position in the item is the
   alignment the occurrence would have; alignments of one document and item supported by
   fewer than two anchors (one for items of a single word) drop out.
5. Only the surviving documents are read again; the item is laid over the document at its
   alignment and every window that matches word for word is an exact phrase match.
   ``slack`` > 0 also reports proximity matches: all words of a window within a span at
   most ``slack`` words longer than the window.

Test terms and anchors are broadcast when counted to be at most ``BROADCAST_ROWS`` rows of
words no longer than ``BROADCAST_CHARS`` (else joined by shuffle, which AQE splits).
Everything is DataFrame code.

Defined results: NULL and wordless texts have no words, hits or windows; repeated rows
of a table give one equal row each; rows are searched by id and text together, so a row
without id is searched like any other and rows that share an id do not share hits; an item
without id counts its hit words but is no named item; an empty benchmark
leaves every document clean; an empty corpus gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_engine.llm.common import lower_ascii, prepare, table

WINDOW = 10
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 10_000_000


def words(text: Column) -> Column:
    """The words of a text, in order (NULL: none)."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATOR)
    return F.filter(parts, lambda w: w != F.lit(""))


def word_array(text: Column) -> Column:
    """As ``words``, but cheaper to explode: only the first and last part can be empty."""
    return F.split(F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATOR, " ")), " ")


def bounded(df: DataFrame, chars: str | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small, as it is otherwise."""
    size = df.agg(F.count("*").alias("n"), (F.sum(F.length(chars)) if chars else F.lit(0)).alias("c")).first()
    return F.broadcast(df) if size["n"] <= BROADCAST_ROWS and (size["c"] or 0) <= BROADCAST_CHARS else df


def benchmark_items(bench: DataFrame, window: int) -> DataFrame:
    """Distinct (item_id, words) with at least one word, and the length of their windows."""
    return (bench.select("item_id", words(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
            .distinct().withColumn("item_key", F.xxhash64("item_id", "item_words"))
            .withColumn("w", F.least(F.size("item_words"), F.lit(window))))


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often all documents hold each test term (0 included)."""
    held = (docs.select(F.explode(word_array(F.col("text"))).alias("term"))
            .join(bounded(terms, "term"), "term").groupBy("term").agg(F.count("*").alias("n")))
    return terms.join(held, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def choose_anchors(items: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(item_key, ipos, term): the two rarest positions of every window, where each can occur."""
    at = (items.select("item_key", "w", F.size("item_words").alias("size"), F.posexplode("item_words").alias("ipos", "term"))
          .join(frequencies, "term"))
    first, last = F.greatest(F.lit(0), F.col("ipos") - F.col("w") + 1), F.least(F.col("ipos"), F.col("size") - F.col("w"))
    inside = at.withColumn("start", F.explode(F.sequence(first, last)))
    order = Window.partitionBy("item_key", "start").orderBy("n", "ipos")
    possible = F.min("n").over(Window.partitionBy("item_key", "start")) > 0
    return (inside.withColumn("k", F.row_number().over(order)).withColumn("possible", possible)
            .where((F.col("k") <= 2) & F.col("possible")).select("item_key", "ipos", "term").distinct())


def posting_index(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Postings (term, doc_id, pos) of the anchor terms in all documents, in the shared folder."""
    terms = anchors.select("term").distinct()
    return (docs.select("doc_id", F.posexplode(word_array(F.col("text"))).alias("pos", "term"))
            .join(bounded(terms, "term"), "term").select("term", "doc_id", "pos").checkpoint())


def alignments(index: DataFrame, anchors: DataFrame, items: DataFrame, slack: int = 0) -> DataFrame:
    """(doc_id, item_key, shift): where the lists of the rarest terms agree on a place."""
    lists = (index.join(bounded(anchors, "term"), "term")
             .select("doc_id", "item_key", (F.col("pos") - F.col("ipos")).alias("shift"), "ipos"))
    need = items.select("item_key", F.least(F.lit(2), "w").alias("need"))
    if slack == 0:
        agreed = lists.groupBy("doc_id", "item_key", "shift").agg(F.count_distinct("ipos").alias("support"))
    else:
        near = Window.partitionBy("doc_id", "item_key").orderBy("shift").rangeBetween(0, slack)
        agreed = (lists.withColumn("support", F.size(F.collect_set("ipos").over(near)))
                  .groupBy("doc_id", "item_key", "shift").agg(F.max("support").alias("support")))
    return agreed.join(bounded(need), "item_key").where("support >= need").select("doc_id", "item_key", "shift")


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """(doc_id, item_id, doc_pos, length, kind): every window occurrence, ``phrase`` or ``proximity``."""
    items = benchmark_items(bench.select("item_id", "text"), window).checkpoint()
    terms = items.select(F.explode("item_words").alias("term")).distinct()
    anchors = choose_anchors(items, term_frequencies(docs, terms)).checkpoint()
    found = (alignments(posting_index(docs, anchors), anchors, items, slack)
             .groupBy("doc_id").agg(F.collect_list(F.struct("item_key", "shift")).alias("found")).checkpoint())
    sized = found.agg(F.count("*").alias("n")).first()["n"]
    ids = found.select("doc_id")
    again = docs.select("doc_id", "text").join(F.broadcast(ids) if sized <= BROADCAST_ROWS else ids, "doc_id", "left_semi")
    again = again.dropDuplicates(["doc_id"])             # equal rows share a key; only rows with candidates are dealt out
    laid = (again.select("doc_id", words(F.col("text")).alias("doc_words")).join(found, "doc_id")
            .select("doc_id", "doc_words", F.inline("found")).join(items, "item_key"))
    fits = F.transform("item_words", lambda word, j: F.get("doc_words", F.col("shift") + j) == word)
    starts = F.sequence(F.lit(0), F.size("item_words") - F.col("w"))
    whole = F.filter(starts, lambda s: F.forall(F.slice("fits", s + 1, F.col("w")), lambda x: F.coalesce(x, F.lit(False))))
    phrase = (laid.withColumn("fits", fits).select("doc_id", "item_id", "w", F.explode(whole).alias("s"), "shift")
              .select("doc_id", "item_id", (F.col("shift") + F.col("s")).alias("doc_pos"), F.col("w").alias("length"),
                      F.lit("phrase").alias("kind")))
    if slack == 0:
        return phrase
    lo = F.greatest(F.lit(0), F.col("shift") + F.col("s"))
    span = F.slice("doc_words", lo + 1, F.greatest(F.lit(0), F.col("w") + slack + F.least(F.lit(0), F.col("shift") + F.col("s"))))
    near = (laid.withColumn("s", F.explode(starts)).withColumn("span", span)
            .where(F.size(F.array_except(F.slice("item_words", F.col("s") + 1, F.col("w")), "span")) == 0)
            .select("doc_id", "item_id", lo.alias("doc_pos"), F.col("w").alias("length"), F.lit("proximity").alias("kind")))
    seen = phrase.select("doc_id", "item_id").distinct()
    return phrase.unionByName(near.distinct().join(seen, ["doc_id", "item_id"], "left_anti"))


def row_key(docs: DataFrame) -> Column:
    """128 bits of a row's id and text: two independent 64-bit hashes."""
    return F.struct(*(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).alias(f"k{seed}") for seed in (1, 2)))


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: words, hit words, items with occurring windows; and the columns to ``carry`` along.

    Rows are told apart by id and text, not by the id alone."""
    rows = docs.select("doc_id", "text", *carry).withColumn("_key", row_key(docs))
    found = matches(rows.select(F.col("_key").alias("doc_id"), "text"), bench, window).withColumnRenamed("doc_id", "_key").checkpoint()
    hit_words = (found.select("_key", F.explode(F.sequence(F.col("doc_pos"), F.col("doc_pos") + F.col("length") - 1)).alias("pos"))
                 .distinct().groupBy("_key").agg(F.count("*").alias("n_hit")))
    hit_items = (found.select("_key", F.col("item_id").cast("string").alias("item")).distinct()
                 .groupBy("_key").agg(F.array_sort(F.collect_list("item")).alias("items")))
    hits = hit_words.join(hit_items, "_key")
    return (rows.select("doc_id", "_key", F.size(words(F.col("text"))).cast("long").alias("n_words"), *carry)
            .join(hits, "_key", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), *carry))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Brute force: every window of every item against every position of every document.
ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT item_id, least(len(ws), 10) AS w, list_slice(ws, s + 1, s + least(len(ws), 10)) AS win
  FROM (SELECT item_id, ws, unnest(range(0, len(ws) - least(len(ws), 10) + 1)) AS s FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT w FROM win),
grams AS (
  SELECT doc_id, w, s, list_slice(ws, s + 1, s + w) AS gram
  FROM (SELECT doc_id, ws, w, unnest(range(0, len(ws) - w + 1)) AS s FROM dw, sizes WHERE len(ws) >= w)),
hit AS (SELECT g.doc_id, win.item_id, g.s, g.w FROM grams g JOIN win ON g.w = win.w AND g.gram = win.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + w)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
