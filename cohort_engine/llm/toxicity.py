"""Toxicity scores from gradient-boosted trees over dense features, calibrated by isotonic regression.

1. A bounded sample of labelled documents (``SAMPLE``, by hash) is split in three.
2. From the first part a lexicon of words and word beginnings is learned, one for each
   tongue that a text's own function words suggest: those that occur in toxic documents
   far more often than in others (log-odds and its standard error over the documents
   that hold them).
3. Dense features of whole texts: lexicon densities, how near second-person words stand
   to lexicon words, rates of capitals, punctuation, digits and obfuscation (symbols
   inside words, letters spaced out, lexicon words that appear when symbols are read as
   letters).
4. Spark ML boosted trees on the second part, isotonic regression of their probability
   on the third.
5. One pass over all documents computes features and scores.

Defined results: NULL and empty texts have zero features and get the score of those;
without labels of both classes every score is the share of toxic labels (0 if none);
repeated rows are scored alike; an empty table gives an empty result; further columns
are ignored.  Neither id, language nor source enters a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import id_remainder, prepare, table
from cohort_engine.llm.labelled import SAMPLE, byte_classes, byte_counts, feature_map, label_sample, labelled_texts

HELD_MOD, HELD = 4, 2
THRESHOLD = 0.3
TREES, DEPTH, STEP = 24, 3, 0.2
MIN_DOCS, MIN_LOG_ODDS, MIN_Z, LEXICON = 5, 2.0, 4.0, 4000
MIN_SHARE = 0.02         # share of the toxic documents of its tongue that an entry must occur in
STRONG = 4.5             # log-odds from which a lexicon entry counts as strong
NEAR = 48                # characters around a lexicon word searched for a second-person word
LONG = 5                 # characters from which a strong entry counts whatever the text's tongue
#: Lengths of the word beginnings that may enter the lexicon.
BEGINNINGS = (2, 3, 4, 5, 6, 7)
#: Function words that tell four languages apart (fixed values).
TONGUES = {w: k for k, words in enumerate((
    "the of and to is that was for with this from are it be", "le les du et une est dans pour sur pas avec au aux ce",
    "der die das und ist mit den von zu ein eine nicht auf im", "el los las y con para por una del al lo su como más")) for w in words.split()}
#: Second-person words (fixed values).
SECOND_PERSON = ("you your yours yourself u ur ya tu te toi ton ta tes vous votre vos du dich dir dein deine deinen ihr euch euer sie "
                 "usted ustedes ti tus vosotros os vuestro").split()
#: Symbols read as letters (fixed values).
LOOKALIKES = str.maketrans("@$0134578!+|", "asoieastbitl")
FEATURES = ("strong_density", "weak_density", "strong_words", "hits", "odds_density", "top_odds", "addressed", "addressed_share",
            "hidden_hits", "symbols_inside", "spaced_letters", "capitals", "caps_run", "exclamations", "questions", "punctuation",
            "digits", "repeated_marks", "length")

CLASSES = byte_classes(upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ", lower="abcdefghijklmnopqrstuvwxyz", digit="0123456789", bang="!", ask="?",
                       mark="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
INSIDE = re.compile(r"[A-Za-z][@$0134578!+|*#]+[A-Za-z]")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?![^\W_])")
CAPS_RUN = re.compile(r"[A-Z]{4,}")
REPEATED = re.compile(r"[!?]{2,}")
PERSON = re.compile(rf"(?<!\w)(?:{'|'.join(SECOND_PERSON)})(?!\w)")


def tongue(words: list[str]) -> int:
    """The language most of the function words belong to (-1: none of them occurs)."""
    votes = Counter(map(TONGUES.get, words))
    del votes[None]
    return min(votes, key=lambda k: (-votes[k], k), default=-1)


def with_tongue(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(tongue=[tongue((t or "").lower().split()) for t in pdf["text"]])


class ToxicFeatures:
    """Features of texts by a lexicon: [(tongue, entry, whole word?, log-odds)].

    Of a word's known beginnings and the word itself the strongest counts."""

    def __init__(self, lexicon: list[tuple[int, str, bool, float]]):
        self.whole: dict[tuple[int, str], float] = {(k, w): o for k, w, whole, o in lexicon if whole}
        self.start: dict[tuple[int, str], float] = {(k, w): o for k, w, whole, o in lexicon if not whole}
        for _, w, whole, o in lexicon:           # long, strong entries hold in every tongue
            if o >= STRONG and len(w) >= LONG:
                for k in range(-1, max(TONGUES.values()) + 1):
                    (self.whole if whole else self.start).setdefault((k, w), o)
        self.automata: dict[int, object] = {}

    def __getstate__(self):
        return self.__dict__ | {"automata": {}}

    def automaton(self, k: int):
        """The entries of one tongue, each after a word boundary (None without any)."""
        if k not in self.automata:
            import ahocorasick
            words = {w for t, w in (*self.whole, *self.start) if t == k}
            made = ahocorasick.Automaton()
            for w in words:
                made.add_word(w, (len(w), self.whole.get((k, w), 0.0), self.start.get((k, w), 0.0)))
            if words:
                made.make_automaton()
            self.automata[k] = made if words else None
        return self.automata[k]

    def hits(self, text: str, k: int) -> list[tuple[int, int, float]]:
        """(start, end, log-odds) of lexicon entries at word starts, the strongest of each word."""
        automaton = self.automaton(k)
        if automaton is None:
            return []
        best: dict[int, tuple[int, float]] = {}
        for last, (size, whole, odds) in automaton.iter(text):
            start, end = last + 1 - size, last + 1
            if start and text[start - 1].isalnum():
                continue
            if whole > odds and (end == len(text) or not text[end].isalnum()):
                odds = whole
            if odds > best.get(start, (0, 0.0))[1]:
                best[start] = (end, odds)
        return [(s, e, o) for s, (e, o) in best.items()]

    def row(self, text: str) -> list[float]:
        bytes_ = byte_counts(text)
        size = max(1, int(bytes_.sum()))
        letters = max(1, int(bytes_[CLASSES["upper"]].sum() + bytes_[CLASSES["lower"]].sum()))
        low = text.lower()
        words = low.split()
        n, k = max(1, len(words)), tongue(words)
        hits = self.hits(low, k)
        strong = [h for h in hits if h[2] >= STRONG]
        addressed = sum(PERSON.search(low, max(0, s - NEAR), min(len(low), e + NEAR)) is not None for s, e, _ in hits)
        inside = len(INSIDE.findall(text))
        hidden = max(0, len(self.hits(low.translate(LOOKALIKES), k)) - len(hits)) if inside else 0
        per = 100 / n
        return [len(strong) * per, (len(hits) - len(strong)) * per, np.log1p(len({low[s:e] for s, e, _ in strong})), np.log1p(len(hits)),
                sum(o for _, _, o in hits) * per, max((o for _, _, o in hits), default=0.0), np.log1p(addressed), addressed / max(1, len(hits)),
                np.log1p(hidden), inside * per, len(SPACED.findall(text)) * per, bytes_[CLASSES["upper"]].sum() / letters,
                len(CAPS_RUN.findall(text)) * per, 1000 * bytes_[CLASSES["bang"]].sum() / size, 1000 * bytes_[CLASSES["ask"]].sum() / size,
                bytes_[CLASSES["mark"]].sum() / size, bytes_[CLASSES["digit"]].sum() / size, len(REPEATED.findall(text)) * per, np.log1p(n)]

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.array([self.row(t) if t else [0.0] * len(FEATURES) for t in texts], float).reshape(-1, len(FEATURES))


def learn_lexicon(texts: DataFrame) -> list[tuple[int, str, bool, float]]:
    """Words and beginnings that mark toxic documents, the surest ``LEXICON``, from (doc_id, label, text, tongue)."""
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"))
    entries = F.array(F.struct(F.col("w").alias("entry"), F.lit(True).alias("whole")),
                      *(F.struct(F.substring("w", 1, k).alias("entry"), F.lit(False).alias("whole")) for k in BEGINNINGS))
    held = (texts.select("doc_id", "label", "tongue", F.explode(words).alias("w")).where(F.length("w") >= min(BEGINNINGS))
            .select("doc_id", "label", "tongue", F.inline(entries)).distinct()
            .groupBy("tongue", "entry", "whole").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")))
    totals = texts.groupBy("tongue").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    p, q, pos, neg = (F.col(c) for c in ("p", "q", "pos", "neg"))
    odds = F.log((p + 0.5) / (pos - p + 0.5)) - F.log((q + 0.5) / (neg - q + 0.5))
    sure = odds / F.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
    rows = (held.join(F.broadcast(totals), "tongue")                  # at most one row a tongue
            .where((p >= MIN_DOCS) & (p >= MIN_SHARE * pos)).withColumn("odds", odds).withColumn("z", sure)
            .where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("z") >= MIN_Z))
            .orderBy(F.desc("z"), "tongue", "entry", "whole").limit(LEXICON).collect())
    return [(r["tongue"], r["entry"], r["whole"], r["odds"]) for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, and the columns to ``carry`` along."""
    out = docs.select("doc_id", "text", *carry)
    known = labelled_texts(out, label_sample(labels, "toxic", HELD_MOD, HELD, sample)).withColumn(
        "part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5))).checkpoint()
    kind = docs.schema["doc_id"].dataType.simpleString()
    spoken = known.where("part < 2").mapInPandas(with_tongue, known.schema.simpleString()[7:-1] + ",tongue:int")
    features = ToxicFeatures(learn_lexicon(spoken.checkpoint()))
    held_out = (id_remainder(F.col("doc_id"), HELD_MOD) == HELD).alias("held_out")
    fitted = (known.where("part >= 2").mapInPandas(feature_map(features), f"doc_id {kind}, label int, part long, x array<double>")
              .withColumn("features", array_to_vector("x")).coalesce(4).persist())
    counts = {r["label"]: r["n"] for r in fitted.where("part < 4").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2 or fitted.where("part = 4").isEmpty():
        fitted.unpersist()
        share = float(counts.get(1, 0)) / max(1, sum(counts.values()))
        return out.select("doc_id", held_out, F.lit(share).alias("score"), F.lit(int(share >= THRESHOLD)).alias("predicted"), *carry)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(fitted.where("part < 4"))
    margin = vector_to_array("probability")[1]
    ladder = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="step").fit(
        trees.transform(fitted.where("part = 4")).select(margin.alias("p"), F.col("label").cast("double").alias("label")))
    fitted.unpersist()
    # ids travel as text: pandas would turn long ones beside a NULL into floats
    sent = out.withColumn("doc_id", F.col("doc_id").cast("string"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields if f.name != "text")
    scored = (sent.mapInPandas(feature_map(features), f"{kinds}, x array<double>")
              .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)).withColumn("features", array_to_vector("x")))
    scored = ladder.transform(trees.transform(scored).withColumn("p", margin))
    # the steps of the ladder are flat; a hundredth of the trees' own probability orders documents on one step
    score = (0.99 * F.col("step") + 0.01 * F.col("p")).alias("score")
    return scored.select("doc_id", held_out, score, *carry).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *carry)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
