"""Quality scores by positive-unlabelled learning with a non-negative risk over all documents.

1. Dense features of whole texts: repetition of words, pairs and lines, shares of capitals,
   symbols, digits and letters, word and line lengths, function words; one pass, written.
2. Trusted positives: a bounded sample (``SAMPLE``) of the labelled documents marked good, one
   for each id; labels that mark documents bad are not used.  Unlabelled text: all documents.
3. The score function g is linear in a fixed basis (the standardised features and ``HIDDEN``
   random tanh units of them).  With the squared loss l(z) = (1 - z)^2 / 4 each expectation of
   the risk is a quadratic form in its weights, so the second moments of the basis, summed over
   every row by Spark, hold all that the unlabelled documents say; no row of them is left out.
4. The class prior is estimated by the best bin: the least ratio, over score thresholds, of the
   shares of all documents and of held-back positives above it, with an allowance for sampling
   error, under the function that tells the two apart.  The shares come from a histogram of
   the scores of all documents.
5. The weights minimise  prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])  with a
   small ridge: the unbiased risk is a linear system; where its solution makes the second term
   negative, the best weights that hold it at zero are found instead.
6. The squared loss makes (1 + g) / 2 the probability of good; it is the score, cut to [0, 1].

Defined results: NULL and empty texts have zero features and get the score of those;
without positives every score is 0; repeated rows are scored alike (and count each as
unlabelled); an empty table gives an empty result; further columns are ignored.  Neither id,
language nor source enters a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import id_remainder, prepare, table
from cohort_engine.llm.labelled import byte_classes, byte_counts, label_sample
from cohort_engine.llm.scratch import Scratch

HELD_MOD, HELD = 5, 0
THRESHOLD = 0.3
SAMPLE = 12_000          # trusted positives, about
HIDDEN, RIDGE = 64, 1e-2
BINS = 4096              # of the score histogram, over [-EDGE, EDGE]
EDGE = 4.0
SLACK = 0.01             # confidence left out of the prior's bound
#: Frequent function words of four languages (fixed values).
FUNCTION_WORDS = frozenset(
    "the of and to in a is that for it was on are as with his they at be this from or had by not but what all were when we there can an "
    "le la les de des du et un une en que qui dans pour sur est par pas au avec ce se "
    "der die das und ist von zu mit den im nicht ein eine auf für als auch es an "
    "el los las y por con para una del al lo como más su no".split())
FEATURES = ("words", "distinct", "pairs_distinct", "repeats", "short_words", "word_length", "long_words", "capitals", "symbols", "exclamations",
            "digits", "letters", "beyond_ascii", "lines", "lines_distinct", "line_words", "stops", "function_words", "symbol_words", "spaces", "top_byte")
CLASSES = byte_classes(upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ", letter="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", digit="0123456789",
                       space=" \t\r\n", bang="!?", stop=".", symbol="#$%&*+/<=>@[\\]^_`{|}~")
BEYOND = np.arange(256) >= 128
ENDS = tuple("#$%&*+/<=>@[\\]^_`{|}~!")


def text_row(text: str) -> list[float]:
    b = byte_counts(text)
    size = max(1, int(b.sum()))
    letters = max(1, int(b[CLASSES["letter"]].sum()))
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    lines = [line for line in text.split("\n") if line]
    share = {k: b[m].sum() / size for k, m in CLASSES.items()}
    pairs = len(set(zip(words, words[1:])))
    return [np.log1p(len(words)), len(set(words)) / n, pairs / max(1, n - 1), sum(map(eq, words, words[1:])) / n, float((lengths <= 2).mean()),
            float(lengths.mean()), float((lengths > 20).mean()), b[CLASSES["upper"]].sum() / letters, share["symbol"], share["bang"], share["digit"],
            share["letter"], b[BEYOND].sum() / size, np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
            b[CLASSES["stop"]].sum() / n, sum(map(FUNCTION_WORDS.__contains__, words)) / n, sum(w.endswith(ENDS) for w in words) / n,
            share["space"], b.max() / size]


def quality_features(texts: list[str]) -> np.ndarray:
    return np.array([text_row(t) if t else [0.0] * len(FEATURES) for t in texts], float).reshape(-1, len(FEATURES))


class Basis:
    """Standardised features, random tanh units of them, and 1; the same weights every run."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.where(scale > 1e-9, scale, 1.0)
        d = len(mean)
        self.w, self.b = rng.normal(0, 1.2 / np.sqrt(d), (d, HIDDEN)), rng.normal(0, 1, HIDDEN)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z / 3, np.tanh(z @ self.w + self.b), np.ones((len(x), 1))], axis=1)


@dataclass
class Moments:
    """Number, mean and mean outer product of basis rows."""
    n: float
    mean: np.ndarray
    second: np.ndarray

    @staticmethod
    def of(phi: np.ndarray) -> Moments:
        return Moments(len(phi), phi.mean(axis=0), phi.T @ phi / len(phi))


def loss(m: Moments, w: np.ndarray, side: int) -> float:
    """Mean of (1 - side * g)^2 / 4."""
    return float(1 - 2 * side * (m.mean @ w) + w @ m.second @ w) / 4


def ridge(size: int) -> np.ndarray:
    out = RIDGE * np.eye(size)
    out[-1, -1] = 1e-9                   # the constant goes free
    return out


def separator(p: Moments, u: Moments) -> np.ndarray:
    """Weights that tell positives (1) from unlabelled rows (-1), both weighing alike."""
    return np.linalg.solve(p.second + u.second + ridge(len(p.mean)), p.mean - u.mean)


def positive_unlabelled(p: Moments, u: Moments, prior: float) -> np.ndarray:
    """Weights of the least non-negative risk.

    The unbiased risk is E_u[l(-g)] - prior * E_p[g], as l(g) - l(-g) = -g.  If its minimum leaves the estimated risk of
    the negatives below zero, the positives' risk is minimised under a multiplier that holds that term at zero."""
    r = ridge(len(p.mean))

    def best(t: float) -> np.ndarray:
        """Minimum of prior * E_p[l(g)] + t * (E_u[l(-g)] - prior * E_p[l(-g)])."""
        a = prior * p.second + t * (u.second - prior * p.second) + r
        return np.linalg.solve(a, prior * p.mean - t * (u.mean - prior * p.mean))

    def rest(w: np.ndarray) -> float:
        return loss(u, w, -1) - prior * loss(p, w, -1)

    w = best(1.0)
    if rest(w) >= 0:
        return w
    low, high = 0.0, 1.0                 # less weight on the term raises it
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if rest(best(mid)) >= 0 else (low, mid)
    return best(low)


def class_prior(p_scores: np.ndarray, u_counts: np.ndarray) -> float:
    """Share of good rows among the unlabelled, by the best bin of the score histograms (over [-EDGE, EDGE])."""
    n_u, n_p = u_counts.sum(), len(p_scores)
    p_counts = np.bincount(score_bin(p_scores), minlength=BINS)
    qu, qp = (c[::-1].cumsum()[::-1] / n for c, n in ((u_counts, n_u), (p_counts, n_p)))       # shares from each bin on
    error = np.sqrt(np.log(4 / SLACK) / (2 * n_u)) + np.sqrt(np.log(4 / SLACK) / (2 * n_p))
    enough = qp >= 0.05
    best = int(np.argmin(np.where(enough, (qu + error) / np.where(enough, qp, 1), np.inf)))
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def score_bin(g: np.ndarray) -> np.ndarray:
    return np.clip((g + EDGE) / (2 * EDGE) * BINS, 0, BINS - 1).astype(int)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, len(FEATURES)))


def summed(rows: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the vector ``f`` makes of a batch's features; one vector a task is merged at a time."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                part = f(matrix(pdf["x"]))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    parts = rows.select("x").mapInPandas(run, "v array<double>").select(array_to_vector("v").alias("v"))
    got = parts.agg(Summarizer.sum(F.col("v")).alias("v")).first()["v"]
    return got.toArray()


def feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        x = quality_features(["" if t is None else t for t in pdf["text"]])
        yield pdf.drop(columns="text").assign(x=list(x))


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, and the columns to ``carry`` along."""
    spark, c = docs.sparkSession, F.col
    kept = ["_id", *carry]
    # ids travel as text: pandas would turn long ones beside a NULL into floats
    raw = docs.select(c("doc_id").cast("string").alias("_id"), *carry, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.schema.fields if f.name != "text") + ", x array<double>"
    rows = Scratch(spark, "quality").put(raw.mapInPandas(feature_rows, schema), "features")
    out = rows.select(c("_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), *carry, "x")
    held_out = (id_remainder(c("doc_id"), HELD_MOD) == HELD).alias("held_out")
    trusted = label_sample(labels.where("quality = 1"), "quality", HELD_MOD, HELD, sample)
    good = (out.join(F.broadcast(trusted.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"))      # one row an id: at most the sample
            .select("x").collect())
    if len(good) < 4:
        return out.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), *carry)
    p = np.array(sorted(r["x"] for r in good), float)               # rows arrive in any order; fix it before drawing halves
    p = np.random.default_rng(5).permutation(p)
    sums = summed(rows, lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]))
    mean, square = np.split(sums[1:] / sums[0], 2)
    basis = Basis(mean, np.sqrt(np.maximum(0, square - mean * mean)))
    size = len(FEATURES) + HIDDEN + 1

    def outer(x: np.ndarray) -> np.ndarray:
        phi = basis(x)
        return np.concatenate([phi.sum(axis=0), (phi.T @ phi).ravel()])

    both = summed(rows, outer) / sums[0]
    u, phi_p = Moments(sums[0], both[:size], both[size:].reshape(size, size)), basis(p)
    apart = separator(Moments.of(phi_p[::2]), u)
    histogram = summed(rows, lambda x: np.bincount(score_bin(basis(x) @ apart), minlength=BINS).astype(float))
    w = positive_unlabelled(Moments.of(phi_p), u, class_prior(phi_p[1::2] @ apart, histogram))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            score = np.clip((1 + basis(matrix(pdf["x"])) @ w) / 2, 0, 1)
            yield pdf[kept].assign(score=score, predicted=(score >= THRESHOLD).astype(int))

    done = rows.mapInPandas(run, schema.replace(", x array<double>", ", score double, predicted int"))
    return (done.withColumn("doc_id", c("_id").cast(docs.schema["doc_id"].dataType)).select("doc_id", held_out, "score", "predicted", *carry))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
