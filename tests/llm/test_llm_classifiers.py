"""Toxicity and quality: held-out accuracy, labels that may not be learned, odd rows."""

import zlib

import numpy as np
import pytest

from cohort_engine.llm.quality import (BINS, FEATURES, Basis, Moments, class_prior, loss, positive_unlabelled, quality_features, score_bin, score_quality,
                                       separator, summed)
from cohort_engine.llm.toxicity import ToxicFeatures, score_toxicity, tongue

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def accuracy(got, labels, column):
    m = got.merge(labels, on="doc_id")
    m = m[m["held_out"]]
    return (m["predicted"] == m[column]).mean(), len(m)


@pytest.mark.parametrize("score,column,mod,held,least", [(score_toxicity, "toxic", 4, 2, 0.85), (score_quality, "quality", 5, 0, 0.95)])
def test_held_out(spark, score, column, mod, held, least):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    got = score(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % mod == held for i in got["doc_id"]]).all()
    right, n = accuracy(got, labels.toPandas(), column)
    assert n > 50 and right >= least
    # turning the held-out labels over changes nothing
    from pyspark.sql import functions as F
    flipped = labels.withColumn(column, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == held, 1 - F.col(column)).otherwise(F.col(column)))
    again = score(docs, flipped).toPandas()
    a, b = got.set_index("doc_id")["score"], again.set_index("doc_id")["score"]
    assert np.allclose(a, b.loc[a.index])


@pytest.mark.parametrize("score,column", [(score_toxicity, "toxic"), (score_quality, "quality")])
def test_odd_rows(spark, score, column):
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (2, "", "x", 1), (None, "some text", None, None), (3, "word " * 50_000, "x", 0)],
                                 "doc_id long, text string, features string, label long")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = score(docs, none).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, None, None), (3, 0, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    assert score(docs, odd).count() == 5


def test_features_see_obfuscation_and_address():
    f = ToxicFeatures([(0, "idiot", True, 6.0), (0, "los", False, 5.0)])
    names = __import__("cohort_engine.llm.toxicity", fromlist=["FEATURES"]).FEATURES
    row = dict(zip(names, f.row("you are the idiot of the losers and that is it")))
    assert row["strong_words"] > 0 and row["addressed"] > 0 and row["hits"] == np.log1p(2)
    assert dict(zip(names, f.row("the 1d!0t and the id10t of it")))["hidden_hits"] > 0
    assert dict(zip(names, f.row("the i d i o t")))["spaced_letters"] > 0
    assert dict(zip(names, f.row("closet and kidiot are the words")))["hits"] == 0
    assert tongue("le chat est sur la table et dans le lit".split()) == 1 and tongue([]) == -1


def mixture(rng, good, bad, d=4):
    return rng.permutation(np.concatenate([rng.normal(1.5, 1, (good, d)), rng.normal(-1.5, 1, (bad, d))]))


def test_prior_and_risk_recover_a_known_mixture():
    rng = np.random.default_rng(0)
    p, u = rng.normal(1.5, 1, (4000, 4)), mixture(rng, 24_000, 16_000)
    basis = Basis(u.mean(axis=0), u.std(axis=0))
    mp, mu = Moments.of(basis(p)), Moments.of(basis(u))
    apart = separator(Moments.of(basis(p[::2])), mu)
    prior = class_prior(basis(p[1::2]) @ apart, np.bincount(score_bin(basis(u) @ apart), minlength=BINS).astype(float))
    assert abs(prior - 0.6) < 0.06
    w = positive_unlabelled(mp, mu, 0.6)
    assert (basis(rng.normal(1.5, 1, (1000, 4))) @ w > 0).mean() > 0.95 and (basis(rng.normal(-1.5, 1, (1000, 4))) @ w < 0).mean() > 0.95


def test_risk_of_negatives_stays_non_negative():
    """Few positives and a prior that is too high: the unbiased risk would go below zero."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(1.5, 1, (60, 4)), mixture(rng, 400, 600)
    basis = Basis(u.mean(axis=0), u.std(axis=0))
    mp, mu = Moments.of(basis(p)), Moments.of(basis(u))
    for prior in (0.4, 0.8, 0.97):
        w = positive_unlabelled(mp, mu, prior)
        assert loss(mu, w, -1) - prior * loss(mp, w, -1) >= -1e-9 and loss(mp, w, 1) <= 1


def test_rare_junk_changes_the_moments():
    """Every unlabelled row counts: a kind of junk of 1 in 50,000 moves prior and weights."""
    rng = np.random.default_rng(2)
    p, u = rng.normal(1.5, 1, (500, 4)), mixture(rng, 30_000, 20_000)
    basis = Basis(u.mean(axis=0), u.std(axis=0))
    with_junk = np.concatenate([u, np.full((1, 4), -40.0)])
    a, b = (positive_unlabelled(Moments.of(basis(p)), Moments.of(basis(x)), 0.6) for x in (u, with_junk))
    assert not np.array_equal(a, b)
    apart = separator(Moments.of(basis(p)), Moments.of(basis(u)))
    assert class_prior(basis(p) @ apart, np.bincount(score_bin(basis(with_junk) @ apart), minlength=BINS)) != class_prior(
        basis(p) @ apart, np.bincount(score_bin(basis(u) @ apart), minlength=BINS))


def test_sums_are_over_all_rows(spark):
    rows = spark.createDataFrame([([float(i)] * len(FEATURES),) for i in range(1000)], "x array<double>").repartition(7)
    assert summed(rows, lambda x: np.array([len(x), x[:, 0].sum()])).tolist() == [1000, 499500]


def test_quality_features_are_finite():
    x = quality_features(["", " ", "a", "é" * 100, "A!! B!! C!!", "\n\n\n", "x " * 10_000])
    assert np.isfinite(x).all() and (x[0] == 0).all()
