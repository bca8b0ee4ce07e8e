"""Contamination against a position-by-position search."""

import hashlib
import random
import re

from cohort_engine.llm.decontaminate import contamination, matches

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench, w=10):
    out = {}
    for d, t in docs:
        ws, hit, items = words(t), set(), set()
        for item, bt in bench:
            bw = words(bt)
            k = min(w, len(bw))
            windows = {tuple(bw[i:i + k]) for i in range(len(bw) - k + 1)} if k else set()
            for i in range(len(ws) - k + 1 if k else 0):
                if tuple(ws[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    items.add(str(item))
        out[d] = (len(ws), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    return out


def make(spark, docs, bench):
    d = spark.createDataFrame([(i, t, "n", 1) for i, t in docs], "doc_id long, text string, term string, pos long")
    b = spark.createDataFrame([(i, t, "n", 2) for i, t in bench], "item_id long, text string, term string, doc_id long")
    return d, b


def test_against_brute_force(spark):
    rnd = random.Random(3)
    vocab = ["the", "of", "Ünder", "a", "b", "c1", "日本", "x"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rnd.choices(vocab, weights=[30, 20, 5, 5, 5, 5, 5, 5] + [1] * 60, k=n))
    bench = [(i, text(rnd.choice([0, 1, 2, 5, 9, 10, 11, 25]))) for i in range(25)] + [(100, None), (101, "..."), (7, "the of the of"), (102, "a a a a a a a a a a a a")]
    docs = []
    for i in range(80):
        parts = [text(rnd.randrange(0, 120))]
        if i % 2:
            bw = words(rnd.choice(bench)[1])
            parts += [" ".join(bw[rnd.randrange(0, 3):]).upper() if i % 4 == 1 else "--".join(bw), text(5)]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, "!!"), (203, "a " * 30_000), (204, bench[0][1]), (205, docs[1][1])]
    d, b = make(spark, docs, bench)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in contamination(d, b).collect()}
    assert got == brute(docs, bench)


def test_empty_tables(spark):
    d, b = make(spark, [(1, "some words here")], [(1, "x y z")])
    assert contamination(d.limit(0), b).count() == 0
    r = contamination(d, b.limit(0)).first()
    assert (r.n_words, r.n_hit, r.contaminated) == (3, 0, False)


def test_proximity(spark):
    d, b = make(spark, [(1, "one two three four five"), (2, "one two and three four five"), (3, "five four three two one"), (4, "one two x y z q r s t three four five")],
                [(9, "one two three four five")])
    got = {(r.doc_id, r.kind) for r in matches(d, b, window=5, slack=2).collect()}
    assert got == {(1, "phrase"), (2, "proximity")}


def test_rows_are_told_apart_by_id_and_text(spark):
    item = " ".join(f"i{k}" for k in range(12))
    d, b = make(spark, [(None, f"x {item} y"), (None, "clean words only"), (1, "twelve clean words stand here and none of them hit at all ok"),
                        (1, f"so {item}"), (2, item), (2, item), (None, None)], [(7, item), (7, item)])
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.contaminated) for r in contamination(d, b).collect())
    assert got == sorted([("None", 14, 12, 1, True), ("None", 3, 0, 0, False), ("1", 13, 0, 0, False), ("1", 13, 12, 1, True),
                          ("2", 12, 12, 1, True), ("2", 12, 12, 1, True), ("None", 0, 0, 0, False)])


def test_beyond_the_broadcast_bounds(spark, monkeypatch):
    """Joined by shuffle, as tables beyond the checked sizes are."""
    from cohort_engine.llm import decontaminate as D
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(40)]
    bench = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([3, 10, 14])))) for i in range(12)]
    docs = [(i, " ".join(rnd.choices(vocab, k=20)) + " " + bench[i % 12][1]) for i in range(40)]
    d, b = make(spark, docs, bench)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.contamination(d, b).collect()} == brute(docs, bench)
