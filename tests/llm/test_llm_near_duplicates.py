"""Near-duplicate components against all pairs."""

import random

from cohort_engine.llm.components import connected_components
from cohort_engine.llm.near_duplicates import near_duplicates, shingle_set, signature


def brute(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        k = min(4, len(w))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    ids = sorted(sets)
    parent = {d: d for d in ids}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def result(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, digest string, id long, component long")
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}


def test_against_all_pairs(spark):
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size, copies in ((40, 12), (300, 25), (8, 5), (5, 4), (90, 40), (1000, 3), (25, 60)):
        base = rnd.choices(vocab, k=size)
        for _ in range(copies):
            now = list(base)
            for _ in range(rnd.randrange(0, max(1, size // 12) + 1)):
                now[rnd.randrange(size)] = rnd.choice(vocab)
            base = now if rnd.random() < 0.3 else base          # chains of copies of copies
            rows.append((n, " ".join(now) if n % 3 else " ".join(now).upper()))
            n += 1
    rows += [(n + i, " ".join(rnd.choices(vocab, k=rnd.randrange(1, 200)))) for i in range(150)]
    rows += [(9000, None), (9001, ""), (9002, " \n\t "), (9003, "one"), (9004, "ONE"), (9005, "a b c"), (9006, "a b d"),
             (9007, "x " * 20_000), (9008, "x x x x x"), (9009, "\x1c y"), (9010, "\xa0 y")]
    rnd.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_many_exact_copies_and_repeated_rows(spark):
    rows = [(i, "the very same text again and again") for i in range(300)] + [(500, "another one that is alone in here")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df).collect()
    assert len(got) == 302 and {r.component_id for r in got} == {0, 500} and sum(r.kept for r in got) == 3


def test_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    got = near_duplicates(spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (2, None)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, None, True), (4, 4, True), (2, 2, True)}


def test_one_id_on_several_texts_and_rows(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (1, "quite another text that stands alone here"), (2, base + " more"), (3, "quite another text that stands alone here too"), ((1 << 60) + 1, base + " and more")]
    got = near_duplicates(spark.createDataFrame([r + ("k",) for r in rows], "doc_id long, text string, key string"), ["key"]).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.key) for r in got) == sorted(
        [(1, 57, 1, "k"), (1, 57, 1, "k"), (1, 4, 1, "k"), (2, 58, 1, "k"), (3, 5, 1, "k"), ((1 << 60) + 1, 59, 1, "k")])


def test_beyond_the_broadcast_bound_and_many_deals(spark, monkeypatch):
    from cohort_engine.llm import near_duplicates as N
    monkeypatch.setattr(N, "BROADCAST_IDS", 0)
    monkeypatch.setattr(N, "DEAL_SHINGLES", 100)
    monkeypatch.setattr(N, "DEAL_MEMBERS", 7)
    monkeypatch.setattr(N, "COLUMNS", 16)
    monkeypatch.setattr(N, "NEIGHBOURS", 1)
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        now = list(base) if i % 2 else [f"v{k}" for k in range(50)]
        now[rnd.randrange(len(now))] = f"e{i}"
        rows.append((i, " ".join(now)))
    assert result(spark, rows) == brute(rows)


def test_signatures_estimate_similarity():
    import numpy as np
    a = shingle_set(" ".join(f"w{i}" for i in range(3000)))
    b = shingle_set(" ".join(f"w{i}" for i in range(600, 3600)))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a) == signature(b)).mean() - true) < 0.2


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 120)] + [(1000, rnd.randrange(1001, 1200)) for _ in range(150)] + [(7, 7), (2001, 2000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(121)) and got[2001] == 2000 == got[2000]
    assert {got[b] for a, b in edges if a == 1000} == {1000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_inside_a_dense_region(spark):
    """Distinct texts about 0.74 alike; planted pairs share one of their three edits and are 0.818 alike."""
    rnd = random.Random(3)
    base, new, texts = [f"t{i}" for i in range(163)], iter(range(10 ** 6)), []
    def edited(shared):
        places = [p for p, _ in shared]
        while len(places) < 3:
            p = rnd.randrange(4, 159)
            if all(abs(p - q) >= 4 for q in places):
                places.append(p)
        words = list(base)
        for p, w in [*shared, *((p, f"e{next(new)}") for p in places[len(shared):])]:
            words[p] = w
        return " ".join(words)
    for _ in range(100):
        shared = [(rnd.randrange(4, 159), f"e{next(new)}")]
        texts += [edited(shared), edited(shared)]
    texts += [edited([]) for _ in range(1800)]
    rnd.shuffle(texts)
    want = all_pairs(texts)
    assert len(set(want.values())) < len(texts) - 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == want


def all_pairs(texts):
    """Component of every text by the intersection counts of all pairs."""
    import numpy as np
    sets = [set(shingle_set(t).tolist()) for t in texts]
    held = {}
    for i, s in enumerate(sets):
        for x in s:
            held.setdefault(x, []).append(i)
    both = np.zeros((len(sets), len(sets)), np.int32)
    for ids in held.values():
        both[np.ix_(ids, ids)] += 1
    n = both.diagonal()
    parent = list(range(len(sets)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in zip(*np.nonzero(np.triu(100 * both >= 80 * (n[:, None] + n[None, :] - both), 1))):
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {i: int(find(i)) for i in range(len(sets))}


def test_pairs_are_dealt_without_a_join_where_every_hub_fits_a_task(spark, monkeypatch):
    """op7, pipeline: only hubs with more than one task are looked up, and one with several loses no link."""
    from cohort_engine.llm import near_duplicates as N
    from cohort_engine.llm.scratch import Scratch
    put, made = Scratch.put, {}

    def counted(self, df, name):
        made[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return put(self, df, name)

    monkeypatch.setattr(Scratch, "put", counted)
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = [(n, " ".join(w if rnd.random() > 0.02 else f"v{n}" for w in base)) for n in range(40)]
    small = result(spark, rows)
    assert small == brute(rows) and made["first-roles"].count("Join") == 1        # the hub's own set only
    monkeypatch.setattr(N, "DEAL_SHINGLES", 200)
    assert result(spark, rows) == small and made["first-roles"].count("Join") > 1


def test_a_class_gets_its_component_once_not_once_a_tree(spark):
    """op7, pipeline: components are joined to classes, below the rows for every tree, and reach the mixed regions."""
    import numpy as np

    from cohort_engine.llm import near_duplicates as N
    same = np.arange(N.HASHES, dtype="<u4").tobytes()
    classes = spark.createDataFrame([(i, bytearray(same)) for i in range(8)], "id long, sig binary")
    regions = classes.mapInPandas(N.region_rows, N.REGION_SCHEMA).groupBy("tree", "k0").count().withColumnRenamed("count", "members")
    mixed = N.mixed_regions(classes, regions, spark.createDataFrame([(3, 1), (1, 1)], "node long, component long"))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInPandas") < plan.index("Join LeftOuter")        # the tree is printed from the top
    rows = mixed.collect()
    assert len(rows) == 8 * N.TREES and {(r.id, r.component) for r in rows} == {(i, 1 if i == 3 else i) for i in range(8)}
    one = spark.createDataFrame([(i, 0) for i in range(8)], "node long, component long")
    assert N.mixed_regions(classes, regions, one).count() == 0
