"""Merkle manifest: whole trees hashed node by node in Python, odd tables, and foreign leaves."""

import hashlib
import zlib

import pytest

from cohort_engine.llm.merkle import dataset_manifest
from cohort_engine.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars) -> str:
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def root_and_paths(leaves: list[str]) -> tuple[str, list[list[tuple[str, bool]]]]:
    """The root, and per leaf its sibling (empty: none) and side on every level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            paths[i].append((nodes[other] if other < len(nodes) else "", place % 2 == 1))
        nodes, at = [h(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)], [place // 2 for place in at]
    return nodes[0], paths


def brute(rows: list[tuple]) -> list[tuple]:
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        made[lang] = root_and_paths([leaf(*r) for r in trees[lang]])
    root, tops = root_and_paths([made[lang][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for r, path in zip(trees[lang], made[lang][1]):
            path = path + tops[k]
            claim = r[:4] + (r[4] + 1,) if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else r
            now = leaf(*claim)
            for sibling, right in path:
                now = h(sibling, now) if right else h(now, sibling)
            out.append((r[0], leaf(*r), made[lang][0], root, h(*(s for s, _ in path)), now, now == root))
    return sorted(out, key=str)


def manifest(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = dataset_manifest(df, Scratch(spark, "merkle-test")).collect()
    return sorted((tuple(r) for r in got), key=str)


def doc(i, lang="en", text="words é", source="s", n_chars=3):
    return (i, text, lang, source, n_chars)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, "de": 1, None: 3}, {"a": 255, "b": 256, "c": 257, "": 5}])
def test_trees_of_every_shape(spark, sizes):
    rows = [doc(1000 * k + i, lang) for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    assert manifest(spark, rows) == brute(rows)


def test_three_written_levels(spark):
    """More leaves than two strides of levels hold: 2 ** 16 + 3 in one tree."""
    rows = [(i, None, "x", None, None) for i in range((1 << 16) + 3)]
    assert manifest(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [doc(None), doc(None), doc(7, text=None), doc(7, text=""), doc(7, text=""), doc(8, source=None), doc(9, n_chars=None),
            doc(10, lang=None, text="x" * 300_000), doc(-5, lang="ü"), doc(11, lang="z")]
    got = manifest(spark, rows)
    assert got == brute(rows)
    assert not all(r[-1] for r in manifest(spark, [doc(i) for i in range(40)]))          # tampered rows are found


def test_empty_table_and_clashing_columns(spark):
    assert manifest(spark, []) == []
    rows = [doc(i) for i in range(5)]
    extra = spark.createDataFrame([r + (1, "t", 2) for r in rows], SCHEMA + ", pos long, tree string, depth int")
    got = dataset_manifest(extra, Scratch(spark, "merkle-test")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
