"""Token counts and packing against the tokenizers themselves."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from cohort_engine.llm.packing import Runs, best_fit_all, pack_documents, piece_spans, plan_sequences, rank_ranges
from cohort_engine.llm.token_counts import WordCounter, count_tokens, load_tokenizer

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "  ", "\n", "a" * 5000, "ab'll re's " * 300, "<|endoftext|> x<|startoftext|>" * 50, "日本語のテキスト" * 200,
       "é É​ß İ Σς ΟΔΟΣ " * 100, "\x00a\x01 b\x1f\x85c d" * 60, "x\xa0y　z " * 100, "'s't're \n\n x \t" * 100,
       "½²①Ⅷ 12٣" * 60, " \xa0 x\x85 \x85y", "é café " * 50, "word " * 9000, "…“quoted” — dash’s €5 " * 80]


def random_texts(n=60, seed=4):
    rnd = random.Random(seed)
    alphabet = "abcdefghij ABC  éèß'’.,!?\n\t0123日本-_<|>\xa0"
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(0, 4000))) for _ in range(n)]


@pytest.mark.parametrize("chunk,overlap", [(600, 16), (1000, 64), (1 << 15, 512)])
def test_counts_are_the_librarys(chunk, overlap):
    library, own = load_tokenizer(WORDS), WordCounter(WORDS, chunk, overlap)
    for text in ODD + random_texts():
        n = len(library.encode(text, add_special_tokens=False))
        assert own.count([text]) == [n]
        assert own.splice(text) == n, (chunk, overlap, text[:40])


def test_evicted_pieces_are_counted_again(monkeypatch):
    from cohort_engine.llm import packing, token_counts
    monkeypatch.setattr(token_counts, "CACHE", 5)
    monkeypatch.setattr(packing, "CACHE", 5)
    library, own = load_tokenizer(WORDS), WordCounter(WORDS)
    for texts in (["alpha beta gamma delta epsilon zeta"], ["alpha newword"], ["zeta alpha", "beta x y z w v u t s"], ["alpha"], []):
        assert own.count(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]
    library, ids = load_tokenizer(BYTES), packing.IdBytes(BYTES, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in ("alpha beta gamma delta epsilon zeta", "alpha newword alpha", "a b c d e f g h alpha"):
        assert np.frombuffer(ids.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("low,high", [(1, 2048), (650, 720), (300, 800), (1000, 1100)])
def test_never_more_sequences_than_best_fit(low, high):
    rnd = random.Random(low)
    hist = Counter(rnd.randrange(low, high + 1) for _ in range(4000))
    plain = Runs(2048)
    best_fit_all(plain, hist)
    assert sum(n for _, n in plan_sequences(dict(hist), 2048)) <= plain.total()


def test_count_tokens_rows(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(99, None, None, None), (None, "hello there", None, 1), (3, ODD[3], "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, over_limit long")
    got = count_tokens(docs, WORDS, chunk_chars=700, overlap=8).toPandas()
    library = load_tokenizer(WORDS)
    want = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False))) for r in rows)
    found = Counter((None if d != d or d is None else int(d), b, n) for d, b, n in zip(got["doc_id"].astype(object).where(got["doc_id"].notna(), None), got["n_bytes"], got["n_tokens"]))
    assert found == want
    assert (got["over_limit"] == (got["n_tokens"] > 2048)).all()
    assert count_tokens(docs.limit(0), WORDS).count() == 0


def test_piece_spans():
    assert piece_spans(5, 4) == [(0, 1), (1, 4)] and piece_spans(4, 4) == [(0, 4)] and piece_spans(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_tight(seed):
    rnd = random.Random(seed)
    cap = 256
    hist = Counter(min(cap, max(1, int(rnd.lognormvariate(4 + seed % 3 * 0.5, 0.8)))) for _ in range(rnd.choice([1, 7, 400, 5000])))
    plan = plan_sequences(dict(hist), cap, groups=12)
    assert all(sum(c) <= cap and n > 0 for c, n in plan)
    held = Counter()
    for contents, n in plan:
        for length in contents:
            held[length] += n
    assert held == hist
    plain = Runs(cap)
    best_fit_all(plain, hist)
    assert sum(n for _, n in plan) <= plain.total()
    for length, ranges in rank_ranges(plan).items():
        assert ranges[0, 0] == 0 and (np.diff(ranges[:, 0]) > 0).all()


def test_packing_round_trip(spark):
    rows = [(i, t, "c") for i, t in enumerate(ODD + random_texts(40))] + [(500, None, "c"), (501, "tie tie", "c"), (502, "tie tie", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = pack_documents(docs).toPandas()
    library = load_tokenizer(BYTES)
    want = {}
    for d, t, _ in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (s, n) in enumerate(piece_spans(len(ids), 2048)):
            want[d, k] = (s, n, zlib.crc32(ids[s:s + n].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want and len(got) == len(want)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.concatenate([[0], g["length"].cumsum()[:-1]])).all() and g["length"].sum() <= 2048
    assert pack_documents(docs.limit(0)).count() == 0
