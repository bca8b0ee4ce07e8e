"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text longer than ``chunk_chars`` is never encoded in one piece.  It is cut into chunks
that overlap by ``overlap`` characters; each chunk is encoded by the tokenizer with
offsets.  Two neighbouring chunks are spliced at a character position that is a token
boundary in both encodings and is proven stable: the character before it is white space
and the one after it is not.  This vocabulary's pre-tokenizer drops white space and looks
neither back nor ahead across it, normalisation composes nothing with it, and added
tokens contain none, so the tokens on either side of such a position are the same
whatever text surrounds them.  If the overlap holds no such position, it is widened,
doubling until one appears or the text ends.

Shorter texts are cut by the vocabulary's own splitting rule, pieces are counted once by
the tokenizer and remembered (``PieceCounts``, at most ``CACHE`` pieces a worker); texts
with characters outside the plain ranges, or that may hold an added token, are encoded
as they are by the tokenizer.

Defined results: NULL counts as empty (0 bytes, 0 tokens); repeated rows are counted
alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cohort_engine.llm.common import prepare, table

CHUNK_CHARS = 1 << 15
OVERLAP = 512
MAX_TOKENS = 2048
CACHE = 600_000          # pieces remembered by a worker
PLAIN_END = 0x250        # characters below have had fixed classes since the first Unicode versions


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def char_ranges(kind: str) -> str:
    """Regex ranges of the characters below PLAIN_END whose Unicode category starts with ``kind``."""
    return "".join(f"\\u{i:04x}" for i in range(PLAIN_END) if unicodedata.category(chr(i))[0] == kind)


LETTERS, DIGITS, SPACES = char_ranges("L"), char_ranges("N"), r"\t-\r \x85\xa0"
#: The splitting rule of word_bpe_49k.json for plain characters (fixed pattern of the vocabulary).
WORD_PIECES = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{SPACES}{LETTERS}{DIGITS}]+"
#: Texts made of anything else go to the tokenizer itself; combining marks and rare scripts are among that.
PLAIN_TEXT = re.compile(f"[\\t-\\r\\x20-\\x7e\\x85\\xa0-\\u024f\\u2010-\\u201f\\u2026\\u20ac]*")
ADDED = "<|"


class PieceCounts(dict):
    """Tokens of one pre-token piece, counted by the tokenizer when first seen."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def make_room(self) -> None:
        """Forget all pieces when there are too many; call it before asking which ones are known."""
        if len(self) > CACHE:
            self.clear()

    def learn(self, pieces: list[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if p not in self]
        for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self[p] = len(e)


class WordCounter:
    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP):
        self.tokenizer = load_tokenizer(path)
        self.counts = PieceCounts(self.tokenizer)
        self.find = re.compile(WORD_PIECES).findall
        self.chunk_chars, self.overlap = chunk_chars, overlap

    def count(self, texts: list[str]) -> list[int]:
        """Token counts of texts that are each at most a chunk long."""
        pieces: list[list[str] | None] = []
        for t in texts:
            if PLAIN_TEXT.fullmatch(t) and ADDED not in t:
                pieces.append(self.find(unicodedata.normalize("NFC", t).lower()))
            else:
                pieces.append(None)
        self.counts.make_room()
        self.counts.learn([p for ps in pieces if ps for p in ps if p not in self.counts])
        get = self.counts.__getitem__
        return [len(self.tokenizer.encode(t, add_special_tokens=False)) if ps is None else sum(map(get, ps))
                for t, ps in zip(texts, pieces)]

    def ends(self, text: str, start: int) -> tuple[int, list[tuple[int, int]]]:
        """One chunk: its end, and its tokens' character offsets within the whole text."""
        stop = min(len(text), start + self.chunk_chars + self.overlap)
        e = self.tokenizer.encode(text[start:stop], add_special_tokens=False)
        return stop, [(start + a, start + b) for a, b in e.offsets]

    def splice(self, text: str) -> int:
        """Tokens of a text of any length, from overlapping chunks spliced where they agree."""
        total, start = 0, 0
        stop, here = self.ends(text, 0)
        while stop < len(text):
            overlap = self.overlap
            while True:
                nxt = max(start + 1, stop - overlap)
                cut = stable_cut(text, nxt, stop)
                if cut is not None:
                    nstop, after = self.ends(text, nxt)
                    if agree(here, after, cut):
                        break
                    overlap *= 2
                else:                       # nothing stable in the overlap: widen it to the right as well
                    overlap *= 2
                if overlap >= self.chunk_chars and stop < len(text):
                    stop = min(len(text), stop + overlap)
                    e = self.tokenizer.encode(text[start:stop], add_special_tokens=False)
                    here = [(start + a, start + b) for a, b in e.offsets]
                if stop == len(text):
                    return total + len(here)
            total += sum(a < cut for a, _ in here)
            start, stop, here = cut, nstop, [t for t in after if t[0] >= cut]
        return total + len(here)


#: The white space of the Unicode property White_Space, which is what the pre-tokenizer drops (fixed values).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_START = re.compile(f"[{WHITE}](?=[^{WHITE}])")


def stable_cut(text: str, lo: int, hi: int) -> int | None:
    """The position nearest to the middle of [lo, hi) that starts a word after white space."""
    found = [m.end() for m in WORD_START.finditer(text[lo:hi]) if lo + m.end() < hi]
    return lo + min(found, key=lambda p: abs(2 * p - (hi - lo))) if found else None


def agree(left: list[tuple[int, int]], right: list[tuple[int, int]], cut: int) -> bool:
    """Both encodings have a token boundary at ``cut`` and the same tokens' offsets around it."""
    if any(a < cut < b for a, b in left) or any(a < cut < b for a, b in right):
        return False
    ahead = [t for t in left if t[0] >= cut][:3]
    return ahead[:-1] == [t for t in right if t[0] >= cut][:max(0, len(ahead) - 1)]


_WORKER: dict[tuple, WordCounter] = {}


def worker_counter(path: str, chunk_chars: int, overlap: int) -> WordCounter:
    """One counter for each Python worker, kept between tasks."""
    key = (path, chunk_chars, overlap)
    if key not in _WORKER:
        _WORKER[key] = WordCounter(*key)
    return _WORKER[key]


def count_tokens(docs: DataFrame, path: str, limit: int = MAX_TOKENS,
                 chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = worker_counter(path, chunk_chars, overlap)
        for pdf in batches:
            texts = ["" if t is None else t for t in pdf["text"]]
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            n = [0] * len(texts)
            for i, c in zip(short, counter.count([texts[i] for i in short])):
                n[i] = c
            for i, t in enumerate(texts):
                if len(t) > chunk_chars:
                    n[i] = counter.splice(t)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_bytes": [len(t.encode()) for t in texts],
                                "n_tokens": n, "over_limit": [c > limit for c in n]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
