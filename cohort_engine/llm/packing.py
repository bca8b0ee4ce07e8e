"""Packing documents into sequences by linear grouping.

1. Texts become token ids plus an end id; only documents longer than a sequence are cut,
   into full pieces, the first one holding the remainder.
2. The histogram of piece lengths (at most ``MAX_TOKENS`` numbers, whatever the data)
   reaches the driver, and the whole packing is decided on it:
   * lengths of at least ``capacity / SMALL`` are large; sorted downwards they are split
     into ``GROUPS`` groups of equal cardinality and rounded up to their group's longest;
   * the rounded problem has few sizes, so its configurations (multisets of sizes that fit
     a sequence) are optimised by column generation: a linear programme over the
     configurations found so far, and a knapsack over its dual prices for the next one;
   * whole multiples of the configurations are opened and the group's actual documents
     substituted, longest first; what the rounding down leaves over is placed best fit
     decreasing, then the small lengths, best fit, into the space left;
   * sequences that rounding left with space are packed again, best fit decreasing, where
     that saves sequences; of the plans for several numbers of groups, and that of best fit
     decreasing without groups, the one with the fewest sequences is taken.
   Identical sequences are kept as runs with a count, so the plan's size depends on the
   numbers of groups and lengths alone.
3. The plan becomes, per length, ranges of ranks with their first sequence and offset.
   Pieces are ranked within their length (``cell_ranks``: no task holds a whole length)
   and look their place up in the broadcast plan.

Defined results: NULL text is empty (one piece, the end id); repeated rows are packed
each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.llm.common import cell_ranks, prepare, table
from cohort_engine.llm.token_counts import ADDED, DIGITS, LETTERS, PLAIN_TEXT, SPACES, load_tokenizer

MAX_TOKENS = 2048
END_ID = 0
GROUPS = 24              # groups of large lengths
SMALL = 4                # lengths under capacity / SMALL are small
REFIT = (256, 64, 16, 8)    # sequences with more than capacity / REFIT left are packed again, where that saves some
CACHE = 400_000          # pieces remembered by a worker
ROWS_PER_CELL = 1_000    # rows of one length that a window numbers at once

#: The splitting rule of byte_bpe_50k.json for plain characters (fixed pattern of the vocabulary).
BYTE_PIECES = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+"
               f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: A piece is already split; the ranks encode it whole.
PIECE = r"(?s:.+)"


class IdBytes(dict):
    """Little-endian ids of one pre-token piece, encoded when first seen (at most ``CACHE`` a worker).

    ``path`` is the vocabulary for tokenizers, which encodes every text that is not plain;
    ``ranks_path`` the same vocabulary as ranks, by which single pieces are encoded."""

    def __init__(self, path: str, ranks_path: str):
        super().__init__()
        import tiktoken
        self.tokenizer = load_tokenizer(path)
        self.find = re.compile(BYTE_PIECES).findall
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = tiktoken.Encoding("pieces", pat_str=PIECE, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        if len(self) > CACHE:
            self.clear()
        ids = self.pieces.encode_ordinary(piece)
        self[piece] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.find(t) if PLAIN_TEXT.fullmatch(t) and ADDED not in t else None for t in texts]
        get = self.__getitem__
        return [b"".join(map(get, ps)) if ps is not None else
                np.asarray(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                for t, ps in zip(texts, split)]


_WORKER: dict[tuple[str, str], IdBytes] = {}


def piece_spans(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the remainder first, then full ones."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, paths: tuple[str, str], capacity: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if paths not in _WORKER:
            _WORKER[paths] = IdBytes(*paths)
        for pdf in batches:
            out = []
            for doc, ids in zip(pdf["doc_id"], _WORKER[paths].encode(["" if t is None else t for t in pdf["text"]])):
                ids = memoryview(ids + end)
                for k, (start, n) in enumerate(piece_spans(len(ids) // 4, capacity)):
                    out.append((doc, k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)])))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --------------------------------------------------------------------------- the plan, on counts

def linear_groups(lengths: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) downwards, cut into groups of equal cardinality (a length may be split)."""
    total = sum(lengths.values())
    out: list[list[tuple[int, int]]] = []
    left = 0
    for i, length in enumerate(sorted(lengths, reverse=True)):
        n = lengths[length]
        while n:
            if not left:
                out.append([])
                left = (total * len(out)) // groups - (total * (len(out) - 1)) // groups
                if not left:
                    out.pop()
                    left = 1
                    out.append([])
            take = min(n, left)
            out[-1].append((length, take))
            n, left = n - take, left - take
    return out


def best_configuration(sizes: np.ndarray, prices: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity of the highest total price (knapsack over the capacity)."""
    value = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    order = [k for k in range(len(sizes)) if prices[k] > 1e-12]
    for c in range(int(sizes.min()), capacity + 1):
        if value[c - 1] > value[c]:
            value[c], last[c] = value[c - 1], -1
        fit = [k for k in order if sizes[k] <= c]
        if fit:
            gains = value[c - sizes[fit]] + prices[fit]
            k = int(np.argmax(gains))
            if gains[k] > value[c] + 1e-12:
                value[c], last[c] = gains[k], fit[k]
    config, c = np.zeros(len(sizes), int), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            config[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(value[capacity]), config


def optimise(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, float]]:
    """Column generation for  min sum x, sum configurations * x = demand, x >= 0.

    A revised simplex over at most ``len(sizes)`` basic configurations; each round prices
    one new configuration by the knapsack and pivots it in.  ``rounds`` bounds the work:
    stopping early costs sequences, never correctness.
    """
    basis = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    x = demand / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, config = best_configuration(sizes, prices, demand, capacity)
        if value <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, config)
        up = direction > 1e-10
        if not up.any():
            break
        ratios = np.where(up, x / np.where(up, direction, 1), np.inf)
        leave = int(np.argmin(ratios))
        step = ratios[leave]
        x = np.maximum(x - step * direction, 0)
        x[leave] = step
        basis[:, leave] = config
    return [(basis[:, j].astype(int), float(x[j])) for j in range(len(sizes))]


class Runs:
    """Open sequences as runs of identical ones: free space -> [(contents, count)]."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.free: dict[int, Counter] = defaultdict(Counter)
        self.order: list[int] = []

    def add(self, contents: tuple[int, ...], n: int) -> None:
        room = self.capacity - sum(contents)
        if not self.free[room]:
            insort(self.order, room)
        self.free[room][contents] += n

    def take(self, room: int) -> Counter:
        self.order.remove(room)
        return self.free.pop(room)

    def copy(self) -> Runs:
        out = Runs(self.capacity)
        out.order = list(self.order)
        for room, runs in self.free.items():
            out.free[room] = Counter(runs)
        return out

    def total(self) -> int:
        return sum(n for runs in self.free.values() for n in runs.values())

    def best_fit(self, length: int, n: int) -> None:
        """Place ``n`` items of one length, each where the least space remains."""
        while n:
            at = bisect_left(self.order, length)
            if at == len(self.order):            # no open sequence has room: new ones
                each = self.capacity // length
                if n // each:
                    self.add((length,) * each, n // each)
                if n % each:
                    self.add((length,) * (n % each), 1)
                return
            each = self.order[at] // length
            for contents, m in self.take(self.order[at]).items():
                full = min(m, n // each)         # of these sequences take a whole share,
                part = n % each if full < m and n < m * each else 0      # one the last few
                for items, times in ((each, full), (part, bool(part)), (0, m - full - bool(part))):
                    if times:
                        self.add(contents + (length,) * items, times)
                n -= full * each + part


def plan_sequences(histogram: dict[int, int], capacity: int, groups: int = GROUPS, small: int = SMALL) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), for every piece of the histogram: the best of several group
    numbers, and of one group for each length, which is best fit decreasing alone."""
    plans = [grouped_plan(histogram, capacity, n, small) for n in (groups, 2 * groups)]
    plain = Runs(capacity)
    best_fit_all(plain, Counter(histogram))
    runs = min([*plans, plain], key=Runs.total)
    return [(c, n) for room in runs.order for c, n in runs.free[room].items()]


def grouped_plan(histogram: dict[int, int], capacity: int, groups: int, small: int) -> Runs:
    runs = Runs(capacity)
    if histogram.get(capacity):
        runs.add((capacity,), histogram[capacity])
    large = {k: n for k, n in histogram.items() if capacity // small <= k < capacity}
    rest: Counter = Counter()
    if large:
        grouped = linear_groups(large, groups)
        by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for g in grouped:
            by_size[g[0][0]] += g
        sizes = np.array(sorted(by_size, reverse=True))
        stock = [list(by_size[s]) for s in sizes]
        demand = np.array([sum(n for _, n in st) for st in stock], float)
        for config, x in sorted(optimise(sizes, demand, capacity), key=lambda c: -c[1]):
            times = int(x + 1e-9)
            slots = [k for k in range(len(sizes)) for _ in range(config[k])]
            for k in set(slots):
                times = min(times, sum(n for _, n in stock[k]) // slots.count(k))
            substitute(runs, stock, slots, times)
        for st in stock:
            rest.update(dict_of(st))
    rest.update({k: n for k, n in histogram.items() if k < capacity // small})
    best_fit_all(runs, rest)
    for share in REFIT:                          # sequences with that much space left are packed again
        again = runs.copy()
        loose: Counter = Counter()
        for room in [r for r in again.order if r * share >= capacity]:
            for contents, n in again.take(room).items():
                for length in contents:
                    loose[length] += n
        best_fit_all(again, loose)
        if again.total() < runs.total():
            runs = again
    return runs


def best_fit_all(runs: Runs, lengths: Counter) -> None:
    """Best fit decreasing."""
    for length in sorted(lengths, reverse=True):
        runs.best_fit(length, lengths[length])


def dict_of(pairs: list[tuple[int, int]]) -> Counter:
    out: Counter = Counter()
    for k, n in pairs:
        out[k] += n
    return out


def substitute(runs: Runs, stock: list[list[tuple[int, int]]], slots: list[int], times: int) -> None:
    """Open ``times`` sequences of one configuration and fill each slot with its group's
    actual lengths, longest first; a run ends where a slot's length changes."""
    if not times or not slots:
        return
    supply = []
    for k in slots:                              # cut each slot's share off its group's stock
        share, left = [], times
        while left:
            length, n = stock[k][0]
            take = min(n, left)
            share.append([length, take])
            left -= take
            if take == n:
                stock[k].pop(0)
            else:
                stock[k][0] = (length, n - take)
        supply.append(share)
    done = 0
    while done < times:
        step = min(s[0][1] for s in supply)
        runs.add(tuple(s[0][0] for s in supply), step)
        for s in supply:
            s[0][1] -= step
            if not s[0][1]:
                s.pop(0)
        done += step


def rank_ranges(sequences: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, first sequence, offset) of every slot, ranks upwards.

    Ranks of a length are handed out slot by slot; the k-th sequence of a run takes the
    k-th rank of each of its slots."""
    used: Counter = Counter()
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    first = 0
    for contents, n in sequences:
        offset = 0
        for length in contents:
            out[length].append((used[length], first, offset))
            used[length] += n
            offset += length
        first += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, length``) with ``sequence_id`` and ``offset``.

    ``pieces`` is read twice; pass a checkpoint."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = rank_ranges(plan_sequences(histogram, capacity, groups))
    spark = pieces.sparkSession
    sizes = spark.createDataFrame([(int(k), int(n)) for k, n in histogram.items()], "length long, _of_length long")
    ranked = cell_ranks(pieces.join(F.broadcast(sizes), "length"), ["length"],
                        F.ceil(F.col("_of_length") / ROWS_PER_CELL), ["doc_id", "piece"]).drop("_of_length")
    shared = spark.sparkContext.broadcast(ranges)     # bounded by groups and lengths
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        for pdf in batches:
            seq, off = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
            rank, length = pdf["rank"].to_numpy(), pdf["length"].to_numpy()
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                rows = plan[int(k)]
                i = np.searchsorted(rows[:, 0], rank[at], "right") - 1
                seq[at] = rows[i, 1] + rank[at] - rows[i, 0]
                off[at] = rows[i, 2]
            yield pdf.assign(sequence_id=seq, offset=off)

    return ranked.mapInPandas(place, schema).drop("rank")


def op4_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    import public_tokenizers
    pieces = token_pieces(docs, paths or (public_tokenizers.path("byte_bpe_50k.json"),
                                          public_tokenizers.path("byte_bpe_50k.tiktoken"))).checkpoint()
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
