"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

Vectors are dealt into shards of about ``SHARD_ROWS`` rows by the hash of their id, so a
vector that many rows share is spread too.  Each shard is one graph: its distinct
vectors, the levels drawn from the shard's own generator, and for every level one flat
array of neighbour positions (``degree`` slots a node, -1 for none).  Graphs are rows of
an index table in the shared folder.  Queries travel in blocks to every shard, where a
graph is loaded once for ``BLOCKS`` of them; a block is searched by walking all its queries
at once, and the shards' nearest are merged.

Nearness is the inner product.  For the graph, vectors get one more component that
makes all lengths equal (sqrt(max - |v|^2)), which turns it into an angle without
changing the order for a query; reported scores are computed from the original vectors
in double precision, summed alike for equal vectors, so ties are exact.

Copies of a vector in a shard share one node that lists all their ids; every one of them
is a candidate.  A query asks for one more than ``k`` because it finds itself.

Defined results: vectors that are NULL, empty, zero, of another dimension than most, or
hold NULL or non-finite components take no part; rows that repeat an id are found once
each, and as queries are asked once, with the smallest of their vectors; fewer than ``k`` candidates give all of them; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import pickle
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_engine.llm.common import prepare, table

SHARD_ROWS = 16_384      # rows of a shard, on average
QUERY_BLOCK = 1024       # queries that travel together
BLOCKS = 64              # blocks that a loaded graph answers at once
DEGREE = 24              # neighbours of a node on upper levels; twice as many on the lowest
BUILD_WIDTH = 64         # candidates kept while a node is linked
SEARCH_WIDTH = 96        # candidates kept while a query is answered
INSERT = 128             # nodes linked at once (they also see each other)


class Graph:
    """One shard's graph over distinct vectors (rows of ``x``, all of the same length)."""

    def __init__(self, x: np.ndarray, seed: int, degree: int = DEGREE):
        self.x = np.ascontiguousarray(x, np.float32)
        rng = np.random.default_rng(seed)
        n = len(x)
        level = np.minimum((-np.log(1 - rng.random(n)) / np.log(degree)).astype(int), 5)
        level[:1] = max(level.max(initial=0), 0)                     # the entry reaches the top
        self.level, self.degree = level, degree
        self.flat = [np.full((n, degree * (2 if k == 0 else 1)), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)]

    def build(self, width: int = BUILD_WIDTH) -> Graph:
        n, done = len(self.x), 1
        while done < n:
            batch = np.arange(done, min(n, done + min(INSERT, max(1, done))))
            self.insert(batch, width)
            done = batch[-1] + 1
        return self

    def insert(self, batch: np.ndarray, width: int) -> None:
        entry = np.zeros(len(batch), np.int64)
        for k in range(len(self.flat) - 1, -1, -1):
            mine = self.level[batch] >= k
            found, sims = self.walk(self.x[batch], entry, k, width if mine.any() else 1)
            entry = found[:, 0]
            at = np.flatnonzero(mine)
            if not len(at):
                continue
            nodes = batch[at]
            among = self.x[nodes] @ self.x[nodes].T              # nodes of the batch see each other
            np.fill_diagonal(among, -np.inf)
            near = min(len(nodes), 16)
            mates = np.argpartition(-among, near - 1, axis=1)[:, :near]
            cand = np.concatenate([found[at], nodes[mates]], axis=1)
            sim = np.concatenate([sims[at], np.take_along_axis(among, mates, 1)], axis=1)
            order = np.argsort(-sim, axis=1, kind="stable")
            cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
            cand[~np.isfinite(sim)] = -1
            chosen = self.spread(cand, sim, self.degree)
            self.flat[k][nodes, :chosen.shape[1]] = chosen
            self.link_back(k, nodes, chosen)

    def spread(self, cand: np.ndarray, sim: np.ndarray, keep: int) -> np.ndarray:
        """Of each row's candidates (best first), those nearer to the row than to a kept one;
        remaining slots go to the best of the others."""
        rows, width = cand.shape
        v = self.x[np.maximum(cand, 0)]
        mutual = v @ v.transpose(0, 2, 1)
        valid = cand >= 0
        kept = np.zeros((rows, width), bool)
        for j in range(width):
            blocked = (kept & (mutual[:, j, :] > sim[:, j, None])).any(axis=1)
            kept[:, j] = valid[:, j] & ~blocked & (kept.sum(axis=1) < keep)
        rank = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :keep]
        out = np.take_along_axis(cand, rank, 1)
        return np.where(np.take_along_axis(valid, rank, 1), out, -1)

    def link_back(self, k: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        """Add the reverse links; a node with no free slot keeps the best spread of all."""
        flat, slots = self.flat[k], self.flat[k].shape[1]
        src = np.repeat(nodes, chosen.shape[1])
        dst = chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        targets, first, count = np.unique(dst, return_index=True, return_counts=True)
        full = []
        for t, i, c in zip(targets, first, count):
            used = int((flat[t] >= 0).sum())
            new = src[i:i + c]
            new = new[~np.isin(new, flat[t])]
            if used + len(new) <= slots:
                flat[t, used:used + len(new)] = new
            else:
                full.append((t, np.concatenate([flat[t, :used], new])))
        if full:
            width = max(len(c) for _, c in full)
            cand = np.full((len(full), width), -1, np.int64)
            for i, (_, c) in enumerate(full):
                cand[i, :len(c)] = c
            at = np.array([t for t, _ in full])
            sim = np.einsum("rcd,rd->rc", self.x[np.maximum(cand, 0)], self.x[at])
            sim[cand < 0] = -np.inf
            order = np.argsort(-sim, axis=1, kind="stable")
            best = self.spread(np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1), slots)
            flat[at] = -1
            flat[at, :best.shape[1]] = best

    def walk(self, q: np.ndarray, entry: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries at once on level k: (positions, similarities), best first."""
        flat, n = self.flat[k], len(q)
        rows = np.arange(n)
        pool = np.full((n, width), -1, np.int64)
        sims = np.full((n, width), -np.inf, np.float32)
        open_ = np.zeros((n, width), bool)
        pool[:, 0], sims[:, 0], open_[:, 0] = entry, np.einsum("nd,nd->n", q, self.x[entry]), True
        seen = np.zeros((n, len(self.x)), bool)
        seen[rows, entry] = True
        live = rows
        while len(live):
            best = np.where(open_[live], sims[live], -np.inf).argmax(axis=1)
            going = open_[live, best]
            live, best = live[going], best[going]
            if not len(live):
                break
            open_[live, best] = False
            near = flat[pool[live, best]]
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            seen[live[r], near[r, c]] = True
            sim = np.full(near.shape, -np.inf, np.float32)
            sim[r, c] = np.einsum("nd,nd->n", q[live[r]], self.x[near[r, c]])
            cat_s = np.concatenate([sims[live], sim], axis=1)
            top = np.argpartition(-cat_s, width - 1, axis=1)[:, :width]
            cat_p = np.concatenate([pool[live], np.where(fresh, near, -1)], axis=1)
            cat_o = np.concatenate([open_[live], fresh], axis=1)
            sims[live] = np.take_along_axis(cat_s, top, 1)
            pool[live] = np.take_along_axis(cat_p, top, 1)
            open_[live] = np.take_along_axis(cat_o, top, 1) & np.isfinite(sims[live])
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(pool, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        entry = np.zeros(len(q), np.int64)
        for k in range(len(self.flat) - 1, 0, -1):
            entry = self.walk(q, entry, k, 1)[0][:, 0]
        return self.walk(q, entry, 0, width)[0]


def longest(vectors: DataFrame) -> float:
    """The largest squared length, over all vectors."""
    return vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0


def clean_vectors(rows: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v) of the usable vectors, as doubles, of the most frequent dimension."""
    v = F.col(column).cast("array<double>")
    good = (rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND size(v) > 0")
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
            .where(F.exists("v", lambda x: x != 0)))
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return good.where(F.size("v") == (sizes["d"] if sizes else 0))


def shard_of(shards: int):
    return F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")


def build_index(vectors: DataFrame, shards: int, top: float, degree: int = DEGREE) -> DataFrame:
    """(shard, graph): one row per shard; every vector is in a graph."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        rows = rows.sort_values("id")
        v = np.stack(rows["v"].to_numpy())
        unique, which = np.unique(v, axis=0, return_inverse=True)
        which = which.ravel()
        order = np.argsort(which, kind="stable")
        rng = np.random.default_rng(shard)
        shuffled = rng.permutation(len(unique))                  # insertion order free of the vectors' sort order
        lift = np.sqrt(np.maximum(top - np.einsum("nd,nd->n", unique, unique), 0))
        graph = Graph(np.column_stack([unique, lift])[shuffled], shard, degree).build()
        first = np.searchsorted(which[order], np.arange(len(unique) + 1))
        ids = rows["id"].to_numpy()[order]
        packed = pickle.dumps({"flat": graph.flat, "x": graph.x, "unique": unique, "node": shuffled, "first": first, "ids": ids}, protocol=5)
        return pd.DataFrame({"shard": [shard], "graph": [packed]})

    return (vectors.withColumn("shard", shard_of(shards)).repartition(shards, "shard").groupBy("shard")
            .applyInPandas(build, "shard int, graph binary").checkpoint())


def search_graph(g: dict, ids: np.ndarray, q: np.ndarray, k: int, width: int) -> pd.DataFrame:
    """The k nearest of every query in one shard, the query itself left out."""
    graph = Graph.__new__(Graph)
    graph.x, graph.flat = g["x"], g["flat"]
    width = min(max(width, k + 1), len(graph.x))
    out = []
    lifted = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
    for at in range(0, len(q), 128):
        found = graph.search(lifted[at:at + 128], width)
        for i in range(len(found)):
            node = g["node"][found[i][found[i] >= 0]]
            score = (g["unique"][node] * q[at + i]).sum(axis=1)
            best = np.lexsort((g["ids"][g["first"][node]], -score))
            got_ids, got_scores, kept = [], [], 0
            for j in best:                                        # copies of a vector: the smallest k + 1 ids are enough
                copies = g["ids"][g["first"][node[j]]:g["first"][node[j] + 1]]
                copies = copies[copies != ids[at + i]][:k]
                if kept >= k and score[j] < got_scores[-1][0]:
                    break
                if len(copies):
                    got_ids.append(copies)
                    got_scores.append(np.full(len(copies), score[j]))
                    kept += len(copies)
            if got_ids:
                a, s = np.concatenate(got_ids), np.concatenate(got_scores)
                o = np.lexsort((a, -s))[:k]
                out.append(pd.DataFrame({"query_id": ids[at + i], "vec_id": a[o], "score": s[o]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
        {"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})


def nearest(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", column: str = "embedding",
            width: int = SEARCH_WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of every query."""
    vectors = clean_vectors(rows, key, column).checkpoint()
    shards = max(1, -(-vectors.count() // shard_rows))
    index = build_index(vectors, shards, longest(vectors))
    wanted = clean_vectors(queries, key, column).groupBy("id").agg(F.min("v").alias("v")).checkpoint()
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": part["block"].iloc[:1], "ids": [part["id"].to_numpy(np.int64).tobytes()],
                             "q": [np.stack(part["v"].to_numpy()).astype("<f8").tobytes()]})

    def search(blocks: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks) or not len(graphs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        g = pickle.loads(graphs["graph"].iloc[0])
        found = []
        for ids, q in zip(blocks["ids"], blocks["q"]):
            ids = np.frombuffer(ids, np.int64)
            found.append(search_graph(g, ids, np.frombuffer(q, "<f8").reshape(len(ids), -1), k, width))
        return pd.concat(found, ignore_index=True)

    packed = (wanted.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(blocks)).cast("int"))
              .groupBy("block").applyInPandas(pack, "block int, ids binary, q binary"))
    sent = (packed.withColumn("deal", F.floor(F.col("block") / BLOCKS).cast("int"))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    deals = index.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // BLOCKS))))
    found = sent.groupBy("shard", "deal").cogroup(deals.groupBy("shard", "deal")).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0), 20)
