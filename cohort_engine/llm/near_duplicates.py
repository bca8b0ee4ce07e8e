"""MinHash near-duplicates by an LSH forest.

1. A text becomes the set of its distinct four-word shingles (64-bit hashes), a digest
   of that set and ``TREES * ROOT`` minhashes.  Equal sets form a class with a number of its
   own (grouped minimum, so a class of any size is one row); from here on only classes are
   compared.
2. Forest: tree t orders all classes by the signature read from its own place on; classes
   that share their first ``ROOT`` minhashes, the shallowest prefix at which a pair counts,
   with no other class of the tree are left out.  The order is a range-partitioned sort, so
   a region of any density is spread over tasks.  In every order a class's candidates are
   its nearest ``NEIGHBOURS`` on both sides within its region.  Sorted neighbours are those
   of the longest common prefix, so the depth at which pairs meet adapts by itself: shallow
   where a region is sparse, as deep as the signatures go where it is dense.  Partition
   edges are paired in a second small step.  Two sets of similarity 0.8 meet at depth
   ``ROOT`` in some order but for 3 in a million.
3. Two bits of every minhash travel along, and a pair whose bits agree in under ``AGREE`` of
   the places (five standard deviations off 0.8) is dropped where it is found.
4. Confirmation on whole sets, by hubs: sets are made from the texts where they are needed,
   those of a hub's partners and the hub's own meet in tasks of bounded size, and nothing
   is stored.  First every class with its candidate of the most candidates (near copies
   have such a hub in common); then one pair for every two components that candidates
   connect; then all other pairs of different components.
5. Components of the confirmed links by large-star and small-star steps.
6. A region of more than ``NEIGHBOURS + 1`` classes is crowded: some of its pairs were never
   neighbours.  If its classes are of one component, nothing can be missing; in all other
   crowded regions every two classes of different components are compared on whole sets, in
   blocks (``crowded_links``).

Tables between steps are written compressed to the shared folder and deleted after their
last reader.  Candidates of the forest are linear in the number of classes: at most
``TREES * NEIGHBOURS`` each.  Step 6 passes links only on, but compares in the worst case (a
dense region of unlinked texts) as many pairs as the region has.

Defined results: NULL, empty and white-space texts have an empty set, no links, and
themselves as component; equal rows that repeat a doc_id belong to one component, rows of
one doc_id with different texts each to that of their text; a row without doc_id links
nothing, has a NULL component and is kept; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import prepare, table
from cohort_engine.llm.components import connected_components
from cohort_engine.llm.scratch import Scratch

SHINGLE = 4
PERCENT = 80             # 100 * intersection >= PERCENT * union
TREES, ROOT, DEPTH = 24, 4, 12
HASHES = TREES * ROOT
NEIGHBOURS = 4
AGREE = 0.67             # share of places whose two bits agree: 0.85 expected at similarity 0.8, standard deviation 0.036
DEAL_SHINGLES = 1 << 20  # shingles of a hub's partners that meet in one task, about
BLOCK = 2048             # shingles hashed at once
DEAL_MEMBERS = 4096      # classes of one block of a crowded region at most, about
COLUMNS = 2048           # shingles whose holders are counted at once
BROADCAST_IDS = 500_000  # ids (8 bytes each) broadcast at most

_rng = np.random.default_rng(7)
MULTIPLY = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)
ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
PLACES = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    from xxhash import xxh3_64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()      # ASCII lower case, ASCII white space
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, SHINGLE)
    s = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        s += mix(h[j:n - k + 1 + j]) * PLACES[j]
    return np.unique(mix(s))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minhashes (uint32) of a non-empty set."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), BLOCK):
        y = x[at:at + BLOCK, None] * MULTIPLY + ADD
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x45D9F3B3)
        np.minimum(best, y.min(axis=0), out=best)
    return best


def set_digest(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingle_set(t) for t in pdf["text"]]
        yield pdf.drop(columns="text").assign(**{
            "n_shingles": [len(s) for s in sets],
            "digest": [set_digest(s) if len(s) else None for s in sets],
            "sig": [signature(s).astype("<u4").tobytes() if len(s) else None for s in sets]})


def region_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each class and tree: its place in that tree's order as three numbers of four 16-bit minhashes, and
    two bits of all its minhashes as three numbers; ``id`` and other whole numbers of the class travel along."""
    turn = (np.arange(TREES)[:, None] * ROOT + np.arange(DEPTH)[None, :]) % HASHES
    shift = 2 * np.arange(32, dtype=np.uint64)
    for pdf in batches:
        if not len(pdf):
            continue
        whole = np.frombuffer(b"".join(pdf["sig"]), "<u4").reshape(len(pdf), HASHES)
        keys = (whole.astype(np.uint64) & np.uint64(0xFFFF))[:, turn].reshape(len(pdf), TREES, 3, 4)
        packed = ((keys[..., 0] << np.uint64(48)) | (keys[..., 1] << np.uint64(32)) | (keys[..., 2] << np.uint64(16)) | keys[..., 3]).view(np.int64)
        bits = ((whole >> 30).astype(np.uint64).reshape(len(pdf), 3, 32) << shift).sum(axis=2, dtype=np.uint64).view(np.int64)
        yield pd.DataFrame({"tree": np.tile(np.arange(TREES, dtype=np.int32), len(pdf)),
                            "k0": packed[..., 0].ravel(), "k1": packed[..., 1].ravel(), "k2": packed[..., 2].ravel(),
                            "b0": np.repeat(bits[:, 0], TREES), "b1": np.repeat(bits[:, 1], TREES), "b2": np.repeat(bits[:, 2], TREES),
                            **{c: np.repeat(pdf[c].to_numpy(np.int64), TREES) for c in pdf.columns if c != "sig"}})


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether enough of the two-bit places of the rows agree."""
    differ = (x ^ y).view(np.uint64)
    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return np.bitwise_count(differ).sum(axis=1) <= (1 - AGREE) * HASHES


def sorted_pairs(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    tree, k0, ids, bits = rows["tree"].to_numpy(), rows["k0"].to_numpy(), rows["id"].to_numpy(np.int64), rows[["b0", "b1", "b2"]].to_numpy(np.int64)
    left, right = [], []
    for d in range(1, NEIGHBOURS + 1):
        i = np.flatnonzero((tree[d:] == tree[:-d]) & (k0[d:] == k0[:-d]) & (ids[d:] != ids[:-d]))
        i = i[agreeing(bits[i], bits[i + d])]
        left.append(ids[i])
        right.append(ids[i + d])
    return np.concatenate(left), np.concatenate(right)


PAIR_SCHEMA = "id long, other long, edge int, tree int, k0 long, b0 long, b1 long, b2 long, place int"


def neighbour_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of neighbours of one sorted partition, and its first and last rows for the edges to the next ones."""
    def edge(rows: pd.DataFrame, number: int, side: int) -> pd.DataFrame:
        return rows[["id", "tree", "k0", "b0", "b1", "b2"]].assign(other=np.int64(0), edge=number, place=side * NEIGHBOURS + np.arange(len(rows)))

    part, tail, first = TaskContext.get().partitionId(), None, True
    for pdf in batches:
        if not len(pdf):
            continue
        if first:
            yield edge(pdf.head(NEIGHBOURS), part - 1, 1)
            first = False
        now = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
        a, b = sorted_pairs(now)
        tail = now.tail(NEIGHBOURS)
        yield pd.DataFrame({"id": a, "other": b, "edge": -2, "tree": 0, "k0": np.int64(0), "b0": np.int64(0), "b1": np.int64(0), "b2": np.int64(0), "place": 0})
    if tail is not None:
        yield edge(tail, part, 0)


def edge_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    a, b = sorted_pairs(rows.sort_values("place"))
    return pd.DataFrame({"id": a, "other": b})


def shared_regions(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(tree, k0, members)``: the regions of the trees that hold several classes."""
    rows = classes.select("id", "sig").mapInPandas(region_rows, REGION_SCHEMA).select("tree", "k0")
    return scratch.put(rows.groupBy("tree", "k0").agg(F.count("*").alias("members")).where("members > 1"), "regions")


REGION_SCHEMA = "tree int, k0 long, k1 long, k2 long, b0 long, b1 long, b2 long, id long"


def forest_candidates(classes: DataFrame, regions: DataFrame, scratch: Scratch) -> DataFrame:
    """``(a, b)``: pairs of classes that are neighbours in some order and agree well enough; a > b."""
    rows = classes.select("id", "sig").mapInPandas(region_rows, REGION_SCHEMA).join(regions.select("tree", "k0"), ["tree", "k0"], "left_semi")
    order = ["tree", "k0", "k1", "k2", "id"]
    columns = [f.split()[0] for f in REGION_SCHEMA.split(", ")]
    sorted_rows = scratch.put(rows.select(*columns), "rows").repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = scratch.put(sorted_rows.mapInPandas(neighbour_pairs, PAIR_SCHEMA), "scanned")
    scratch.drop("rows")
    edges = scanned.where("edge > -2").groupBy("edge").applyInPandas(edge_pairs, "id long, other long")
    pairs = scanned.where("edge = -2").select("id", "other").unionByName(edges)
    found = scratch.put(pairs.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct(), "pairs")
    scratch.drop("scanned")
    return found


def texts_of(docs: DataFrame, roles: DataFrame) -> DataFrame:
    """``roles`` (doc, digest, ...) with the texts of rows of that doc_id; the roles are broadcast where they are counted to be few."""
    roles = F.broadcast(roles) if roles.count() <= BROADCAST_IDS else roles
    return docs.select(F.col("doc_id").alias("doc"), "text").join(roles, "doc")


def made_sets(pdf: pd.DataFrame, seen: set, keys: list[str]) -> tuple[pd.DataFrame, list[np.ndarray]]:
    """The rows whose text has the set of their class, each once a task, with that set (an id may stand on other texts and on repeated rows)."""
    made: dict[tuple, np.ndarray] = {}
    keep, sets = [], []
    for row in zip(range(len(pdf)), pdf["text"], pdf["digest"], *(pdf[k] for k in keys)):
        at, text, digest, *key = row
        if tuple(key) in seen:
            continue
        if (key[0], text) not in made:
            made[key[0], text] = shingle_set(text)
        x = made[key[0], text]
        if set_digest(x) == digest:
            seen.add(tuple(key))
            keep.append(at)
            sets.append(x)
    return pdf.iloc[keep], sets


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(hub, id)``: those of the pairs whose whole sets are similar enough.

    A hub's partners are dealt to as many tasks as their shingles need, the hub's set goes to each of them."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for pdf in batches:
            rows, made = made_sets(pdf, seen, ["id", "hub", "deal"])
            yield rows[["id", "hub", "deal"]].assign(shingles=[x.tobytes() for x in made])

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hub, _ = key
        own = np.frombuffer(rows.loc[rows["id"] == hub, "shingles"].iloc[0], np.uint64)
        keep = []
        for i, raw in zip(rows["id"], rows["shingles"]):
            x = np.frombuffer(raw, np.uint64)
            both = len(np.intersect1d(x, own, assume_unique=True))
            keep.append(i != hub and 100 * both >= PERCENT * (len(x) + len(own) - both))
        return rows.loc[keep, ["hub", "id"]]

    own = classes.select("id", "n_shingles", "digest", "doc")
    load = F.ceil((F.sum("n_shingles") + 1) / DEAL_SHINGLES).cast("int")
    partners = scratch.put(pairs.join(own, "id").select("id", "hub", "n_shingles", "digest", "doc"), f"{name}-partners")
    deals = partners.groupBy("hub").agg(load.alias("deals"))
    many = scratch.put(deals.where("deals > 1"), f"{name}-many")           # mostly none: partners of over DEAL_SHINGLES shingles together
    if many.isEmpty():
        dealt = partners.withColumn("deal", F.lit(0))
    else:
        dealt = (partners.join(F.broadcast(many), "hub", "left")
                 .withColumn("deal", F.pmod(F.xxhash64("id"), F.coalesce("deals", F.lit(1))).cast("int")))
    dealt = dealt.select("id", "hub", "deal", "digest", "doc")
    hubs = (dealt.select("hub", "deal").distinct().join(own.select(F.col("id").alias("hub"), "digest", "doc"), "hub")
            .select(F.col("hub").alias("id"), "hub", "deal", "digest", "doc"))
    roles = scratch.put(dealt.unionByName(hubs), f"{name}-roles")
    out = scratch.put(texts_of(docs, roles).mapInPandas(sets, "id long, hub long, deal int, shingles binary").groupBy("hub", "deal")
                      .applyInPandas(compare, "hub long, id long"), f"{name}-links")
    scratch.drop(f"{name}-partners", f"{name}-many", f"{name}-roles")
    return out


def mixed_regions(classes: DataFrame, regions: DataFrame, components: DataFrame) -> DataFrame:
    """(tree, k0, id, component): the classes of crowded regions whose classes are of several components."""
    # a class gets its component once, before it stands in a region of every tree
    placed = (classes.select("id", "sig").join(components.withColumnRenamed("node", "id"), "id", "left")
              .select("id", "sig", F.coalesce("component", "id").alias("component")))
    rows = (placed.mapInPandas(region_rows, f"{REGION_SCHEMA}, component long").select("tree", "k0", "id", "component")
            .join(regions.where(F.col("members") > NEIGHBOURS + 1).select("tree", "k0"), ["tree", "k0"], "left_semi"))
    mixed = rows.groupBy("tree", "k0").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return rows.join(mixed, ["tree", "k0"], "left_semi").select("tree", "k0", "id", "component")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of their 0/1 rows over a few shingles at a time."""
    _, code, held = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    shared = held[code] > 1
    code, row = code[shared], row[shared]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    out = np.zeros((len(a), len(b)), np.float32)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
    column = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code))))
    for at in range(0, len(first), COLUMNS):
        lo, hi = first[at], first[at + COLUMNS] if at + COLUMNS < len(first) else len(code)
        x = np.zeros((len(a) + len(b), COLUMNS), np.float32)
        x[row[lo:hi], column[lo:hi] - at] = 1
        out += x[:len(a)] @ x[len(a):].T
    return out.astype(np.int64)


def spanning(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Those of the pairs that join what earlier ones leave apart."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def crowded_links(rows: DataFrame, classes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(hub, id): links between different components within the regions of ``rows`` (tree, k0, id, component).

    All classes of a region are compared on whole sets.  A region's classes are dealt to blocks of bounded size, and
    every two blocks meet in a task of their own, which passes on what joins components, not every pair."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for pdf in batches:
            kept, made = made_sets(pdf, seen, ["id", "tree", "k0", "x", "y"])
            yield kept[["id", "component", "tree", "k0", "x", "y", "own"]].assign(shingles=[m.tobytes() for m in made])

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("id")
        left, right = part[part["own"] == key[2]], part[part["own"] == key[3]]
        a, b = ([np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (left, right))
        if not a or not b:
            return pd.DataFrame({"hub": [], "id": []})
        both = shared_counts(a, b)
        sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
        near = (100 * both >= PERCENT * (sizes - both)) & (left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :])
        i, j = np.nonzero(near)
        found = spanning(np.column_stack([left["id"].to_numpy()[i], right["id"].to_numpy()[j]]))
        return pd.DataFrame(found, columns=["hub", "id"])

    own = rows.join(classes.select("id", "n_shingles", "digest", "doc"), "id")
    blocks = F.ceil(F.greatest(F.sum("n_shingles") / DEAL_SHINGLES, F.count("*") / DEAL_MEMBERS)).cast("int")
    load = own.groupBy("tree", "k0").agg(blocks.alias("blocks"))
    dealt = own.join(load, ["tree", "k0"]).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    with_other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    roles = scratch.put(with_other.select("id", "component", "tree", "k0", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "digest", "doc"), "roles")
    met = texts_of(docs, roles).mapInPandas(sets, "id long, component long, tree int, k0 long, x int, y int, own int, shingles binary")
    return met.groupBy("tree", "k0", "x", "y").applyInPandas(compare, "hub long, id long")


def hubs_first(pairs: DataFrame) -> DataFrame:
    """``(hub, id, rank)``: every pair from its class of fewer candidates to the one of more."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count("*").alias("n"))
    rank_a, rank_b = F.struct("n_a", (-F.col("a")).alias("id")), F.struct("n_b", (-F.col("b")).alias("id"))
    known = pairs.join(degree.withColumnRenamed("n", "n_a"), "a").join(degree.select(F.col("a").alias("b"), F.col("n").alias("n_b")), "b")
    up = rank_b > rank_a
    return known.select(F.when(up, F.col("b")).otherwise(F.col("a")).alias("hub"), F.when(up, F.col("a")).otherwise(F.col("b")).alias("id"),
                        F.greatest("n_a", "n_b").alias("rank"))


def joined_up(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) with further links (hub, id)."""
    roots = parts.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(roots.unionByName(links.select(F.col("id").alias("a"), F.col("hub").alias("b"))))


def apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (hub, id) of different components (ch, ci)."""
    of_hub = parts.select(F.col("node").alias("hub"), F.col("component").alias("ch"))
    of_id = parts.select(F.col("node").alias("id"), F.col("component").alias("ci"))
    return pairs.join(of_hub, "hub", "left").join(of_id, "id", "left").select("hub", "id", F.coalesce("ch", "hub").alias("ch"), F.coalesce("ci", "id").alias("ci")).where("ch <> ci")


def links(classes: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of the classes that are linked to another one."""
    regions = shared_regions(classes, scratch)
    found = forest_candidates(classes, regions, scratch)
    pairs = scratch.put(hubs_first(found), "hubs")
    scratch.drop("pairs")
    one_each = pairs.groupBy("id").agg(F.max_by("hub", F.struct("rank", (-F.col("hub")).alias("first"))).alias("hub"))
    first = confirmed(one_each, classes, docs, scratch, "first")
    parts = scratch.put(connected_components(first.select(F.col("id").alias("a"), F.col("hub").alias("b"))), "parts0")
    # one pair for every two components: near copies in many small components come together here
    left = scratch.put(apart(pairs.select("hub", "id"), parts), "left")
    scratch.drop("hubs")
    bridges = scratch.put(left.groupBy(F.least("ch", "ci").alias("low"), F.greatest("ch", "ci").alias("high"))
                          .agg(F.min(F.struct("hub", "id")).alias("pair")).select("pair.hub", "pair.id"), "bridges")
    parts = scratch.put(joined_up(parts, confirmed(bridges, classes, docs, scratch, "bridge")), "parts1")
    # only pairs that are neither within a component nor compared yet are looked up again
    unseen = left.select("hub", "id").join(bridges, ["hub", "id"], "left_anti")
    other = scratch.put(apart(unseen, parts).select("hub", "id"), "other")
    scratch.drop("left", "parts0", "bridges")
    second = scratch.put(joined_up(parts, confirmed(other, classes, docs, scratch, "more")), "parts2")
    scratch.drop("other", "parts1", "first-links", "bridge-links", "more-links")
    crowded = scratch.put(mixed_regions(classes, regions, second), "crowded")
    scratch.drop("regions")
    missed = scratch.put(crowded_links(crowded, classes, docs, scratch), "missed")
    scratch.drop("crowded", "roles")
    return second if missed.isEmpty() else scratch.put(joined_up(second, missed), "parts3")


def near_duplicates(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document, and the columns to ``carry`` along."""
    scratch = Scratch(docs.sparkSession, "near")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[2:])
    made = given.withColumn("_id", F.col("doc_id").cast("string")).drop("doc_id").mapInPandas(sketch, f"_id string, n_shingles long, digest binary, sig binary{kinds}")
    sketches = scratch.put(made.withColumn("doc_id", F.col("_id").cast("long")).drop("_id"), "sketches")
    classes = scratch.put(sketches.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
                          .agg(F.min("doc_id").alias("doc"), F.count("*").alias("members"), F.min_by("sig", "doc_id").alias("sig"),
                               F.first("n_shingles").alias("n_shingles"))
                          .withColumn("id", F.monotonically_increasing_id()), "classes")        # written, so it stays
    rows = scratch.put(sketches.drop("sig"), "documents")
    scratch.drop("sketches")
    linked = links(classes, given, scratch)
    # only classes of several members or with links need a look-up; the others are their own component
    parts = classes.join(linked, F.col("id") == F.col("node"), "left")
    smallest = parts.where("node IS NOT NULL").groupBy("component").agg(F.min("doc").alias("component_id"))
    known = scratch.put(parts.where("members > 1 OR node IS NOT NULL").select("digest", "doc", "component").join(smallest, "component", "left")
                        .select("digest", F.coalesce("component_id", "doc").alias("component")), "known")
    scratch.drop("classes", "parts2", "parts3")
    return (rows.select("doc_id", "n_shingles", "digest", *carry).join(known, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), *carry)
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "n_shingles", "component_id", "kept", *carry))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Brute force: all pairs that share a shingle, and the closure of their links.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i + 1, i + least(4, len(ws))), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - least(4, len(ws)) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ways AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.i >= 80 * (na.n + nb.n - p.i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
