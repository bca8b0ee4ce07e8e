"""Merkle manifest of a dataset: stored every few levels, missing nodes recomputed for proofs.

1. Every row becomes a leaf: the SHA-256 of its columns, each written as ``-`` if NULL, else
   as its UTF-8 byte count, a colon and its value.
2. The leaves of one tree (rows of one ``lang``) are ordered by a range-partitioned sort, so
   a tree of any size is spread over tasks; partition counts turn row numbers into places.
3. A tree's nodes at level l are the hashes of two consecutive ones below (a last one alone
   is hashed alone).  Only every ``STRIDE``-th level is written: a row of the table of level
   ``k * STRIDE`` holds the at most ``2 ** STRIDE`` nodes that one node of the next written
   level covers, an aligned subtree.  The subroots of all trees form one more tree.
4. Proofs go from the top down.  For each aligned subtree the levels in between are made
   again from its stored nodes, every stored node gets its siblings of these levels in front
   of those of the node above, and the levels are forgotten again.  What is joined are whole
   subtrees, one row each, so neither a large tree nor a long path meets in one task.
5. ``fold`` recomputes the root from a leaf and its siblings.

Defined results: a row without ``lang`` belongs to the tree of NULL, which comes first; rows
without doc_id come first in their tree; rows that repeat a doc_id are ordered by their leaf,
and equal rows are leaves of their own at neighbouring places; an empty table has no trees,
no root and no rows; a NULL doc_id is never tampered with; further columns are ignored.
Everything is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_engine.llm.common import prepare, table
from cohort_engine.llm.scratch import Scratch

STRIDE = 8               # levels between two written ones: subtrees of 256 nodes
TAMPERED = 7             # rows whose id's CRC this divides are claimed with another n_chars
STEP = "array<struct<sibling:string,right:boolean>>"


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of the columns' values, one after the other."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def parents(nodes: Column) -> Column:
    """The level above an array of nodes: hashes of two consecutive ones, a last one alone."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) + 1) / 2).cast("int") - 1)
    return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256))


def first_steps(steps: Column) -> Column:
    """[0, 1, .., steps - 1], empty for no steps."""
    return F.slice(F.array(*map(F.lit, range(STRIDE))), F.lit(1), steps)


def levels_between(nodes: Column, steps: Column) -> Column:
    """The levels of one subtree from its stored nodes on, ``steps`` hashings up."""
    return F.aggregate(first_steps(steps), F.array(nodes), lambda levels, _: F.concat(levels, F.array(parents(F.element_at(levels, -1)))))


def siblings(levels: Column, place: Column, steps: Column) -> Column:
    """A stored node's sibling on each level below the subtree's root (NULL: none), and whether the node's side is the right one."""
    def step(level: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(2), level)).cast("int")
        right = at % 2 == 1
        return F.struct(F.get(F.get(levels, level), F.when(right, at - 1).otherwise(at + 1)).alias("sibling"), right.alias("right"))
    return F.transform(first_steps(steps), step)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    def up(node: Column, step: Column) -> Column:
        left, right = F.coalesce(step["sibling"], F.lit("")), step["right"]
        return F.sha2(F.when(right, F.concat(left, node)).otherwise(F.concat(node, left)), 256)
    return F.aggregate(path, leaf, up)


def placed(leaves: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``leaves`` with ``pos``, the place in its tree's order, and ``depth``, the tree's levels above the leaves."""
    keys = ["tree", *order, "node", "_tie"]
    tied = leaves.withColumn("_tie", F.monotonically_increasing_id())      # equal rows may lie in several partitions
    rows = scratch.put(tied.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys))
                       .sortWithinPartitions(*(F.col(k).asc_nulls_first() for k in keys)).drop("_tie")
                       .withColumn("_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("_row", 33).alias("_part")
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("tree", part).agg(F.count("*").alias("n"), F.min("_row").alias("_first"))
    firsts = counts.select("tree", "_part", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
                           F.sum("n").over(Window.partitionBy("tree")).alias("n"))
    depth = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    return (rows.withColumn("_part", part).join(firsts.withColumn("depth", depth), ["tree", "_part"])
            .withColumn("pos", F.col("_before") + F.col("_row") - F.col("_first")).drop("_part", "_row", "_first", "_before", "n"))


@dataclass
class Forest:
    """Merkle trees in the shared folder: ``blocks[k]`` holds level ``k * STRIDE`` by aligned subtrees."""

    blocks: list[DataFrame]
    subroots: DataFrame                # tree, depth, subroot

    def paths(self, tops: DataFrame) -> DataFrame:
        """The leaves, each with its siblings, leaf level first, before those of its tree's row (tree, path, ...) in ``tops``."""
        above = None
        for k in range(len(self.blocks) - 1, -1, -1):
            ends = tops.where((F.col("depth") <= (k + 1) * STRIDE) & (F.col("depth") > (k * STRIDE if k else -1))).withColumn("pos", F.lit(0).cast("long"))
            above = ends if above is None else above.select(*ends.columns).unionByName(ends)
            steps = F.least(F.lit(STRIDE), F.col("depth") - k * STRIDE).cast("int")
            met = self.blocks[k].withColumnRenamed("block", "pos").join(above.withColumnRenamed("path", "_above"), ["tree", "depth", "pos"])
            below = (met.withColumn("_levels", levels_between(F.col("nodes.node"), steps)).withColumn("_steps", steps)
                     .select("*", F.posexplode("nodes").alias("_place", "_node")))
            path = F.concat(siblings(F.col("_levels"), F.col("_place"), F.col("_steps")), F.col("_above"))
            above = (below.withColumn("path", path).drop("_levels", "_steps", "_above", "nodes", "pos")
                     .select("*", "_node.*").drop("_node", "_place"))
        return above


def build(leaves: DataFrame, order: list[str], scratch: Scratch, name: str) -> Forest:
    """Trees of ``leaves`` (tree, node and columns to carry along), ordered by ``order`` in each tree."""
    nodes = placed(leaves, order, scratch, f"{name}-sorted")
    blocks: list[DataFrame] = []
    ends: list[DataFrame] = []
    carried = [c for c in nodes.columns if c not in ("tree", "depth", "pos")]
    while True:
        k = len(blocks)
        grouped = (nodes.groupBy("tree", "depth", F.shiftright("pos", STRIDE).alias("block"))
                   .agg(F.sort_array(F.collect_list(F.struct("pos", *carried))).alias("nodes")))
        blocks.append(scratch.put(grouped, f"{name}-level{k * STRIDE}"))
        scratch.drop(f"{name}-sorted")
        steps = F.least(F.lit(STRIDE), F.col("depth") - k * STRIDE).cast("int")
        top = F.element_at(F.element_at(levels_between(F.col("nodes.node"), steps), -1), 1)
        nodes = scratch.put(blocks[k].select("tree", "depth", F.col("block").alias("pos"), top.alias("node")), f"{name}-next{k + 1}")
        ends.append(nodes.where(F.col("depth") <= (k + 1) * STRIDE).select("tree", "depth", F.col("node").alias("subroot")))
        nodes, carried = nodes.where(F.col("depth") > (k + 1) * STRIDE), ["node"]
        if nodes.isEmpty():
            break
    subroots = ends[0]
    for end in ends[1:]:
        subroots = subroots.unionByName(end)
    return Forest(blocks, scratch.put(subroots, f"{name}-subroots"))


def manifest_proofs(leaves: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Every leaf with ``subroot``, ``root`` and ``path``, its siblings from its level up to the root."""
    forest = build(leaves, order, scratch, "rows")
    whole = build(forest.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("depth").alias("own_depth"), F.col("subroot").alias("node")),
                  ["own"], scratch, "trees")
    roots = whole.subroots.select("tree", "depth", F.col("subroot").alias("root"), F.lit(None).cast(STEP).alias("path"))
    tops = whole.paths(roots.withColumn("path", F.array().cast(STEP)))
    return forest.paths(scratch.put(tops.select(F.col("own").alias("tree"), F.col("own_depth").alias("depth"), F.col("node").alias("subroot"), "root", "path"), "tops"))


def tree_of(lang: Column) -> Column:
    """A key that is never NULL and sorts as lang does, NULL first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def dataset_manifest(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Each row's leaf, subroot, root, proof digest, and the root recomputed for what the row claims to be."""
    c = F.col
    kept = (c("doc_id"), c("source"), c("lang"))
    tampered = F.crc32(c("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    leaves = docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        tree_of(c("lang")).alias("tree"), c("doc_id"), row_hash(*kept, c("n_chars"), c("text")).alias("node"),
        F.when(tampered & c("n_chars").isNotNull(), row_hash(*kept, c("n_chars").cast("long") + 1, c("text"))).alias("claim"))
    proofs = manifest_proofs(scratch.put(leaves, "leaves"), ["doc_id"], scratch)
    return (proofs.withColumn("folded_root", fold(F.coalesce("claim", "node"), c("path")))
            .select("doc_id", c("node").alias("leaf"), "subroot", "root", F.sha2(F.array_join("path.sibling", ""), 256).alias("proof_sha256"),
                    "folded_root", (c("folded_root") == c("root")).alias("verified")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dataset_manifest(table(spark, sf_dir, "documents"), Scratch(spark, "merkle"))


#: Whole levels by recursion, siblings by joins, the fold by list_reduce; CRC-32 bit by bit.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) AS crc FROM documents),
h AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
         CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS claim FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM h),
lv AS (
  SELECT lang, pos, leaf AS node, 0 AS level, n FROM leaves
  UNION ALL
  SELECT lang, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), level + 1, (n + 1) // 2 FROM lv WHERE n > 1 GROUP BY lang, pos // 2, level, n),
subs AS (SELECT lang, node AS subroot, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (
  SELECT pos, subroot AS node, 0 AS level, n FROM subs
  UNION ALL
  SELECT pos // 2, sha256(string_agg(node, '' ORDER BY pos)), level + 1, (n + 1) // 2 FROM tv WHERE n > 1 GROUP BY pos // 2, level, n),
top AS (SELECT node AS root, level AS depth FROM tv WHERE n = 1),
low AS (
  SELECT l.lang, l.pos, x.level, s.node AS sibling, (l.pos >> x.level) % 2 = 1 AS on_right
  FROM leaves l JOIN (SELECT lang, unnest(range(0, depth)) AS level FROM subs) x ON l.lang IS NOT DISTINCT FROM x.lang
  LEFT JOIN lv s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = x.level AND s.pos = xor(l.pos >> x.level, 1)),
high AS (
  SELECT b.lang, x.level, s.node AS sibling, (b.pos >> x.level) % 2 = 1 AS on_right
  FROM subs b, (SELECT unnest(range(0, depth)) AS level FROM top) x LEFT JOIN tv s ON s.level = x.level AND s.pos = xor(b.pos >> x.level, 1)),
low_path AS (SELECT lang, pos, list({'s': sibling, 'r': on_right} ORDER BY level) AS p FROM low GROUP BY lang, pos),
high_path AS (SELECT lang, list({'s': sibling, 'r': on_right} ORDER BY level) AS p FROM high GROUP BY lang),
full_path AS (
  SELECT l.doc_id, l.leaf, b.subroot, t.root, list_concat([{'s': coalesce(l.claim, l.leaf), 'r': false}], coalesce(lp.p, []), coalesce(hp.p, [])) AS p
  FROM leaves l JOIN subs b ON l.lang IS NOT DISTINCT FROM b.lang CROSS JOIN top t
  LEFT JOIN low_path lp ON lp.lang IS NOT DISTINCT FROM l.lang AND lp.pos = l.pos LEFT JOIN high_path hp ON hp.lang IS NOT DISTINCT FROM l.lang),
folded AS (
  SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(p[2:], lambda x: coalesce(x.s, '')), ''), '')) AS proof_sha256,
         list_reduce(p, lambda a, b: {'s': sha256(CASE WHEN b.r THEN coalesce(b.s, '') || a.s ELSE a.s || coalesce(b.s, '') END), 'r': false}).s AS folded_root FROM full_path)
SELECT *, folded_root = root AS verified FROM folded
"""
