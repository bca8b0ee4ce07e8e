"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of positions.  Every shard owns ``vnodes`` of them; a key
belongs to the first virtual node clockwise from the position its hash gives.  A shard
takes at most its capacity; keys that overflow a full shard continue clockwise to the
next virtual node of a shard that has room.  Capacities are floor(n / shards), one more
for the first n mod shards shards, so counts differ by one at most (law ``rows``).

Only key counts per ring position (a table bounded by the ring's resolution, not by the
data) reach the driver.  There the overflow is settled on the counts: each position gets
ranges of key ranks with their shard and first slot.  Rows learn their rank with windows
over cells of their own position (``cell_ranks``: a position, or a key, of any number of
rows is spread) and their shard with one broadcast join on the position, whose size is
bounded by ``RING`` and the number of shards.  Everything that touches rows is a DataFrame
expression.

Defined results: NULL or repeated keys hash and rank as any other key (repeats get
consecutive slots); NULL text has size 1 and the CRC of the empty string; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import bounded_rows, cell_ranks, prepare, table

RING = 1 << 14       # ring positions: the resolution of the ring
VNODES = 64          # virtual nodes of each shard
ROWS_PER_CELL = 5_000    # rows of one position that a window numbers at once


def ring_nodes(spark: SparkSession, shards: int, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; at most shards * vnodes rows.

    A shard's positions depend on its own number only, so adding a shard moves none of
    the others' nodes."""
    rows = (spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("v"))
            .select(F.pmod(F.xxhash64(F.lit("node"), "shard", "v"), F.lit(ring)).alias("pos"), "shard").collect())
    return sorted((int(r["pos"]), int(r["shard"])) for r in rows)


def settle(counts: dict[int, int], nodes: list[tuple[int, int]], shards: int) -> list[dict]:
    """Bounded loads on key counts: ranges (pos, lo, hi, shard, slot0) of the keys' ranks.

    In rounds: keys waiting at a virtual node go to its shard while it has room, clockwise
    from position 0; what does not fit moves on to the next node of a shard with room.
    Each round fills a shard or ends, so there are at most ``shards`` rounds.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    waiting, k = [], 0
    for pos in sorted(counts):
        while k < len(nodes) and nodes[k][0] < pos:
            k += 1
        waiting.append((pos, 0, counts[pos], k % len(nodes)))
    ranges = []
    while waiting:
        over = []
        for pos, lo, hi, at in waiting:
            shard = nodes[at][1]
            taken = min(room[shard] - used[shard], hi - lo)
            if taken:
                ranges.append({"pos": pos, "lo": lo, "hi": lo + taken, "shard": shard, "slot0": used[shard]})
                used[shard] += taken
            if lo + taken < hi:
                over.append((pos, lo + taken, hi, at))
        onward, has_room = [0] * len(nodes), None
        for at in range(2 * len(nodes) - 1, -1, -1):      # next node clockwise with room, for every node
            if used[nodes[at % len(nodes)][1]] < room[nodes[at % len(nodes)][1]]:
                has_room = at % len(nodes)
            onward[at % len(nodes)] = has_room
        waiting = [(pos, lo, hi, onward[at]) for pos, lo, hi, at in over]
    return ranges


def assign_shards(rows: DataFrame, key: str, shards: int, vnodes: int = VNODES, ring: int = RING) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 inside a shard)."""
    spark = rows.sparkSession
    pos = F.pmod(F.xxhash64(F.lit("key"), key), F.lit(ring)).cast("int")
    counts = {r["pos"]: r["n"] for r in rows.groupBy(pos.alias("pos")).agg(F.count("*").alias("n")).collect()}
    ranges = settle(counts, ring_nodes(spark, shards, vnodes, ring), shards)
    plan = bounded_rows(spark, ranges, "pos:int,lo:long,hi:long,shard:int,slot0:long")
    # a position's rows are numbered cell by cell: by key, content and, for equal rows, where they lie, so that no key's rows meet in one task
    here_n = bounded_rows(spark, [{"_pos": p, "_here": n} for p, n in counts.items()], "_pos:int,_here:long")
    placed = rows.withColumn("_pos", pos).withColumn("_tie", F.monotonically_increasing_id()).join(F.broadcast(here_n), "_pos")      # at most RING rows
    ranked = cell_ranks(placed, ["_pos"], F.ceil(F.col("_here") / ROWS_PER_CELL), [key, *(c for c in rows.columns if c != key), "_tie"], "_rank")
    here = (F.col("_pos") == F.col("pos")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    return (ranked.join(F.broadcast(plan), here)       # at most RING + shards * nodes ranges
            .withColumn("slot", F.col("slot0") + F.col("_rank") - F.col("lo"))
            .select(*rows.columns, "shard", "slot"))


def shard_documents(docs: DataFrame, shards: int = 16, vnodes: int = VNODES) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign_shards(rows, "doc_id", shards, vnodes).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return shard_documents(table(spark, sf_dir, "documents"))
