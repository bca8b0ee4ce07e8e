"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohort_engine.session import ensure_checkpoint_dir, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> None:
    """Ship the package to Python workers and make sure the shared checkpoint folder is set."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is (``lower`` only where the text is pure ASCII)."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (a NULL id counts as the empty string)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def bounded_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A DataFrame of a bounded list, built from one JSON literal (no Python worker takes part)."""
    js = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(js))


def cell_ranks(df: DataFrame, group: list[str], cells: Column, order: list[str], rank: str = "rank") -> DataFrame:
    """Number the rows of each group from 0 without one task per group.

    A group is dealt into ``cells`` cells (an expression, the same for all rows of a group)
    by the hash of ``order``.  Cell sizes are counted with map-side combine, their running
    sum gives each cell's first number, and a window numbers the rows inside a cell.
    """
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.greatest(cells, F.lit(1)).cast("long")))
    keys = [*group, "_cell"]
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (dealt.groupBy(*keys).agg(F.count("*").alias("_n"))
              .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    numbered = dealt.withColumn("_inside", inside)
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (numbered.alias("a").join(firsts.alias("b"), cond)
            .select("a.*", (F.col("b._first") + F.col("a._inside")).cast("long").alias(rank))
            .drop("_cell", "_inside"))
