"""Cohorts of tens of thousands of columns as rows times column-block arrays.

A table of 20,000 measurements has no 20,000 columns here: a row of the stored form is one
subject's cells of one block of ``width`` columns, as an array.  Plans and schemas keep their
size whatever the number of columns, and a task works on whole blocks.

* Statistics (P4, A2-A6, F1) are array aggregates: tasks fold their rows into one array per
  block and group (numpy, a bounded number of them held at once), and the partial arrays are
  merged by block in two salted steps.  Order statistics are found by radix selection.
* Transforms (T1-T4, T6, T7) are array expressions of the JVM.  Their statistics are one array
  per block, at most ``columns`` numbers each, which is what bounds the broadcast.
* The CSV reader (S1) takes lines, so no reader's limit on columns is met.

Missing cells are NULL; NaN and infinities become NULL on the way in.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.functions.expressions import name
from cohort_engine.sources.tables import MISSING

WIDTH = 256              # columns of a block
HELD_BYTES = 64 << 20    # of partial arrays that a task holds before it passes them on
SALTS = 32               # first merging step: partial arrays of a block and group are dealt to so many tasks
BINS_LOG2 = 8            # bits of the order key that one round of the radix selection decides
GATHER = 2048            # cells left of a wanted order statistic from which on they are gathered


@dataclass
class BlockMatrix:
    """``rows``: the key columns, ``block`` and ``cells``, the row's values of that block's columns."""
    rows: DataFrame
    keys: list[str]
    columns: list[str]
    width: int = WIDTH

    def cells(self, f: Callable[[Column], Column]) -> BlockMatrix:
        """Every cell replaced by ``f`` of it."""
        return replace(self, rows=self.rows.withColumn("cells", F.transform("cells", f)))

    def persist(self) -> BlockMatrix:
        return replace(self, rows=self.rows.persist())

    def long(self) -> DataFrame:
        """``(*keys, feature, value)``, a row for every cell."""
        at = self.rows.select(*self.keys, "block", F.posexplode("cells").alias("_at", "value"))
        return named(at.withColumn("i", F.col("block") * self.width + F.col("_at")).drop("block", "_at"), self.columns)


def finite(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def from_arrays(df: DataFrame, keys: Sequence[str], array: str, columns: Sequence[str], width: int = WIDTH) -> BlockMatrix:
    """From a column holding all values of a row, in the order of ``columns``."""
    starts = F.sequence(F.lit(0), F.lit((len(columns) - 1) // width))
    rows = (df.select(*keys, F.transform(F.col(array).cast("array<double>"), finite).alias("_all")).withColumn("block", F.explode(starts))
            .select(*keys, "block", F.slice("_all", F.col("block") * width + 1, width).alias("cells")))
    return BlockMatrix(rows, list(keys), list(columns), width)


def from_columns(df: DataFrame, keys: Sequence[str], cols: Sequence[str], width: int = WIDTH) -> BlockMatrix:
    """From a table of columns."""
    whole = ", ".join(f"CAST({name(c)} AS DOUBLE)" for c in cols)
    return from_arrays(df.selectExpr(*[name(k) for k in keys], f"array({whole}) AS _whole"), keys, "_whole", cols, width)


def read_block_csv(spark: SparkSession, path: str, keys: Sequence[str], width: int = WIDTH) -> BlockMatrix:
    """S1 for wide tables: header CSV files of one layout, one record a line; ``keys`` stay text, all else is a number.

    Missing markers and text that is no number become NULL (S2's coercion)."""
    lines = spark.read.text(path)
    first = lines.first()
    header = next(csv.reader([first[0]])) if first else []
    lower = [h.strip().lower() for h in header]
    at_keys = [lower.index(k) for k in keys]
    at_cells = [i for i in range(len(lower)) if i not in set(at_keys)]
    columns = [lower[i] for i in at_cells]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), 64):                       # a few wide lines at once
                table = np.array([r for r in csv.reader(pdf["value"].iloc[start:start + 64]) if len(r) == len(lower)], object).reshape(-1, len(lower))
                if not len(table):
                    continue
                values = table[:, at_cells].ravel()
                numbers = pd.to_numeric(pd.Series(values), errors="coerce").to_numpy(float)
                numbers = np.where(np.isfinite(numbers), numbers, np.nan).reshape(len(table), -1)
                ids = [[None if v in MISSING else v for v in table[:, k]] for k in at_keys]
                for b in range(0, len(at_cells), width):
                    out = {k: v for k, v in zip(keys, ids)} | {"block": b // width}
                    yield pd.DataFrame(out | {"cells": [[None if x != x else x for x in row] for row in numbers[:, b:b + width]]})

    schema = "".join(f"{k} string, " for k in keys) + "block int, cells array<double>"
    rows = lines.where(F.col("value") != (first[0] if first else "")).mapInPandas(run, schema)
    return BlockMatrix(rows, list(keys), columns, width)


def named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with column number ``i`` replaced by ``feature``, its name (a table of one row per column)."""
    names = df.sparkSession.createDataFrame(pd.DataFrame({"i": range(len(columns)), "feature": list(columns)}), "i int, feature string")
    return df.join(F.broadcast(names), "i").drop("i")


# -- array aggregates -----------------------------------------------------------------------

def matrix_of(cells: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Arrays of one length as a matrix; NULL cells are NaN."""
    values = cells.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(cells), -1)


def fold_blocks(by: list[str], start: Callable, add: Callable, emit: Callable, more: tuple = ()):
    """A mapInArrow function: one accumulator per (group, block), passed on when they grow beyond ``HELD_BYTES``.

    ``start(block, columns)`` makes an accumulator (arrays by name), ``add(held, block, matrix, rows)`` folds rows in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            groups = table.select([*by, "block"]).to_pandas().astype(object)
            for key, at in groups.where(groups.notna(), None).groupby([*by, "block"], dropna=False).indices.items():
                key = tuple(None if k != k else k for k in (key if isinstance(key, tuple) else (key,)))
                x = matrix_of(table.column("cells").take(pa.array(at)).combine_chunks())
                if key not in held:
                    held[key] = start(key[-1], x.shape[1])
                add(held[key], key[-1], x)
            if sum(v.nbytes for h in held.values() for v in h.values()) > HELD_BYTES:
                yield from emit(held)
                held = {}
        yield from emit(held)
    return run


def merged(parts: DataFrame, by: list[str], merge: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """Partial arrays of each group and block merged, in tasks dealt by salt first."""
    keys = [*by, "block"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([dict(zip(keys, key)) | merge(pdf)])

    salted = parts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    once = salted.groupBy(*keys, "_salt").applyInPandas(lambda key, pdf: run(key[:-1], pdf), schema)
    return once.groupBy(*keys).applyInPandas(run, schema)


MOMENTS = ("n", "logs", "mean", "m2", "low", "high")


def exact_where_constant(m: dict) -> dict:
    """A mean of equal cells is that cell, without rounding, and their spread is 0."""
    same = m["low"] == m["high"]
    return m | {"mean": np.where(same, m["low"], m["mean"]), "m2": np.where(same, 0.0, m["m2"])}


def combine(a: dict, b: dict) -> dict:
    """Moments of two sets of cells together (stable for large means)."""
    n = a["n"] + b["n"]
    share = np.divide(b["n"], n, out=np.zeros(len(n)), where=n > 0)
    apart = b["mean"] - a["mean"]
    return exact_where_constant({
        "n": n, "logs": a["logs"] + b["logs"], "mean": a["mean"] + apart * share, "m2": a["m2"] + b["m2"] + apart * apart * a["n"] * share,
        "low": np.fmin(a["low"], b["low"]), "high": np.fmax(a["high"], b["high"])})


def moments_of(x: np.ndarray) -> dict:
    there = ~np.isnan(x)
    n = there.sum(axis=0).astype(float)
    mean = np.divide(np.where(there, x, 0).sum(axis=0), n, out=np.zeros(x.shape[1]), where=n > 0)
    return exact_where_constant({
        "n": n, "logs": (x > -1).sum(axis=0).astype(float), "mean": mean, "m2": (np.where(there, x - mean, 0) ** 2).sum(axis=0),
        "low": np.fmin.reduce(x, axis=0, initial=np.nan), "high": np.fmax.reduce(x, axis=0, initial=np.nan)})


def block_moments(matrix: BlockMatrix, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, block, rows, n, logs, mean, m2, low, high)``: per block and group one array of each; a NULL group is a group."""
    by = list(by)

    def start(block: int, columns: int) -> dict:
        return moments_of(np.full((0, columns), np.nan)) | {"rows": np.zeros(1)}

    def add(held: dict, block: int, x: np.ndarray) -> None:
        held.update(combine(held, moments_of(x)) | {"rows": held["rows"] + len(x)})

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        if held:
            cols = {k: [key[i] for key in held] for i, k in enumerate([*by, "block"])}
            stats = {c: [h[c] for h in held.values()] for c in MOMENTS}
            frame = pa.table(cols | {"rows": [int(h["rows"][0]) for h in held.values()]} | stats)
            yield from frame.cast(arrow).to_batches()

    def merge(pdf: pd.DataFrame) -> dict:
        each = [{c: np.array([np.nan if v is None else v for v in row[c]], float) for c in MOMENTS} for _, row in pdf.iterrows()]
        return {"rows": int(pdf["rows"].sum())} | reduce(combine, each)

    schema = "".join(f"{k} {matrix.rows.schema[k].dataType.simpleString()}, " for k in by) + "block int, rows long, " + ", ".join(f"{c} array<double>" for c in MOMENTS)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(matrix.rows.sparkSession.createDataFrame([], schema).schema)
    parts = matrix.rows.select(*by, "block", "cells").mapInArrow(fold_blocks(by, start, add, emit), schema)
    return merged(parts, by, merge, schema)


def per_column(stats: DataFrame, matrix: BlockMatrix, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, rows, n, logs, mean, var, low, high)`` of :func:`block_moments`; var is the population's."""
    cells = stats.select(*by, "block", "rows", F.posexplode(F.arrays_zip(*MOMENTS)).alias("_at", "s"))
    flat = cells.select(*by, (F.col("block") * matrix.width + F.col("_at")).alias("i"), "rows", F.col("s.n").cast("long").alias("n"), F.col("s.logs").cast("long").alias("logs"),
                        F.when(F.col("s.n") > 0, F.col("s.mean")).alias("mean"), F.when(F.col("s.n") > 0, F.col("s.m2") / F.col("s.n")).alias("var"),
                        finite(F.col("s.low")).alias("low"), finite(F.col("s.high")).alias("high"))
    return named(flat, matrix.columns)


# -- statistics -----------------------------------------------------------------------------

def wide_moments(matrix: BlockMatrix) -> DataFrame:
    """A2, A4: ``(feature, n, mean, std_pop, min_value, max_value)`` over non-NULL cells."""
    return per_column(block_moments(matrix), matrix).select("feature", "n", "mean", F.sqrt("var").alias("std_pop"), F.col("low").alias("min_value"), F.col("high").alias("max_value"))


def wide_constant(matrix: BlockMatrix) -> DataFrame:
    """``(feature, n_non_null, min_value, max_value, is_constant)``."""
    return per_column(block_moments(matrix), matrix).select(
        "feature", F.col("n").alias("n_non_null"), F.col("low").alias("min_value"), F.col("high").alias("max_value"),
        ((F.col("n") == 0) | (F.col("low") == F.col("high"))).alias("is_constant"))


def wide_any_negative(matrix: BlockMatrix) -> bool:
    """A3 over all cells."""
    return bool(matrix.rows.agg(F.coalesce(F.min(F.array_min("cells")) < 0, F.lit(False))).first()[0])


def wide_anova(matrix: BlockMatrix, label: str) -> DataFrame:
    """ANOVA F of every column against the class, from moments by class."""
    from cohort_engine.operators.select import f_from_moments
    per = per_column(block_moments(matrix, [label]), matrix, [label]).where("n > 0")
    scored = f_from_moments(per.select("feature", F.col("n").alias("n_c"), F.col("mean").alias("mean_c"), F.col("var").alias("var_c")))
    every = named(matrix.rows.sparkSession.range(len(matrix.columns)).select(F.col("id").cast("int").alias("i")), matrix.columns)
    return every.join(scored, "feature", "left")


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned keys that sort as the numbers do (0.0 and -0.0 alike)."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def from_bits(key: np.ndarray) -> np.ndarray:
    return np.where(key >> np.uint64(63), key & np.uint64((1 << 63) - 1), ~key).view(float)


def wide_quantiles(matrix: BlockMatrix, probs: Sequence[float], gather: int = GATHER) -> DataFrame:
    """Exact ``(feature, q, value)``, linear between order statistics; a column of NULLs has NULL.

    Radix selection: each round counts, for every wanted order statistic of every column, the next bits of the cells
    that agree with the bits known so far, until few enough cells agree; these are gathered by block and ranked.  The
    known bits and ranks, two numbers for each column and order statistic, go through the driver; counts do not."""
    spark, width = matrix.rows.sparkSession, matrix.width
    counts = {r["block"]: np.array(r["n"]) for r in block_moments(matrix).select("block", "n").collect()}
    wanted: dict[int, dict[str, np.ndarray]] = {}
    for b, n in counts.items():
        place = np.array([[q * max(0.0, m - 1) for m in n] for q in probs])
        ranks = np.concatenate([np.floor(place), np.ceil(place)]).astype(np.int64)           # 2 * probabilities rows
        wanted[b] = {"rank": ranks, "known": np.zeros(ranks.shape, np.uint64), "left": np.tile(n, (len(ranks), 1)).astype(np.int64), "frac": place - np.floor(place)}
    fixed = 0
    while fixed < 64 and any((w["left"] > gather).any() for w in wanted.values()):
        shift, sent = np.uint64(64 - fixed - BINS_LOG2), spark.sparkContext.broadcast({b: w["known"] for b, w in wanted.items()})
        bins = 1 << BINS_LOG2

        def start(block: int, columns: int) -> dict:
            return {"counts": np.zeros((len(sent.value[block]), columns, bins), np.int64)}

        def add(held: dict, block: int, x: np.ndarray, shift=shift, fixed=fixed) -> None:
            key, known = ordered_bits(x), sent.value[block]
            columns = np.broadcast_to(np.arange(x.shape[1]), x.shape)
            for t in range(len(known)):
                same = ~np.isnan(x)
                if fixed:
                    same &= (key >> np.uint64(64 - fixed)) == (known[t] >> np.uint64(64 - fixed))
                np.add.at(held["counts"][t], (columns[same], ((key[same] >> shift) & np.uint64(bins - 1)).astype(int)), 1)

        def emit(held: dict) -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([k[-1] for k in held], pa.int32()), pa.array([h["counts"].tobytes() for h in held.values()], pa.binary())], ["block", "counts"])

        def merge(pdf: pd.DataFrame) -> dict:
            return {"counts": sum(np.frombuffer(c, np.int64) for c in pdf["counts"]).tobytes()}

        def pick(batches: Iterator[pd.DataFrame], ranks={b: w["rank"] for b, w in wanted.items()}) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for block, raw in zip(pdf["block"], pdf["counts"]):
                    c = np.frombuffer(raw, np.int64).reshape(*ranks[block].shape, bins)
                    upto = c.cumsum(axis=2)
                    at = np.minimum((upto <= ranks[block][..., None]).sum(axis=2), bins - 1)
                    own = np.take_along_axis(c, at[..., None], 2)[..., 0]
                    below = np.take_along_axis(upto, at[..., None], 2)[..., 0] - own
                    yield pd.DataFrame({"block": [block], "bin": [at.astype(np.int64).tobytes()], "own": [own.tobytes()], "below": [below.tobytes()]})

        parts = matrix.rows.select("block", "cells").mapInArrow(fold_blocks([], start, add, emit), "block int, counts binary")
        for r in merged(parts, [], merge, "block int, counts binary").mapInPandas(pick, "block int, bin binary, own binary, below binary").collect():
            w = wanted[r["block"]]
            read = {k: np.frombuffer(r[k], np.int64).reshape(w["rank"].shape) for k in ("bin", "own", "below")}
            w["known"] = w["known"] | (read["bin"].astype(np.uint64) << shift)
            w["rank"], w["left"] = np.maximum(0, w["rank"] - read["below"]), read["own"]
        fixed += BINS_LOG2
    return named(gathered(matrix, wanted, fixed, probs), matrix.columns)


def gathered(matrix: BlockMatrix, wanted: dict, fixed: int, probs: Sequence[float]) -> DataFrame:
    """``(i, q, value)``: the cells that agree with the known bits, ranked by block and column."""
    width, sent = matrix.width, matrix.rows.sparkSession.sparkContext.broadcast(wanted)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in np.unique(batch.column("block").to_numpy()):
                own = batch.filter(pa.compute.equal(batch.column("block"), int(block)))
                x = matrix_of(own.column("cells"))
                key, known = ordered_bits(x), sent.value[block]["known"]
                for t in range(len(known)):
                    same = ~np.isnan(x)
                    if fixed:
                        same &= (key >> np.uint64(64 - fixed)) == (known[t] >> np.uint64(64 - fixed))
                    _, column = np.nonzero(same)
                    # equal cells are one row with their number: a value on most rows stays small
                    value, column, count = tally(x[same], column)
                    yield pa.RecordBatch.from_arrays([pa.array(column + int(block) * width, pa.int32()), pa.array(np.full(len(value), t), pa.int32()), pa.array(value), pa.array(count)],
                                                     ["i", "t", "value", "cells"])

    def ranked(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["i", "t", "value"])
        out = []
        for (i, t), own in pdf.groupby(["i", "t"]):
            w = sent.value[i // width]
            at = np.searchsorted(own["cells"].to_numpy().cumsum(), w["rank"][t, i % width], side="right")
            out.append((i, t, own["value"].to_numpy()[min(at, len(own) - 1)], w["frac"][t % len(probs), i % width]))
        return pd.DataFrame(out, columns=["i", "t", "value", "frac"])

    found = matrix.rows.select("block", "cells").mapInArrow(near, "i int, t int, value double, cells long").groupBy("i", "t", "value").agg(F.sum("cells").alias("cells"))
    each = found.groupBy(F.floor(F.col("i") / 16)).applyInPandas(ranked, "i int, t int, value double, frac double")
    m = len(probs)
    low, high = F.max(F.when(F.col("t") < m, F.col("value"))), F.max(F.when(F.col("t") >= m, F.col("value")))
    picked = each.groupBy("i", F.pmod("t", F.lit(m)).alias("p")).agg((low + (high - low) * F.max("frac")).alias("value"))
    grid = matrix.rows.sparkSession.range(len(matrix.columns)).select(F.col("id").cast("int").alias("i"), F.posexplode(F.array(*map(F.lit, map(float, probs)))).alias("p", "q"))
    return grid.join(picked, ["i", "p"], "left").select("i", "q", "value")


def tally(value: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((value, column))
    value, column = value[order] + 0.0, column[order]
    first = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (column[1:] != column[:-1]))) if len(value) else np.zeros(0, int)
    return value[first], column[first], np.diff(np.append(first, len(value)))


# -- transforms -----------------------------------------------------------------------------

def by_block(values: DataFrame, matrix: BlockMatrix, columns: dict[str, str]) -> DataFrame:
    """Per-column values ``(feature, ...)`` as one array a block, in column order."""
    names = matrix.rows.sparkSession.createDataFrame(pd.DataFrame({"i": range(len(matrix.columns)), "feature": matrix.columns}), "i int, feature string")
    at = values.join(F.broadcast(names), "feature").withColumn("block", F.floor(F.col("i") / matrix.width).cast("int"))
    rows = at.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", *columns))).alias("s"))
    return rows.select("block", *(F.col(f"s.{c}").alias(out) for c, out in columns.items()))


def with_stats(matrix: BlockMatrix, stats: DataFrame, f: Callable[[Column], Column], arrays: Sequence[str], on: Sequence[str] = ()) -> BlockMatrix:
    """Every cell replaced by ``f`` of a struct of itself (``cells``) and its column's values in ``arrays``.

    One row per block (at most ``columns`` numbers an array) is broadcast; rows per group (``on``) are joined as the runtime decides."""
    cond = F.col("m.block") == F.col("s.block")
    for k in on:
        cond = cond & F.col(f"m.{k}").eqNullSafe(F.col(f"s.{k}"))
    right = stats.select(*on, "block", *arrays)
    joined = matrix.rows.alias("m").join((right if on else F.broadcast(right)).alias("s"), cond, "left")
    cells = F.transform(F.arrays_zip("m.cells", *(F.col(f"s.{a}") for a in arrays)), f)
    return replace(matrix, rows=joined.select(*(F.col(f"m.{k}") for k in matrix.keys), F.col("m.block"), cells.alias("cells")))


@dataclass
class WideFacts:
    """What preparation learned of the matrix it was fitted on."""
    zscore: bool
    moments: DataFrame
    medians: DataFrame | None
    scales: DataFrame


def prepare_wide(matrix: BlockMatrix, batch: str | None = None, held: Callable[[DataFrame], DataFrame] = lambda df: df.checkpoint()) -> tuple[BlockMatrix, WideFacts]:
    """log2 or z-score, bad cells to the median, batch means removed, columns scaled.

    Each statistic is a small table (``held``: written, so later steps read it instead of the cells)."""
    stats = held(block_moments(matrix))
    zscore = wide_any_negative(matrix)
    if zscore:
        spread = F.transform(F.arrays_zip("m2", "n"), lambda s: F.when(s["n"] > 0, F.sqrt(s["m2"] / s["n"])))
        normed = with_stats(matrix, stats.withColumn("std", spread), lambda s: F.try_divide(s["cells"] - s["mean"], s["std"]), ["mean", "std"])
    else:
        normed = matrix.cells(lambda x: F.log2(x + 1))
    medians = held(by_block(wide_quantiles(normed, [0.5]).withColumnRenamed("value", "median"), matrix, {"median": "median"}))
    out = with_stats(normed, medians, lambda s: F.coalesce(s["cells"], s["median"], F.lit(0.0)), ["median"])
    if batch:
        means = block_moments(out, [batch])
        out = with_stats(out, held(means), lambda s: s["cells"] - F.coalesce(s["mean"], F.lit(0.0)), ["mean"], [batch])
    final = held(block_moments(out))
    spread = F.transform(F.arrays_zip("m2", "n"), lambda s: F.when((s["n"] > 0) & (s["m2"] > 0), F.sqrt(s["m2"] / s["n"])).otherwise(1.0))
    scales = final.select("block", "mean", spread.alias("scale"))
    out = with_stats(out, scales, lambda s: (s["cells"] - s["mean"]) / s["scale"], ["mean", "scale"])
    return out, WideFacts(zscore, stats, medians, scales)


def impute_wide(matrix: BlockMatrix) -> BlockMatrix:
    """NULL to the column's median; a column of NULLs keeps them."""
    medians = by_block(wide_quantiles(matrix, [0.5]).withColumnRenamed("value", "median"), matrix, {"median": "median"})
    return with_stats(matrix, medians, lambda s: F.coalesce(s["cells"], s["median"]), ["median"])
