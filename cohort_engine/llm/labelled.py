"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import id_remainder

SAMPLE = 16_000          # labelled documents a classifier is fitted on, about
HASH_RANGE = 1 << 20


def hash_sample(rows: DataFrame, bound: int, seed: str) -> DataFrame:
    """About ``bound`` of the rows (all, if fewer), chosen by the hash of ``doc_id``."""
    n = rows.count()
    if n <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(HASH_RANGE)) < int(HASH_RANGE * bound / n))


def label_sample(labels: DataFrame, label: str, mod: int, held: int, bound: int = SAMPLE) -> DataFrame:
    """(doc_id, label): labels that may be learned, one for each id (the higher, if they differ)."""
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
             .groupBy("doc_id").agg(F.max("label").alias("label")).where(id_remainder(F.col("doc_id"), mod) != held))
    return hash_sample(known, bound, label)


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a bounded sample; its ids are broadcast, the texts stay where they are."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def feature_map(features: Callable[[list[str]], np.ndarray]):
    """A mapInPandas function that puts ``features`` in place of the texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = features(["" if t is None else t for t in pdf["text"]])
            yield pdf.drop(columns="text").assign(x=list(x))
    return run


def byte_counts(text: str) -> np.ndarray:
    """How often each byte occurs in the UTF-8 form of a text."""
    return np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)


def byte_classes(**classes: str) -> dict[str, np.ndarray]:
    """Masks over the 256 bytes for sets of ASCII characters."""
    return {k: np.isin(np.arange(256), np.frombuffer(v.encode(), np.uint8)) for k, v in classes.items()}
