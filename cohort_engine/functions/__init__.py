"""Shared column-level primitives."""

from cohort_engine.functions.hashing import hash_key, hash_order
from cohort_engine.functions.cumulative import running_sum, range_buckets
from cohort_engine.functions.quantiles import exact_quantiles, approx_quantiles

__all__ = [
    "hash_key", "hash_order",
    "running_sum", "range_buckets",
    "exact_quantiles", "approx_quantiles",
]
