"""Keyed upsert of one table into another, and what it changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """True where any column differs; NULL equals NULL."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(or_, tests, F.lit(False))


def pair_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once, with its row on either side as the structs ``old`` and ``new``.

    Keys must be unique on both sides, so no key is larger than another.
    """
    left = target.select(*keys, F.struct(*target.columns).alias("old"))
    right = source.select(*keys, F.struct(*source.columns).alias("new"))
    return left.join(right, list(keys), "full")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace the target rows of their key; new keys are added."""
    source = source.select(*target.columns)
    merged = pair_by_key(target, source, keys).select(F.coalesce("new", "old").alias("row"))
    return merged.select("row.*")


def upsert_metrics(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys inserted, rows really changed, and keys in all after the upsert."""
    columns = [c for c in target.columns if c not in keys]
    pairs = pair_by_key(target, source.select(*target.columns), keys)
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    return pairs.agg(
        F.count_if(F.col("old").isNull()).alias("inserted"),
        F.count_if(both & differs("old", "new", columns)).alias("modified"),
        F.count(F.lit(1)).alias("total"),
    )
