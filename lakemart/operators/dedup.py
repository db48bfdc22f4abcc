"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dedup(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """Keep the row of each key that is latest by the given columns, missing values last.

    All remaining columns break ties in their order, smallest first, so the choice is the
    same in every run.

    ``row_number() = 1`` is planned with a group limit on both sides of the shuffle, so
    every task sends at most one row per key: a key that holds a third of the table costs
    its map tasks a local sort and the reducer one row per map task.
    """
    used = {*keys, *latest_by}
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    order += [F.col(c).asc_nulls_first() for c in df.columns if c not in used]
    window = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts. Empty for a unique key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
