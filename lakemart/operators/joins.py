"""Joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Rows of one key that a single task may join. A key above this is spread over several tasks.
HOT_ROWS = 1_000_000
# Sampled rows that a key of HOT_ROWS rows is recognised by; their count is off by about 1 %.
SAMPLED_ROWS = 10_000
# Keys on the list, those with the most rows; any other key has less than this share of all rows.
MOST_HOT = 65_536


def hot_keys(
    rows: DataFrame, key: str, spread_by: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with about ``hot_rows`` rows or more, and the number of tasks to spread each over.

    Counted on the rows whose hash falls into one of every ``hot_rows / 10,000`` classes, so
    a hundredth of the rows is shuffled at the default, combined map-side. The hash makes
    the choice the same wherever the plan evaluates it. The list steers only where rows are
    joined, never what is joined. It has ``MOST_HOT`` keys at most, which is what makes it safe to
    broadcast; where more keys are that large, none of the others stands out.
    """
    every = max(1, hot_rows // SAMPLED_ROWS)
    seen = rows.where(F.col(key).isNotNull())
    if every > 1:
        seen = seen.where(F.pmod(F.xxhash64(key, *spread_by), F.lit(every)) == 0)
    counts = seen.groupBy(key).agg((F.count(F.lit(1)) * every).alias("_rows"))
    largest = counts.where(F.col("_rows") > hot_rows).orderBy(F.desc("_rows"), key).limit(MOST_HOT)
    return largest.select(
        key, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_copies")
    )


def join_spread(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    strategy: str | None = None,
) -> DataFrame:
    """Join many ``rows`` per key to a ``lookup`` with one row per key, splitting hot keys.

    Adaptive execution can split a skewed join only where both inputs come straight from a
    shuffle. A lookup that is itself an aggregate on the key does not, so hot keys are split
    here: their rows get a salt, and only their lookup rows are repeated, once per salt. Other
    keys have the single salt 0.

    The salt is a hash of the columns ``spread_by``, which tell the rows of one key apart; a
    retried task computes the same again. ``strategy`` may name a join hint for a lookup that
    is known to be large.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join_spread cannot repeat lookup rows in a {how} join")
    hot = F.broadcast(hot_keys(rows, key, spread_by, hot_rows))
    left = rows.join(hot, key, "left").select(
        *rows.columns,
        F.when(F.col("_copies").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(*spread_by), F.col("_copies")).cast("int"))
        .alias("_salt"),
    )
    last_copy = F.coalesce(F.col("_copies"), F.lit(1)) - 1
    right = lookup.join(hot, key, "left").select(
        *lookup.columns, F.explode(F.sequence(F.lit(0), last_copy)).alias("_salt")
    )
    right = right.hint(strategy) if strategy else right
    return left.join(right, [key, "_salt"], how).drop("_salt")
