"""Running totals over one total order of a whole table, in two levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.session import SHUFFLE_PARTITIONS, scratch_path, small_tasks

#: The range that a row fell into, while totals are made.
RANGE = "_range"


def _sum(a: object, b: object) -> object:
    return b if a is None else a if b is None else a + b


def running_totals(df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, str | Column]) -> DataFrame:
    """``df`` with columns that sum ``totals`` (name: value) over each row and all rows before it.

    A window over the whole table would sort it in one task. Here the rows are cut into ranges of the order, written
    to the shared folder so that every reader sees the same ranges, and summed within each range;
    the driver adds the totals of earlier ranges, one row per range. ``order_by`` has to be a total order. NULL values
    add nothing; a total is NULL until the first value that is not.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get(SHUFFLE_PARTITIONS))
    values = {name: F.col(v) if isinstance(v, str) else v for name, v in totals.items()}
    placed = df.select("*", *[v.alias(f"_{name}") for name, v in values.items()])
    placed = placed.repartitionByRange(ranges, *order_by).withColumn(RANGE, F.spark_partition_id())
    staged = scratch_path(spark, "running")
    with small_tasks(spark):
        placed.write.parquet(staged)
    rows = spark.read.schema(placed.schema).parquet(staged)

    sums = rows.groupBy(RANGE).agg(*[F.sum(f"_{name}").alias(name) for name in values])
    found = sorted(sums.collect(), key=lambda r: r[RANGE])  # one row per range
    within = Window.partitionBy(RANGE).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    shown = []
    for name in values:
        own = F.sum(f"_{name}").over(within)
        kind = sums.schema[name].dataType.simpleString()
        before = [None, *list(accumulate((r[name] for r in found), _sum))[:-1]]
        if found:
            keys = F.array(*[F.lit(r[RANGE]) for r in found])
            earlier = F.map_from_arrays(keys, F.array(*[F.lit(b).cast(kind) for b in before]))[F.col(RANGE)]
            own = F.coalesce(own + earlier, own, earlier).cast(kind)
        shown.append(own.alias(name))
    return rows.select(*df.columns, *shown)


def numbered(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """``df`` with its rows numbered from 1 in an order that no two rows share."""
    return running_totals(df, order_by, {name: F.lit(1).cast("long")})
