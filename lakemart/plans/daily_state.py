"""Key figures of any range of days from the state of its days, without the fact.

Sums of days add up; distinct counts do not, so each day keeps bitmaps of the numbers of its orders, customers,
products and sellers, and a range is the union of its days' bitmaps. Counts are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakemart.functions.money import amount, cents_sum, half_up
from lakemart.operators.running import numbered

DAY = "order_date"
#: What is counted, and the column of the fact that tells it apart.
COUNTED = {
    "orders": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
}
SUMS = ("cents", "score_sum", "score_count", "days_sum", "days_count")


def dense_ids(keys: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(key, id): every distinct key of the frame's first column with a number from 1 up, none left out.

    A second column, if there is one, puts the keys in order by its smallest value: numbered by their day, the orders of a
    day lie in few bitmaps instead of a few bits in each. Keys that ``known`` has keep their numbers, new ones follow, so bitmaps made before stay valid. NULL has none.
    """
    key, *first = keys.columns
    present = keys.where(F.col(key).isNotNull())
    distinct = present.groupBy(key).agg(*[F.min(c).alias(c) for c in first]) if first else present.distinct()
    order = [F.col(c) for c in (*first, key)]
    if known is None:
        return numbered(distinct, order, "id").select(key, "id")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0).cast("long"))).first()[0]
    new = numbered(distinct.join(known, key, "left_anti"), order, "id").select(key, "id")
    return known.unionByName(new.withColumn("id", F.col("id") + F.lit(top)))


def daily_bitmaps(fact: DataFrame, ids: Mapping[str, DataFrame]) -> DataFrame:
    """(order_date, kind, bucket, bitmap): who occurs on each day; lines without a date are on none.

    A bitmap covers 32,768 neighbouring numbers, so a day has a row for each such stretch that occurs on it. The fact is
    reduced to days and keys before it meets the numbers. The single bits are sent to where their bitmap is made: a
    bitmap of few bits takes 4 KB in every task that makes and sorts it.
    """
    dated = fact.where(F.col(DAY).isNotNull())
    kinds = []
    for kind, key in COUNTED.items():
        seen = dated.select(DAY, key).distinct().join(ids[kind], key)
        kinds.append(
            seen.select(DAY, F.lit(kind).alias("kind"), F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit"))
        )
    together = reduce(DataFrame.unionByName, kinds).repartition(DAY, "kind", "bucket")
    return together.groupBy(DAY, "kind", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def daily_sums(fact: DataFrame) -> DataFrame:
    """One row per day: what adds up."""
    return fact.where(F.col(DAY).isNotNull()).groupBy(DAY).agg(
        cents_sum("gross_revenue").alias("cents"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
        F.sum("delivery_days").alias("days_sum"),
        F.count("delivery_days").alias("days_count"),
    )


def merge_days(bitmaps: DataFrame) -> DataFrame:
    """(kind, bucket, bitmap) of all days together: a state that can be merged further."""
    return bitmaps.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def kpis_between(bitmaps: DataFrame, sums: DataFrame, first: str, last: str) -> DataFrame:
    """One row: distinct orders, customers, products and sellers, revenue and averages of the days first..last."""
    day = F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    bits = merge_days(bitmaps.where(day)).select("kind", F.bitmap_count("bitmap").alias("n"))
    counts = bits.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in COUNTED])
    total = sums.where(day).agg(*[F.sum(c).alias(c) for c in SUMS])
    one = F.lit(1).alias("one")
    return counts.select("*", one).join(total.select("*", one), "one").select(
        F.lit(first).cast("date").alias("first_day"),
        F.lit(last).cast("date").alias("last_day"),
        *COUNTED,
        amount(F.coalesce("cents", F.lit(0))).alias("revenue"),
        half_up(F.try_divide(F.col("score_sum"), F.col("score_count")), 2).alias("avg_review_score"),
        half_up(F.try_divide(F.col("days_sum"), F.col("days_count")), 1).alias("avg_delivery_days"),
    )


def kpis_of_ranges(bitmaps: DataFrame, sums: DataFrame, ranges: Sequence[tuple[str, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, (kpis_between(bitmaps, sums, a, b) for a, b in ranges))
