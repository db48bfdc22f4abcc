"""The fact kept up to date by the periods that changed.

A line of the fact depends on its order's items, payments, reviews and the order itself. One digest per order over its
lines, as they stand and as they should be, tells which orders differ: new items, late payments and reviews, changed
status. The periods (days or months) of those orders, then and now, are rebuilt and overwritten; other partitions are not
touched.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from lakemart.plans import gold
from lakemart.session import folder_bytes, frame_bytes, scratch_path, sized_shuffles  # noqa: F401  (tests watch scratch_path)
from lakemart.sinks.tables import write_partitioned
from lakemart.sources.tables import delete_folder, partition_folders, read_partitioned

TABLES = ("order_items", "orders", "payments", "reviews")
DAY, PERIOD = "order_date", "period"
#: Bytes that a partition should hold: days are kept apart only where a day has as many.
PARTITION_BYTES = 64 * 1024**2
#: Bytes of files per task that joins their rows by order and compares them: sorted, they take some 35 times as much.
BYTES_PER_JOIN = 8 * 1024**2


def period_of(day: Column, unit: str) -> Column:
    """The first day of the day's period; ``unit`` is "day" or "month"."""
    if unit not in ("day", "month"):
        raise ValueError(f"periods are days or months, not {unit}")
    return day if unit == "day" else F.trunc(day, "month")


def unit_for(table_bytes: int, days: int) -> str:
    """Days where an average day fills a partition, else months: folders cost a listing and a file each."""
    return "day" if table_bytes >= PARTITION_BYTES * max(1, days) else "month"


def order_digests(lines: DataFrame) -> DataFrame:
    """order_id, digest, and the days of its lines (first, last, and whether some have none) for every order with lines.

    Combined in each task first; lines that lie placed by order are not sent. Sums and counts stand beside the
    exclusive-or, in which equal lines would cancel each other.
    """
    h = F.xxhash64(*lines.columns, *[F.col(c).isNull() for c in lines.columns])
    return (
        lines.select("order_id", DAY, h.alias("h"))
        .groupBy("order_id")
        .agg(
            F.min(DAY).alias("first"),
            F.max(DAY).alias("last"),
            F.bool_or(F.col(DAY).isNull()).alias("undated"),
            F.struct(F.bit_xor("h"), F.sum(F.col("h") % 1000003), F.count(F.lit(1))).alias("digest"),
        )
    )


def _periods_of(side: str, unit: str) -> Column:
    """The periods of an order's lines, nearly always one. Those between are among them where its rows differ in the day."""
    first, last = (period_of(F.col(f"{side}.{end}"), unit) for end in ("first", "last"))
    dated = F.coalesce(F.sequence(first, last, F.expr(f"interval 1 {unit}")), F.array().cast("array<date>"))
    return F.when(F.col(f"{side}.undated"), F.concat(dated, F.array(F.lit(None).cast("date")))).otherwise(dated)


def changed_periods(before: DataFrame, after: DataFrame, unit: str) -> DataFrame:
    """The periods (one column, NULL among them) of orders that are new, gone, changed or moved to another day."""
    b, a = before.alias("b"), after.alias("a")
    both = F.col("b.order_id").isNotNull() & F.col("a.order_id").isNotNull()
    same = both & F.col("b.digest").eqNullSafe(F.col("a.digest"))
    changed = b.join(a, F.col("a.order_id") == F.col("b.order_id"), "full").where(~same)
    periods = F.array_distinct(F.concat(_periods_of("b", unit), _periods_of("a", unit)))
    return changed.select(F.explode(periods).alias(PERIOD)).distinct()


def fact_of_periods(tables: Mapping[str, DataFrame], periods: DataFrame, unit: str) -> DataFrame:
    """The fact's lines of chosen periods, for a rebuild by hand; ``refresh_fact`` finds the periods among its own lines.

    A calendar is small: its periods are sent to every task.
    """
    period = period_of(F.to_date("order_purchase_timestamp"), unit)
    orders = tables["orders"].join(F.broadcast(periods), period.eqNullSafe(periods[PERIOD]), "left_semi")
    ids = orders.select("order_id")
    others = {n: tables[n].join(ids, "order_id", "left_semi") for n in ("order_items", "payments", "reviews")}
    return gold.fact_sales(others["order_items"], orders, others["payments"], others["reviews"])


def _folder(period: object) -> str:
    return f"{PERIOD}={'__HIVE_DEFAULT_PARTITION__' if period is None else period}"


def _periods_seen() -> list[Column]:
    """Observed of lines: their periods, and how many have none."""
    return [F.collect_set(PERIOD).alias("periods"), F.count_if(F.col(PERIOD).isNull()).alias("undated")]


def _listed(seen: Mapping[str, object]) -> set:
    return {*seen["periods"], *([None] if seen["undated"] else [])}


def refresh_fact(
    spark: SparkSession, tables: Mapping[str, DataFrame], target: str, unit: str = "day"
) -> dict[str, int]:
    """Bring the fact below ``target`` up to date with the cleaned tables; returns the periods rewritten and emptied.

    The fact is its own record: a run that died left periods as they were or as they should be, and the next one finds the
    others again. The first run writes all; ``unit`` has to stay what it was then.

    One job compares, picks and writes: the tables are sent around once for both, the digests and the lines.
    """
    fact = f"{target}/fact_sales"
    folders = partition_folders(spark, fact, PERIOD)
    lines = gold.fact_lines(*(tables[n] for n in TABLES))
    dated = lines.withColumn(PERIOD, period_of(F.col(DAY), unit))
    rows, size = dated, sum(frame_bytes(tables[n]) for n in TABLES)
    there, written = Observation(), Observation()
    if folders:
        before, after = read_fact(spark, tables, target), gold.fact_columns(lines)
        changed = changed_periods(order_digests(before), order_digests(after), unit)
        # A calendar is small: its periods are sent to every task.
        found = F.broadcast(changed.select(F.col(PERIOD).alias("_period"), F.lit(True).alias("_changed")))
        marked = dated.join(found, F.col(PERIOD).eqNullSafe(F.col("_period")), "left")
        rows = marked.observe(there, *_periods_seen()).where("_changed").drop("_period", "_changed")
        size += folder_bytes(spark, fact)
    with sized_shuffles(spark, size, BYTES_PER_JOIN):
        # The periods that have lines are observed on the way: the lines are made once and written once.
        write_partitioned(rows, fact, PERIOD, finish=lambda df: gold.fact_columns(df).observe(written, *_periods_seen()))
        rewritten = _listed(written.get)
        emptied = folders - {_folder(period) for period in rewritten}
        if emptied:
            # Where no line is written, Spark forgets what it saw before it picked them.
            kept = _listed(there.get) if rewritten else {r[0] for r in dated.select(PERIOD).distinct().collect()}
            # Periods that lost all their lines keep no folder.
            emptied -= {_folder(period) for period in kept}
    for folder in emptied:
        delete_folder(spark, f"{fact}/{folder}")
    return {"rewritten": len(rewritten), "emptied": len(emptied)}


def read_fact(spark: SparkSession, tables: Mapping[str, DataFrame], target: str) -> DataFrame:
    """The fact below ``target``; ``tables`` give its columns."""
    fact = gold.fact_sales(*(tables[n] for n in TABLES))
    schema = StructType([*fact.schema.fields, StructField(PERIOD, DateType())])
    return read_partitioned(spark, f"{target}/fact_sales", schema).select(*fact.columns)
