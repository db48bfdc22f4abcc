"""The two daily jobs: landed snapshots to cleaned tables, cleaned tables to the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from lakemart.operators.quality import GateError, enforce, gate_file_count, gate_unique
from lakemart.operators.scd2 import OBSERVED, first_observed, scd2_merge, scd2_splice
from lakemart.plans import gold, marts
from lakemart.plans.silver import csv_to_silver
from lakemart.schemas import SILVER
from lakemart.session import folder_bytes, scratch_path, sized_shuffles
from lakemart.sinks.buckets import is_bucketed
from lakemart.sinks.tables import write_table
from lakemart.sources.files import file_inventory, read_catalogue
from lakemart.sources.tables import (
    current_folder,
    delete_folder,
    drop_old_versions,
    publish,
    read_table,
    versions,
)
from lakemart.streaming.silver import read_silver

CLUSTER_BY = ("customer_id", "product_id")
TRACKED = ("product_category_en",)
DIMENSION_KEYS = {"dim_product": "product_id", "dim_customer": "customer_id", "dim_seller": "seller_id"}

# Fixed value: tables written at a time.
TABLES_AT_ONCE = 4

Counts = dict[str, object]


def write_all(writes: Mapping[str, Callable[[], Counts]]) -> dict[str, Counts]:
    """Run independent table writes, a few at a time, so small ones do not idle the cluster.

    The first failure is raised once the writes already started have ended; those not yet started are
    dropped.
    """
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        started = {name: pool.submit(write) for name, write in writes.items()}
        try:
            return {name: done.result() for name, done in started.items()}
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


def publish_all(
    spark: SparkSession, root: str, writes: Mapping[str, Callable[[], Counts]], gate: Callable[[dict[str, Counts]], None]
) -> dict[str, Counts]:
    """Write tables unseen by readers, check them, then publish them one right after the other.

    A failed write or gate leaves the tables of the run before as they are. Versions older than the one
    before are deleted.
    """
    counts: dict[str, Counts] = {}

    def noted(name: str, write: Callable[[], Counts]) -> Counts:
        counts[name] = write()
        return counts[name]

    try:
        write_all({name: partial(noted, name, write) for name, write in writes.items()})
        gate(counts)
    except BaseException:
        for name, done in counts.items():
            delete_folder(spark, f"{root}/{name}/{done['pending']}")
        raise
    for name in writes:
        publish(spark, f"{root}/{name}", counts[name].pop("pending"))
        drop_old_versions(spark, f"{root}/{name}")
    return {name: counts[name] for name in writes}


def current_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the current versions of some tables."""
    folders = [f"{p}/data" if is_bucketed(spark, p) else current_folder(spark, p) for p in paths]
    return folder_bytes(spark, *[f for f in folders if f])


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    quarantine: str | None = None,
    run_ts: Column | None = None,
    order_floor: int = 0,
    since: str | None = None,
) -> dict[str, Counts]:
    """Clean all seven tables and return the counts of each write.

    The gate on the orders uses the count observed during their write; no table is read again. Tables
    become visible together once it has passed.
    """
    writes = {
        name: partial(csv_to_silver, spark, spec, bronze, silver, quarantine, run_ts, since, publish=False)
        for name, spec in SILVER.items()
    }

    def gate(counts: dict[str, Counts]) -> None:
        if counts["orders"]["rows"] <= order_floor:
            raise GateError(f"orders: {counts['orders']['rows']} rows, need more than {order_floor}")

    for name in SILVER:
        gate_file_count(file_inventory(spark, f"{bronze}/{name}"), 1)
    sources = [f"{bronze}/{name}" for name in SILVER]
    with sized_shuffles(spark, folder_bytes(spark, *sources)):
        return publish_all(spark, silver, writes, gate)


def product_history(
    spark: SparkSession, path: str, today: DataFrame, run_date: str | Column | None
) -> DataFrame:
    """Today's products folded into the written history, or the first day's rows alone.

    Days may come in any order: a run for an earlier day splits the versions it falls into. Tables written before the days
    of a version were kept take later days only.
    """
    if run_date is None:
        return today
    incoming = gold.product_attributes(today)
    if not versions(spark, path):
        return first_observed(incoming, run_date, run_date)
    history = read_table(spark, path)
    fold = scd2_splice if OBSERVED in history.columns else scd2_merge
    return fold(history, incoming, ["product_id"], TRACKED, run_date)


def write_clustered(
    spark: SparkSession, df: DataFrame, path: str, partition_by: str | None, publish: bool = True
) -> Counts:
    """Write a computed table in z-order.

    Placing rows on the curve reads them three times: for the range bounds, for the sample behind
    the range partitioning, and to write. The rows are computed once, written to the shared
    folder, and those reads are scans of that.
    """
    staged = scratch_path(spark, "staged")
    try:
        write_table(df, staged)
        rows = read_table(spark, staged)
        return write_table(rows, path, partition_by, CLUSTER_BY, publish=publish)
    finally:
        delete_folder(spark, staged)


def silver_to_gold(
    spark: SparkSession,
    silver: str,
    catalogue: str,
    target: str,
    run_date: str | Column | None = None,
    keep_history: bool = False,
    partition_by: str | None = "order_date",
) -> dict[str, Counts]:
    """Build the star schema from written tables and return the counts of each write.

    The fact is partitioned by order date and clustered within it; ``partition_by=None`` only
    clusters it. ``keep_history`` folds products into their validity intervals instead of
    overwriting them.
    """
    table = {name: read_silver(spark, silver, spec) for name, spec in SILVER.items()}
    product = gold.dim_product(table["products"], read_catalogue(spark, catalogue), run_date)
    if keep_history:
        product = product_history(spark, f"{target}/dim_product", product, run_date)
    star = {
        "dim_product": product,
        "dim_customer": gold.dim_customer(table["customers"]),
        "dim_seller": gold.dim_seller(table["sellers"]),
        "dim_date": gold.dim_date(table["orders"]),
    }
    fact = gold.fact_sales(
        table["order_items"], table["orders"], table["payments"], table["reviews"]
    )
    path = f"{target}/fact_sales"
    writes = {"fact_sales": partial(write_clustered, spark, fact, path, partition_by, publish=False)}
    for name, df in star.items():
        writes[name] = partial(write_table, df, f"{target}/{name}", publish=False)

    def gate(counts: dict[str, Counts]) -> None:
        for name, key in DIMENSION_KEYS.items():
            written = spark.read.parquet(f"{target}/{name}/{counts[name]['pending']}")
            enforce(gate_unique(marts.current(written), [key]), f"{name}: {key} repeats")

    with sized_shuffles(spark, current_bytes(spark, *[f"{silver}/{name}" for name in SILVER])):
        return publish_all(spark, target, writes, gate)


def read_star(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    names = ("fact_sales", "dim_product", "dim_customer", "dim_seller", "dim_date")
    return {name: read_table(spark, f"{target}/{name}") for name in names}
