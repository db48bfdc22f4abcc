"""The registered queries, one per operator. Each takes (spark, folder of parquet tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemart.functions.dates import (
    calendar_columns,
    calendar_days,
    elapsed_days,
    is_weekend,
    iso_month,
    iso_week,
    iso_year,
)
from lakemart.functions.money import amount, gross_revenue, half_up
from lakemart.functions.text import category_tags, flat_tags, looks_like_month, or_unknown, UNKNOWN
from lakemart.operators.aggregates import first_order, order_total, payment_total, sales_by_product
from lakemart.operators.dedup import dedup
from lakemart.operators.joins import join_spread
from lakemart.operators.quality import expectations, file_count, gate_output, gate_unique, row_floor
from lakemart.operators.reviews import latest_review, latest_review_ranked
from lakemart.operators.scd2 import (
    FLOOR_DATE,
    OBSERVED,
    as_of_join,
    first_observed,
    scd2_merge,
    scd2_splice,
    with_validity,
)
from lakemart.operators.upsert import upsert, upsert_metrics
from lakemart.plans import gold, marts, reports
from lakemart.plans import daily_state, fact_increment, upkeep
from lakemart.plans.catalogue import build_catalogue, margin_from_number
from lakemart.plans.silver import csv_to_silver, latest_snapshot, split_bad_rows, with_lineage
from lakemart.schemas import (
    CATALOGUE_DDL,
    GOLD_CSV_DDL,
    NATURAL_KEYS,
    REQUIRED,
    SILVER,
    SILVER_DDL,
    TableSpec,
    pick,
)
from lakemart.session import scratch_path
from lakemart.sinks.bronze import land_csv, land_jsonl
from lakemart.sinks.layout import zorder
from lakemart.sinks.recluster import file_ranges, overlap_depth, recluster_worst
from lakemart.sinks.tables import export_csv, to_json_rows, write_partitioned, write_table
from lakemart.sources.files import (
    file_inventory,
    project_catalogue,
    read_catalogue,
    read_csv,
    read_csv_text,
    read_gold_csv,
    read_snapshots,
    read_translation,
)
from lakemart.sources.tables import read_partitioned, read_table, register_views
from lakemart.streaming.incremental import current_rows, ingest_incremental
from lakemart.streaming.silver import REASONS, cleaned_rows, ingest_to_silver, refused_rows
from lakemart.workload.inputs import all_shipped
from lakemart.workload.lakehouse import LAST_DATE, NEXT_DATE, RANGES, RUN_DATE, Lakehouse, run_ts

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

ITEM = ("order_id", "order_item_id")


def register(name: str | None = None):
    """Register a function of a lakehouse as a query of (spark, folder)."""

    def wrap(build: Callable[[Lakehouse], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Lakehouse(spark, sf_dir))

        query.__name__ = query.__qualname__ = name or build.__name__
        query.__doc__ = build.__doc__
        REGISTRY[name or build.__name__] = query
        return build

    return wrap


def ddl_of(df: DataFrame, table: str) -> str:
    return pick(SILVER_DDL[table], df.columns)


def raw_tables(lake: Lakehouse) -> dict[str, DataFrame]:
    raw = lake.raw
    return {
        "orders": raw.orders,
        "order_items": raw.order_items_raw,
        "customers": raw.customers,
        "products": raw.products,
        "sellers": raw.sellers,
        "payments": raw.payments,
        "reviews": raw.reviews_raw,
    }


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def with_flat_tags(df: DataFrame) -> DataFrame:
    """Tags as text for comparison; a missing array stays missing."""
    return df.withColumn("tags", F.array_join("tags", ","))


def flat_dim_product(dim: DataFrame) -> DataFrame:
    return dim.withColumn("tags", flat_tags())


def landed(lake: Lakehouse, day: str = RUN_DATE) -> str:
    """All raw tables landed as CSV under one ingest date; returns the folder."""
    root = scratch_path(lake.spark, "bronze")
    for name, df in raw_tables(lake).items():
        land_csv(df, root, name, day)
    return root


def landed_orders(lake: Lakehouse) -> tuple[str, str]:
    """Two daily snapshots of the orders; returns the folder and the pinned schema."""
    root = scratch_path(lake.spark, "bronze")
    land_csv(lake.raw.orders, root, "orders", RUN_DATE)
    path = land_csv(lake.raw.orders_next, root, "orders", NEXT_DATE)
    return path, ddl_of(lake.raw.orders, "orders")


# ---- sources


@register()
def scan_csv_pinned(lake: Lakehouse) -> DataFrame:
    items = lake.raw.order_items_raw
    path = scratch_path(lake.spark, "items-csv")
    export_csv(items, path)
    return read_csv(lake.spark, path, ddl_of(items, "order_items"))


@register()
def scan_bronze_snapshots(lake: Lakehouse) -> DataFrame:
    path, ddl = landed_orders(lake)
    return read_snapshots(lake.spark, path, ddl)


@register()
def scan_bronze_since(lake: Lakehouse) -> DataFrame:
    path, ddl = landed_orders(lake)
    return read_snapshots(lake.spark, path, ddl, since=NEXT_DATE)


@register()
def scan_catalogue(lake: Lakehouse) -> DataFrame:
    root = scratch_path(lake.spark, "catalogue")
    path = land_jsonl(lake.raw.catalogue, root, "product_catalogue", "product_id", RUN_DATE)
    return with_flat_tags(read_catalogue(lake.spark, path))


@register()
def scan_silver(lake: Lakehouse) -> DataFrame:
    return count_rows({name: lake.silver(name) for name in SILVER_DDL})


@register()
def scan_gold_csv(lake: Lakehouse) -> DataFrame:
    return exported(lake)["fact_sales"]


@register()
def scan_translation(lake: Lakehouse) -> DataFrame:
    path = scratch_path(lake.spark, "translation")
    export_csv(lake.raw.translation, path)
    lookup = read_translation(lake.spark, path)
    return lake.silver("products").join(lookup, "product_category_name", "left").select(
        "product_id", "product_category_name_english"
    )


@register()
def gold_table_views(lake: Lakehouse) -> DataFrame:
    """SQL text over the five named views."""
    register_views(lake.star())
    return lake.spark.sql(
        """
        select d.year, d.month, d.month_name, p.product_category_en,
               count(distinct f.order_id) as orders,
               cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as gross_revenue,
               cast(sum(cast(f.gross_revenue as decimal(18,2)) * cast(p.margin_pct as decimal(6,3)))
                    as double) as estimated_margin
        from v_fact_sales f
        join v_dim_date d on d.date_key = f.order_date
        join v_dim_product p on p.product_id = f.product_id
        where p.is_current
        group by d.year, d.month, d.month_name, p.product_category_en
        """
    )


@register("file_inventory")
def landed_file_inventory(lake: Lakehouse) -> DataFrame:
    files = file_inventory(lake.spark, landed(lake))
    table = F.regexp_extract("path", r"/([^/]+)/ingest_date=", 1)
    return files.groupBy(table.alias("table_name")).agg(
        F.bool_and(F.col("length") > 0).alias("all_filled")
    )


# ---- sinks


@register()
def land_bronze_csv(lake: Lakehouse) -> DataFrame:
    root = landed(lake)
    tables = raw_tables(lake)
    return count_rows(
        {n: read_snapshots(lake.spark, f"{root}/{n}", ddl_of(df, n)) for n, df in tables.items()}
    )


@register()
def land_bronze_jsonl(lake: Lakehouse) -> DataFrame:
    root = scratch_path(lake.spark, "catalogue")
    path = land_jsonl(lake.raw.catalogue, root, "product_catalogue", "product_id", RUN_DATE)
    return with_flat_tags(lake.spark.read.schema(CATALOGUE_DDL).json(path))


@register()
def write_overwrite(lake: Lakehouse) -> DataFrame:
    """A table written twice, the second time with another schema."""
    path = scratch_path(lake.spark, "dim_product")
    write_table(lake.silver("products"), path)
    write_table(gold.dim_product(lake.silver("products"), lake.catalogue(), RUN_DATE), path)
    return flat_dim_product(read_table(lake.spark, path))


@register()
def write_fact_partitioned(lake: Lakehouse) -> DataFrame:
    path = scratch_path(lake.spark, "fact-by-day")
    fact = lake.fact()
    write_partitioned(fact, path, "order_date")
    return read_partitioned(lake.spark, path, fact.schema)


def exported(lake: Lakehouse) -> dict[str, DataFrame]:
    root = scratch_path(lake.spark, "gold-csv")
    star = lake.star()
    for name, df in star.items():
        export_csv(df, f"{root}/{name}")
    ddl = {name: pick(GOLD_CSV_DDL[name], df.columns) for name, df in star.items()}
    return read_gold_csv(lake.spark, root, ddl)


@register()
def export_gold_csv(lake: Lakehouse) -> DataFrame:
    """Tags come back as the flattened text."""
    return exported(lake)["dim_product"]


@register()
def upsert_catalogue(lake: Lakehouse) -> DataFrame:
    return with_flat_tags(upsert(lake.raw.catalogue, lake.raw.catalogue_next, ["product_id"]))


@register("upsert_metrics")
def catalogue_upsert_metrics(lake: Lakehouse) -> DataFrame:
    return upsert_metrics(lake.raw.catalogue, lake.raw.catalogue_next, ["product_id"])


@register()
def optimize_zorder(lake: Lakehouse) -> DataFrame:
    path = scratch_path(lake.spark, "fact-zorder")
    write_table(zorder(lake.fact(), ["customer_id", "product_id"]), path)
    return read_table(lake.spark, path)


@register()
def result_json(lake: Lakehouse) -> DataFrame:
    sellers = marts.top_sellers(lake.fact(), lake.seller(), marts.LIMIT_MAX)
    return to_json_rows(sellers, ["revenue", "avg_review", "avg_delivery_days"])


# ---- projections and predicates


@register()
def project_rename(lake: Lakehouse) -> DataFrame:
    return project_catalogue(lake.raw.catalogue).drop("tags")


@register()
def lineage_columns(lake: Lakehouse) -> DataFrame:
    return with_lineage(lake.raw.orders, run_ts())


@register()
def scd_shape_columns(lake: Lakehouse) -> DataFrame:
    return with_validity(lake.raw.products, RUN_DATE)


@register("gross_revenue")
def item_gross_revenue(lake: Lakehouse) -> DataFrame:
    return lake.silver("order_items").select(*ITEM, gross_revenue().alias("gross_revenue"))


@register("allocated_payment")
def item_allocated_payment(lake: Lakehouse) -> DataFrame:
    return built_fact(lake).select(*ITEM, "allocated_payment")


@register()
def default_unknown(lake: Lakehouse) -> DataFrame:
    category = or_unknown("product_category_name").alias("product_category_name")
    return lake.raw.products.select("product_id", category)


@register()
def filter_not_null(lake: Lakehouse) -> DataFrame:
    orders = lake.silver("orders").where(F.col("order_purchase_timestamp").isNotNull())
    return orders.select("order_id", "order_purchase_timestamp")


@register()
def filter_current(lake: Lakehouse) -> DataFrame:
    return catalogue_history(lake).where("is_current").select("product_id", "category_en")


@register()
def filter_exclude_unknown(lake: Lakehouse) -> DataFrame:
    known = lake.product().where(F.col("product_category_en") != UNKNOWN)
    return known.select("product_id", "product_category_en")


@register()
def filter_month_regex(lake: Lakehouse) -> DataFrame:
    months = lake.fact().select(iso_month("order_date").alias("month")).where(looks_like_month("month"))
    return months.groupBy("month").agg(F.count(F.lit(1)).alias("items"))


@register("is_weekend")
def weekend_days(lake: Lakehouse) -> DataFrame:
    return gold.order_dates(lake.silver("orders")).select(
        "date_key", is_weekend("date_key").alias("is_weekend")
    )


@register("category_tags")
def product_category_tags(lake: Lakehouse) -> DataFrame:
    translated = lake.raw.products.join(lake.raw.translation, "product_category_name", "left")
    english = or_unknown("product_category_name_english")
    return translated.select(
        "product_id",
        english.alias("category_en"),
        F.array_join(category_tags(english), ",").alias("tags"),
    )


@register()
def catalogue_build(lake: Lakehouse) -> DataFrame:
    raw = lake.raw
    return with_flat_tags(build_catalogue(raw.products, raw.translation, margin_from_number()))


def product_history(lake: Lakehouse) -> DataFrame:
    """The products with a second day's catalogue merged in: changed categories have two versions."""
    first = lake.product()
    second = gold.dim_product(lake.silver("products"), project_catalogue(lake.raw.catalogue_next), NEXT_DATE)
    return scd2_merge(first, gold.product_attributes(second), ["product_id"], ["product_category_en"], NEXT_DATE)


@register()
def top_categories_with_history(lake: Lakehouse) -> DataFrame:
    """Each sale counts once, under the current category of its product."""
    return marts.top_categories(lake.fact(), product_history(lake))


def keyless_customers(lake: Lakehouse) -> DataFrame:
    """The customers, every tenth without its id."""
    named = F.col("customer_id").cast("bigint") % 10 != 0
    return lake.raw.customers.withColumn("customer_id", F.when(named, F.col("customer_id")))


def stored_customers(lake: Lakehouse, *days: tuple[str, DataFrame]) -> tuple[str, TableSpec]:
    """Daily snapshots of customers, ingested one after the other; the folder of silver tables, and the spec."""
    bronze, silver = scratch_path(lake.spark, "bronze"), scratch_path(lake.spark, "silver")
    for day, rows in days:
        spec = replace(SILVER["customers"], ddl=ddl_of(rows, "customers"))
        land_csv(rows, bronze, "customers", day)
        csv_to_silver(lake.spark, spec, bronze, silver, since=day)
    return silver, spec


@register()
def silver_missing_keys(lake: Lakehouse) -> DataFrame:
    """Good rows and diverted ones together are the input."""
    silver, _ = stored_customers(lake, (RUN_DATE, keyless_customers(lake)))
    good, bad = (read_table(lake.spark, f"{silver}/{name}") for name in ("customers", "_refused/customers"))
    columns = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    return good.select(*columns, F.lit(True).alias("stored")).unionByName(
        bad.select(*columns, F.lit(False).alias("stored"))
    )


@register()
def silver_merge_since(lake: Lakehouse) -> DataFrame:
    """Day 2 brings every third customer anew; the others stay as they were."""
    raw = lake.raw.customers
    number = F.col("customer_id").cast("bigint")
    moved = raw.where(number % 3 == 0).withColumn("customer_city", F.lit("moved"))
    silver, _ = stored_customers(lake, (RUN_DATE, raw), (NEXT_DATE, moved))
    return read_table(lake.spark, f"{silver}/customers").drop("_ingest_ts")


@register()
def limit_bounds(lake: Lakehouse) -> DataFrame:
    """The top categories at a limit below their number."""
    return marts.top_categories(lake.fact(), lake.product(), 3)


# ---- joins


@register()
def join_product_catalogue(lake: Lakehouse) -> DataFrame:
    dim = gold.dim_product(lake.silver("products"), lake.catalogue(), RUN_DATE)
    return with_flat_tags(gold.product_attributes(dim))


@register()
def join_items_orders(lake: Lakehouse) -> DataFrame:
    items, orders = lake.silver("order_items"), lake.silver("orders")
    return items.join(orders, "order_id").select(*ITEM, "customer_id", "order_status")


@register()
def join_order_total(lake: Lakehouse) -> DataFrame:
    items = lake.silver("order_items").select(*ITEM, "price")
    return join_spread(items, order_total(items), "order_id", ["order_item_id"])


@register()
def join_payment_total(lake: Lakehouse) -> DataFrame:
    items = lake.silver("order_items").select(*ITEM)
    totals = payment_total(lake.silver("payments"))
    return join_spread(items, totals, "order_id", ["order_item_id"], "left")


@register()
def join_latest_review(lake: Lakehouse) -> DataFrame:
    items = lake.silver("order_items").select(*ITEM)
    latest = latest_review(lake.silver("reviews"))
    return join_spread(items, latest, "order_id", ["order_item_id"], "left")


def fact_with(lake: Lakehouse, dim: DataFrame, key: str, how: str, *columns: str) -> DataFrame:
    joined = lake.fact().join(dim.select(key, *columns), key, how)
    return joined.select(*ITEM, "gross_revenue", *columns)


@register()
def join_fact_product(lake: Lakehouse) -> DataFrame:
    return fact_with(
        lake, marts.current(lake.product()), "product_id", "inner", "product_category_en", "margin_pct"
    )


@register()
def join_fact_product_left(lake: Lakehouse) -> DataFrame:
    return fact_with(lake, marts.current(lake.product()), "product_id", "left", "product_category_en")


@register()
def join_fact_customer(lake: Lakehouse) -> DataFrame:
    return fact_with(lake, lake.customer(), "customer_id", "left", "customer_state")


@register()
def join_fact_customer_inner(lake: Lakehouse) -> DataFrame:
    return fact_with(lake, lake.customer(), "customer_id", "inner", "customer_state")


@register()
def join_fact_seller(lake: Lakehouse) -> DataFrame:
    return fact_with(lake, lake.seller(), "seller_id", "left", "seller_state")


@register()
def join_fact_seller_inner(lake: Lakehouse) -> DataFrame:
    return fact_with(lake, lake.seller(), "seller_id", "inner", "seller_state")


@register()
def join_fact_date(lake: Lakehouse) -> DataFrame:
    """The calendar has one row per day at most, so it can always be broadcast."""
    dates = F.broadcast(lake.date().select("date_key", "year", "month_name"))
    joined = lake.fact().join(dates, F.col("order_date") == F.col("date_key"))
    return joined.select(*ITEM, "date_key", "year", "month_name")


@register()
def join_first_order(lake: Lakehouse) -> DataFrame:
    sales = lake.fact().select(*ITEM, "customer_id", "order_date")
    return marts.with_first_order(sales)


def built_fact(lake: Lakehouse) -> DataFrame:
    """The fact planned from the cleaned tables."""
    return gold.fact_sales(*map(lake.silver, ("order_items", "orders", "payments", "reviews")))


@register()
def fact_sales(lake: Lakehouse) -> DataFrame:
    return built_fact(lake)


# ---- aggregates


@register()
def agg_order_total(lake: Lakehouse) -> DataFrame:
    return order_total(lake.silver("order_items"))


@register()
def agg_payment_total(lake: Lakehouse) -> DataFrame:
    return payment_total(lake.silver("payments"))


@register()
def agg_first_order(lake: Lakehouse) -> DataFrame:
    return first_order(lake.fact())


@register()
def agg_distinct_count(lake: Lakehouse) -> DataFrame:
    """Four distinct counts, each over its own column: rows are not repeated per count."""
    fact = lake.fact()
    keys = {
        "customers": "customer_id",
        "products": "product_id",
        "sellers": "seller_id",
    }
    orders = fact.agg(F.count_distinct("order_id").alias("orders"))
    return orders.select(
        "orders", *[marts.distinct_keys(fact, key).alias(name) for name, key in keys.items()]
    )


@register()
def agg_conditional_distinct(lake: Lakehouse) -> DataFrame:
    everything = marts.customer_days(lake.fact()).withColumn("period", F.lit(1))
    return marts.count_new_and_returning(everything, "period").drop("period", "revenue")


@register()
def agg_weighted_sum(lake: Lakehouse) -> DataFrame:
    return reports.margin_waterfall(lake.fact(), lake.product()).drop("running_margin")


@register()
def agg_mean_skip_null(lake: Lakehouse) -> DataFrame:
    return lake.fact().groupBy("seller_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.avg("delivery_days").alias("avg_delivery_days"),
    )


@register()
def agg_min_max_date(lake: Lakehouse) -> DataFrame:
    return lake.fact().groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )


@register()
def agg_count_star_vs_col(lake: Lakehouse) -> DataFrame:
    return lake.fact().groupBy("order_status").agg(
        F.count(F.lit(1)).alias("rows_all"),
        F.count("order_item_id").alias("items"),
        F.count("review_score").alias("scored"),
        F.count("delivery_days").alias("delivered"),
    )


@register()
def agg_enriched_count(lake: Lakehouse) -> DataFrame:
    star = lake.star()
    product = star["dim_product"].agg(
        F.count(F.lit(1)).alias("dim_product"),
        F.count_if(F.col("product_category_en") != UNKNOWN).alias("enriched"),
    )
    others = [
        df.agg(F.count(F.lit(1))).scalar().alias(name)
        for name, df in star.items()
        if name != "dim_product"
    ]
    return product.select("*", *others)


# ---- windows, order, duplicates


@register("latest_review")
def latest_review_rows(lake: Lakehouse) -> DataFrame:
    return latest_review_ranked(lake.raw.reviews)


@register()
def latest_review_sorted_dedup(lake: Lakehouse) -> DataFrame:
    return latest_review_ranked(lake.raw.reviews_raw, null_date_wins=True)


@register("top_k")
def top_products(lake: Lakehouse) -> DataFrame:
    best = marts.top_k(sales_by_product(lake.fact()), "cents", "product_id", 10)
    return best.select("product_id", amount("cents").alias("revenue"))


@register()
def sort_full(lake: Lakehouse) -> DataFrame:
    return marts.state_revenue(lake.fact(), lake.customer())


@register()
def dedup_natural_key(lake: Lakehouse) -> DataFrame:
    return lake.raw.order_items


@register()
def dedup_orders(lake: Lakehouse) -> DataFrame:
    """Two landed snapshots, the newer row of each order kept."""
    path, ddl = landed_orders(lake)
    return latest_snapshot(read_snapshots(lake.spark, path, ddl), NATURAL_KEYS["orders"])


def _register_dedup(table: str, source: str, *latest_by: str) -> None:
    def build(lake: Lakehouse) -> DataFrame:
        rows = getattr(lake.raw, source)
        return dedup(rows, NATURAL_KEYS[table], latest_by)

    register(f"dedup_{table}")(build)


_register_dedup("customers", "customers")
_register_dedup("products", "products")
_register_dedup("sellers", "sellers")
_register_dedup("payments", "payments")
_register_dedup("reviews", "reviews_raw", "review_creation_date")


@register()
def distinct_dates(lake: Lakehouse) -> DataFrame:
    return gold.order_dates(lake.silver("orders"))


# ---- scalar functions


@register()
def scalar_date_parts(lake: Lakehouse) -> DataFrame:
    return gold.order_dates(lake.silver("orders")).withColumns(calendar_columns("date_key"))


@register()
def scalar_date_diff(lake: Lakehouse) -> DataFrame:
    start, end = "order_purchase_timestamp", "order_delivered_customer_date"
    return lake.raw.orders.select(
        "order_id",
        calendar_days(start, end).alias("calendar_days"),
        elapsed_days(start, end).alias("elapsed_days"),
        elapsed_days(end, start).alias("elapsed_days_back"),
    )


@register()
def scalar_parse_coerce(lake: Lakehouse) -> DataFrame:
    placed = lake.spark.read.parquet(f"{lake.sf_dir}/orders.parquet")
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("o_orderkey") % 50 == 0, F.lit("no date")).otherwise(written)
    return placed.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        text.try_cast("timestamp_ntz").alias("parsed"),
        F.substring(text, 1, 7).alias("month_text"),
        iso_week("o_orderdate").alias("iso_week"),
        iso_year("o_orderdate").alias("iso_year"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"),
    )


@register()
def scalar_string_array(lake: Lakehouse) -> DataFrame:
    catalogue = lake.raw.catalogue
    return lake.raw.products.join(catalogue, "product_id", "left").select(
        "product_id",
        flat_tags().alias("tag_text"),
        F.coalesce("category_en", F.lit("")).contains("electronics").alias("is_electronics"),
        F.coalesce("category_pt", F.lit("")).alias("category_pt"),
    )


@register()
def scalar_round(lake: Lakehouse) -> DataFrame:
    parts = lake.spark.read.parquet(f"{lake.sf_dir}/part.parquet")
    return parts.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        half_up(F.col("p_retailprice") / 3, 2).alias("two_places"),
        half_up(F.col("p_retailprice") / 7, 1).alias("one_place"),
        half_up(F.col("p_size") / F.lit(7.0), 3).alias("three_places"),
    )


@register()
def scalar_format_cards(lake: Lakehouse) -> DataFrame:
    return marts.kpi_cards(kpi_row(lake))


# ---- dimensions and marts


@register()
def dim_product(lake: Lakehouse) -> DataFrame:
    catalogue = project_catalogue(lake.raw.catalogue)
    return flat_dim_product(gold.dim_product(lake.raw.products, catalogue, RUN_DATE))


@register()
def dim_customer(lake: Lakehouse) -> DataFrame:
    return gold.dim_customer(lake.raw.customers)


@register()
def dim_seller(lake: Lakehouse) -> DataFrame:
    return gold.dim_seller(lake.raw.sellers)


@register()
def dim_date(lake: Lakehouse) -> DataFrame:
    return gold.dim_date(lake.raw.orders)


@register()
def fact_sales_elapsed(lake: Lakehouse) -> DataFrame:
    """Whole elapsed days, undated reviews last, reviews as landed."""
    return gold.fact_sales(
        *map(lake.silver, ("order_items", "orders", "payments")),
        lake.raw.reviews_raw,
        days="elapsed",
        null_date_wins=True,
    )


def kpi_row(lake: Lakehouse) -> DataFrame:
    return marts.kpis(lake.fact(), lake.customer(), lake.product(), lake.seller())


def _register_mart(name: str, build: Callable[[Lakehouse], DataFrame]) -> None:
    register(name)(build)


_register_mart(
    "revenue_by_category_notebook", lambda k: marts.revenue_by_category(k.fact(), k.product())
)
_register_mart("kpis", kpi_row)
_register_mart("top_categories", lambda k: marts.top_categories(k.fact(), k.product()))
_register_mart("state_revenue", lambda k: marts.state_revenue(k.fact(), k.customer()))
_register_mart("revenue_trend", lambda k: marts.revenue_trend(k.fact()))
_register_mart("top_sellers", lambda k: marts.top_sellers(k.fact(), k.seller()))
_register_mart("top_states", lambda k: marts.state_revenue(k.fact(), k.customer(), 10))
_register_mart(
    "vw_monthly_revenue_by_category",
    lambda k: marts.monthly_by_category(k.fact(), k.date(), k.product()),
)
_register_mart("vw_customer_ltv", lambda k: marts.customer_ltv(k.fact(), k.customer()))
_register_mart("vw_seller_performance", lambda k: marts.seller_performance(k.fact(), k.seller()))
_register_mart("vw_weekly_cohort", lambda k: marts.weekly_cohort(k.fact(), k.date()))
_register_mart("weekly_cohort_iso_year", lambda k: marts.weekly_cohort(k.fact(), k.date(), "iso"))
_register_mart(
    "customer_ltv_by_person",
    lambda k: marts.customer_ltv(k.fact(), k.customer(), "customer_unique_id"),
)

# ---- reports

_register_mart("delivery_days_histogram", lambda k: reports.delivery_days_histogram(k.fact()))
_register_mart("ltv_distribution", lambda k: reports.ltv_distribution(k.fact(), k.customer()))
_register_mart("category_share", lambda k: reports.category_share(k.fact(), k.product()))
_register_mart("margin_waterfall", lambda k: reports.margin_waterfall(k.fact(), k.product()))
_register_mart("review_heatmap", lambda k: reports.review_heatmap(k.fact(), k.customer()))
_register_mart("tag_cloud", lambda k: reports.tag_cloud(k.fact(), k.product()))
_register_mart("cohort_matrix", lambda k: reports.cohort_matrix(k.fact()))


# ---- history, quality, incremental


def catalogue_history(lake: Lakehouse) -> DataFrame:
    """Two days of the catalogue as validity intervals of the category."""
    columns = ["product_id", "category_en", "margin_pct"]
    day1 = with_validity(lake.raw.catalogue.select(columns), FLOOR_DATE)
    day2 = lake.raw.catalogue_next.select(columns)
    return scd2_merge(day1, day2, ["product_id"], ["category_en"], NEXT_DATE)


@register("scd2_merge")
def catalogue_scd2(lake: Lakehouse) -> DataFrame:
    return catalogue_history(lake)


@register()
def dim_product_as_of(lake: Lakehouse) -> DataFrame:
    path = scratch_path(lake.spark, "catalogue-history")
    write_table(catalogue_history(lake), path)
    history = read_table(lake.spark, path)
    return as_of_join(lake.fact(), history, "product_id", "order_date").select(
        *ITEM, "product_id", "order_date", "category_en", "effective_from"
    )


@register()
def gate_row_floor(lake: Lakehouse) -> DataFrame:
    return row_floor(lake.silver("orders"))


@register()
def gate_file_count(lake: Lakehouse) -> DataFrame:
    """At least one file for each of the seven landed tables."""
    return file_count(file_inventory(lake.spark, landed(lake)), len(SILVER_DDL)).select("ok")


@register()
def gate_unique_key(lake: Lakehouse) -> DataFrame:
    checked = {
        "order_items": gate_unique(lake.raw.order_items_raw, NATURAL_KEYS["order_items"]),
        "catalogue": gate_unique(lake.raw.catalogue, ["product_id"]),
    }
    named = [df.withColumn("table_name", F.lit(name)) for name, df in checked.items()]
    return reduce(DataFrame.unionByName, named)


@register()
def gate_expectations(lake: Lakehouse) -> DataFrame:
    fact, product, orders = lake.fact(), lake.product(), lake.silver("orders")
    of_fact = expectations(
        fact,
        {
            "orders above floor": (F.count_distinct("order_id"), lambda n: n > 0),
            "items above floor": (F.count(F.lit(1)), lambda n: n > 0),
            "score within 0..5": (F.avg("review_score"), lambda s: s.between(0, 5)),
            "rows without gross revenue": (
                F.count_if(F.col("gross_revenue").isNull()),
                lambda n: n == 0,
            ),
        },
    )
    loaded = lake.silver("products").agg(F.count(F.lit(1))).scalar()
    of_product = expectations(
        product, {"products in dimension": (F.count(F.lit(1)), lambda n: n == loaded)}
    )
    # At most one order in twenty may be without items.
    allowed = orders.agg(F.count(F.lit(1)) / F.lit(20.0)).scalar()
    unsold = orders.join(fact.select("order_id").distinct(), "order_id", "left_anti")
    coverage = expectations(
        unsold, {"loaded orders without sales": (F.count(F.lit(1)), lambda n: n <= allowed)}
    )
    return of_fact.unionByName(of_product).unionByName(coverage)


def damaged_items(lake: Lakehouse):
    """The raw items as text with some cells damaged on the way, landed and split again."""
    items = lake.raw.order_items_raw
    number = F.col("order_id").cast("bigint")
    text = items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])
    damaged = text.withColumns(
        {
            "price": F.when(number % 10 == 3, F.lit("n/a")).otherwise(F.col("price")),
            "product_id": F.when(number % 17 != 5, F.col("product_id")),
        }
    )
    path = scratch_path(lake.spark, "damaged-csv")
    export_csv(damaged, path)
    ddl = ddl_of(items, "order_items")
    return split_bad_rows(read_csv_text(lake.spark, path, ddl), ddl, REQUIRED["order_items"])


@register()
def quarantine_bad_rows(lake: Lakehouse) -> DataFrame:
    bad = damaged_items(lake).bad
    in_order = F.array_join(F.sort_array("_reasons"), ",").alias("reasons")
    return bad.select("order_id", F.col("order_item_id").cast("int").alias("order_item_id"), in_order)


@register()
def quarantine_good_rows(lake: Lakehouse) -> DataFrame:
    return damaged_items(lake).good


@register("incremental_ingest")
def incremental_orders(lake: Lakehouse) -> DataFrame:
    """Two days of files arriving in turn; the stream runs once per day."""
    spark, orders = lake.spark, lake.raw.orders
    root, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "orders-log", "progress"))
    ddl, keys = ddl_of(orders, "orders"), NATURAL_KEYS["orders"]
    for day, rows in ((RUN_DATE, orders), (NEXT_DATE, lake.raw.orders_next)):
        source = land_csv(rows, root, "orders", day)
        ingest_incremental(spark, source, ddl, keys, target, checkpoint)
    return current_rows(spark, target, ddl, keys)


# ---- upkeep: days that come late, tables and figures kept up to date by what changed


@register()
def scd2_late_version(lake: Lakehouse) -> DataFrame:
    """Three days of the catalogue, the one between folded in last."""
    columns = ["product_id", "category_en", "margin_pct"]
    key, tracked = ["product_id"], ["category_en"]
    history = first_observed(lake.raw.catalogue.select(columns), RUN_DATE)
    history = scd2_splice(history, lake.raw.catalogue_next.select(columns), key, tracked, LAST_DATE)
    history = scd2_splice(history, lake.raw.catalogue_interim.select(columns), key, tracked, NEXT_DATE)
    return history.withColumn("days_seen", F.size(OBSERVED)).drop(OBSERVED)


def streamed_orders(lake: Lakehouse) -> tuple[str, str]:
    """Three days of files streamed into a bucketed table, one day a run; returns it and its schema."""
    spark, orders = lake.spark, lake.raw.orders
    root, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "silver-orders", "progress"))
    ddl, keys, required = ddl_of(orders, "orders"), tuple(NATURAL_KEYS["orders"]), tuple(REQUIRED["orders"])
    for day, rows in ((RUN_DATE, orders), (NEXT_DATE, lake.raw.orders_next), (LAST_DATE, lake.raw.orders_closed)):
        source = land_csv(rows, root, "orders", day)
        ingest_to_silver(spark, source, ddl, keys, required, target, checkpoint, buckets=16)
    return target, ddl


@register()
def incremental_to_silver(lake: Lakehouse) -> DataFrame:
    return cleaned_rows(lake.spark, *streamed_orders(lake))


@register()
def incremental_refused(lake: Lakehouse) -> DataFrame:
    refused = refused_rows(lake.spark, *streamed_orders(lake))
    return refused.select("order_id", "order_status", "ingest_date", F.array_join(REASONS, ",").alias("reasons"))


@register()
def fact_sales_incremental(lake: Lakehouse) -> DataFrame:
    """The fact of an earlier state, brought up to date with items, payments and reviews that came late and changed orders."""
    tables = {n: lake.silver(n) for n in ("order_items", "orders", "payments", "reviews")}
    earlier = {
        "order_items": tables["order_items"].where("order_item_id < 4"),
        "orders": all_shipped(tables["orders"]),
        "payments": tables["payments"].where("payment_sequential < 3"),
        "reviews": tables["reviews"].where("review_creation_date is not null"),
    }
    target = scratch_path(lake.spark, "fact-by-day")
    fact_increment.refresh_fact(lake.spark, earlier, target, "month")
    fact_increment.refresh_fact(lake.spark, tables, target, "month")
    return fact_increment.read_fact(lake.spark, tables, target)


@register()
def kpis_by_range(lake: Lakehouse) -> DataFrame:
    """Key figures of ten ranges of days, merged from the state of each day."""
    spark, fact = lake.spark, lake.fact()
    ids = {kind: daily_state.dense_ids(fact.select(key, daily_state.DAY)) for kind, key in daily_state.COUNTED.items()}
    state, sums = scratch_path(spark, "daily-bitmaps"), scratch_path(spark, "daily-sums")
    write_table(daily_state.daily_bitmaps(fact, ids), state)
    write_table(daily_state.daily_sums(fact), sums)
    return daily_state.kpis_of_ranges(read_table(spark, state), read_table(spark, sums), RANGES)


@register()
def gate_outputs(lake: Lakehouse) -> DataFrame:
    """Ranked answers as readers get them: size, order, no unknown category."""
    fact, product, seller = lake.fact(), lake.product(), lake.seller()
    categories = gate_output(
        marts.top_categories(fact, product, 3), "top_categories", 3, [("revenue", True), ("category", False)], "category"
    )
    sellers = gate_output(
        marts.top_sellers(fact, seller, 10), "top_sellers", 10, [("revenue", True), ("seller_id", False)]
    )
    months = gate_output(marts.revenue_trend(fact).orderBy("month"), "revenue_trend", 80, [("month", False)])
    return categories.unionByName(sellers).unionByName(months.where("check like '%sorted'"))


@register()
def catalogue_feed(lake: Lakehouse) -> DataFrame:
    """Three runs of the catalogue job, the last one with the documents of the second: every change it made."""
    target = scratch_path(lake.spark, "catalogue-store")
    for day, documents in (
        (RUN_DATE, lake.raw.catalogue),
        (NEXT_DATE, lake.raw.catalogue_next),
        (LAST_DATE, lake.raw.catalogue_next),
    ):
        upkeep.refresh_catalogue(lake.spark, documents, target, day, buckets=16)
    return upkeep.catalogue_feed(lake.spark, target).select(
        "product_id",
        "change",
        "day",
        F.col("old.category_en").alias("category_before"),
        F.col("new.category_en").alias("category_after"),
    )


@register()
def reload_changed_days(lake: Lakehouse) -> DataFrame:
    """Two days of orders, then the second day's files replaced by others: only that day is loaded again."""
    spark, orders = lake.spark, lake.raw.orders
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    spec = replace(SILVER["orders"], ddl=ddl_of(orders, "orders"))
    land_csv(orders, bronze, "orders", RUN_DATE)
    land_csv(lake.raw.orders_next, bronze, "orders", NEXT_DATE)
    upkeep.reload_changed_days(spark, spec, bronze, silver, buckets=16)
    returned = orders.where("order_status = 'processing'").withColumn("order_status", F.lit("returned"))
    land_csv(returned, bronze, "orders", NEXT_DATE)
    upkeep.reload_changed_days(spark, spec, bronze, silver, buckets=16)
    return cleaned_rows(spark, f"{silver}/orders", spec.ddl)


@register()
def land_tables(lake: Lakehouse) -> DataFrame:
    """All tables landed by the job, and every cell of the items read back."""
    root = scratch_path(lake.spark, "bronze")
    upkeep.land_tables(raw_tables(lake), root, RUN_DATE)
    items = lake.raw.order_items_raw
    return read_snapshots(lake.spark, f"{root}/order_items", ddl_of(items, "order_items")).drop("ingest_date")


@register()
def scan_silver_cells(lake: Lakehouse) -> DataFrame:
    """Every cell of a cleaned table."""
    return lake.silver("order_items").select("*")


@register()
def cluster_worst_periods(lake: Lakehouse) -> DataFrame:
    """The fact by year, one year's lines arriving in two more writes: only that year is clustered again.

    Returns the lines of each year, and whether its files overlap.
    """
    spark, path, by = lake.spark, scratch_path(lake.spark, "fact-by-year"), ["customer_id", "product_id"]
    fact = lake.fact().withColumn("order_year", F.year("order_date"))
    write_partitioned(fact.where("order_year <> 1995 or order_year is null or order_item_id < 3"), path, "order_year", by)
    for late in ("order_item_id = 3", "order_item_id > 3"):
        fact.where(f"order_year = 1995 and {late}").coalesce(1).write.partitionBy("order_year").mode("append").parquet(path)
    recluster_worst(spark, path, fact.schema, "order_year", by, deeper_than=2, most=1)
    written = read_partitioned(spark, path, fact.schema)
    depths = overlap_depth(file_ranges(written, "order_year", by), "order_year", by).where("order_year is not null")
    lines = written.groupBy("order_year").agg(F.count(F.lit(1)).alias("lines"))
    return lines.join(depths, "order_year").select("order_year", "lines", (F.col("depth") > 2).alias("overlaps"))
