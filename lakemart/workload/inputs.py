"""The retail parquet tables as the engine's raw input tables.

Modulo terms below decide which rows lack a date, a score, a state, a payment, a review or a
catalogue entry, so that every optional match is exercised. Orders without payments or reviews and
products missing in the catalogue are such absent children; all other rows are used. ``oracle.py`` states the same mapping as SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.operators.dedup import dedup
from lakemart.plans.catalogue import build_catalogue, margin_from_number
from lakemart.schemas import NATURAL_KEYS

# Category names of the parts and their English form.
TRANSLATION = [
    ("economy", "furniture_decor"),
    ("standard", "electronics"),
    ("large", "sports_leisure"),
    ("medium", "books_technical"),
    ("small", "food_drink"),
]

CHANGED_CATEGORY = "electronics_changed"
INTERIM_CATEGORY = "electronics_interim"


def all_shipped(orders: DataFrame) -> DataFrame:
    """A day later: the orders in processing have shipped."""
    shipped = F.when(F.col("order_status") == "processing", F.lit("shipped")).otherwise(F.col("order_status"))
    return orders.withColumn("order_status", shipped)


class Inputs:
    """Raw tables of one folder. Every property is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        shipped = (
            self._table("lineitem")
            .groupBy(F.col("l_orderkey").cast("string").alias("order_id"))
            .agg(F.max("l_shipdate").alias("last_ship"))
        )
        placed = self._table("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            "o_orderstatus",
            "o_orderdate",
            F.expr(
                "case when o_orderkey % 97 = 0 then null "
                "else o_orderdate + interval '1' hour * (o_orderkey % 24) end"
            ).alias("order_purchase_timestamp"),
        )
        return placed.join(shipped, "order_id", "left").select(
            "order_id",
            "customer_id",
            F.expr(
                "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' "
                "else 'processing' end"
            ).alias("order_status"),
            "order_purchase_timestamp",
            F.expr(
                "case when o_orderstatus = 'F' and last_ship >= o_orderdate + interval '1' day "
                "then last_ship + interval '1' hour end"
            ).alias("order_delivered_customer_date"),
        )

    @cached_property
    def order_items_raw(self) -> DataFrame:
        """Line items as landed: item numbers repeat within an order."""
        return self._table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.when(F.col("l_orderkey") % 41 == 0, F.lit(0.0))
            .otherwise(F.col("l_extendedprice"))
            .alias("price"),
            (F.floor(F.col("l_extendedprice") * F.col("l_tax") * 100) / F.lit(100.0)).alias(
                "freight_value"
            ),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return dedup(self.order_items_raw, NATURAL_KEYS["order_items"], ["shipping_limit_date"])

    def _nations(self) -> DataFrame:
        return self._table("nation").select("n_nationkey", "n_name")

    @cached_property
    def customers(self) -> DataFrame:
        joined = self._table("customer").join(
            self._nations(), F.col("n_nationkey") == F.col("c_nationkey")
        )
        return joined.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.floor(F.col("c_custkey") / 3).cast("string").alias("customer_unique_id"),
            F.col("c_name").alias("customer_city"),
            F.when(F.col("c_custkey") % 71 != 0, F.col("n_name")).alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        joined = self._table("supplier").join(
            self._nations(), F.col("n_nationkey") == F.col("s_nationkey")
        )
        return joined.select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            F.col("s_name").alias("seller_city"),
            F.when(F.col("s_suppkey") % 19 != 0, F.col("n_name")).alias("seller_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_partkey") % 13 != 0, F.lower("p_type")).alias("product_category_name"),
            (F.col("p_size").cast("double") * 100).alias("product_weight_g"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One to three equal payments per order, none for some."""
        n = F.explode(F.sequence(F.lit(1), (1 + F.col("o_orderkey") % 3).cast("int")))
        numbered = (
            self._table("orders")
            .where(F.col("o_orderkey") % 37 != 0)
            .select("o_orderkey", "o_totalprice", n.alias("payment_sequential"))
        )
        return numbered.select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            "payment_sequential",
            F.expr(
                "case payment_sequential when 1 then 'credit_card' when 2 then 'voucher' "
                "else 'boleto' end"
            ).alias("payment_type"),
            (
                F.floor(F.col("o_totalprice") * 100 / (1 + F.col("o_orderkey") % 3)) / F.lit(100.0)
            ).alias("payment_value"),
        )

    @cached_property
    def reviews_raw(self) -> DataFrame:
        """One or two reviews per order, none for some; some ids cover several orders."""
        n = F.explode(F.sequence(F.lit(1), (1 + F.col("o_orderkey") % 2).cast("int")))
        numbered = (
            self._table("orders")
            .where(F.col("o_orderkey") % 5 != 0)
            .select("o_orderkey", "o_custkey", "o_orderdate", n.alias("n"))
        )
        return numbered.selectExpr(
            "case when o_orderkey % 53 = 0 then concat('shared-', cast(o_custkey as string)) "
            "else concat('r', cast(o_orderkey * 10 + n as string)) end as review_id",
            "cast(o_orderkey as string) as order_id",
            "case when o_orderkey % 43 = 0 then null "
            "else cast(1 + (o_orderkey * 7 + n * 3) % 5 as int) end as review_score",
            "case when (o_orderkey + n) % 29 = 0 then null when o_orderkey % 31 = 0 then o_orderdate "
            "else o_orderdate + interval '1' day * n end as review_creation_date",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Reviews with one row per review id."""
        return dedup(self.reviews_raw, NATURAL_KEYS["reviews"], ["review_creation_date"])

    @cached_property
    def translation(self) -> DataFrame:
        rows = ", ".join(f"('{name}', '{english}')" for name, english in TRANSLATION)
        return self.spark.sql(
            f"select * from values {rows} "
            "as t(product_category_name, product_category_name_english)"
        )

    @cached_property
    def catalogue_all(self) -> DataFrame:
        """Catalogue documents of every product."""
        return build_catalogue(self.products, self.translation, margin_from_number())

    @cached_property
    def catalogue(self) -> DataFrame:
        """The catalogue as of day 1: some products are not in it yet."""
        return self.catalogue_all.where(F.col("product_id").cast("bigint") % 11 != 0)

    @cached_property
    def catalogue_next(self) -> DataFrame:
        """The catalogue as of day 2: the missing products added, some categories changed."""
        changed = F.col("product_id").cast("bigint") % 7 == 0
        return self.catalogue_all.withColumn(
            "category_en", F.when(changed, F.lit(CHANGED_CATEGORY)).otherwise(F.col("category_en"))
        )

    @cached_property
    def orders_next(self) -> DataFrame:
        """The next day's snapshot of the orders: those in processing have shipped."""
        return all_shipped(self.orders)

    @cached_property
    def catalogue_interim(self) -> DataFrame:
        """The catalogue of the day between, as far as it was noted: a third of the products, some changed."""
        number = F.col("product_id").cast("bigint")
        category = F.when(number % 2 == 0, F.lit(INTERIM_CATEGORY)).otherwise(F.col("category_en"))
        return self.catalogue_all.where(number % 3 == 0).withColumn("category_en", category)

    @cached_property
    def orders_closed(self) -> DataFrame:
        """A third day's snapshot as text: delivered orders are closed, and some rows cannot be read."""
        number = F.col("order_id").cast("bigint")
        bad_time = F.when(number % 10 == 0, F.lit("not a time")).otherwise(F.col("order_purchase_timestamp").cast("string"))
        delivered = self.orders.where("order_status = 'delivered'").withColumn("order_status", F.lit("closed"))
        return delivered.withColumns(
            {
                "order_purchase_timestamp": bad_time,
                "customer_id": F.when(number % 7 != 0, F.col("customer_id")),
            }
        )
