"""Aggregates per order, customer, product and seller."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakemart.functions.money import amount, cents_sum, money_sum


def order_total(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(money_sum("price").alias("order_total_price"))


def with_order_total(items: DataFrame) -> DataFrame:
    """The items, each with the total of its order that ``order_total`` gives.

    Items placed by order, as a join on ``order_id`` wants them, are not sent a second time for it. A task holds the
    items of one order at a time and spills them if it must; orders of very many items are better joined to their total.
    """
    total = cents_sum("price").over(Window.partitionBy("order_id"))
    return items.withColumn("order_total_price", amount(total))


def payment_total(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(money_sum("payment_value").alias("payment_total"))


def first_order(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(F.min("order_date").alias("first_date"))


def sales_by_customer(fact: DataFrame) -> DataFrame:
    """One row per customer, ready to be rolled up further.

    Reducing the fact before it meets the customer table makes that join one row to one row,
    whatever share of the sales one customer has. An order belongs to one customer, so the
    distinct orders of any group of customers are the sum of theirs.
    """
    return fact.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders"),
        cents_sum("gross_revenue").alias("cents"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def sales_by_product(fact: DataFrame) -> DataFrame:
    """One row per product: revenue in cents and items sold."""
    return fact.groupBy("product_id").agg(
        cents_sum("gross_revenue").alias("cents"),
        F.count("order_item_id").alias("items_sold"),
    )


def sales_by_seller(fact: DataFrame) -> DataFrame:
    """One row per seller: revenue in cents, rows, items and the two averages."""
    return fact.groupBy("seller_id").agg(
        cents_sum("gross_revenue").alias("cents"),
        F.count(F.lit(1)).alias("rows_sold"),
        F.count("order_item_id").alias("items_sold"),
        F.avg("review_score").alias("avg_score"),
        F.avg("delivery_days").alias("avg_days"),
    )
