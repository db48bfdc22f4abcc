"""The star schema: order-item fact and four dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions.dates import calendar_columns, calendar_days, elapsed_days
from lakemart.functions.money import allocated_payment, gross_revenue
from lakemart.functions.text import or_unknown
from lakemart.operators.dedup import dedup
from lakemart.operators.aggregates import order_total, payment_total, with_order_total
from lakemart.operators.joins import HOT_ROWS, hot_keys, join_spread
from lakemart.operators.reviews import latest_review
from lakemart.operators.scd2 import VALIDITY, with_validity

DAY_COUNTS = {"calendar": calendar_days, "elapsed": elapsed_days}


def dim_product(
    products: DataFrame, catalogue: DataFrame, run_date: str | Column | None = None
) -> DataFrame:
    """One current row per product, with its catalogue attributes where it has any.

    A product that the catalogue lists more than once gets one of its documents, the same in every run.
    """
    attributes = dedup(
        catalogue.select("product_id", "product_category_en", "tags", "margin_pct"), ["product_id"]
    )
    enriched = products.join(attributes, "product_id", "left").select(
        "product_id",
        "product_category_name",
        or_unknown("product_category_en").alias("product_category_en"),
        "tags",
        "margin_pct",
        "product_weight_g",
    )
    return with_validity(enriched, F.current_date() if run_date is None else run_date)


def product_attributes(dim: DataFrame) -> DataFrame:
    """A product dimension without its validity columns."""
    return dim.drop(*VALIDITY)


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("*")


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("*")


def order_dates(orders: DataFrame) -> DataFrame:
    """The days on which anything was ordered."""
    day = F.to_date("order_purchase_timestamp").alias("date_key")
    return orders.where(F.col("order_purchase_timestamp").isNotNull()).select(day).distinct()


def dim_date(orders: DataFrame) -> DataFrame:
    """Calendar attributes of every order day (days without orders are absent)."""
    return order_dates(orders).withColumns(calendar_columns("date_key"))


def order_facts(
    orders: DataFrame,
    items: DataFrame | None,
    payments: DataFrame,
    reviews: DataFrame,
    days: str = "calendar",
    null_date_wins: bool = False,
) -> DataFrame:
    """One row per order with everything an item inherits from it; its total only where ``items`` are given.

    All inputs are reduced to one row per order first and share one partitioning by
    ``order_id``, so the three joins add no shuffle and no key outweighs another. The optimizer
    knows the aggregates to be unique and drops those whose column a query does not use.
    Tables of order grain grow with the business: they are merged, never broadcast.
    """
    count_days = DAY_COUNTS[days]
    base = orders.select(
        "order_id",
        "customer_id",
        F.to_date("order_purchase_timestamp").alias("order_date"),
        "order_status",
        count_days("order_purchase_timestamp", "order_delivered_customer_date").alias("delivery_days"),
    )
    if items is not None:
        base = base.join(order_total(items).hint("merge"), "order_id", "left")
    return base.join(payment_total(payments).hint("merge"), "order_id", "left").join(
        latest_review(reviews, null_date_wins).hint("merge"), "order_id", "left"
    )


#: What the fact's columns are made of. Columns of the order stand together: lines of one order follow each other where
#: they are sent on, and what repeats as one run takes little room.
LINE = [
    *("order_id", "customer_id", "order_date", "order_status", "delivery_days", "review_score"),
    *("payment_total", "order_total_price"),
    *("order_item_id", "product_id", "seller_id", "price", "freight_value"),
]


def fact_lines(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    days: str = "calendar",
    null_date_wins: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The columns ``LINE`` of every item that has an order.

    The items are shuffled once: placed by order they get their order's total and meet its row, which lies there
    already. An order with very many items would fill a task: such orders take a way of their own, on which their total is
    an aggregate and their items are spread over several tasks.
    """
    lines = items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    ).where("order_id is not null")
    hot = F.broadcast(hot_keys(lines, "order_id", ["order_item_id"], hot_rows).select("order_id"))
    # Placed by name: else the amounts in cents, made for the total, would be sent as well.
    few = with_order_total(lines.join(hot, "order_id", "left_anti").repartition("order_id"))
    per_order = order_facts(orders, None, payments, reviews, days, null_date_wins)
    usual = few.join(per_order.hint("merge"), "order_id")
    many, *others = (t.join(hot, "order_id", "left_semi") for t in (lines, orders, payments, reviews))
    spread = join_spread(
        many,
        order_facts(others[0], many, *others[1:], days, null_date_wins),
        "order_id",
        ["order_item_id"],
        "inner",
        hot_rows,
        "merge",
    )
    return usual.select(*LINE).unionByName(spread.select(*LINE))


def fact_columns(lines: DataFrame) -> DataFrame:
    """The fact's columns from those of ``fact_lines``, and after them any others."""
    return lines.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_id",
        "order_date",
        "order_status",
        "price",
        "freight_value",
        gross_revenue().alias("gross_revenue"),
        allocated_payment("payment_total", "price", "order_total_price").alias("allocated_payment"),
        "review_score",
        "delivery_days",
        *[c for c in lines.columns if c not in LINE],
    )


def fact_sales(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    days: str = "calendar",
    null_date_wins: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per order item that has an order, with its share of the order's payments.

    Orders without items do not appear.
    """
    return fact_columns(fact_lines(items, orders, payments, reviews, days, null_date_wins, hot_rows))
