"""Business answers over the star schema. Every function returns one lazy plan.

The fact is reduced by the dimension's key before it meets the dimension wherever the
answer allows: the join then handles one row per key, and a customer, product or seller
with a third of all sales is already one row. Dimensions have one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakemart.functions.dates import iso_month, iso_week, iso_year
from lakemart.functions.money import amount, cents_sum, half_up, money_sum, weighted_sum
from lakemart.functions.text import (
    UNKNOWN,
    fixed_places,
    looks_like_month,
    money_card,
    thousands,
)
from lakemart.operators.aggregates import (
    first_order,
    sales_by_customer,
    sales_by_product,
    sales_by_seller,
)
from lakemart.operators.joins import join_spread

# Bounds and default of the top-k limit.
LIMIT_MIN, LIMIT_MAX, LIMIT_DEFAULT = 1, 50, 10


def check_limit(limit: int) -> int:
    if not LIMIT_MIN <= limit <= LIMIT_MAX:
        raise ValueError(f"limit must be between {LIMIT_MIN} and {LIMIT_MAX}, got {limit}")
    return limit


def top_k(df: DataFrame, measure: str, tie_break: str, k: int) -> DataFrame:
    """The k largest rows; equal measures in the order of the tie-break, so the set is fixed.

    Planned as a per-task top-k and one merge of k rows per task, not as a full sort.
    """
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie_break).asc_nulls_last()).limit(k)


def current(product: DataFrame) -> DataFrame:
    """The products as they are now: one row each, of all the versions a history holds."""
    return product.where("is_current") if "is_current" in product.columns else product


def sales_by_category(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Revenue in cents and items sold per current English category."""
    categories = current(product).select("product_id", "product_category_en")
    return (
        sales_by_product(fact)
        .join(categories, "product_id")
        .groupBy("product_category_en")
        .agg(F.sum("cents").alias("cents"), F.sum("items_sold").alias("items_sold"))
    )


def revenue_by_category(fact: DataFrame, product: DataFrame, n: int = LIMIT_DEFAULT) -> DataFrame:
    """The best-selling categories, products of unknown category included."""
    sales = sales_by_category(fact, product)
    return top_k(sales, "cents", "product_category_en", n).select(
        "product_category_en", amount("cents").alias("revenue"), "items_sold"
    )


def top_categories(fact: DataFrame, product: DataFrame, limit: int = LIMIT_DEFAULT) -> DataFrame:
    """The best-selling known categories."""
    check_limit(limit)
    known = product.where(F.col("product_category_en") != UNKNOWN)
    sales = sales_by_category(fact, known)
    return top_k(sales, "cents", "product_category_en", limit).select(
        F.col("product_category_en").alias("category"),
        amount("cents").alias("revenue"),
        "items_sold",
    )


def distinct_keys(dim: DataFrame, key: str) -> Column:
    """Number of distinct keys as a scalar subquery: one narrow column scanned on its own."""
    return dim.select(F.count_distinct(key)).scalar()


def kpis(fact: DataFrame, customer: DataFrame, product: DataFrame, seller: DataFrame) -> DataFrame:
    """One row of headline figures. Averages are over items."""
    headline = fact.agg(
        F.coalesce(money_sum("gross_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        half_up(F.avg("review_score"), 2).alias("avg_review_score"),
        half_up(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
    )
    return headline.select(
        "total_revenue",
        "total_orders",
        distinct_keys(customer, "customer_id").alias("total_customers"),
        distinct_keys(product, "product_id").alias("total_products"),
        distinct_keys(seller, "seller_id").alias("total_sellers"),
        "avg_review_score",
        "avg_delivery_days",
    )


def kpi_cards(kpi: DataFrame) -> DataFrame:
    """The headline figures as display text."""
    return kpi.select(
        money_card(F.col("total_revenue")).alias("total_revenue"),
        thousands(F.col("total_orders")).alias("orders"),
        thousands(F.col("total_customers")).alias("customers"),
        thousands(F.col("total_products")).alias("products"),
        fixed_places(F.col("avg_review_score"), 2).alias("avg_review_score"),
        F.concat(fixed_places(F.col("avg_delivery_days"), 1), F.lit(" d")).alias("avg_delivery"),
    )


def state_revenue(fact: DataFrame, customer: DataFrame, n: int | None = None) -> DataFrame:
    """Revenue and orders per customer state, best first; all states or the first n."""
    located = customer.where(F.col("customer_state").isNotNull())
    sales = (
        sales_by_customer(fact)
        .join(located.select("customer_id", F.col("customer_state").alias("state")), "customer_id")
        .groupBy("state")
        .agg(F.sum("cents").alias("cents"), F.sum("orders").alias("orders"))
    )
    ranked = (
        sales.orderBy(F.col("cents").desc_nulls_last(), "state")
        if n is None
        else top_k(sales, "cents", "state", n)
    )
    return ranked.select("state", amount("cents").alias("revenue"), "orders")


def revenue_trend(fact: DataFrame) -> DataFrame:
    """Revenue and orders per month, oldest first; sales without a date have no month."""
    return (
        fact.withColumn("month", iso_month("order_date"))
        .where(looks_like_month("month"))
        .groupBy("month")
        .agg(
            money_sum("gross_revenue").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy("month")
    )


def top_sellers(fact: DataFrame, seller: DataFrame, limit: int = LIMIT_DEFAULT) -> DataFrame:
    """The best sellers of known state, with review and delivery averages."""
    check_limit(limit)
    located = seller.where(F.col("seller_state").isNotNull())
    sales = sales_by_seller(fact).join(
        located.select("seller_id", F.col("seller_state").alias("state")), "seller_id"
    )
    return top_k(sales, "cents", "seller_id", limit).select(
        "seller_id",
        "state",
        amount("cents").alias("revenue"),
        "items_sold",
        half_up(F.col("avg_score"), 2).alias("avg_review"),
        half_up(F.col("avg_days"), 1).alias("avg_delivery_days"),
    )


def monthly_by_category(fact: DataFrame, date: DataFrame, product: DataFrame) -> DataFrame:
    """Orders, revenue and estimated margin per month and category of the current product.

    Distinct orders need the join at fact grain: the planner broadcasts a product table it
    knows to be small, and adaptive execution splits hot products of a shuffled one. The
    calendar has at most one row per day, so its size is bounded whatever the data's.
    """
    current = product.where("is_current").select("product_id", "product_category_en", "margin_pct")
    calendar = F.broadcast(date.select("date_key", "year", "month", "month_name"))
    return (
        fact.join(calendar, F.col("order_date") == F.col("date_key"))
        .join(current, "product_id")
        .groupBy("year", "month", "month_name", "product_category_en")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            money_sum("gross_revenue").alias("gross_revenue"),
            weighted_sum("gross_revenue", "margin_pct").alias("estimated_margin"),
        )
    )


def customer_ltv(fact: DataFrame, customer: DataFrame, key: str = "customer_id") -> DataFrame:
    """Lifetime orders, revenue, score and active period per customer and state.

    With ``key='customer_unique_id'`` the customer is the person behind several ids.
    """
    who = customer.select(*dict.fromkeys(["customer_id", key, "customer_state"]))
    return (
        sales_by_customer(fact)
        .join(who, "customer_id")
        .groupBy(key, "customer_state")
        .agg(
            F.sum("orders").alias("lifetime_orders"),
            amount(F.sum("cents")).alias("lifetime_revenue"),
            F.try_divide(F.sum("score_sum"), F.sum("score_count")).alias("avg_review_score"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
    )


def seller_performance(fact: DataFrame, seller: DataFrame) -> DataFrame:
    """Delivered items, revenue and averages per seller."""
    delivered = fact.where(F.col("delivery_days").isNotNull())
    return (
        sales_by_seller(delivered)
        .join(seller.select("seller_id", "seller_state"), "seller_id")
        .select(
            "seller_id",
            "seller_state",
            F.col("rows_sold").alias("items_sold"),
            amount("cents").alias("gross_revenue"),
            F.col("avg_days").alias("avg_delivery_days"),
            F.col("avg_score").alias("avg_review_score"),
        )
    )


def with_first_order(fact: DataFrame) -> DataFrame:
    """Every sale with its customer's first order date."""
    return join_spread(fact, first_order(fact), "customer_id", ["order_id", "order_item_id"])


def customer_days(fact: DataFrame) -> DataFrame:
    """Revenue per customer and day, with the customer's first day.

    Reduced to days before the window: a customer then has at most one row per calendar day,
    however much they buy, and that bounds the window's group.
    """
    daily = (
        fact.where(F.col("order_date").isNotNull() & F.col("customer_id").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(cents_sum("gross_revenue").alias("cents"))
    )
    return daily.withColumn(
        "first_date", F.min("order_date").over(Window.partitionBy("customer_id"))
    )


def count_new_and_returning(days: DataFrame, *period: str) -> DataFrame:
    """New and returning customers and revenue per period.

    Reduced to one row per period and customer first, so two distinct counts become two
    plain ones. A customer with a first and a later day in the period counts as both.
    """
    per_customer = days.groupBy(*period, "customer_id").agg(
        F.bool_or(F.col("order_date") == F.col("first_date")).alias("is_new"),
        F.bool_or(F.col("order_date") > F.col("first_date")).alias("is_returning"),
        F.sum("cents").alias("cents"),
    )
    return per_customer.groupBy(*period).agg(
        F.count_if("is_new").alias("new_customers"),
        F.count_if("is_returning").alias("returning_customers"),
        amount(F.sum("cents")).alias("revenue"),
    )


def weekly_cohort(fact: DataFrame, date: DataFrame, year: str = "calendar") -> DataFrame:
    """New and returning customers and revenue per ISO week.

    ``year='calendar'`` pairs the week with the calendar year, under which 1 January may
    share a group with the last week of that December; ``year='iso'`` uses the year the
    week belongs to.
    """
    if year not in ("calendar", "iso"):
        raise ValueError(f"year must be 'calendar' or 'iso', got {year!r}")
    calendar = date.select(
        "date_key",
        iso_week("date_key").alias("iso_week"),
        (F.col("year") if year == "calendar" else iso_year("date_key")).alias("year"),
    )
    days = customer_days(fact).join(F.broadcast(calendar), F.col("order_date") == F.col("date_key"))
    return count_new_and_returning(days, "iso_week", "year").withColumnRenamed(
        "revenue", "weekly_revenue"
    )


# Names of the business views and of the table views they read.
BUSINESS_VIEWS = (
    "vw_monthly_revenue_by_category",
    "vw_customer_ltv",
    "vw_seller_performance",
    "vw_weekly_cohort",
)


def register_business_views(spark: SparkSession, prefix: str = "") -> None:
    """The four business views, over the registered table views."""
    fact, product, customer, seller, date = (
        spark.table(f"{prefix}v_{n}")
        for n in ("fact_sales", "dim_product", "dim_customer", "dim_seller", "dim_date")
    )
    marts = (
        monthly_by_category(fact, date, product),
        customer_ltv(fact, customer),
        seller_performance(fact, seller),
        weekly_cohort(fact, date),
    )
    for name, mart in zip(BUSINESS_VIEWS, marts):
        mart.createOrReplaceTempView(prefix + name)
