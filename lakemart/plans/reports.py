"""Report-page queries over the star schema and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.functions.dates import iso_month
from lakemart.functions.money import amount, weighted_amount, weighted_steps
from lakemart.operators.aggregates import sales_by_product
from lakemart.operators.running import running_totals
from lakemart.plans.marts import count_new_and_returning, current, customer_days, customer_ltv, sales_by_category

SCORES = (1, 2, 3, 4, 5)


def delivery_days_histogram(fact: DataFrame, width: int = 5) -> DataFrame:
    """Distinct orders per band of delivery days."""
    delivered = fact.where(F.col("delivery_days").isNotNull())
    band = (F.floor(F.col("delivery_days") / width) * width).cast("bigint")
    return delivered.groupBy(band.alias("days_from")).agg(F.count_distinct("order_id").alias("orders"))


def ltv_distribution(fact: DataFrame, customer: DataFrame, width: int = 1000) -> DataFrame:
    """Customers per band of lifetime revenue."""
    band = (F.floor(F.col("lifetime_revenue") / width) * width).cast("bigint")
    lifetime = customer_ltv(fact, customer).where(F.col("lifetime_revenue").isNotNull())
    return lifetime.groupBy(band.alias("revenue_from")).agg(F.count(F.lit(1)).alias("customers"))


def category_share(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Revenue per category and its share of all revenue.

    The total is a scalar subquery over the same aggregate, not a window over one task.
    """
    sales = sales_by_category(fact, product)
    total = sales.agg(amount(F.sum("cents"))).scalar()
    revenue = amount("cents")
    return sales.select(
        "product_category_en",
        revenue.alias("revenue"),
        F.try_divide(revenue, total).alias("share"),
    )


def margin_waterfall(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Estimated margin per category with its running total, largest first.

    The running total is made in two levels, so the number of categories has no bound.
    """
    priced = current(product).select("product_id", "product_category_en", "margin_pct")
    margins = (
        sales_by_product(fact)
        .join(priced, "product_id")
        .groupBy("product_category_en")
        .agg(weighted_steps(F.col("cents"), "margin_pct").alias("margin"))
    )
    order = [F.col("margin").desc_nulls_last(), F.col("product_category_en").asc_nulls_first()]
    return running_totals(margins, order, {"running": "margin"}).select(
        "product_category_en",
        weighted_amount("margin").alias("margin"),
        weighted_amount("running").alias("running_margin"),
    )


def review_heatmap(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Scored items per customer state, one column per score."""
    per_customer = fact.groupBy("customer_id").agg(
        *[F.count_if(F.col("review_score") == s).alias(f"score_{s}") for s in SCORES]
    )
    located = customer.where(F.col("customer_state").isNotNull())
    return (
        per_customer.join(located.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(*[F.sum(f"score_{s}").alias(f"score_{s}") for s in SCORES])
    )


def tag_cloud(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Items sold and products sold per tag."""
    return (
        sales_by_product(fact)
        .join(current(product).select("product_id", "tags"), "product_id")
        .select("product_id", "items_sold", F.explode("tags").alias("tag"))
        .groupBy("tag")
        .agg(F.sum("items_sold").alias("items_sold"), F.count_distinct("product_id").alias("products"))
    )


def cohort_matrix(fact: DataFrame) -> DataFrame:
    """New and returning customers per month, and the share of returning ones."""
    months = customer_days(fact).withColumn("month", iso_month("order_date"))
    counts = count_new_and_returning(months, "month")
    both = F.col("new_customers") + F.col("returning_customers")
    return counts.select(
        "month",
        "new_customers",
        "returning_customers",
        F.try_divide(F.col("returning_customers"), both).alias("returning_share"),
    )
