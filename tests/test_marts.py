"""Star schema and marts on hand-made edge cases, and relations between marts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakemart.operators.aggregates import first_order
from lakemart.operators.quality import (
    GateError,
    expectations,
    gate_file_count,
    gate_row_floor,
    gate_unique,
)
from lakemart.plans import gold, marts, reports
from lakemart.sources.tables import register_views
from lakemart.workload.lakehouse import Lakehouse

FACT = (
    "order_id string, order_item_id int, product_id string, seller_id string, customer_id string, "
    "order_date date, gross_revenue double, review_score int, delivery_days bigint"
)


def sale(order="o1", item=1, product="p1", seller="s1", customer="c1", day=date(2017, 5, 1), gross=10.0, score=5, days=3):
    return (order, item, product, seller, customer, day, gross, score, days)


@pytest.fixture
def lake(spark, sf_dir):
    return Lakehouse(spark, sf_dir)


# ---- fact


def small_inputs(frame):
    items = frame(
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
        ("o1", 1, "p1", "s1", 30.0, 1.0),
        ("o1", 2, "p2", "s1", 10.0, None),
        ("free", 1, "p1", "s1", 0.0, 2.0),
        ("unpaid", 1, "p1", "s1", 5.0, 1.0),
        ("orphan", 1, "p1", "s1", 5.0, 1.0),
    )
    at = datetime(2017, 5, 1, 23)
    orders = frame(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz",
        ("o1", "c1", "delivered", at, datetime(2017, 5, 2, 1)),
        ("free", "c2", "shipped", None, None),
        ("unpaid", "c1", "shipped", at, None),
        ("empty", "c1", "shipped", at, None),
    )
    payments = frame(
        "order_id string, payment_value double", ("o1", 20.0), ("o1", 24.0), ("free", 2.0)
    )
    reviews = frame(
        "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz",
        ("r1", "o1", 1, datetime(2017, 6, 1)),
        ("r2", "o1", 4, datetime(2017, 6, 2)),
    )
    return items, orders, payments, reviews


@pytest.mark.parametrize("days, want_days", [("calendar", 1), ("elapsed", 0)])
def test_fact_rows(frame, days, want_days):
    fact = gold.fact_sales(*small_inputs(frame), days=days)
    rows = {(r.order_id, r.order_item_id): r for r in fact.collect()}
    assert set(rows) == {("o1", 1), ("o1", 2), ("free", 1), ("unpaid", 1)}
    first, second = rows["o1", 1], rows["o1", 2]
    assert (first.allocated_payment, second.allocated_payment) == (33.0, 11.0)
    assert (first.gross_revenue, second.gross_revenue) == (31.0, None)
    assert (first.review_score, first.delivery_days, first.order_date) == (4, want_days, date(2017, 5, 1))
    assert rows["free", 1].allocated_payment is None and rows["free", 1].order_date is None
    assert rows["unpaid", 1].allocated_payment is None


def test_fact_is_the_same_with_hot_orders(frame, rows_of):
    inputs = small_inputs(frame)
    assert rows_of(gold.fact_sales(*inputs, hot_rows=1)) == rows_of(gold.fact_sales(*inputs))


def test_unused_parts_of_an_order_are_not_computed(lake, plan_of):
    fact = gold.fact_sales(*map(lake.silver, ("order_items", "orders", "payments", "reviews")))
    plan = plan_of(fact.groupBy("order_date").agg(F.sum("gross_revenue")))
    assert "payment_value" not in plan and "review_score" not in plan
    assert "payment_value" in plan_of(fact.select("allocated_payment"))


def test_dim_product_defaults_and_shape(frame):
    products = frame("product_id string, product_category_name string, product_weight_g double", ("a", "x", 1.0), ("b", None, 2.0))
    catalogue = frame("product_id string, product_category_en string, tags array<string>, margin_pct double", ("a", "toys", ["kids"], 0.1), ("z", "toys", [], 0.2))
    dim = gold.dim_product(products, catalogue, "2024-01-01")
    got = {r.product_id: r for r in dim.collect()}
    assert set(got) == {"a", "b"}
    assert got["b"].product_category_en == "unknown" and got["b"].tags is None
    assert (got["a"].effective_from, got["a"].effective_to, got["a"].is_current) == (date(2024, 1, 1), None, True)


# ---- marts


@pytest.mark.parametrize("limit", [0, 51, 999])
def test_limit_out_of_bounds_is_refused(frame, limit):
    empty = frame(FACT)
    dim = frame("product_id string, product_category_en string")
    sellers = frame("seller_id string, seller_state string")
    with pytest.raises(ValueError):
        marts.top_categories(empty, dim, limit)
    with pytest.raises(ValueError):
        marts.top_sellers(empty, sellers, limit)


def test_top_categories_order_and_default(lake):
    got = [r.asDict() for r in marts.top_categories(lake.fact(), lake.product()).collect()]
    assert got == sorted(got, key=lambda r: -r["revenue"])
    assert "unknown" not in {r["category"] for r in got}
    assert marts.top_categories(lake.fact(), lake.product(), 3).count() == 3
    assert marts.top_sellers(lake.fact(), lake.seller(), 5).count() == 5


def test_top_k_ties_are_settled_by_the_key(frame):
    df = frame("k string, v int", ("b", 1), ("a", 1), ("c", 1))
    assert [r.k for r in marts.top_k(df, "v", "k", 2).collect()] == ["a", "b"]


def test_top_k_is_not_a_full_sort(lake, plan_of):
    assert "TakeOrderedAndProject" in plan_of(marts.top_sellers(lake.fact(), lake.seller()))


def test_null_states_are_dropped_here_and_kept_there(frame):
    fact = frame(FACT, sale(), sale(order="o2", customer="c2"), sale(order="o3", customer="nobody"))
    customer = frame("customer_id string, customer_state string", ("c1", "SP"), ("c2", None))
    assert [tuple(r) for r in marts.state_revenue(fact, customer).collect()] == [("SP", 10.0, 1)]
    ltv = {r.customer_id: r.customer_state for r in marts.customer_ltv(fact, customer).collect()}
    assert ltv == {"c1": "SP", "c2": None}


def test_lifetime_by_person_adds_up_ids(frame):
    fact = frame(FACT, sale(), sale(order="o2", customer="c2", gross=5.0, score=None))
    customer = frame(
        "customer_id string, customer_unique_id string, customer_state string",
        ("c1", "ann", "SP"),
        ("c2", "ann", "SP"),
    )
    got = marts.customer_ltv(fact, customer, "customer_unique_id").collect()
    assert [(r.customer_unique_id, r.lifetime_orders, r.lifetime_revenue, r.avg_review_score) for r in got] == [
        ("ann", 2, 15.0, 5.0)
    ]


def test_averages_are_missing_without_values(frame):
    fact = frame(FACT, sale(score=None, days=None))
    seller = frame("seller_id string, seller_state string", ("s1", "SP"))
    row = marts.top_sellers(fact, seller).first()
    assert (row.avg_review, row.avg_delivery_days) == (None, None)
    assert marts.seller_performance(fact, seller).count() == 0


def test_kpis_of_nothing(frame):
    row = marts.kpis(
        frame(FACT), frame("customer_id string"), frame("product_id string"), frame("seller_id string")
    ).first()
    assert (row.total_revenue, row.total_orders, row.avg_review_score) == (0.0, 0, None)


def test_sales_without_a_date_have_no_month(frame):
    fact = frame(FACT, sale(), sale(order="o2", day=None))
    assert [tuple(r) for r in marts.revenue_trend(fact).collect()] == [("2017-05", 10.0, 1)]


def test_cohort_counts_one_customer_as_new_and_returning(frame):
    fact = frame(FACT, sale(day=date(2017, 5, 1)), sale(order="o2", day=date(2017, 5, 3)))
    calendar = frame("date_key date, year int", (date(2017, 5, 1), 2017), (date(2017, 5, 3), 2017))
    row = marts.weekly_cohort(fact, calendar).first()
    assert (row.new_customers, row.returning_customers, row.weekly_revenue) == (1, 1, 20.0)


def test_cohort_years(frame):
    days = [date(2016, 12, 31), date(2017, 1, 1), date(2017, 12, 31)]
    fact = frame(FACT, *[sale(order=str(d), customer=str(d), day=d) for d in days])
    calendar = frame("date_key date, year int", *[(d, d.year) for d in days])

    def groups(year):
        return sorted((r.year, r.iso_week, r.new_customers) for r in marts.weekly_cohort(fact, calendar, year).collect())

    assert groups("calendar") == [(2016, 52, 1), (2017, 52, 2)]
    assert groups("iso") == [(2016, 52, 2), (2017, 52, 1)]
    with pytest.raises(ValueError):
        marts.weekly_cohort(fact, calendar, "fiscal")


def test_marts_agree_with_each_other(lake):
    fact = lake.fact()
    total = marts.kpis(fact, lake.customer(), lake.product(), lake.seller()).first().total_revenue
    states = sum(r.revenue for r in marts.state_revenue(fact, lake.customer()).collect())
    months = sum(r.revenue for r in marts.revenue_trend(fact).collect())
    weeks = sum(r.weekly_revenue for r in marts.weekly_cohort(fact, lake.date(), "iso").collect())
    shares = sum(r.share for r in reports.category_share(fact, lake.product()).collect())
    assert states <= total and months <= total
    assert weeks == pytest.approx(months)
    assert shares == pytest.approx(1.0)


def test_allocated_payments_add_up_to_the_payment(lake):
    fact = lake.fact()
    paid = lake.silver("payments").groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    split = fact.groupBy("order_id").agg(F.sum("allocated_payment").alias("split"))
    off = split.where("split is not null").join(paid, "order_id").where("abs(split - paid) > 0.001")
    assert off.count() == 0


def test_first_order_is_the_minimum(frame):
    fact = frame(FACT, sale(day=date(2017, 5, 2)), sale(day=None), sale(day=date(2017, 5, 1)))
    assert first_order(fact).first().first_date == date(2017, 5, 1)


def test_scans_read_only_what_a_mart_needs(lake, plan_of):
    plan = plan_of(marts.revenue_trend(lake.fact()))
    assert "ReadSchema: struct<order_id:string,order_date:date,gross_revenue:double>" in plan
    assert "PushedFilters: [IsNotNull(order_date)" in plan


def test_hot_product_is_split_in_a_plain_join(spark, tmp_path, set_conf, plan_of):
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__shuffle__partitions="8",
    )
    product = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).cast("string")
    spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("order_id"),
        product.alias("product_id"),
        F.lit("2017-01-01").cast("date").alias("order_date"),
        F.lit(1.0).alias("gross_revenue"),
    ).write.parquet(f"{tmp_path}/fact")
    spark.range(-1, 500).select(
        F.col("id").cast("string").alias("product_id"),
        (F.col("id") % 5).cast("string").alias("product_category_en"),
        F.lit(0.1).alias("margin_pct"),
        F.lit(True).alias("is_current"),
    ).write.parquet(f"{tmp_path}/product")
    calendar = spark.sql("select date'2017-01-01' date_key, 2017 year, 1 month, 'January' month_name")
    fact, dim = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("fact", "product"))
    monthly = marts.monthly_by_category(fact, calendar, dim)
    assert sum(r.orders for r in monthly.collect()) == 60000
    assert "skew=true" in plan_of(monthly, final=True)


def test_a_filtered_calendar_prunes_fact_partitions(spark, tmp_path, plan_of):
    day = F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    spark.range(100).select("id", day.alias("order_date"), F.lit(1.0).alias("gross_revenue")).write.partitionBy(
        "order_date"
    ).parquet(f"{tmp_path}/fact")
    spark.range(5).select(day.alias("date_key"), (F.col("id") + 1).alias("day")).write.parquet(f"{tmp_path}/date")
    fact, date_dim = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("fact", "date"))
    wanted = F.broadcast(date_dim.where("day = 2"))
    joined = fact.join(wanted, F.col("order_date") == F.col("date_key"))
    assert joined.count() == 20
    assert "dynamicpruning" in plan_of(joined.select("id"))


def test_business_views(spark, lake):
    register_views(lake.star(), prefix="t_")
    marts.register_business_views(spark, prefix="t_")
    for name in marts.BUSINESS_VIEWS:
        assert spark.table(f"t_{name}").limit(1).count() == 1


# ---- gates


def test_gates(frame):
    df = frame("k string", ("a",), ("a",))
    gate_row_floor(df, 1)
    gate_file_count(df, 2)
    with pytest.raises(GateError):
        gate_row_floor(df, 2)
    with pytest.raises(GateError):
        gate_row_floor(df.limit(0))
    with pytest.raises(GateError):
        gate_file_count(df, 7)
    assert tuple(gate_unique(df, ["k"]).first()) == (1, False)


def test_expectations_treat_unknown_as_failed(frame):
    checks = {
        "some rows": (F.count(F.lit(1)), lambda n: n > 0),
        "mean of nothing": (F.avg("v"), lambda v: v > 0),
    }
    got = {r.check: r.ok for r in expectations(frame("v int", (None,)), checks).collect()}
    assert got == {"some rows": True, "mean of nothing": False}
