"""De-duplication, reviews, skew-proof joins, upsert and history on small frames."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakemart.operators.aggregates import order_total, with_order_total
from lakemart.operators.dedup import dedup, duplicate_keys
from lakemart.operators.joins import hot_keys, join_spread
from lakemart.operators.reviews import latest_review, latest_review_ranked
from lakemart.operators.scd2 import as_of_join, scd2_merge, with_validity
from lakemart.operators.upsert import upsert, upsert_metrics

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# ---- de-duplication


def test_dedup_latest_wins_and_ties_are_total(frame, rows_of):
    df = frame(
        "k string, day date, v string",
        ("a", date(2024, 1, 1), "old"),
        ("a", date(2024, 1, 2), "z"),
        ("a", date(2024, 1, 2), "b"),
        ("b", None, "only"),
        ("c", None, "undated"),
        ("c", date(2023, 1, 1), "dated"),
    )
    got = rows_of(dedup(df, ["k"], ["day"]).select("k", "v"))
    assert got == [("a", "b"), ("b", "only"), ("c", "dated")]
    assert rows_of(dedup(df.repartition(5, "v"), ["k"], ["day"]).select("k", "v")) == got


def test_dedup_sends_one_row_per_key_and_task(frame, plan_of):
    plan = plan_of(dedup(frame("k string, v int", ("a", 1)), ["k"]))
    assert plan.count("WindowGroupLimit") == 2


def test_duplicate_keys(frame, rows_of):
    df = frame("k string", ("a",), ("a",), ("b",))
    assert rows_of(duplicate_keys(df, ["k"])) == [("a", 2)]


# ---- reviews

REVIEWS = "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz"


@pytest.mark.parametrize("null_date_wins, want", [(False, 5), (True, 1)])
def test_undated_review(frame, null_date_wins, want):
    df = frame(REVIEWS, ("r1", "o", 1, None), ("r2", "o", 5, datetime(2018, 1, 1)))
    assert latest_review(df, null_date_wins).first()["review_score"] == want
    assert latest_review_ranked(df, null_date_wins).first()["review_score"] == want


def test_review_ties_and_missing_scores(frame, rows_of):
    day = datetime(2018, 1, 1)
    df = frame(
        REVIEWS,
        ("r1", "tied", 5, day),
        ("r2", "tied", 2, day),
        ("s", "same", 2, day),
        ("s", "same", 4, day),
        ("x", "unscored", 3, day),
        ("y", "unscored", None, datetime(2018, 2, 1)),
    )
    want = [("same", 4), ("tied", 2), ("unscored", None)]
    assert rows_of(latest_review(df)) == want
    assert rows_of(latest_review_ranked(df).select("order_id", "review_score")) == want


maybe_day = st.none() | st.integers(1, 3).map(lambda d: datetime(2018, 1, d))


@QUICK
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.none() | st.integers(1, 5), maybe_day),
        min_size=1,
        max_size=15,
    ),
    st.booleans(),
)
def test_both_forms_of_latest_review_agree(frame, rows_of, reviews, null_date_wins):
    df = frame(REVIEWS, *reviews)
    ranked = latest_review_ranked(df, null_date_wins).select("order_id", "review_score")
    assert rows_of(latest_review(df, null_date_wins)) == rows_of(ranked)


# ---- joins


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 7, 1_000_000])
def test_join_spread_equals_plain_join(spark, rows_of, how, hot_rows):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") < 290, F.col("id")).alias("v"),
    )
    rows = rows.unionByName(spark.sql("select cast(null as string) as k, cast(1 as bigint) as v"))
    lookup = rows.where("k = 'hot' or v % 2 = 0").groupBy("k").agg(F.sum("v").alias("total"))
    got = join_spread(rows, lookup, "k", ["v"], how, hot_rows).select("k", "v", "total")
    assert rows_of(got) == rows_of(rows.join(lookup, "k", how).select("k", "v", "total"))


def test_hot_key_is_spread_over_tasks(spark, set_conf):
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rows = spark.range(8000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    lookup = rows.groupBy("k").agg(F.sum("v").alias("total"))

    def tasks(hot_rows):
        joined = join_spread(rows, lookup, "k", ["v"], hot_rows=hot_rows, strategy="merge")
        return joined.select(F.spark_partition_id().alias("p")).distinct().count()

    assert tasks(hot_rows=1_000_000) == 1
    assert tasks(hot_rows=500) > 1


def test_hot_keys_are_few(spark):
    rows = spark.range(1000).select((F.col("id") % 4).alias("k"), "id")
    assert hot_keys(rows, "k", ["id"], 250).count() == 0
    assert {r["_copies"] for r in hot_keys(rows, "k", ["id"], 100).collect()} == {3}


def test_hot_keys_are_recognised_by_a_sample(spark):
    key = F.when(F.col("id") < 500_000, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(600_000).select(key.alias("k"), "id")
    assert [tuple(r) for r in hot_keys(rows, "k", ["id"], 100_000).collect()] in (
        [("hot", 5)],
        [("hot", 6)],
    )


def test_join_spread_refuses_joins_that_would_repeat_lookup_rows(frame):
    df = frame("k string", ("a",))
    with pytest.raises(ValueError):
        join_spread(df, df, "k", ["k"], "full")


def test_adaptive_execution_splits_a_hot_key_after_salting(spark, set_conf, plan_of):
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__shuffle__partitions="8",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("string")
    items = spark.range(0, 60000, 1, 8).select(
        key.alias("order_id"), F.col("id").alias("order_item_id"), (F.col("id") * 1.0).alias("price")
    )
    joined = join_spread(items, order_total(items), "order_id", ["order_item_id"], strategy="merge")
    assert "skew=true" in plan_of(joined, final=True).lower().replace("isskew", "skew").replace(" ", "")


def test_total_beside_the_items_is_the_total_of_the_order(frame, rows_of):
    ddl = "order_id string, order_item_id int, price double"
    items = frame(ddl, ("a", 1, 0.1), ("a", 2, 0.2), ("a", 2, 0.2), ("b", 1, None), ("c", 1, -1.005), ("c", 2, None))
    assert rows_of(with_order_total(items)) == rows_of(items.join(order_total(items), "order_id").select(*items.columns, "order_total_price"))


# ---- upsert


CATALOGUE = "product_id string, category_en string, tags array<string>"


def catalogue_days(frame):
    day1 = frame(CATALOGUE, ("1", "a", ["x"]), ("2", "b", None), ("3", None, ["z"]))
    day2 = frame(CATALOGUE, ("2", "c", None), ("3", None, ["z"]), ("4", "d", []))
    return day1, day2


def test_upsert_and_its_metrics(frame, rows_of):
    day1, day2 = catalogue_days(frame)
    merged = upsert(day1, day2, ["product_id"])
    assert rows_of(merged) == [("1", "a", ["x"]), ("2", "c", None), ("3", None, ["z"]), ("4", "d", [])]
    assert tuple(upsert_metrics(day1, day2, ["product_id"]).first()) == (1, 1, 4)


def test_upsert_is_idempotent(frame, rows_of):
    day1, day2 = catalogue_days(frame)
    once = upsert(day1, day2, ["product_id"])
    assert rows_of(upsert(once, day2, ["product_id"])) == rows_of(once)
    assert tuple(upsert_metrics(once, day2, ["product_id"]).first()) == (0, 0, 4)


# ---- history

KEY, TRACKED = ["product_id"], ["category_en"]
D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


def catalogue(frame, *rows):
    return frame("product_id string, category_en string", *rows)


def test_scd2_days(frame, rows_of):
    history = with_validity(catalogue(frame, ("same", "a"), ("moved", "a"), ("gone", "a")), "1900-01-01")
    today = catalogue(frame, ("same", "a"), ("moved", "b"), ("new", "c"))
    merged = scd2_merge(history, today, KEY, TRACKED, D2)
    floor, day = date(1900, 1, 1), date(2024, 1, 2)
    want = [
        ("gone", "a", floor, None, True),
        ("moved", "a", floor, day, False),
        ("moved", "b", day, None, True),
        ("new", "c", floor, None, True),
        ("same", "a", floor, None, True),
    ]
    assert rows_of(merged) == sorted(want, key=repr)
    assert rows_of(scd2_merge(merged, today, KEY, TRACKED, D2)) == sorted(want, key=repr)


def test_scd2_second_change_on_one_day_replaces_the_first(frame, rows_of):
    history = with_validity(catalogue(frame, ("p", "a")), "1900-01-01")
    for category in ("b", "c"):
        history = scd2_merge(history, catalogue(frame, ("p", category)), KEY, TRACKED, D2)
    assert [(r[1], r[4]) for r in rows_of(history)] == [("a", False), ("c", True)]


def test_scd2_null_is_a_value(frame, rows_of):
    history = with_validity(catalogue(frame, ("p", None), ("q", "a")), "1900-01-01")
    merged = scd2_merge(history, catalogue(frame, ("p", None), ("q", None)), KEY, TRACKED, D2)
    assert sorted(r["product_id"] for r in merged.collect()) == ["p", "q", "q"]


@QUICK
@given(st.lists(st.dictionaries(st.sampled_from("pqr"), st.sampled_from("abc"), max_size=3), min_size=1, max_size=3))
def test_scd2_invariants(frame, spark, days):
    history = with_validity(catalogue(frame, ("p", "a")), "1900-01-01")
    for day, rows in zip((D1, D2, D3), days):
        history = scd2_merge(history, catalogue(frame, *rows.items()), KEY, TRACKED, day)
    versions = {}
    for r in history.collect():
        versions.setdefault(r["product_id"], []).append(
            (r["effective_from"], r["effective_to"], r["is_current"])
        )
    for spans in versions.values():
        spans.sort(key=lambda s: s[0])
        assert [s[2] for s in spans] == [False] * (len(spans) - 1) + [True]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert all(s[1] is None or s[0] < s[1] for s in spans)


def test_as_of_join_is_half_open(frame, rows_of):
    history = scd2_merge(
        with_validity(catalogue(frame, ("p", "a")), "1900-01-01"),
        catalogue(frame, ("p", "b")),
        KEY,
        TRACKED,
        D2,
    )
    fact = frame(
        "product_id string, day date",
        ("p", date(2016, 1, 1)),
        ("p", date(2024, 1, 1)),
        ("p", date(2024, 1, 2)),
        ("p", None),
    )
    got = as_of_join(fact, history, "product_id", "day").select("day", "category_en")
    assert [r[1] for r in rows_of(got)] == ["a", "a", "b"]
