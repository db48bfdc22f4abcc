"""Money, dates and text expressions on hand-made values."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakemart.functions import dates, money, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value, places, want", [(2.675, 2, 2.68), (1.25, 1, 1.3), (0.0, 2, 0.0), (-1.25, 1, -1.2)])
def test_half_up(spark, value, places, want):
    assert one(spark, money.half_up(F.lit(value), places)) == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=30))
def test_money_sum_is_exact(spark, values):
    df = spark.createDataFrame([(v / 100.0,) for v in values], "v double")
    assert df.agg(money.money_sum("v")).first()[0] == sum(values) / 100.0


def test_allocated_payment_guards_zero_and_missing_totals(frame):
    df = frame(
        "payment double, price double, total double",
        (90.0, 10.0, 30.0),
        (90.0, 0.0, 0.0),
        (90.0, 10.0, None),
        (None, 10.0, 30.0),
    )
    got = [r[0] for r in df.select(money.allocated_payment("payment", "price", "total")).collect()]
    assert got == [30.0, None, None, None]


def test_gross_revenue_is_null_when_a_part_is(frame):
    df = frame("price double, freight_value double", (1.5, 2.0), (1.5, None))
    assert [r[0] for r in df.select(money.gross_revenue()).collect()] == [3.5, None]


@pytest.mark.parametrize(
    "start, end, calendar, elapsed",
    [
        (datetime(2018, 1, 1, 23), datetime(2018, 1, 2, 1), 1, 0),
        (datetime(2018, 1, 2, 1), datetime(2018, 1, 1, 23), -1, -1),
        (datetime(2018, 1, 1), datetime(2018, 1, 3), 2, 2),
        (datetime(2018, 1, 1), None, None, None),
    ],
)
def test_day_differences(frame, start, end, calendar, elapsed):
    df = frame("a timestamp_ntz, b timestamp_ntz", (start, end))
    got = df.select(dates.calendar_days("a", "b"), dates.elapsed_days("a", "b")).first()
    assert tuple(got) == (calendar, elapsed)


@pytest.mark.parametrize(
    "day, week, year",
    [
        (date(2016, 12, 31), 52, 2016),
        (date(2017, 1, 1), 52, 2016),
        (date(2017, 12, 31), 52, 2017),
        (date(2018, 1, 1), 1, 2018),
    ],
)
def test_iso_week_and_year(frame, day, week, year):
    row = frame("d date", (day,)).select(dates.iso_week("d"), dates.iso_year("d")).first()
    assert tuple(row) == (week, year)


def test_calendar_columns(frame):
    got = frame("d date", (date(2017, 9, 2),)).withColumns(dates.calendar_columns("d")).first()
    assert tuple(got) == (date(2017, 9, 2), 2017, 3, 9, "September", 2, "Saturday", True)


def test_iso_month_of_missing_day(frame):
    df = frame("d date", (date(2017, 9, 2),), (None,)).select(dates.iso_month("d").alias("m"))
    assert [r.m for r in df.collect()] == ["2017-09", None]
    assert df.where(text.looks_like_month("m")).count() == 1


@pytest.mark.parametrize(
    "category, tags",
    [
        ("electronics", "gadget,tech,wired"),
        ("furniture_decor", "home,bulky,assembly"),
        ("health_beauty", "skincare,giftable"),
        ("books_imported", "media,lightweight"),
        ("sports_leisure", "outdoor,fitness"),
        ("toys", "kids,giftable"),
        ("food_drink", "consumable,perishable"),
        ("fashion_sport", "apparel,seasonal"),
        ("fashion_sports", "outdoor,fitness"),
        ("fashio_female_clothing", "general"),
        ("Electronics", "general"),
        ("unknown", "general"),
    ],
)
def test_category_tags(spark, category, tags):
    assert one(spark, F.array_join(text.category_tags(F.lit(category)), ",")) == tags


def test_flat_tags(frame):
    df = frame("tags array<string>", (["a", "b"],), ([],), (None,))
    assert [r[0] for r in df.select(text.flat_tags()).collect()] == ["a,b", "", ""]


def test_cards(spark):
    assert one(spark, text.money_card(F.lit(15843553.24))) == "R$ 15,843,553"
    assert one(spark, text.money_card(F.lit(2.5))) == "R$ 3"
    assert one(spark, text.fixed_places(F.lit(4.1), 2)) == "4.10"
