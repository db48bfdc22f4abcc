"""The product catalogue: translated category, tags and margin per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions.text import category_tags, or_unknown

# Margins lie in [0.08, 0.42] and have three decimals.
MARGIN_LOW, MARGIN_STEPS = 80, 340


def margin_from_number(product_id: str = "product_id") -> Column:
    """A stand-in margin from a numeric id; the same for a product in every run and row order."""
    step = (F.col(product_id).cast("bigint") * 37) % MARGIN_STEPS
    return (MARGIN_LOW + step).cast("double") / 1000.0


def margin_from_text(product_id: str = "product_id") -> Column:
    """The same from an opaque id."""
    step = F.pmod(F.xxhash64(product_id), F.lit(MARGIN_STEPS + 1))
    return (MARGIN_LOW + step).cast("double") / 1000.0


def build_catalogue(
    products: DataFrame, translation: DataFrame, margin: Column | None = None
) -> DataFrame:
    """Catalogue rows for products. The translation is a small lookup, left to the planner."""
    named = products.join(translation, "product_category_name", "left")
    english = or_unknown("product_category_name_english")
    return named.select(
        "product_id",
        F.coalesce("product_category_name", F.lit("")).alias("category_pt"),
        english.alias("category_en"),
        category_tags(english).alias("tags"),
        (margin_from_text() if margin is None else margin).alias("margin_pct"),
    )
