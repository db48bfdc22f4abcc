"""Categories, tags and display text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The default category, and category fragments with their tags. The first fragment
# found wins; a category with none of them is tagged 'general'.
UNKNOWN = "unknown"
CATEGORY_TAGS = {
    "electronics": ["gadget", "tech", "wired"],
    "furniture": ["home", "bulky", "assembly"],
    "beauty": ["skincare", "giftable"],
    "books": ["media", "lightweight"],
    "sports": ["outdoor", "fitness"],
    "toys": ["kids", "giftable"],
    "food": ["consumable", "perishable"],
    "fashion": ["apparel", "seasonal"],
}
DEFAULT_TAGS = ["general"]
MONTH_PATTERN = r"^\d{4}-\d{2}"


def _text_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def or_unknown(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(UNKNOWN))


def category_tags(category: Column) -> Column:
    """Tags of the first known fragment in the category text (case-sensitive)."""
    first, *rest = CATEGORY_TAGS.items()
    chain = reduce(
        lambda acc, kv: acc.when(category.contains(kv[0]), _text_array(kv[1])),
        rest,
        F.when(category.contains(first[0]), _text_array(first[1])),
    )
    return chain.otherwise(_text_array(DEFAULT_TAGS))


def flat_tags(tags: str = "tags") -> Column:
    """Tags as one comma-joined string, empty when there are none."""
    return F.coalesce(F.array_join(tags, ","), F.lit(""))


def looks_like_month(column: str) -> Column:
    return F.col(column).rlike(MONTH_PATTERN)


def thousands(value: Column) -> Column:
    """A whole number with thousands separators, rounded half up."""
    return F.format_number(F.floor(value + 0.5), 0)


def money_card(value: Column) -> Column:
    return F.concat(F.lit("R$ "), thousands(value))


def fixed_places(value: Column, places: int) -> Column:
    return F.format_string(f"%.{places}f", value)
