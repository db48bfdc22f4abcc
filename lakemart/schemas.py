"""Pinned table schemas, natural keys and required columns.

Order times carry no zone in the source, so they are ``timestamp_ntz``: the
calendar day of an order never depends on the session's time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# Column names (source spelling kept), types and keys of the seven cleaned tables.
SILVER_DDL = {
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price double, freight_value double"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "payments": (
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value double"
    ),
    "reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        "review_answer_timestamp timestamp_ntz"
    ),
}

NATURAL_KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id"],
}

REQUIRED = {
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
}

# Columns of the exported star schema; tags are one comma-joined string there.
GOLD_CSV_DDL = {
    "fact_sales": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "customer_id string, order_date date, order_status string, price double, "
        "freight_value double, gross_revenue double, allocated_payment double, "
        "review_score int, delivery_days bigint"
    ),
    "dim_product": (
        "product_id string, product_category_name string, product_category_en string, "
        "tags string, margin_pct double, product_weight_g double, effective_from date, "
        "effective_to date, is_current boolean"
    ),
    "dim_customer": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string, _ingest_ts timestamp"
    ),
    "dim_seller": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string, _ingest_ts timestamp"
    ),
    "dim_date": (
        "date_key date, year int, quarter int, month int, month_name string, day int, "
        "day_of_week string, is_weekend boolean"
    ),
}

CATALOGUE_DDL = (
    "product_id string, category_pt string, category_en string, tags array<string>, "
    "margin_pct double"
)

TRANSLATION_DDL = "product_category_name string, product_category_name_english string"

# Only free text may hold line breaks inside quotes. Multi-line CSV cannot be split
# within a file, so every other table is read in the splittable mode.
MULTI_LINE = frozenset({"reviews"})


@dataclass(frozen=True)
class TableSpec:
    """What ingestion needs to know about one table."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    multi_line: bool

    @property
    def columns(self) -> list[str]:
        return StructType.fromDDL(self.ddl).fieldNames()


SILVER = {
    name: TableSpec(name, ddl, tuple(NATURAL_KEYS[name]), tuple(REQUIRED[name]), name in MULTI_LINE)
    for name, ddl in SILVER_DDL.items()
}


def pick(ddl: str, columns: list[str]) -> str:
    """The part of a pinned schema that covers ``columns``, in their order."""
    fields = StructType.fromDDL(ddl)
    return ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in columns)
