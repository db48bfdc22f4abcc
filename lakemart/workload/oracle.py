"""The same answers as plain SQL over the parquet tables, for checking.

The texts state what each query means, not how it should run. Common table expressions carry
the mapping from the parquet tables and the star schema; each text names the ones it uses.
"""

from __future__ import annotations

import re

from lakemart.workload.inputs import CHANGED_CATEGORY, INTERIM_CATEGORY
from lakemart.workload.lakehouse import LAST_DATE, NEXT_DATE, RANGES, RUN_DATE, RUN_TS

MAPPING = {
    "fx_translation": """
select pt as product_category_name, en as product_category_name_english
from (values ('economy','furniture_decor'),('standard','electronics'),('large','sports_leisure'),
  ('medium','books_technical'),('small','food_drink')) v(pt,en)""",
    "fx_orders": """
select cast(o.o_orderkey as string) as order_id, cast(o.o_custkey as string) as customer_id,
 case o.o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end as order_status,
 case when o.o_orderkey % 97 = 0 then null else o.o_orderdate + interval '1' hour * (o.o_orderkey % 24) end as order_purchase_timestamp,
 case when o.o_orderstatus = 'F' and s.mx >= o.o_orderdate + interval '1' day then s.mx + interval '1' hour end as order_delivered_customer_date
from orders o left join (select l_orderkey, max(l_shipdate) as mx from lineitem group by l_orderkey) s on s.l_orderkey = o.o_orderkey""",
    "fx_order_items_raw": """
select cast(l_orderkey as string) as order_id, l_linenumber as order_item_id, cast(l_partkey as string) as product_id,
 cast(l_suppkey as string) as seller_id, l_shipdate as shipping_limit_date,
 case when l_orderkey % 41 = 0 then cast(0 as double) else l_extendedprice end as price,
 floor(l_extendedprice * l_tax * 100) / cast(100 as double) as freight_value
from lineitem""",
    "fx_order_items": """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
from (select *, row_number() over (partition by order_id, order_item_id
   order by shipping_limit_date desc nulls last, product_id, seller_id, price, freight_value) as rn from fx_order_items_raw) t
where rn = 1""",
    "fx_customers": """
select cast(c_custkey as string) as customer_id, cast(cast(floor(c_custkey / 3) as bigint) as string) as customer_unique_id, c_name as customer_city,
 case when c_custkey % 71 = 0 then null else n_name end as customer_state
from customer join nation on n_nationkey = c_nationkey""",
    "fx_sellers": """
select cast(s_suppkey as string) as seller_id, s_name as seller_city,
 case when s_suppkey % 19 = 0 then null else n_name end as seller_state
from supplier join nation on n_nationkey = s_nationkey""",
    "fx_products": """
select cast(p_partkey as string) as product_id,
 case when p_partkey % 13 = 0 then null else lower(p_type) end as product_category_name,
 cast(p_size as double) * 100 as product_weight_g
from part""",
    "fx_payments": """
select cast(o_orderkey as string) as order_id, n as payment_sequential,
 case n when 1 then 'credit_card' when 2 then 'voucher' else 'boleto' end as payment_type,
 floor(o_totalprice * 100 / (1 + o_orderkey % 3)) / cast(100 as double) as payment_value
from orders cross join (values (1),(2),(3)) v(n)
where n <= 1 + o_orderkey % 3 and o_orderkey % 37 <> 0""",
    "fx_reviews": """
select case when o_orderkey % 53 = 0 then concat('shared-', cast(o_custkey as string)) else concat('r', cast(o_orderkey * 10 + n as string)) end as review_id,
 cast(o_orderkey as string) as order_id,
 case when o_orderkey % 43 = 0 then null else cast(1 + (o_orderkey * 7 + n * 3) % 5 as int) end as review_score,
 case when (o_orderkey + n) % 29 = 0 then null when o_orderkey % 31 = 0 then o_orderdate else o_orderdate + interval '1' day * n end as review_creation_date
from orders cross join (values (1),(2)) v(n)
where n <= 1 + o_orderkey % 2 and o_orderkey % 5 <> 0""",
    "silver_reviews": """
select review_id, order_id, review_score, review_creation_date
from (select *, row_number() over (partition by review_id
   order by review_creation_date desc nulls last, order_id nulls first, review_score nulls first) as rn from fx_reviews) t
where rn = 1""",
    "catalogue_all": """
select product_id, category_pt, category_en, split(tag_csv, ',') as tags, margin_pct
from (select p.product_id, coalesce(p.product_category_name, '') as category_pt,
  coalesce(t.product_category_name_english, 'unknown') as category_en,
  case when t.product_category_name_english like '%electronics%' then 'gadget,tech,wired'
   when t.product_category_name_english like '%furniture%' then 'home,bulky,assembly'
   when t.product_category_name_english like '%beauty%' then 'skincare,giftable'
   when t.product_category_name_english like '%books%' then 'media,lightweight'
   when t.product_category_name_english like '%sports%' then 'outdoor,fitness'
   when t.product_category_name_english like '%toys%' then 'kids,giftable'
   when t.product_category_name_english like '%food%' then 'consumable,perishable'
   when t.product_category_name_english like '%fashion%' then 'apparel,seasonal' else 'general' end as tag_csv,
  cast(80 + (cast(p.product_id as bigint) * 37) % 340 as double) / cast(1000 as double) as margin_pct
  from fx_products p left join fx_translation t on t.product_category_name = p.product_category_name) q""",
    "fx_catalogue": "select * from catalogue_all where cast(product_id as bigint) % 11 <> 0",
    "catalogue_next": f"""
select product_id, category_pt,
 case when cast(product_id as bigint) % 7 = 0 then '{CHANGED_CATEGORY}' else category_en end as category_en, tags, margin_pct
from catalogue_all""",
    "order_total": "select order_id, sum(cast(price as decimal(18,2))) as tp from fx_order_items group by order_id",
    "payment_total": "select order_id, sum(cast(payment_value as decimal(18,2))) as pt from fx_payments group by order_id",
    "latest": """
select order_id, review_id, review_score, review_creation_date
from (select *, row_number() over (partition by order_id
   order by review_creation_date desc nulls last, review_id desc nulls last, review_score desc nulls last) rn from silver_reviews) x
where rn = 1""",
    "latest_undated_first": """
select order_id, review_id, review_score, review_creation_date
from (select *, row_number() over (partition by order_id
   order by review_creation_date desc nulls first, review_id desc nulls last, review_score desc nulls last) rn from fx_reviews) x
where rn = 1""",
    "fact": """
select i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
 cast(o.order_purchase_timestamp as date) as order_date, o.order_status, i.price, i.freight_value,
 i.price + i.freight_value as gross_revenue,
 case when t.tp > 0 then cast(p.pt as double) * i.price / cast(t.tp as double) end as allocated_payment,
 r.review_score,
 date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) as delivery_days
from fx_order_items i join fx_orders o on o.order_id = i.order_id
join order_total t on t.order_id = i.order_id
left join payment_total p on p.order_id = i.order_id
left join latest r on r.order_id = i.order_id""",
    "fact_elapsed": """
select i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
 cast(o.order_purchase_timestamp as date) as order_date, o.order_status, i.price, i.freight_value,
 i.price + i.freight_value as gross_revenue,
 case when t.tp > 0 then cast(p.pt as double) * i.price / cast(t.tp as double) end as allocated_payment,
 r.review_score,
 cast(floor((epoch(o.order_delivered_customer_date) - epoch(o.order_purchase_timestamp)) / 86400.0) as bigint) as delivery_days
from fx_order_items i join fx_orders o on o.order_id = i.order_id
join order_total t on t.order_id = i.order_id
left join payment_total p on p.order_id = i.order_id
left join latest_undated_first r on r.order_id = i.order_id""",
    "product_attributes": """
select p.product_id, p.product_category_name, coalesce(c.category_en, 'unknown') as product_category_en,
 c.tags, c.margin_pct, p.product_weight_g
from fx_products p left join fx_catalogue c on c.product_id = p.product_id""",
    "dim_product": f"""
select *, date '{RUN_DATE}' as effective_from, cast(null as date) as effective_to, true as is_current
from product_attributes""",
    "dim_date": """
select date_key, cast(year(date_key) as int) as year, cast(quarter(date_key) as int) as quarter,
 cast(month(date_key) as int) as month, monthname(date_key) as month_name, cast(day(date_key) as int) as day,
 dayname(date_key) as day_of_week, dayofweek(date_key) in (0, 6) as is_weekend
from (select distinct cast(order_purchase_timestamp as date) as date_key from fx_orders
  where order_purchase_timestamp is not null) d""",
    "first_order": "select customer_id, min(order_date) as first_date from fact group by customer_id",
    "history": f"""
select product_id, category_en, margin_pct, date '1900-01-01' as effective_from,
 case when category_en <> '{CHANGED_CATEGORY}' and cast(product_id as bigint) % 7 = 0 then date '{NEXT_DATE}' end as effective_to,
 cast(product_id as bigint) % 7 <> 0 as is_current from fx_catalogue
union all
select product_id, category_en, margin_pct,
 case when cast(product_id as bigint) % 11 = 0 then date '1900-01-01' else date '{NEXT_DATE}' end as effective_from,
 cast(null as date) as effective_to, true as is_current
from catalogue_next where cast(product_id as bigint) % 7 = 0 or cast(product_id as bigint) % 11 = 0""",
    "catalogue_days": f"""
select product_id, category_en, margin_pct, date '{RUN_DATE}' as day from fx_catalogue
union all select product_id, category_en, margin_pct, date '{LAST_DATE}' from catalogue_next
union all select product_id, case when cast(product_id as bigint) % 2 = 0 then '{INTERIM_CATEGORY}' else category_en end,
 margin_pct, date '{NEXT_DATE}' from catalogue_all where cast(product_id as bigint) % 3 = 0""",
    "catalogue_runs": """
select *, sum(begins) over (partition by product_id order by day) as island from (
 select *, case when category_en is distinct from lag(category_en) over (partition by product_id order by day) then 1 else 0 end as begins
 from catalogue_days) d""",
    "catalogue_versions": """
select product_id, island, min(category_en) as category_en, min(margin_pct) as margin_pct, min(day) as first_day,
 cast(count(*) as int) as days_seen
from catalogue_runs group by product_id, island""",
    "closed_orders": f"""
select *, cast(order_id as bigint) % 10 = 0 as bad_time, cast(order_id as bigint) % 7 = 0 as no_customer
from fx_orders where order_status = 'delivered'""",
    "sales_by_category": """
select p.product_category_en, sum(cast(f.gross_revenue as decimal(18,2))) as revenue, count(f.order_item_id) as items_sold
from fact f join dim_product p on p.product_id = f.product_id group by p.product_category_en""",
    "state_sales": """
select c.customer_state as state, sum(cast(f.gross_revenue as decimal(18,2))) as revenue, count(distinct f.order_id) as orders
from fact f left join fx_customers c on c.customer_id = f.customer_id
where c.customer_state is not null group by c.customer_state""",
    "seller_sales": """
select f.seller_id, s.seller_state as state, sum(cast(f.gross_revenue as decimal(18,2))) as revenue,
 count(f.order_item_id) as items_sold, floor(avg(f.review_score) * 100 + 0.5) / 100.0 as avg_review,
 floor(avg(f.delivery_days) * 10 + 0.5) / 10.0 as avg_delivery_days
from fact f left join fx_sellers s on s.seller_id = f.seller_id
where s.seller_state is not null group by f.seller_id, s.seller_state""",
    "kpi": """
select cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as total_revenue,
 count(distinct f.order_id) as total_orders,
 (select count(distinct customer_id) from fx_customers) as total_customers,
 (select count(distinct product_id) from dim_product) as total_products,
 (select count(distinct seller_id) from fx_sellers) as total_sellers,
 floor(avg(f.review_score) * 100 + 0.5) / 100.0 as avg_review_score,
 floor(avg(f.delivery_days) * 10 + 0.5) / 10.0 as avg_delivery_days
from fact f""",
    "ltv": """
select c.customer_id, c.customer_state, count(distinct f.order_id) as lifetime_orders,
 cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as lifetime_revenue,
 avg(f.review_score) as avg_review_score, min(f.order_date) as first_order_date, max(f.order_date) as last_order_date
from fact f join fx_customers c on c.customer_id = f.customer_id group by c.customer_id, c.customer_state""",
    "category_margin": """
select p.product_category_en,
 sum(cast(f.gross_revenue as decimal(18,2)) * cast(p.margin_pct as decimal(6,3))) as margin
from fact f join dim_product p on p.product_id = f.product_id group by p.product_category_en""",
    "bad_cells": """
select order_id, order_item_id,
 case when cast(order_id as bigint) % 10 = 3 then 'bad price' end as r1,
 case when cast(order_id as bigint) % 17 = 5 then 'missing product_id' end as r2
from fx_order_items_raw""",
}

FACT_COLUMNS = (
    "order_id, order_item_id, product_id, seller_id, customer_id, order_date, order_status, price, "
    "freight_value, gross_revenue, allocated_payment, review_score, delivery_days"
)
DIM_PRODUCT_FLAT = (
    "select product_id, product_category_name, product_category_en, "
    "coalesce(array_to_string(tags, ','), '') as tags, margin_pct, product_weight_g, effective_from, "
    "effective_to, is_current from dim_product"
)
CATALOGUE_FLAT = (
    "select product_id, category_pt, category_en, array_to_string(tags, ',') as tags, margin_pct from "
)

MONTHLY = """
select d.year, d.month, d.month_name, p.product_category_en, count(distinct f.order_id) as orders,
 cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as gross_revenue,
 cast(sum(cast(f.gross_revenue as decimal(18,2)) * cast(p.margin_pct as decimal(6,3))) as double) as estimated_margin
from fact f join dim_date d on d.date_key = f.order_date join dim_product p on p.product_id = f.product_id
where p.is_current group by d.year, d.month, d.month_name, p.product_category_en"""


def _cohort(period: str, group: str) -> str:
    return f"""
select {period},
 count(distinct case when f.order_date = fo.first_date then f.customer_id end) as new_customers,
 count(distinct case when f.order_date > fo.first_date then f.customer_id end) as returning_customers,
 cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as weekly_revenue
from fact f join first_order fo on fo.customer_id = f.customer_id join dim_date d on d.date_key = f.order_date
group by {group}"""


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {source}"
        for name, source in tables.items()
    )


SILVER_SOURCES = {
    "orders": "fx_orders",
    "order_items": "fx_order_items",
    "customers": "fx_customers",
    "products": "fx_products",
    "sellers": "fx_sellers",
    "payments": "fx_payments",
    "reviews": "silver_reviews",
}
RAW_SOURCES = {**SILVER_SOURCES, "order_items": "fx_order_items_raw", "reviews": "fx_reviews"}

FACT = f"select {FACT_COLUMNS} from fact"
ORDERS_NEXT = """
select order_id, customer_id,
 case when order_status = 'processing' then 'shipped' else order_status end as order_status,
 order_purchase_timestamp, order_delivered_customer_date from fx_orders"""
DATE_TEXT = """
case when o_orderkey % 50 = 0 then 'no date' else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end"""
CAST_DATES = (
    "select date_key, year, quarter, month, month_name, day, day_of_week, is_weekend from dim_date"
)
UPSERTED = f"""
select * from (select product_id, category_pt, category_en, array_to_string(tags, ',') as tags, margin_pct
 from fx_catalogue where product_id not in (select product_id from catalogue_next)
 union all {CATALOGUE_FLAT} catalogue_next)"""

ORACLES = {
    # sources
    "scan_csv_pinned": "select * from fx_order_items_raw",
    "scan_bronze_snapshots": f"""
select order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
 date '{RUN_DATE}' as ingest_date from fx_orders
union all select *, date '{NEXT_DATE}' as ingest_date from ({ORDERS_NEXT})""",
    "scan_bronze_since": f"select *, date '{NEXT_DATE}' as ingest_date from ({ORDERS_NEXT})",
    "scan_catalogue": """
select product_id, category_en as product_category_en, array_to_string(tags, ',') as tags, margin_pct from fx_catalogue""",
    "scan_silver": _counts(SILVER_SOURCES),
    "scan_gold_csv": FACT,
    "scan_translation": """
select p.product_id, t.product_category_name_english
from fx_products p left join fx_translation t on t.product_category_name = p.product_category_name""",
    "gold_table_views": MONTHLY,
    "file_inventory": " union all ".join(
        f"select '{t}' as table_name, true as all_filled" for t in SILVER_SOURCES
    ),
    # sinks
    "land_bronze_csv": _counts(RAW_SOURCES),
    "land_bronze_jsonl": CATALOGUE_FLAT + "fx_catalogue",
    "write_overwrite": DIM_PRODUCT_FLAT,
    "write_fact_partitioned": FACT,
    "export_gold_csv": DIM_PRODUCT_FLAT.replace("coalesce(array_to_string(tags, ','), '')", "array_to_string(tags, ',')"),
    "upsert_catalogue": UPSERTED,
    "upsert_metrics": f"""
select cast(count(*) filter (where o.product_id is null) as bigint) as inserted,
 cast(count(*) filter (where o.product_id is not null and n.category_en <> o.category_en) as bigint) as modified,
 cast(count(*) as bigint) as total
from catalogue_next n full join fx_catalogue o on o.product_id = n.product_id""",
    "optimize_zorder": FACT,
    "result_json": """
select concat('{"seller_id":"', seller_id, '","state":"', state, '","revenue":', cast(revenue as decimal(18,2)),
 ',"items_sold":', items_sold, ',"avg_review":', coalesce(cast(cast(avg_review as decimal(18,2)) as string), 'null'),
 ',"avg_delivery_days":', coalesce(cast(cast(avg_delivery_days as decimal(18,2)) as string), 'null'), '}') as json
from (select * from seller_sales order by revenue desc, seller_id limit 50)""",
    # projections and predicates
    "project_rename": "select product_id, category_en as product_category_en, margin_pct from fx_catalogue",
    "lineage_columns": f"""
select order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date,
 timestamp '{RUN_TS}' as _ingest_ts from fx_orders""",
    "scd_shape_columns": f"""
select product_id, product_category_name, product_weight_g, date '{RUN_DATE}' as effective_from,
 cast(null as date) as effective_to, true as is_current from fx_products""",
    "gross_revenue": "select order_id, order_item_id, price + freight_value as gross_revenue from fx_order_items",
    "allocated_payment": "select order_id, order_item_id, allocated_payment from fact",
    "default_unknown": "select product_id, coalesce(product_category_name, 'unknown') as product_category_name from fx_products",
    "filter_not_null": "select order_id, order_purchase_timestamp from fx_orders where order_purchase_timestamp is not null",
    "filter_current": "select product_id, category_en from history where is_current",
    "filter_exclude_unknown": "select product_id, product_category_en from dim_product where product_category_en <> 'unknown'",
    "filter_month_regex": """
select substr(cast(order_date as string), 1, 7) as month, count(*) as items from fact
where regexp_matches(cast(order_date as string), '^\\d{4}-\\d{2}') group by 1""",
    "is_weekend": "select date_key, is_weekend from dim_date",
    "category_tags": "select product_id, category_en, array_to_string(tags, ',') as tags from catalogue_all",
    "catalogue_build": CATALOGUE_FLAT + "catalogue_all",
    "top_categories_with_history": f"""
select coalesce(c.category_en, 'unknown') as category, cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as revenue,
 count(f.order_item_id) as items_sold
from fact f join fx_products p on p.product_id = f.product_id left join catalogue_next c on c.product_id = p.product_id
where coalesce(c.category_en, 'unknown') <> 'unknown' group by 1 order by 2 desc, 1 limit 10""",
    "silver_missing_keys": """
select case when cast(customer_id as bigint) % 10 <> 0 then customer_id end as customer_id, customer_unique_id,
 customer_city, customer_state, cast(customer_id as bigint) % 10 <> 0 as stored from fx_customers""",
    "silver_merge_since": """
select customer_id, customer_unique_id, case when cast(customer_id as bigint) % 3 = 0 then 'moved' else customer_city end
 as customer_city, customer_state from fx_customers""",
    "limit_bounds": """
select product_category_en as category, cast(revenue as double) as revenue, items_sold from sales_by_category
where product_category_en <> 'unknown' order by revenue desc, category limit 3""",
    # joins
    "join_product_catalogue": """
select product_id, product_category_name, product_category_en, array_to_string(tags, ',') as tags, margin_pct,
 product_weight_g from product_attributes""",
    "join_items_orders": """
select i.order_id, i.order_item_id, o.customer_id, o.order_status from fx_order_items i join fx_orders o on o.order_id = i.order_id""",
    "join_order_total": """
select i.order_id, i.order_item_id, i.price, cast(t.tp as double) as order_total_price
from fx_order_items i join order_total t on t.order_id = i.order_id""",
    "join_payment_total": """
select i.order_id, i.order_item_id, cast(p.pt as double) as payment_total
from fx_order_items i left join payment_total p on p.order_id = i.order_id""",
    "join_latest_review": """
select i.order_id, i.order_item_id, r.review_score from fx_order_items i left join latest r on r.order_id = i.order_id""",
    "join_fact_product": """
select f.order_id, f.order_item_id, f.gross_revenue, p.product_category_en, p.margin_pct
from fact f join dim_product p on p.product_id = f.product_id""",
    "join_fact_product_left": """
select f.order_id, f.order_item_id, f.gross_revenue, p.product_category_en
from fact f left join dim_product p on p.product_id = f.product_id""",
    "join_fact_customer": """
select f.order_id, f.order_item_id, f.gross_revenue, c.customer_state
from fact f left join fx_customers c on c.customer_id = f.customer_id""",
    "join_fact_customer_inner": """
select f.order_id, f.order_item_id, f.gross_revenue, c.customer_state
from fact f join fx_customers c on c.customer_id = f.customer_id""",
    "join_fact_seller": """
select f.order_id, f.order_item_id, f.gross_revenue, s.seller_state
from fact f left join fx_sellers s on s.seller_id = f.seller_id""",
    "join_fact_seller_inner": """
select f.order_id, f.order_item_id, f.gross_revenue, s.seller_state
from fact f join fx_sellers s on s.seller_id = f.seller_id""",
    "join_fact_date": """
select f.order_id, f.order_item_id, d.date_key, d.year, d.month_name from fact f join dim_date d on d.date_key = f.order_date""",
    "join_first_order": """
select f.order_id, f.order_item_id, f.customer_id, f.order_date, fo.first_date
from fact f join first_order fo on fo.customer_id = f.customer_id""",
    "fact_sales": FACT,
    # aggregates
    "agg_order_total": "select order_id, cast(tp as double) as order_total_price from order_total",
    "agg_payment_total": "select order_id, cast(pt as double) as payment_total from payment_total",
    "agg_first_order": "select customer_id, first_date from first_order",
    "agg_distinct_count": """
select count(distinct order_id) as orders, count(distinct customer_id) as customers,
 count(distinct product_id) as products, count(distinct seller_id) as sellers from fact""",
    "agg_conditional_distinct": """
select count(distinct case when f.order_date = fo.first_date then f.customer_id end) as new_customers,
 count(distinct case when f.order_date > fo.first_date then f.customer_id end) as returning_customers
from fact f join first_order fo on fo.customer_id = f.customer_id""",
    "agg_weighted_sum": """
select product_category_en, cast(margin as double) as margin from category_margin""",
    "agg_mean_skip_null": """
select seller_id, avg(review_score) as avg_review_score, avg(delivery_days) as avg_delivery_days from fact group by seller_id""",
    "agg_min_max_date": """
select customer_id, min(order_date) as first_order_date, max(order_date) as last_order_date from fact group by customer_id""",
    "agg_count_star_vs_col": """
select order_status, count(*) as rows_all, count(order_item_id) as items, count(review_score) as scored,
 count(delivery_days) as delivered from fact group by order_status""",
    "agg_enriched_count": """
select (select count(*) from fact) as fact_sales, (select count(*) from dim_product) as dim_product,
 (select count(*) from dim_product where product_category_en <> 'unknown') as enriched,
 (select count(*) from fx_customers) as dim_customer, (select count(*) from fx_sellers) as dim_seller,
 (select count(*) from dim_date) as dim_date""",
    # windows, order, duplicates
    "latest_review": "select order_id, review_id, review_score, review_creation_date from latest",
    "latest_review_sorted_dedup": "select order_id, review_id, review_score, review_creation_date from latest_undated_first",
    "top_k": """
select product_id, cast(revenue as double) as revenue from
 (select product_id, sum(cast(gross_revenue as decimal(18,2))) as revenue from fact group by product_id
  order by revenue desc, product_id limit 10)""",
    "sort_full": "select state, cast(revenue as double) as revenue, orders from state_sales order by revenue desc, state",
    "dedup_natural_key": "select * from fx_order_items",
    "dedup_orders": ORDERS_NEXT,
    "dedup_customers": "select * from fx_customers",
    "dedup_products": "select * from fx_products",
    "dedup_sellers": "select * from fx_sellers",
    "dedup_payments": "select * from fx_payments",
    "dedup_reviews": "select * from silver_reviews",
    "distinct_dates": "select date_key from dim_date",
    # scalar functions
    "scalar_date_parts": CAST_DATES,
    "scalar_date_diff": """
select order_id, date_diff('day', order_purchase_timestamp, order_delivered_customer_date) as calendar_days,
 cast(floor((epoch(order_delivered_customer_date) - epoch(order_purchase_timestamp)) / 86400.0) as bigint) as elapsed_days,
 cast(floor((epoch(order_purchase_timestamp) - epoch(order_delivered_customer_date)) / 86400.0) as bigint) as elapsed_days_back
from fx_orders""",
    "scalar_parse_coerce": f"""
select cast(o_orderkey as string) as order_id, try_cast({DATE_TEXT} as timestamp) as parsed,
 substr({DATE_TEXT}, 1, 7) as month_text, cast(week(o_orderdate) as int) as iso_week,
 cast(isoyear(o_orderdate) as int) as iso_year, strftime(o_orderdate, '%Y-%m-%d') as day_text
from orders""",
    "scalar_string_array": """
select p.product_id, coalesce(array_to_string(c.tags, ','), '') as tag_text,
 contains(coalesce(c.category_en, ''), 'electronics') as is_electronics, coalesce(c.category_pt, '') as category_pt
from fx_products p left join fx_catalogue c on c.product_id = p.product_id""",
    "scalar_round": """
select cast(p_partkey as string) as product_id, floor(p_retailprice / 3 * 100 + 0.5) / 100.0 as two_places,
 floor(p_retailprice / 7 * 10 + 0.5) / 10.0 as one_place, floor(p_size / 7.0 * 1000 + 0.5) / 1000.0 as three_places
from part""",
    "scalar_format_cards": """
select concat('R$ ', format('{:,}', cast(floor(total_revenue + 0.5) as bigint))) as total_revenue,
 format('{:,}', total_orders) as orders, format('{:,}', total_customers) as customers,
 format('{:,}', total_products) as products, printf('%.2f', avg_review_score) as avg_review_score,
 concat(printf('%.1f', avg_delivery_days), ' d') as avg_delivery from kpi""",
    # dimensions and marts
    "dim_product": DIM_PRODUCT_FLAT,
    "dim_customer": "select * from fx_customers",
    "dim_seller": "select * from fx_sellers",
    "dim_date": CAST_DATES,
    "fact_sales_elapsed": f"select {FACT_COLUMNS} from fact_elapsed",
    "revenue_by_category_notebook": """
select product_category_en, cast(revenue as double) as revenue, items_sold from
 (select * from sales_by_category order by revenue desc, product_category_en limit 10)""",
    "kpis": "select * from kpi",
    "top_categories": """
select product_category_en as category, cast(revenue as double) as revenue, items_sold from
 (select * from sales_by_category where product_category_en <> 'unknown' order by revenue desc, product_category_en limit 10)""",
    "state_revenue": "select state, cast(revenue as double) as revenue, orders from state_sales",
    "revenue_trend": """
select substr(cast(order_date as string), 1, 7) as month, cast(sum(cast(gross_revenue as decimal(18,2))) as double) as revenue,
 count(distinct order_id) as orders from fact where order_date is not null group by 1""",
    "top_sellers": """
select seller_id, state, cast(revenue as double) as revenue, items_sold, avg_review, avg_delivery_days from
 (select * from seller_sales order by revenue desc, seller_id limit 10)""",
    "top_states": """
select state, cast(revenue as double) as revenue, orders from (select * from state_sales order by revenue desc, state limit 10)""",
    "vw_monthly_revenue_by_category": MONTHLY,
    "vw_customer_ltv": "select * from ltv",
    "vw_seller_performance": """
select s.seller_id, s.seller_state, count(*) as items_sold,
 cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as gross_revenue,
 avg(f.delivery_days) as avg_delivery_days, avg(f.review_score) as avg_review_score
from fact f join fx_sellers s on s.seller_id = f.seller_id
where f.delivery_days is not null group by s.seller_id, s.seller_state""",
    "vw_weekly_cohort": _cohort("cast(week(f.order_date) as int) as iso_week, d.year", "week(f.order_date), d.year"),
    "weekly_cohort_iso_year": _cohort(
        "cast(week(f.order_date) as int) as iso_week, cast(isoyear(f.order_date) as int) as year",
        "week(f.order_date), isoyear(f.order_date)",
    ),
    "customer_ltv_by_person": """
select c.customer_unique_id, c.customer_state, count(distinct f.order_id) as lifetime_orders,
 cast(sum(cast(f.gross_revenue as decimal(18,2))) as double) as lifetime_revenue,
 avg(f.review_score) as avg_review_score, min(f.order_date) as first_order_date, max(f.order_date) as last_order_date
from fact f join fx_customers c on c.customer_id = f.customer_id group by c.customer_unique_id, c.customer_state""",
    # reports
    "delivery_days_histogram": """
select cast(floor(delivery_days / 5.0) * 5 as bigint) as days_from, count(distinct order_id) as orders
from fact where delivery_days is not null group by 1""",
    "ltv_distribution": """
select cast(floor(lifetime_revenue / 1000.0) * 1000 as bigint) as revenue_from, count(*) as customers from ltv group by 1""",
    "category_share": """
select product_category_en, cast(revenue as double) as revenue,
 cast(revenue as double) / (select cast(sum(revenue) as double) from sales_by_category) as share from sales_by_category""",
    "margin_waterfall": """
select product_category_en, cast(margin as double) as margin,
 cast(sum(margin) over (order by margin desc nulls last, product_category_en rows unbounded preceding) as double) as running_margin
from category_margin""",
    "review_heatmap": "select c.customer_state, "
    + ", ".join(
        f"cast(count(*) filter (where f.review_score = {s}) as bigint) as score_{s}" for s in range(1, 6)
    )
    + """ from fact f join fx_customers c on c.customer_id = f.customer_id
where c.customer_state is not null group by c.customer_state""",
    "tag_cloud": """
select tag, count(*) as items_sold, count(distinct product_id) as products from
 (select f.product_id, unnest(p.tags) as tag from fact f join dim_product p on p.product_id = f.product_id) group by tag""",
    "cohort_matrix": """
select month, new_customers, returning_customers,
 returning_customers / cast(new_customers + returning_customers as double) as returning_share
from (select substr(cast(f.order_date as string), 1, 7) as month,
 count(distinct case when f.order_date = fo.first_date then f.customer_id end) as new_customers,
 count(distinct case when f.order_date > fo.first_date then f.customer_id end) as returning_customers
 from fact f join first_order fo on fo.customer_id = f.customer_id where f.order_date is not null group by 1)""",
    # history and quality
    "scd2_merge": "select * from history",
    "dim_product_as_of": """
select f.order_id, f.order_item_id, f.product_id, f.order_date, h.category_en, h.effective_from
from fact f join history h on h.product_id = f.product_id and h.effective_from <= f.order_date
 and f.order_date < coalesce(h.effective_to, date '9999-12-31')""",
    "gate_row_floor": "select count(*) as observed, cast(0 as bigint) as floor, count(*) > 0 as ok from fx_orders",
    "gate_file_count": "select true as ok",
    "gate_unique_key": """
select 'order_items' as table_name, count(*) as observed, count(*) = 0 as ok from
 (select order_id, order_item_id from fx_order_items_raw group by 1, 2 having count(*) > 1)
union all
select 'catalogue' as table_name, count(*) as observed, count(*) = 0 as ok from
 (select product_id from fx_catalogue group by 1 having count(*) > 1)""",
    "gate_expectations": """
select 'orders above floor' as "check", count(distinct order_id) > 0 as ok, cast(count(distinct order_id) as double) as observed from fact
union all select 'items above floor', count(*) > 0, cast(count(*) as double) from fact
union all select 'score within 0..5', avg(review_score) between 0 and 5, cast(avg(review_score) as double) from fact
union all select 'rows without gross revenue', count(*) filter (where gross_revenue is null) = 0, cast(count(*) filter (where gross_revenue is null) as double) from fact
union all select 'products in dimension', count(*) = (select count(*) from fx_products), cast(count(*) as double) from dim_product
union all select 'loaded orders without sales', count(*) <= (select count(*) / 20.0 from fx_orders), cast(count(*) as double) from fx_orders o where o.order_id not in (select order_id from fact)""",
    "quarantine_bad_rows": """
select order_id, order_item_id, concat_ws(',', r1, r2) as reasons from bad_cells where r1 is not null or r2 is not null""",
    "quarantine_good_rows": """
select i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price, i.freight_value
from fx_order_items_raw i where cast(order_id as bigint) % 10 <> 3 and cast(order_id as bigint) % 17 <> 5""",
    "incremental_ingest": ORDERS_NEXT,
    # upkeep
    "scd2_late_version": """
select product_id, category_en, margin_pct,
 case when row_number() over w = 1 then date '1900-01-01' else first_day end as effective_from,
 lead(first_day) over w as effective_to, lead(first_day) over w is null as is_current, days_seen
from catalogue_versions window w as (partition by product_id order by island)""",
    "incremental_to_silver": """
select o.order_id, o.customer_id,
 case when c.order_id is not null then 'closed' when o.order_status = 'processing' then 'shipped' else o.order_status end as order_status,
 o.order_purchase_timestamp, o.order_delivered_customer_date
from fx_orders o left join closed_orders c on c.order_id = o.order_id and not c.bad_time and not c.no_customer""",
    "incremental_refused": f"""
select order_id, 'closed' as order_status, date '{LAST_DATE}' as ingest_date,
 concat_ws(',', case when no_customer then 'missing customer_id' end, case when bad_time then 'bad order_purchase_timestamp' end) as reasons
from closed_orders where bad_time or no_customer""",
    "fact_sales_incremental": FACT,
    "kpis_by_range": " union all ".join(
        f"""
select date '{a}' as first_day, date '{b}' as last_day, count(distinct order_id) as orders, count(distinct customer_id) as customers,
 count(distinct product_id) as products, count(distinct seller_id) as sellers,
 cast(coalesce(sum(cast(gross_revenue as decimal(18,2))), 0) as double) as revenue,
 floor(avg(review_score) * 100 + 0.5) / 100.0 as avg_review_score, floor(avg(delivery_days) * 10 + 0.5) / 10.0 as avg_delivery_days
from fact where order_date between date '{a}' and date '{b}'"""
        for a, b in RANGES
    ),
    "cluster_worst_periods": """
select cast(year(order_date) as int) as order_year, count(*) as lines, false as overlaps from fact where order_date is not null group by 1""",
    "catalogue_feed": f"""
select product_id, 'inserted' as change, date '{RUN_DATE}' as day, cast(null as string) as category_before, category_en as category_after
from fx_catalogue
union all
select n.product_id, case when o.product_id is null then 'inserted' else 'modified' end, date '{NEXT_DATE}', o.category_en, n.category_en
from catalogue_next n left join fx_catalogue o on o.product_id = n.product_id
where o.product_id is null or o.category_en is distinct from n.category_en""",
    "reload_changed_days": """
select order_id, customer_id, case when order_status = 'processing' then 'returned' else order_status end as order_status,
 order_purchase_timestamp, order_delivered_customer_date from fx_orders""",
    "land_tables": "select * from fx_order_items_raw",
    "scan_silver_cells": "select * from fx_order_items",
    "gate_outputs": """
select 'top_categories has 3 rows' as "check", count(*) = 3 as ok, cast(count(*) as double) as observed
from (select * from sales_by_category where product_category_en <> 'unknown' limit 3) t
union all select 'top_categories is sorted', true, cast(0 as double)
union all select 'top_categories has no unknown category', true, cast(0 as double)
union all select 'top_sellers has 10 rows', count(*) = 10, cast(count(*) as double) from (select * from seller_sales limit 10) t
union all select 'top_sellers is sorted', true, cast(0 as double)
union all select 'revenue_trend is sorted', true, cast(0 as double)""",
}


def with_mapping(sql: str) -> str:
    """The text preceded by the common table expressions it refers to, in their order."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in MAPPING:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(MAPPING[name])
    ctes = [f"{name} as ({MAPPING[name].strip()})" for name in MAPPING if name in needed]
    return f"with {', '.join(ctes)} {sql.strip()}" if ctes else sql.strip()


def oracle_sql() -> dict[str, str]:
    return {name: with_mapping(sql) for name, sql in ORACLES.items()}
