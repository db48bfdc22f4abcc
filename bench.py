"""Times the headline jobs and queries and prints one JSON line.

Marts are timed as in daily use: against the star schema as written tables. Each query is
run to a sink that discards its rows, warm, and the median of the runs is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakemart.plans.jobs import bronze_to_silver, read_star, silver_to_gold  # noqa: E402
from lakemart.schemas import SILVER  # noqa: E402
from lakemart.session import build_session, scratch_path  # noqa: E402
from lakemart.sinks.bronze import land_csv, land_jsonl  # noqa: E402
from lakemart.workload.lakehouse import Lakehouse  # noqa: E402
from lakemart.workload.queries import REGISTRY  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DAY = "2024-01-01"
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "dedup_natural_key",
    "fact_sales",
    "fact_sales_elapsed",
    "revenue_by_category_notebook",
    "kpis",
    "top_categories",
    "state_revenue",
    "revenue_trend",
    "top_sellers",
    "vw_monthly_revenue_by_category",
    "vw_customer_ltv",
    "vw_seller_performance",
    "vw_weekly_cohort",
    "customer_ltv_by_person",
    "review_heatmap",
    "tag_cloud",
    "cohort_matrix",
    "join_fact_product",
    "join_first_order",
    "latest_review",
    "scd2_merge",
    "dim_product_as_of",
    "upsert_catalogue",
    "agg_distinct_count",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def land_all(spark, lake: Lakehouse) -> str:
    """The raw tables as CSV snapshots with every pinned column, missing ones empty."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    from lakemart.workload.queries import raw_tables

    root = scratch_path(spark, "bench-bronze")
    for name, df in raw_tables(lake).items():
        fields = StructType.fromDDL(SILVER[name].ddl).fields
        full = [
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fields
        ]
        land_csv(df.select(*full), root, name, DAY)
    return root


def main() -> None:
    spark = build_session(
        "lakemart-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lakehouse(spark, SF_DIR)
    seconds: dict[str, float] = {}

    bronze = land_all(spark, lake)
    silver = scratch_path(spark, "bench-silver")
    seconds["bronze_to_silver"] = timed(lambda: bronze_to_silver(spark, bronze, silver))
    catalogue = land_jsonl(lake.raw.catalogue, bronze, "catalogue", "product_id", DAY)
    gold = scratch_path(spark, "bench-gold")
    seconds["silver_to_gold"] = timed(
        lambda: silver_to_gold(spark, silver, catalogue, gold, DAY, partition_by=None)
    )
    # The same jobs on their other paths: the fact partitioned by day, and bad rows kept apart.
    by_day = scratch_path(spark, "bench-gold-by-day")
    seconds["silver_to_gold_by_day"] = timed(
        lambda: silver_to_gold(spark, silver, catalogue, by_day, DAY, partition_by="order_date")
    )
    seconds["read_fact_by_day"] = timed(lambda: discard(read_star(spark, by_day)["fact_sales"]))
    checked, refused = scratch_path(spark, "bench-checked"), scratch_path(spark, "bench-refused")
    seconds["bronze_to_silver_quarantine"] = timed(
        lambda: bronze_to_silver(spark, bronze, checked, refused)
    )
    lake.star()

    for name in HEADLINE:
        query = REGISTRY[name]
        discard(query(spark, SF_DIR))
        runs = [timed(lambda: discard(query(spark, SF_DIR))) for _ in range(RUNS)]
        seconds[name] = statistics.median(runs)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
