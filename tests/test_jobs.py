"""The daily jobs end to end, and incremental ingestion."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators.quality import GateError
from lakemart.plans import gold, marts, reports
from lakemart.plans.silver import csv_to_silver
from lakemart.plans.jobs import bronze_to_silver, read_star, silver_to_gold, write_all
from lakemart.schemas import SILVER
from lakemart.session import (
    BYTES_PER_PARTITION,
    SHUFFLE_PARTITIONS,
    TASK_SIZES,
    folder_bytes,
    shared_dir,
    shuffle_partitions_for,
    sized_shuffles,
    small_tasks,
)
from lakemart.sinks.bronze import land_csv, land_jsonl
from lakemart.sinks.tables import write_table
from lakemart.sources.tables import read_table
from lakemart.streaming.incremental import compact, current_rows, ingest_incremental
from lakemart.workload.inputs import Inputs
from lakemart.workload.queries import raw_tables

DDL = "id string, v int"


def pinned(df, name):
    """All columns of the pinned schema, those the data lacks as missing."""
    fields = StructType.fromDDL(SILVER[name].ddl).fields
    return df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )


class Raw:
    def __init__(self, spark, sf_dir):
        self.raw = Inputs(spark, sf_dir)


@pytest.fixture(scope="module")
def lakehouse_dir(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    holder = Raw(spark, sf_dir)
    for name, df in raw_tables(holder).items():
        land_csv(pinned(df, name), f"{root}/bronze", name, "2024-01-01")
    land_csv(pinned(holder.raw.orders_next, "orders"), f"{root}/bronze", "orders", "2024-01-02")
    land_jsonl(holder.raw.catalogue, f"{root}/bronze", "catalogue", "product_id", "2024-01-01")
    land_jsonl(holder.raw.catalogue_next, f"{root}/bronze", "catalogue", "product_id", "2024-01-02")
    return root


def test_daily_jobs(spark, sf_dir, lakehouse_dir):
    root, raw = lakehouse_dir, Inputs(spark, sf_dir)
    counts = bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine")
    assert counts["orders"]["rows"] == raw.orders.count()
    assert counts["order_items"]["rows"] == raw.order_items.count()
    orders = read_table(spark, f"{root}/silver/orders")
    assert orders.where("order_status = 'processing'").count() == 0, "the newer snapshot wins"
    assert dict(orders.dtypes)["_ingest_ts"] == "timestamp"
    assert orders.select("_ingest_ts").distinct().count() == 1
    assert read_table(spark, f"{root}/quarantine/orders").count() == 0

    def day(n, **options):
        path = f"{root}/bronze/catalogue/ingest_date=2024-01-0{n}"
        return silver_to_gold(spark, f"{root}/silver", path, f"{root}/gold", f"2024-01-0{n}", **options)

    first = day(1, partition_by="order_status")
    assert first["fact_sales"]["rows"] == counts["order_items"]["rows"]
    assert first["dim_product"]["rows"] == raw.products.count()
    day(2, keep_history=True, partition_by=None)
    star = read_star(spark, f"{root}/gold")
    product = star["dim_product"]
    current = product.where("is_current")
    assert current.count() == first["dim_product"]["rows"]
    closed = product.where("not is_current")
    assert 0 < closed.count() == closed.where(F.col("effective_to") == date(2024, 1, 2)).count()
    assert star["fact_sales"].select("order_id").distinct().count() == orders.count() - (
        orders.join(raw.order_items, "order_id", "left_anti").count()
    )


def test_marts_count_a_sale_once_with_history(spark, lakehouse_dir):
    star = read_star(spark, f"{lakehouse_dir}/gold")
    fact, product = star["fact_sales"], star["dim_product"]
    assert product.where("not is_current").count() > 0
    total = marts.kpis(fact, star["dim_customer"], product, star["dim_seller"]).first().total_revenue
    shares = reports.category_share(fact, product).agg(F.sum("revenue")).first()[0]
    assert shares == pytest.approx(total)
    assert reports.tag_cloud(fact, product).agg(F.max("items_sold")).first()[0] <= fact.count()
    assert marts.revenue_by_category(fact, product, 50).agg(F.sum("items_sold")).first()[0] == fact.count()


def test_refused_run_leaves_the_tables(spark, tmp_path, frame):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for name, spec in SILVER.items():
        rows = spark.createDataFrame([], spec.ddl)
        if name == "orders":
            rows = pinned(frame("order_id string", ("a",)), "orders")
        land_csv(rows, bronze, name, "2024-01-01")
    bronze_to_silver(spark, bronze, silver)
    with pytest.raises(GateError):
        bronze_to_silver(spark, bronze, silver, order_floor=5)
    assert [r.order_id for r in read_table(spark, f"{silver}/orders").collect()] == ["a"]
    assert not [n for n in os.listdir(f"{silver}/orders") if n.startswith("pending=")]


def test_rows_without_key_are_diverted(spark, tmp_path, frame):
    spec, bronze = SILVER["customers"], f"{tmp_path}/bronze"
    rows = frame("customer_id string, customer_city string", ("1", "x"), (None, "y"), (None, "z"), ("2", "x"))
    land_csv(pinned(rows, "customers"), bronze, "customers", "2024-01-01")
    for quarantine, folder in ((None, f"{tmp_path}/a/_refused"), (f"{tmp_path}/q", f"{tmp_path}/q")):
        counts = csv_to_silver(spark, spec, bronze, f"{tmp_path}/a", quarantine)
        assert (counts["rows"], counts["refused"]) == (2, 2)
        assert {r.customer_city for r in read_table(spark, f"{folder}/customers").collect()} == {"y", "z"}


def test_since_merges_into_the_table(spark, tmp_path, frame, rows_of):
    spec, bronze, silver = SILVER["customers"], f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for day, rows in (("2024-01-01", [("1", "old"), ("2", "old")]), ("2024-01-02", [("2", "new"), ("3", "new")])):
        land_csv(pinned(frame("customer_id string, customer_city string", *rows), "customers"), bronze, "customers", day)
        csv_to_silver(spark, spec, bronze, silver, since=day)
    table = read_table(spark, f"{silver}/customers").select("customer_id", "customer_city")
    assert rows_of(table) == [("1", "old"), ("2", "new"), ("3", "new")]


def test_repeated_catalogue_entries_do_not_multiply_products(spark, frame):
    products = frame("product_id string, product_category_name string, product_weight_g double", ("1", "a", 1.0))
    catalogue = frame("product_id string, product_category_en string, tags array<string>, margin_pct double", ("1", "x", ["t"], 0.1), ("1", "y", None, 0.2))
    assert gold.dim_product(products, catalogue, "2024-01-01").count() == 1


def test_run_without_orders_fails(spark, tmp_path):
    for name, spec in SILVER.items():
        land_csv(spark.createDataFrame([], spec.ddl), f"{tmp_path}/bronze", name, "2024-01-01")
    with pytest.raises(GateError):
        bronze_to_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark)).rstrip("/")


def test_shuffles_grow_with_the_input(spark, tmp_path):
    assert shuffle_partitions_for(10**6, at_least=200) == 200
    assert shuffle_partitions_for(10**12, at_least=200) == 3726
    assert shuffle_partitions_for(10**14, at_least=200) == -(-10**14 // BYTES_PER_PARTITION)
    assert shuffle_partitions_for(10**12, at_least=10**5) == 10**5
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    assert folder_bytes(spark, str(tmp_path)) == 5
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    with pytest.raises(KeyError), sized_shuffles(spark, 10**12):
        assert spark.conf.get(SHUFFLE_PARTITIONS) == "3726"
        raise KeyError
    assert spark.conf.get(SHUFFLE_PARTITIONS) == before


def test_writes_run_in_small_tasks(spark, set_conf, tmp_path, monkeypatch):
    """Tasks that sort what they read are small whatever the session says, and its settings come back."""
    spark.range(300_000).selectExpr("id", "uuid() as text").repartition(1).write.option("parquet.block.size", 2**20).parquet(f"{tmp_path}/in")
    set_conf(**{TASK_SIZES[0]: "128m", TASK_SIZES[1]: "8k", "spark.sql.files.minPartitionNum": "1"})
    monkeypatch.setattr("lakemart.session.BYTES_PER_TASK", 2**20)
    before = [spark.conf.get(k) for k in TASK_SIZES]
    write_table(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/out")
    assert len(glob.glob(f"{tmp_path}/out/*/*.parquet")) > 4
    with pytest.raises(KeyError), small_tasks(spark), small_tasks(spark):
        assert [spark.conf.get(k) for k in TASK_SIZES] == [f"{2**20}b", f"{8 * 2**10}b"]
        raise KeyError
    assert [spark.conf.get(k) for k in TASK_SIZES] == before


def test_failed_write_fails_the_job(frame):
    def fail():
        raise OSError("disk")

    with pytest.raises(OSError):
        write_all({"good": lambda: {"rows": 1}, "bad": fail})
    assert write_all({"good": lambda: {"rows": 1}}) == {"good": {"rows": 1}}


# ---- incremental


class Arrivals:
    """A landing folder and a table fed from it."""

    def __init__(self, spark, root, frame):
        self.spark, self.root, self.frame = spark, str(root), frame

    def land(self, day, *rows):
        land_csv(self.frame(DDL, *rows), f"{self.root}/landing", "t", day)

    def run(self, checkpoint="progress", **options):
        ingest_incremental(
            self.spark,
            f"{self.root}/landing/t",
            DDL,
            ["id"],
            f"{self.root}/log",
            f"{self.root}/{checkpoint}",
            **options,
        )

    def rows(self, log="log"):
        current = current_rows(self.spark, f"{self.root}/{log}", DDL, ["id"])
        return sorted(tuple(r) for r in current.collect())


@pytest.fixture
def arrivals(spark, tmp_path, frame):
    return Arrivals(spark, tmp_path, frame)


def test_latest_day_wins_and_old_files_are_not_read_again(arrivals):
    arrivals.land("2024-01-01", ("a", 1), ("b", 1))
    arrivals.run()
    arrivals.land("2024-01-02", ("a", 2), ("c", 2))
    arrivals.run()
    arrivals.run()
    assert arrivals.rows() == [("a", 2), ("b", 1), ("c", 2)]
    batches = [d for d in os.listdir(f"{arrivals.root}/log") if d.startswith("batch_id=")]
    assert len(batches) == 2


def test_file_arriving_late_does_not_undo_a_newer_day(arrivals):
    arrivals.land("2024-01-02", ("a", 2))
    arrivals.run()
    arrivals.land("2024-01-01", ("a", 1), ("b", 1))
    arrivals.run()
    assert arrivals.rows() == [("a", 2), ("b", 1)]


def test_replay_from_scratch_gives_the_same_table(arrivals):
    arrivals.land("2024-01-01", ("a", 1), ("b", 1))
    arrivals.land("2024-01-02", ("a", 2))
    arrivals.run()
    before = arrivals.rows()
    arrivals.run(checkpoint="lost-and-begun-again")
    assert arrivals.rows() == before == [("a", 2), ("b", 1)]


def test_one_file_per_batch_gives_the_same_table(arrivals):
    for day in (1, 2, 3):
        arrivals.land(f"2024-01-0{day}", ("a", day), (f"only{day}", day))
    arrivals.run(files_per_batch=1)
    assert arrivals.rows() == [("a", 3), ("only1", 1), ("only2", 2), ("only3", 3)]


def test_compaction_keeps_the_table(arrivals, spark):
    for day in (1, 2):
        arrivals.land(f"2024-01-0{day}", ("a", day), (f"only{day}", day))
        arrivals.run()
    compact(spark, f"{arrivals.root}/log", DDL, ["id"], f"{arrivals.root}/folded")
    assert arrivals.rows("folded") == arrivals.rows()
    assert spark.read.parquet(f"{arrivals.root}/folded").count() == 3
