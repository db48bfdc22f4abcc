"""The tables of one input folder, cleaned and modelled, written once and read back.

Marts are asked of a star schema that exists as tables, not of a plan that rebuilds it for every
question. Each table is written on first use to the cluster's shared folder and read from
there by every later query of the application.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.plans import gold
from lakemart.session import scratch_path
from lakemart.sinks.tables import write_table
from lakemart.sources.files import project_catalogue
from lakemart.sources.tables import read_table, versions
from lakemart.workload.inputs import Inputs

RUN_DATE = "2024-01-01"
NEXT_DATE = "2024-01-02"
LAST_DATE = "2024-01-03"
#: Ranges of days that figures are asked for: overlapping, of one day, and without sales.
RANGES = [
    ("1992-01-01", "1998-12-31"),
    ("1992-01-01", "1992-01-31"),
    ("1993-02-14", "1993-02-14"),
    ("1993-07-01", "1994-06-30"),
    ("1994-01-01", "1994-12-31"),
    ("1995-03-01", "1995-03-07"),
    ("1995-12-31", "1996-01-01"),
    ("1996-01-01", "1998-08-02"),
    ("1997-04-01", "1997-06-30"),
    ("2030-01-01", "2030-12-31"),
]
RUN_TS = "2024-01-01 02:00:00"

_written: dict[tuple[str, str, str], str] = {}


def run_ts():
    """The run's time as a fixed value, so results can be compared."""
    return F.lit(RUN_TS).cast("timestamp_ntz")


class Lakehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.raw = Inputs(spark, sf_dir)

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        path = _written.get(key)
        if path is None or not versions(self.spark, path):
            path = scratch_path(self.spark, name)
            write_table(build(), path)
            _written[key] = path
        return read_table(self.spark, path)

    def silver(self, name: str) -> DataFrame:
        """A cleaned table: orders, order_items, customers, products, sellers, payments, reviews."""
        return self._table(f"silver-{name}", lambda: getattr(self.raw, name))

    def catalogue(self) -> DataFrame:
        return project_catalogue(self._table("silver-catalogue", lambda: self.raw.catalogue))

    def fact(self) -> DataFrame:
        return self._table(
            "gold-fact_sales",
            lambda: gold.fact_sales(*map(self.silver, ("order_items", "orders", "payments", "reviews"))),
        )

    def product(self) -> DataFrame:
        return self._table(
            "gold-dim_product",
            lambda: gold.dim_product(self.silver("products"), self.catalogue(), RUN_DATE),
        )

    def customer(self) -> DataFrame:
        return self._table("gold-dim_customer", lambda: gold.dim_customer(self.silver("customers")))

    def seller(self) -> DataFrame:
        return self._table("gold-dim_seller", lambda: gold.dim_seller(self.silver("sellers")))

    def date(self) -> DataFrame:
        return self._table("gold-dim_date", lambda: gold.dim_date(self.silver("orders")))

    def star(self) -> dict[str, DataFrame]:
        return {
            "fact_sales": self.fact(),
            "dim_product": self.product(),
            "dim_customer": self.customer(),
            "dim_seller": self.seller(),
            "dim_date": self.date(),
        }
