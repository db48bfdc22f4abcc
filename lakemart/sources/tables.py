"""Written tables and the views over them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# How folders of published versions, and of those that wait, begin, and the time that follows.
VERSION, PENDING, STAMP = "version=", "pending=", "%Y%m%dT%H%M%S%f"
#: No run waits this long between writing a version and publishing it.
ABANDONED = timedelta(days=2)

# View names that reports query.
TABLE_VIEWS = {
    "fact_sales": "v_fact_sales",
    "dim_product": "v_dim_product",
    "dim_customer": "v_dim_customer",
    "dim_seller": "v_dim_seller",
    "dim_date": "v_dim_date",
}


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Completed versions of a table, oldest first. A write that died left no marker."""
    fs, root = _hadoop(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(
        n for n in names if n.startswith(VERSION) and path_exists(spark, f"{path}/{n}/_SUCCESS")
    )


def publish(spark: SparkSession, path: str, pending: str) -> None:
    """Make a version that waits the current one."""
    fs, source = _hadoop(spark, f"{path}/{pending}")
    _, target = _hadoop(spark, f"{path}/{pending.replace(PENDING, VERSION)}")
    if not fs.rename(source, target):
        raise OSError(f"could not publish {path}/{pending}")


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest completed version."""
    done = versions(spark, path)
    return f"{path}/{done[-1]}" if done else None


def partition_folders(spark: SparkSession, path: str, column: str) -> set[str]:
    """The names of the folders that a table partitioned by a column has."""
    fs, root = _hadoop(spark, path)
    if not fs.exists(root):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return {n for n in names if n.startswith(f"{column}=")}


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that is no longer needed."""
    fs, folder = _hadoop(spark, path)
    fs.delete(folder, True)


def abandoned(spark: SparkSession, path: str) -> list[str]:
    """Versions that wait to be published since longer than any run takes. Their names tell when they were begun."""
    fs, root = _hadoop(spark, path)
    if not fs.exists(root):
        return []
    limit = f"{PENDING}{(datetime.now(timezone.utc) - ABANDONED).strftime(STAMP)}"
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(PENDING) and n < limit)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest completed versions and return the names of those deleted.

    Keep more than one while queries that started on an older version may still run. Versions that have waited for longer
    than ``ABANDONED`` were left by a run that died, and go as well.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    old = versions(spark, path)[:-keep] + abandoned(spark, path)
    for name in old:
        delete_folder(spark, f"{path}/{name}")
    return old


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The latest completed version of a written table."""
    done = versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no completed version of a table below {path}")
    with few_listing_tasks(spark):
        return spark.read.parquet(f"{path}/{done[-1]}")


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List folders in two tasks per core.

    Spark lists every folder in a task of its own, up to ten thousand; a table partitioned by day has
    thousands, and fewer tasks list them sooner.
    """
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, 2 * spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def read_partitioned(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table partitioned into many folders, under its known schema."""
    with few_listing_tasks(spark):
        return spark.read.schema(schema).parquet(path)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Name the star-schema tables for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + TABLE_VIEWS.get(name, name))
