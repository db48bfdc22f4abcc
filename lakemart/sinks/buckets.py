"""A keyed table in hash buckets: a batch of rows rewrites only the buckets its keys fall into.

``data/batch=<id>/bucket=<k>`` holds what a batch wrote. A small versioned table of parts names the folder in which
each bucket now stands and the last batch that was applied. Publishing a new version of it is the only step that
readers see, so all that a batch changes becomes visible at once, and a batch that died is written again over its own
folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.operators.dedup import dedup
from lakemart.session import BYTES_PER_PARTITION, scratch_path
from lakemart.sinks.tables import write_table
from lakemart.sources.tables import (
    _hadoop,
    delete_folder,
    drop_old_versions,
    path_exists,
    read_table,
    versions,
)

BUCKET = "_bucket"
#: Buckets of a table that is not told how many: enough for a quarter of a terabyte at 256 MB each.
BUCKETS = 1024
_PARTS_DDL = "bucket int, folder string, batch long, buckets int"


@dataclass(frozen=True)
class Parts:
    """Where the buckets stand (bucket: folder below the table), how many there are, and the last batch applied."""

    folders: dict[int, str]
    buckets: int
    batch: int


def buckets_for(table_bytes: int) -> int:
    """Buckets for a table of that size."""
    return max(1, -(-table_bytes // BYTES_PER_PARTITION))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, f"{path}/_parts"))


def read_parts(spark: SparkSession, path: str) -> Parts | None:
    """The parts of the newest version; one row per bucket is read."""
    if not is_bucketed(spark, path):
        return None
    rows = read_table(spark, f"{path}/_parts").collect()
    return Parts({r.bucket: r.folder for r in rows if r.folder is not None}, rows[0].buckets, rows[0].batch)


def read_buckets(spark: SparkSession, path: str, ddl: str, only: Sequence[int] | None = None) -> DataFrame:
    """The rows of the table, or of some buckets, under its known schema."""
    parts = read_parts(spark, path)
    wanted = [f for b, f in sorted(parts.folders.items()) if only is None or b in set(only)] if parts else []
    if not wanted:
        return spark.createDataFrame([], StructType.fromDDL(ddl))
    return spark.read.schema(ddl).parquet(*[f"{path}/{folder}" for folder in wanted])


def merge_batch(
    spark: SparkSession,
    path: str,
    arrived: DataFrame,
    ddl: str,
    keys: Sequence[str],
    latest_by: Sequence[str],
    batch: int,
    buckets: int = BUCKETS,
    instead_of: Column | None = None,
) -> list[int]:
    """Fold a batch into the table and return the buckets that were rewritten.

    Of the rows of a key, stored or arrived, the latest stays, by the rule of ``dedup``; so the table is the
    same however the rows were cut into batches. A batch whose number is not above the last one applied changes nothing,
    and ``buckets`` counts for a new table only. Rows need their whole key. Stored rows for which ``instead_of`` holds are
    taken out, as far as the batch does not bring them again.
    """
    parts = read_parts(spark, path) or Parts({}, buckets, -1)
    if batch <= parts.batch:
        return []
    columns = StructType.fromDDL(ddl).fieldNames()
    number = bucket_of(keys, parts.buckets)
    staged = scratch_path(spark, "arrived")
    # Duplicates go before anything is placed, so a key that fills the batch is one row per task.
    dedup(arrived.select(*columns), keys, latest_by).withColumn(BUCKET, number).write.parquet(staged)
    try:
        new = spark.read.schema(f"{ddl}, {BUCKET} int").parquet(staged)
        hit = new.select(BUCKET)
        if instead_of is not None:
            hit = hit.unionByName(read_buckets(spark, path, ddl).where(instead_of).select(number.alias(BUCKET)))
        touched = sorted(r[0] for r in hit.distinct().collect())  # the number of buckets at most
        if touched:
            old = read_buckets(spark, path, ddl, touched).withColumn(BUCKET, number)
            if instead_of is not None:
                old = old.where(~F.coalesce(instead_of, F.lit(False)))
            # One shuffle: rows of a key are in one bucket, so the ranking needs no other placing.
            together = old.unionByName(new).repartition(len(touched), BUCKET)
            merged = dedup(together, [BUCKET, *keys], latest_by)
            merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/data/batch={batch}")
    finally:
        delete_folder(spark, staged)
    folders = {**parts.folders, **{b: f"data/batch={batch}/{BUCKET}={b}" for b in touched}}
    # A bucket that lost all its rows has no folder any more.
    folders = {b: f for b, f in folders.items() if b not in touched or path_exists(spark, f"{path}/{f}")}
    rows = [(b, f, batch, parts.buckets) for b, f in sorted(folders.items())] or [(None, None, batch, parts.buckets)]
    write_table(spark.createDataFrame(rows, _PARTS_DDL).coalesce(1), f"{path}/_parts")
    _drop_unnamed(spark, path)
    return touched


def _drop_unnamed(spark: SparkSession, path: str) -> None:
    """Delete buckets that neither the newest version of the parts nor the one before names."""
    drop_old_versions(spark, f"{path}/_parts")
    kept = {
        r.folder
        for name in versions(spark, f"{path}/_parts")
        for r in spark.read.schema(_PARTS_DDL).parquet(f"{path}/_parts/{name}").collect()
    }
    fs, root = _hadoop(spark, f"{path}/data")
    if not fs.exists(root):
        return
    for batch in [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]:
        named = False
        for bucket in [s.getPath() for s in fs.listStatus(batch) if s.isDirectory()]:
            if f"data/{batch.getName()}/{bucket.getName()}" in kept:
                named = True
            else:
                fs.delete(bucket, True)
        if not named:
            fs.delete(batch, True)
