"""Clustering again only those partitions whose files have come to overlap."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from lakemart.session import scratch_path
from lakemart.sinks.tables import write_partitioned
from lakemart.sources.tables import delete_folder, read_partitioned


def file_ranges(written: DataFrame, partition: str, by: Sequence[str]) -> DataFrame:
    """One row per file of a partitioned table: its partition, and the smallest and largest value of each column.

    Only the columns of ``by`` are read, and each task sends one row per file.
    """
    ends = [f(c).alias(f"{n}_{c}") for c in by for f, n in ((F.min, "min"), (F.max, "max"))]
    return written.groupBy(partition, F.col("_metadata.file_path").alias("file")).agg(*ends)


def overlap_depth(ranges: DataFrame, partition: str, by: Sequence[str]) -> DataFrame:
    """(partition, depth, files): files that one value of a column lies in, at the worst, over the columns.

    Ranges open and close along a column's values; the depth is the largest number that are open at once. The files of
    one partition are ranked together, of no more than one.
    """
    events = []
    for c in by:
        for end, step in (("min", 1), ("max", -1)):
            known = ranges.where(F.col(f"{end}_{c}").isNotNull())
            events.append(known.select(partition, F.col(f"{end}_{c}").alias("at"), F.lit(step).alias("step")))
    per_column = [
        e.union(x).withColumn(
            "open", F.sum("step").over(Window.partitionBy(partition).orderBy("at", F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0))
        ).groupBy(partition).agg(F.max("open").alias("depth"))
        for e, x in zip(events[::2], events[1::2])
    ]
    depths = reduce(DataFrame.unionByName, per_column).groupBy(partition).agg(F.max("depth").cast("int").alias("depth"))
    files = ranges.groupBy(partition).agg(F.count(F.lit(1)).cast("int").alias("files"))
    same = F.col("f.p").eqNullSafe(F.col("d.p"))
    f, d = files.withColumnRenamed(partition, "p").alias("f"), depths.withColumnRenamed(partition, "p").alias("d")
    return f.join(d, same, "left").select(F.col("f.p").alias(partition), F.coalesce("d.depth", F.lit(0)).alias("depth"), "f.files")


def recluster_worst(
    spark: SparkSession, path: str, schema: StructType | str, partition: str, by: Sequence[str], deeper_than: int, most: int = 64
) -> list[object]:
    """Rewrite the ``most`` partitions whose files overlap deepest, above a depth, in z-order; returns their values.

    Their rows are copied to the shared folder first, as they are read and replaced in place. Files of other
    partitions are not touched. A run that died is run again: partitions are replaced whole.
    """
    written = read_partitioned(spark, path, schema)
    depths = overlap_depth(file_ranges(written, partition, by), partition, by)
    worst = [r[0] for r in depths.where(F.col("depth") > deeper_than).orderBy(F.desc("depth"), partition).limit(most).collect()]
    if not worst:
        return []
    hit = reduce(lambda a, b: a | b, (F.col(partition).eqNullSafe(F.lit(v)) for v in worst))
    staged = scratch_path(spark, "recluster")
    written.where(hit).write.parquet(staged)
    write_partitioned(spark.read.schema(written.schema).parquet(staged), path, partition, by)
    delete_folder(spark, staged)
    return worst
