"""Intermediate tables of one operator call, in the folder that all executors share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession

from lakemart.session import folder_bytes, scratch_path

#: Largest table that is sent to every executor, in bytes of its files. Beyond it the join shuffles
#: both sides; the answer is the same.
BROADCAST_BYTES = 8 * 1024**2


class Scratch:
    """Writes tables below the shared folder and deletes those that are no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._n = 0

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """The frame as a written table: it cuts the lineage and survives lost executors."""
        self._n += 1
        path = f"{self.root}/{self._n}-{name}"
        df.write.options(**options).parquet(path)
        # The schema is known, so no job has to read a footer.
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a table that write() returned; nothing may read it afterwards."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Have Spark delete the shuffle files of finished jobs now, not when the driver next runs out of heap.

        It deletes them once their plans are garbage; steps that each shuffle much would else add up on disk.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def join_small(self, big: DataFrame, table: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
        """Join to a written table, sent to every executor only if its files are small."""
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        small = folder_bytes(self.spark, *folders) <= BROADCAST_BYTES
        return big.join(table.hint("broadcast" if small else "merge"), on, how)
