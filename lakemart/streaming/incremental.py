"""Daily arrival of files to a current, de-duplicated table, by Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.operators.dedup import dedup

INGEST_DATE = "ingest_date"
BATCH = "batch_id"


def ingest_incremental(
    spark: SparkSession,
    source: str,
    ddl: str,
    keys: Sequence[str],
    target: str,
    checkpoint: str,
    multi_line: bool = False,
    files_per_batch: int | None = None,
) -> None:
    """Process the files that arrived since the last run, then stop.

    Each micro-batch is reduced to the latest row per key and written to a folder named by
    its id. A batch that is replayed after a failure writes the same folder again, so the
    outcome is exactly once, and no batch rewrites rows of an earlier one. Rows without a whole key are
    no versions of each other: they are kept apart, whole, below ``target/_keyless``, which readers of the log do not see.
    """
    options = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    arriving = (
        spark.readStream.schema(f"{ddl}, {INGEST_DATE} date")
        .options(header=True, quote='"', escape='"', multiLine=multi_line, enforceSchema=False, **options)
        .csv(source)
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        whole = reduce(and_, (F.col(k).isNotNull() for k in keys))
        batch.where(~whole).write.mode("overwrite").parquet(f"{target}/_keyless/{BATCH}={batch_id}")
        latest = dedup(batch.where(whole), keys, [INGEST_DATE])
        latest.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    query = (
        arriving.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_rows(spark: SparkSession, target: str, ddl: str, keys: Sequence[str]) -> DataFrame:
    """The table as of now: the latest row per key over all stored batches.

    Latest is by ingest date, then by batch, so a file that arrives late with an older date
    does not undo a newer one.
    """
    stored = spark.read.schema(f"{ddl}, {INGEST_DATE} date, {BATCH} bigint").parquet(target)
    columns = StructType.fromDDL(ddl).fieldNames()
    return dedup(stored, keys, [INGEST_DATE, BATCH]).select(*columns)


def compact(spark: SparkSession, target: str, ddl: str, keys: Sequence[str], into: str) -> None:
    """Fold all batches into a new folder holding one row per key, as a batch before all others."""
    stored = spark.read.schema(f"{ddl}, {INGEST_DATE} date, {BATCH} bigint").parquet(target)
    folded = dedup(stored, keys, [INGEST_DATE, BATCH]).drop(BATCH)
    folded.write.mode("overwrite").parquet(f"{into}/{BATCH}=-1")
