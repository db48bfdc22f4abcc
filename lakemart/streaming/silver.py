"""Files that arrive day by day to cleaned tables, by Structured Streaming, with refused rows kept apart.

Each micro-batch is parsed once. Its good rows are merged into the bucketed table, its refused rows go, with their
reasons, to a folder named by the batch, and both become visible by one publication of the table's parts: readers of
refused rows see those of applied batches only. A run killed anywhere writes the same folders again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.operators.quality import GateError
from lakemart.plans.silver import INGEST_DATE, split_checked, with_lineage, with_reasons
from lakemart.schemas import SILVER, TableSpec
from lakemart.session import scratch_path
from lakemart.sinks.buckets import BUCKETS, is_bucketed, merge_batch, read_buckets, read_parts
from lakemart.sources.files import CORRUPT
from lakemart.sources.tables import delete_folder, path_exists, read_table

REASONS = "_reasons"


def stored_ddl(ddl: str) -> str:
    """The columns of a table with the day of the snapshot that each row is from."""
    return f"{ddl}, {INGEST_DATE} date"


def arriving_text(spark: SparkSession, source: str, ddl: str, multi_line: bool, files_per_batch: int | None) -> DataFrame:
    """A stream of new files with every cell as text, as ``sources.files.read_csv_text`` reads them."""
    names = StructType.fromDDL(ddl).fieldNames()
    text = ", ".join(f"`{n}` string" for n in names)
    options = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    return (
        spark.readStream.schema(f"{text}, {CORRUPT} string, {INGEST_DATE} date")
        .options(
            header=True,
            quote='"',
            escape='"',
            multiLine=multi_line,
            enforceSchema=False,
            columnPruning=False,
            columnNameOfCorruptRecord=CORRUPT,
            **options,
        )
        .csv(source)
    )


def store_batch(
    text: DataFrame, batch: int, ddl: str, keys: tuple[str, ...], required: tuple[str, ...], target: str, buckets: int = BUCKETS
) -> None:
    """One micro-batch of text rows into the table at ``target`` and the refused rows below it."""
    spark = text.sparkSession
    parts = read_parts(spark, target)
    if parts and batch <= parts.batch:
        return
    staged = scratch_path(spark, "checked")
    with_reasons(text, ddl, [*dict.fromkeys([*required, *keys])]).write.parquet(staged)
    try:
        checked = split_checked(spark.read.parquet(staged), ddl)
        checked.bad.write.mode("overwrite").parquet(f"{target}/_refused/batch={batch}")
        merge_batch(spark, target, checked.good, stored_ddl(ddl), keys, [INGEST_DATE], batch, buckets)
    finally:
        delete_folder(spark, staged)


def ingest_to_silver(
    spark: SparkSession,
    source: str,
    ddl: str,
    keys: tuple[str, ...],
    required: tuple[str, ...],
    target: str,
    checkpoint: str,
    multi_line: bool = False,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Merge the files below ``source/ingest_date=...`` that arrived since the last run into a cleaned table."""

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, ddl, keys, required, target, buckets)

    query = (
        arriving_text(spark, source, ddl, multi_line, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def cleaned_rows(spark: SparkSession, target: str, ddl: str) -> DataFrame:
    """The cleaned table: one row per key, without the day of its snapshot."""
    return read_buckets(spark, target, stored_ddl(ddl)).drop(INGEST_DATE)


def refused_rows(spark: SparkSession, target: str, ddl: str) -> DataFrame:
    """Refused rows of all applied batches: cells as text, the day, the batch, and the reasons."""
    names = StructType.fromDDL(ddl).fieldNames()
    text = ", ".join(f"`{n}` string" for n in names)
    schema = f"{text}, {CORRUPT} string, {INGEST_DATE} date, {REASONS} array<string>, batch long"
    parts = read_parts(spark, target)
    if parts is None or not path_exists(spark, f"{target}/_refused"):
        return spark.createDataFrame([], StructType.fromDDL(schema))
    return spark.read.schema(schema).parquet(f"{target}/_refused").where(F.col("batch") <= parts.batch)


def read_silver(spark: SparkSession, silver: str, spec: TableSpec, run_ts: Column | None = None) -> DataFrame:
    """A cleaned table, kept in buckets by the incremental job or written whole by the daily one."""
    path = f"{silver}/{spec.name}"
    if is_bucketed(spark, path):
        return with_lineage(cleaned_rows(spark, path, spec.ddl), run_ts)
    return read_table(spark, path)


def bronze_to_silver_incremental(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoints: str,
    order_floor: int = 0,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> dict[str, dict[str, int]]:
    """Bring all seven tables up to date with the files that arrived; returns the rows kept and refused of each.

    Tables follow one another: a stream keeps the cluster busy by itself. The floor on the orders is checked after
    their merge, and a run below it fails before the other tables change.
    """
    counts: dict[str, dict[str, int]] = {}
    for name, spec in SILVER.items():
        target = f"{silver}/{name}"
        ingest_to_silver(
            spark, f"{bronze}/{name}", spec.ddl, spec.keys, spec.required, target,
            f"{checkpoints}/{name}", spec.multi_line, files_per_batch, buckets,
        )
        kept = cleaned_rows(spark, target, spec.ddl).count()
        counts[name] = {"rows": kept, "refused": refused_rows(spark, target, spec.ddl).count()}
        if name == "orders" and kept <= order_floor:
            raise GateError(f"orders: {kept} rows, need more than {order_floor}")
    return counts
