"""Scans of landed text files under pinned schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.schemas import CATALOGUE_DDL, GOLD_CSV_DDL, TRANSLATION_DDL

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, ddl: str, multi_line: bool = False) -> DataFrame:
    """CSV under a pinned schema. A cell that does not fit its type becomes NULL.

    The header must carry the schema's names in order: swapped columns fail the read
    instead of loading into each other.
    """
    return (
        spark.read.schema(ddl)
        .options(header=True, quote='"', escape='"', multiLine=multi_line, enforceSchema=False)
        .csv(path)
    )


def read_csv_text(spark: SparkSession, path: str, ddl: str, multi_line: bool = False) -> DataFrame:
    """The same file with every cell as text, plus the raw line where cells are missing or left over.

    The header must carry the schema's names in order, as in ``read_csv``. Column pruning is off, so the answer does not depend on which columns a query selects.
    """
    names = StructType.fromDDL(ddl).fieldNames()
    text = ", ".join(f"`{n}` string" for n in names)
    return (
        spark.read.schema(f"{text}, {CORRUPT} string")
        .options(
            header=True,
            quote='"',
            escape='"',
            multiLine=multi_line,
            enforceSchema=False,
            columnPruning=False,
            columnNameOfCorruptRecord=CORRUPT,
        )
        .csv(path)
    )


def read_snapshots(
    spark: SparkSession,
    root: str,
    ddl: str,
    since: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All snapshots below ``root/ingest_date=...``, or those from a day on.

    ``ingest_date`` comes from the directory names, so a bound on it skips whole directories.
    """
    return from_day(read_csv(spark, root, f"{ddl}, ingest_date date", multi_line), since)


def from_day(snapshots: DataFrame, since: str | None) -> DataFrame:
    """The snapshots from a day on, or all of them."""
    if since is None:
        return snapshots
    return snapshots.where(F.col("ingest_date") >= F.lit(since).cast("date"))


def read_catalogue(spark: SparkSession, path: str, fmt: str = "json", **options: str) -> DataFrame:
    """Catalogue documents as rows of the four fields the star schema uses.

    ``fmt`` may name a document-store connector where one is attached; the documents are
    read by the executors either way.
    """
    documents = spark.read.format(fmt).schema(CATALOGUE_DDL).options(**options)
    return project_catalogue(documents.load(path) if path else documents.load())


def project_catalogue(catalogue: DataFrame) -> DataFrame:
    return catalogue.select(
        "product_id", F.col("category_en").alias("product_category_en"), "tags", "margin_pct"
    )


def read_translation(spark: SparkSession, path: str) -> DataFrame:
    """Category names and their English form; a byte-order mark is skipped by the reader."""
    return read_csv(spark, path, TRANSLATION_DDL)


def read_gold_csv(spark: SparkSession, root: str, ddl: dict[str, str] = GOLD_CSV_DDL) -> dict[str, DataFrame]:
    """The exported star schema, one CSV folder per table."""
    return {name: read_csv(spark, f"{root}/{name}", columns) for name, columns in ddl.items()}


def file_inventory(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Path and size of landed files; their contents are never read.

    Files of zero bytes are not listed: Spark leaves them out of every scan.
    """
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=glob, recursiveFileLookup=True)
        .load(root)
        .select("path", "length")
    )
