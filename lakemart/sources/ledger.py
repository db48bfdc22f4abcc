"""Which landed files are new, replaced or gone since a table was loaded from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

INGEST_DATE = "ingest_date"
_STATE = ("path", "length", "modified")


def file_states(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """path below ``root``, length, modified (time of last change) of every landed file; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=glob, recursiveFileLookup=True)
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    # Listings name the file system in full, callers often do not: what follows the table's folder tells files apart.
    tail = F.regexp_extract("path", f"({INGEST_DATE}=.*)$", 1)
    return found.withColumn("path", F.when(tail != "", tail).otherwise(F.col("path")))


def file_changes(loaded: DataFrame, now: DataFrame) -> DataFrame:
    """path, change: files that are new, replaced (another length or time) or vanished. Equal ones are not listed."""
    l, n = loaded.select(*_STATE).alias("l"), now.select(*_STATE).alias("n")
    same = F.col("l.length").eqNullSafe(F.col("n.length")) & F.col("l.modified").eqNullSafe(F.col("n.modified"))
    change = (
        F.when(F.col("l.path").isNull(), "new").when(F.col("n.path").isNull(), "vanished").when(~same, "replaced")
    )
    both = l.join(n, F.col("l.path") == F.col("n.path"), "full")
    return both.select(F.coalesce("n.path", "l.path").alias("path"), change.alias("change")).where("change is not null")


def day_changes(loaded: DataFrame, now: DataFrame) -> DataFrame:
    """ingest_date, change: days that are new (no file before), vanished (none now) or replaced (any other change)."""
    day = F.try_to_date(F.regexp_extract("path", rf"{INGEST_DATE}=([^/]+)", 1))
    changed = file_changes(loaded, now).select(day.alias(INGEST_DATE)).distinct()
    had = loaded.select(day.alias(INGEST_DATE)).distinct().withColumn("had", F.lit(True))
    has = now.select(day.alias(INGEST_DATE)).distinct().withColumn("has", F.lit(True))
    change = F.when(F.col("had").isNull(), "new").when(F.col("has").isNull(), "vanished").otherwise("replaced")
    return (
        changed.join(had, INGEST_DATE, "left").join(has, INGEST_DATE, "left").select(INGEST_DATE, change.alias("change"))
    )


def day_folders(root: str, days: Sequence[object]) -> list[str]:
    return [f"{root}/{INGEST_DATE}={day}" for day in days]
