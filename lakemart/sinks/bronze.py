"""Landing raw snapshots by ingest date."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame


def _day(root: str, table: str, ingest_date: str | None) -> str:
    today = datetime.now(timezone.utc).date().isoformat()
    return f"{root}/{table}/ingest_date={ingest_date or today}"


def land_csv(df: DataFrame, root: str, table: str, ingest_date: str | None = None) -> str:
    """Land one table as headered CSV under its ingest date, today in UTC unless given.

    A rerun replaces that day only.

    Returns the table's folder. The files are written in parallel, one per input partition.
    """
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(
        _day(root, table, ingest_date)
    )
    return f"{root}/{table}"


def land_jsonl(
    df: DataFrame, root: str, table: str, key: str, ingest_date: str | None = None
) -> str:
    """Land documents as JSON lines, ordered by key across and within the files."""
    path = _day(root, table, ingest_date)
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    ordered.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path
