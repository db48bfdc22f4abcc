"""Writing tables and exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakemart.functions.money import MONEY
from lakemart.functions.text import flat_tags
from lakemart.session import small_tasks
from lakemart.sinks.layout import zorder
from lakemart.sources.tables import PENDING, STAMP, VERSION


#: How the files of tables are compressed; readers find out by themselves.
COMPRESSION = "zstd"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    zorder_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
    publish: bool = True,
) -> dict[str, object]:
    """Replace a table, schema included, and return counts taken during the write.

    Each write goes to a version folder of its own, and readers use the newest one that is
    complete: they never see a half-written table, and a job may rewrite what it reads.
    The row count is observed on the way, so nothing is computed a second time for it. With
    ``publish=False`` the version waits, unseen by readers, for ``sources.tables.publish``; its
    name is then among the counts.
    """
    version = datetime.now(timezone.utc).strftime(STAMP)
    seen = Observation()
    counts = {"rows": F.count(F.lit(1)), **(metrics or {})}
    with small_tasks(df.sparkSession):
        arranged = arrange(df, partition_by, zorder_by)
        writer = arranged.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.option("compression", COMPRESSION)
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{path}/{VERSION if publish else PENDING}{version}")
    return seen.get if publish else {**seen.get, "pending": f"{PENDING}{version}"}


def arrange(df: DataFrame, partition_by: str | None, zorder_by: Sequence[str] = ()) -> DataFrame:
    """Rows placed for writing.

    The rows of a partition value are brought together, so that a day is a few files and not
    one per task, and a value that is too big for one task is split: by adaptive execution
    after a rebalance, or by the ranges of a z-order when clustering columns are given.
    """
    if zorder_by:
        return zorder(df, zorder_by, within=[partition_by] if partition_by else [])
    return df.hint("rebalance", partition_by) if partition_by else df


def write_partitioned(
    df: DataFrame,
    path: str,
    column: str,
    zorder_by: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write partitioned by a column; a rerun replaces only the partitions it has rows for.

    Rows without a value go to the default partition. ``finish`` makes the columns to write from those of ``df`` once the
    rows are placed: what follows from other columns is not sent with them.
    """
    with small_tasks(df.sparkSession):
        arranged = arrange(df, column, zorder_by)
        (
            (finish(arranged) if finish else arranged)
            .write.mode("overwrite")
            .options(partitionOverwriteMode="dynamic", compression=COMPRESSION)
            .partitionBy(column)
            .parquet(path)
        )


def export_csv(df: DataFrame, path: str) -> None:
    """Export a table as headered CSV; tags become one comma-joined string."""
    if dict(df.dtypes).get("tags", "string") != "string":
        df = df.withColumn("tags", flat_tags())
    with small_tasks(df.sparkSession):
        df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def to_json_rows(df: DataFrame, amounts: Sequence[str] = ()) -> DataFrame:
    """Result rows as JSON records, a missing value as an explicit null.

    The columns named as amounts are written with two decimals and never with an exponent.
    """
    shown = [F.col(c).cast(MONEY).alias(c) if c in amounts else F.col(c) for c in df.columns]
    record = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})
    return df.select(record.alias("json"))
