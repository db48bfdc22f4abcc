"""Raw snapshots to typed, de-duplicated tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.operators.dedup import dedup
from lakemart.schemas import TableSpec
from lakemart.session import scratch_path
from lakemart.sinks.tables import write_table
from lakemart.sources.files import CORRUPT, from_day, read_csv_text, read_snapshots
from lakemart.sources.tables import delete_folder, drop_old_versions, read_table, versions

INGEST_DATE = "ingest_date"
INGEST_TS = "_ingest_ts"


def with_lineage(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Stamp rows with the run's time: one value for the whole run."""
    return df.withColumn(INGEST_TS, F.current_timestamp() if run_ts is None else run_ts)


def latest_snapshot(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key over all snapshots, the newest snapshot winning."""
    return dedup(snapshots, keys, [INGEST_DATE]).drop(INGEST_DATE)


@dataclass(frozen=True)
class Checked:
    """Typed good rows, and refused rows as text with the reasons."""

    good: DataFrame
    bad: DataFrame


def with_reasons(text: DataFrame, ddl: str, required: Sequence[str]) -> DataFrame:
    """An all-text frame with ``_reasons``: why a row does not fit, empty if it does."""
    reasons = []
    for field in StructType.fromDDL(ddl).fields:
        cell = F.col(field.name)
        typed = cell.try_cast(field.dataType)
        reasons.append(F.when(cell.isNotNull() & typed.isNull(), F.lit(f"bad {field.name}")))
        if field.name in required:
            reasons.append(F.when(cell.isNull(), F.lit(f"missing {field.name}")))
    if CORRUPT in text.columns:
        reasons.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed line")))
    return text.withColumn("_reasons", F.array_compact(F.array(*reasons)))


def split_checked(checked: DataFrame, ddl: str) -> Checked:
    """The typed rows without a reason, and the others as they are."""
    fields = StructType.fromDDL(ddl).fields
    extra = [c for c in checked.columns if c not in {f.name for f in fields} | {CORRUPT, "_reasons"}]
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return Checked(
        good=checked.where(F.size("_reasons") == 0).select(*typed, *extra),
        bad=checked.where(F.size("_reasons") > 0),
    )


def split_bad_rows(text: DataFrame, ddl: str, required: Sequence[str]) -> Checked:
    """Type an all-text frame and divert what does not fit.

    A row is refused when a cell cannot be cast to its column's type, a required column is
    missing, or the line has the wrong number of cells. Every reason is listed. Nothing
    is lost: good and bad rows together are the input.
    """
    return split_checked(with_reasons(text, ddl, required), ddl)


def read_checked(
    spark: SparkSession, root: str, spec: TableSpec, since: str | None = None
) -> Checked:
    """The snapshots of a table, split into typed rows and refused ones."""
    text = from_day(read_csv_text(spark, root, spec.ddl, spec.multi_line), since)
    return split_bad_rows(text, spec.ddl, spec.required)


def merged(current: DataFrame | None, arrived: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that arrived, and those of the current table whose keys did not."""
    if current is None:
        return arrived
    return current.join(arrived.select(*keys), list(keys), "left_anti").unionByName(arrived)


def csv_to_silver(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    silver: str,
    quarantine: str | None = None,
    run_ts: Column | None = None,
    since: str | None = None,
    publish: bool = True,
) -> dict[str, object]:
    """Ingest one table: scan, keep the latest row per key, stamp, write. Returns write counts.

    With a quarantine folder, refused rows go there; without one, cells that do not fit
    become NULL. Rows without a whole key have no place in the table: they always go to the quarantine,
    below ``silver/_refused`` if none is given, and are counted as ``refused``. ``since`` leaves out older
    snapshots, whose folders are then not read, and merges the newer ones into the current table.
    """
    root, target = f"{bronze}/{spec.name}", f"{silver}/{spec.name}"
    refused_to = f"{quarantine or f'{silver}/_refused'}/{spec.name}"
    seen, staged = Observation(), None
    if quarantine is None:
        arrived = read_snapshots(spark, root, spec.ddl, since, spec.multi_line)
        no_key = reduce(or_, (F.col(k).isNull() for k in spec.keys))
        refused = arrived.where(no_key)
        rows = arrived.observe(seen, F.count_if(no_key).alias("refused")).where(~no_key)
    else:
        # The files are parsed once; both kinds of rows are then read from what was checked.
        text = from_day(read_csv_text(spark, root, spec.ddl, spec.multi_line), since)
        required = [*dict.fromkeys([*spec.required, *spec.keys])]
        staged = scratch_path(spark, "checked")
        with_reasons(text, spec.ddl, required).observe(
            seen, F.count_if(F.size("_reasons") > 0).alias("refused")
        ).write.parquet(staged)
        checked = split_checked(spark.read.parquet(staged), spec.ddl)
        rows, refused = checked.good, checked.bad
    try:
        clean = with_lineage(latest_snapshot(rows, spec.keys), run_ts)
        current = read_table(spark, target) if since and versions(spark, target) else None
        counts = write_table(merged(current, clean, spec.keys), target, publish=publish)
        n_refused = seen.get["refused"]
        if n_refused or quarantine is not None:
            write_table(refused, refused_to)
            drop_old_versions(spark, refused_to)
        return {**counts, "refused": n_refused}
    finally:
        if staged:
            delete_folder(spark, staged)
