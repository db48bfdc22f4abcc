"""Daily jobs around the star schema: landing, the catalogue, reloading changed days, exports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakemart.operators.quality import enforce, gate_unique
from lakemart.operators.upsert import differs, pair_by_key
from lakemart.plans.jobs import write_all
from lakemart.plans.silver import INGEST_DATE
from lakemart.schemas import CATALOGUE_DDL, TableSpec
from lakemart.session import scratch_path
from lakemart.sinks.bronze import land_csv, land_jsonl
from lakemart.sinks.buckets import BUCKETS, merge_batch, read_buckets, read_parts
from lakemart.sinks.tables import export_csv, write_table
from lakemart.sources.files import file_inventory
from lakemart.sources.ledger import day_changes, day_folders, file_states
from lakemart.sources.tables import delete_folder, drop_old_versions, read_table, versions
from lakemart.streaming.silver import stored_ddl


_STORED_CATALOGUE = f"{CATALOGUE_DDL}, _batch long"


def land_tables(tables: Mapping[str, DataFrame], root: str, day: str | None = None) -> dict[str, dict[str, int]]:
    """Land every table as CSV under one ingest date, a few at a time; returns the rows of each.

    Rows are counted while they are written. A rerun replaces that day only.
    """

    def land(name: str, df: DataFrame) -> dict[str, int]:
        seen = Observation()
        land_csv(df.observe(seen, F.count(F.lit(1)).alias("rows")), root, name, day)
        return seen.get

    return write_all({name: partial(land, name, df) for name, df in tables.items()})


def export_star(spark: SparkSession, star: Mapping[str, DataFrame], root: str) -> dict[str, dict[str, int]]:
    """Export the tables of the star schema as headered CSV, a few at a time; returns files and bytes of each."""

    def export(name: str, df: DataFrame) -> dict[str, int]:
        export_csv(df, f"{root}/{name}")
        files = file_inventory(spark, f"{root}/{name}").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        return files.first().asDict()

    return write_all({name: partial(export, name, df) for name, df in star.items()})


def refresh_catalogue(
    spark: SparkSession, documents: DataFrame, target: str, day: str, snapshots: str | None = None, buckets: int = BUCKETS
) -> dict[str, int]:
    """Bring the stored catalogue up to date with today's documents and return inserted, modified and total.

    Today's documents are paired with the stored ones once. Those that differ are written to the feed with what they were
    before, and merged into the buckets they belong to; the counts come from the same pass. Documents that are equal
    are not written, so a second run of one snapshot writes nothing. Two documents of one product fail the run
    before anything changes. ``snapshots`` also lands the documents as JSON lines of that day.
    """
    enforce(gate_unique(documents, ["product_id"]), "catalogue: product_id repeats")
    stored = catalogue_rows(spark, target)
    columns = [c for c in stored.columns if c != "product_id"]
    pairs = pair_by_key(stored, documents.select(*stored.columns), ["product_id"])
    kind = F.when(F.col("old").isNull(), "inserted").when(
        F.col("new").isNotNull() & differs("old", "new", columns), "modified"
    )
    seen, staged = Observation(), scratch_path(spark, "catalogue-feed")
    judged = pairs.withColumn("change", kind).observe(
        seen,
        F.count_if(F.col("change") == "inserted").alias("inserted"),
        F.count_if(F.col("change") == "modified").alias("modified"),
        F.count(F.lit(1)).alias("total"),
    )
    judged.where("change is not null").select("product_id", "change", "old", "new").write.parquet(staged)
    try:
        counts = seen.get
        if counts["inserted"] + counts["modified"]:
            parts = read_parts(spark, f"{target}/rows")
            batch = parts.batch + 1 if parts else 0
            feed = spark.read.parquet(staged)
            feed.withColumn("day", F.lit(day).cast("date")).write.mode("overwrite").parquet(f"{target}/feed/batch={batch}")
            changed = feed.select("new.*")
            # The last run counts, also where an earlier run of the same day wrote a document.
            versioned = changed.withColumn("_batch", F.lit(batch).cast("long"))
            merge_batch(spark, f"{target}/rows", versioned, _STORED_CATALOGUE, ["product_id"], ["_batch"], batch, buckets)
    finally:
        delete_folder(spark, staged)
    if snapshots is not None:
        land_jsonl(documents, snapshots, "product_catalogue", "product_id", day)
    return counts


def catalogue_rows(spark: SparkSession, target: str) -> DataFrame:
    """The stored catalogue."""
    return read_buckets(spark, f"{target}/rows", CATALOGUE_DDL)


def catalogue_feed(spark: SparkSession, target: str) -> DataFrame:
    """Every change so far: batch, day, product_id, change, and the document before (old) and after (new)."""
    parts = read_parts(spark, f"{target}/rows")
    document = f"struct<{', '.join(f.replace(' ', ': ', 1) for f in CATALOGUE_DDL.split(', '))}>"
    schema = f"product_id string, change string, old {document}, new {document}, day date, batch long"
    if parts is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{target}/feed").where(F.col("batch") <= parts.batch)


def reload_changed_days(
    spark: SparkSession, spec: TableSpec, bronze: str, silver: str, buckets: int = BUCKETS
) -> dict[str, list[str]]:
    """Load the days of a table whose files changed since the last run; returns the days by kind of change.

    The states of the files that were loaded are kept beside the table. Only folders of changed days are read. Rows that
    came from a replaced or vanished day leave the table; where their keys do not come again, the newest
    row of an earlier day takes their place, and for those keys alone the other days are read. The states are
    published last, so a run that died finds the same days again.
    """
    root, target, ledger = f"{bronze}/{spec.name}", f"{silver}/{spec.name}", f"{silver}/_ledger/{spec.name}"
    now = scratch_path(spark, "states")
    file_states(spark, root).write.parquet(now)
    states = spark.read.parquet(now)
    loaded = read_table(spark, ledger) if versions(spark, ledger) else states.limit(0)
    changes = {r[INGEST_DATE]: r.change for r in day_changes(loaded, states).collect()}  # days of the calendar
    by_kind = {k: sorted(str(d) for d, c in changes.items() if c == k) for k in ("new", "replaced", "vanished")}
    if changes:
        arrived, stored = _day_rows(spark, spec, root, by_kind["new"] + by_kind["replaced"]), None
        stale = by_kind["replaced"] + by_kind["vanished"]
        if stale:
            stored = F.col(INGEST_DATE).isin([F.lit(d).cast("date") for d in stale])
            ddl = stored_ddl(spec.ddl)
            lost = read_buckets(spark, target, ddl).where(stored).select(*spec.keys)
            orphans = lost.join(arrived.select(*spec.keys), list(spec.keys), "left_anti")
            if not orphans.isEmpty():
                every = {r[0] for r in states.select(F.regexp_extract("path", rf"{INGEST_DATE}=([^/]+)", 1)).distinct().collect()}
                others = sorted(every - set(by_kind["new"] + by_kind["replaced"]))
                older = _day_rows(spark, spec, root, others).join(orphans, list(spec.keys), "left_semi")
                arrived = arrived.unionByName(older.select(*arrived.columns))
        parts = read_parts(spark, target)
        batch = parts.batch + 1 if parts else 0
        merge_batch(spark, target, arrived, stored_ddl(spec.ddl), spec.keys, [INGEST_DATE], batch, buckets, stored)
        write_table(states.coalesce(1), ledger)
        drop_old_versions(spark, ledger)
    delete_folder(spark, now)
    return by_kind


def _day_rows(spark: SparkSession, spec: TableSpec, root: str, days: list[str]) -> DataFrame:
    """The rows of some days that have their whole key, with the day; other folders are not touched."""
    ddl = stored_ddl(spec.ddl)
    if not days:
        return spark.createDataFrame([], ddl)
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": spec.multi_line, "enforceSchema": False}
    rows = spark.read.schema(ddl).options(basePath=root, **options).csv(day_folders(root, days))
    for key in spec.keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows
