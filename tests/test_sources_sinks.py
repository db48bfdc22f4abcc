"""Files in and out: pinned CSV, snapshots, versions, partitions, exports and layout."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakemart.plans.silver import latest_snapshot, read_checked, split_bad_rows
from lakemart.schemas import SILVER, TableSpec
from lakemart.sinks.bronze import land_csv, land_jsonl
from lakemart.session import frame_bytes
from lakemart.sinks.layout import zorder
from lakemart.sinks.tables import export_csv, to_json_rows, write_partitioned, write_table
from lakemart.sources.files import (
    file_inventory,
    read_catalogue,
    read_csv,
    read_csv_text,
    read_snapshots,
    read_translation,
)
from lakemart.sources.tables import drop_old_versions, partition_folders, read_partitioned, read_table, versions

DDL = "id string, n int, price double"
SPEC = TableSpec("t", DDL, ("id",), ("id",), False)


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


# ---- CSV


def test_byte_order_mark_is_skipped(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        "product_category_name,product_category_name_english\nmusica,music\n",
        "utf-8-sig",
    )
    assert [tuple(r) for r in read_translation(spark, path).collect()] == [("musica", "music")]


def test_multi_line_cells_and_doubled_quotes(spark, tmp_path):
    path = write(tmp_path / "r.csv", 'id,text\n1,"two\nlines, ""quoted"""\n2,plain\n')
    got = read_csv(spark, path, "id int, text string", multi_line=True).orderBy("id").collect()
    assert [r.text for r in got] == ['two\nlines, "quoted"', "plain"]


def test_cell_that_does_not_fit_becomes_null(spark, tmp_path):
    path = write(tmp_path / "t.csv", "id,n,price\na,x,1.5\nb,2,\n")
    got = sorted(tuple(r) for r in read_csv(spark, path, DDL).collect())
    assert got == [("a", None, 1.5), ("b", 2, None)]


def test_swapped_columns_are_refused(spark, tmp_path):
    path = write(tmp_path / "t.csv", "n,id,price\n1,a,1.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, DDL).collect()


def test_snapshots_and_pruning(spark, tmp_path, frame, plan_of):
    root = str(tmp_path)
    land_csv(frame(DDL, ("a", 1, 1.0), ("b", 1, 1.0)), root, "t", "2024-01-01")
    land_csv(frame(DDL, ("a", 2, 2.0)), root, "t", "2024-01-02")
    both = read_snapshots(spark, f"{root}/t", DDL)
    assert both.count() == 3
    late = read_snapshots(spark, f"{root}/t", DDL, since="2024-01-02")
    assert [(r.id, r.n, r.ingest_date) for r in late.collect()] == [("a", 2, date(2024, 1, 2))]
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_of(late)
    latest = latest_snapshot(both, ["id"])
    assert sorted(tuple(r) for r in latest.collect()) == [("a", 2, 2.0), ("b", 1, 1.0)]


def test_landing_a_day_again_replaces_that_day(spark, tmp_path, frame):
    root = str(tmp_path)
    for rows in ([("a", 1, 1.0), ("b", 1, 1.0)], [("c", 1, 1.0)]):
        land_csv(frame(DDL, *rows), root, "t", "2024-01-01")
    assert [r.id for r in read_snapshots(spark, f"{root}/t", DDL).collect()] == ["c"]


def test_file_inventory_never_reads_contents(spark, tmp_path, plan_of):
    write(tmp_path / "a" / "x.csv", "id\n1\n")
    write(tmp_path / "b" / "y.csv", "id\n")
    write(tmp_path / "b" / "empty.csv", "")
    write(tmp_path / "b" / "z.json", "{}")
    found = file_inventory(spark, str(tmp_path))
    assert sorted((os.path.basename(r.path), r.length) for r in found.collect()) == [
        ("x.csv", 5),
        ("y.csv", 3),
    ]
    assert "content" not in plan_of(found).split("ReadSchema")[1]


# ---- quarantine

BAD = "id,n,price\na,1,1.5\nb,x,1.5\n,3,2.0\nd,4\ne,5,1.0,extra\nf,,\n"


def test_bad_rows_are_diverted_with_reasons(spark, tmp_path):
    path = write(tmp_path / "t.csv", BAD)
    checked = split_bad_rows(read_csv_text(spark, path, DDL), DDL, ["id"])
    assert sorted(tuple(r) for r in checked.good.collect()) == [("a", 1, 1.5), ("f", None, None)]
    reasons = {r["id"]: r["_reasons"] for r in checked.bad.collect()}
    assert reasons == {
        "b": ["bad n"],
        None: ["missing id"],
        "d": ["malformed line"],
        "e": ["malformed line"],
    }
    assert checked.bad.select("id").count() == 4, "the verdict does not depend on the columns read"


def test_checked_snapshots_keep_their_ingest_date(spark, tmp_path):
    write(tmp_path / "t" / "ingest_date=2024-01-01" / "p.csv", BAD)
    checked = read_checked(spark, str(tmp_path / "t"), SPEC)
    assert dict(checked.good.dtypes)["ingest_date"] == "date"
    assert checked.good.count() == 2
    assert read_checked(spark, str(tmp_path / "t"), SPEC, since="2024-01-02").good.count() == 0


def test_pinned_schemas_cover_keys_and_required_columns():
    for spec in SILVER.values():
        assert set(spec.keys) <= set(spec.required) <= set(spec.columns)


# ---- written tables


def test_overwrite_replaces_rows_and_schema(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    assert write_table(frame(DDL, ("a", 1, 1.0)), path) == {"rows": 1}
    counts = write_table(
        frame("id string, extra boolean", ("b", True), ("c", None)),
        path,
        metrics={"extras": F.count("extra")},
    )
    assert counts == {"rows": 2, "extras": 1}
    assert read_table(spark, path).columns == ["id", "extra"]
    assert len(versions(spark, path)) == 2


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    write_table(frame(DDL, ("a", 1, 1.0)), path)
    write_table(read_table(spark, path).withColumn("n", F.col("n") + 1), path)
    assert read_table(spark, path).first()["n"] == 2


def test_old_versions_are_dropped_on_request(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        write_table(frame(DDL, ("a", n, 1.0)), path)
    before = versions(spark, path)
    assert drop_old_versions(spark, path, keep=2) == before[:1]
    assert versions(spark, path) == before[1:]
    assert read_table(spark, path).first()["n"] == 3
    with pytest.raises(ValueError):
        drop_old_versions(spark, path, keep=0)


def test_unfinished_version_is_invisible(spark, tmp_path, frame):
    path = tmp_path / "t"
    write_table(frame(DDL, ("a", 1, 1.0)), str(path))
    (path / "version=99999999T000000000000").mkdir()
    assert read_table(spark, str(path)).count() == 1
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("zorder_by", [(), ("id",)])
def test_partitioned_write_keeps_null_and_replaces_only_its_days(spark, tmp_path, frame, zorder_by):
    path, ddl = str(tmp_path / "t"), "id string, day date"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    write_partitioned(frame(ddl, ("a", d1), ("b", d2), ("c", None)), path, "day", zorder_by)
    write_partitioned(frame(ddl, ("b2", d2)), path, "day", zorder_by)
    got = sorted((r.id, r.day) for r in read_partitioned(spark, path, ddl).collect())
    assert got == [("a", d1), ("b2", d2), ("c", None)]


def test_columns_made_after_rows_are_placed(spark, tmp_path, frame):
    path, ddl = str(tmp_path / "t"), "id string, n int, day date"
    df = frame(ddl, ("a", 1, date(2024, 1, 1)), ("b", 2, None))
    write_partitioned(df, path, "day", finish=lambda placed: placed.select("id", (F.col("n") * 2).alias("twice"), "day"))
    assert sorted((r.id, r.twice, r.day) for r in spark.read.parquet(path).collect()) == [("a", 2, date(2024, 1, 1)), ("b", 4, None)]
    assert partition_folders(spark, path, "day") == {"day=2024-01-01", "day=__HIVE_DEFAULT_PARTITION__"}
    assert partition_folders(spark, f"{path}-none", "day") == set()


def test_hot_day_is_split_when_partitioning(spark, tmp_path, set_conf):
    set_conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB")
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date")
    df = spark.range(0, 40000, 1, 4).select("id", F.xxhash64("id").alias("v"), day.alias("day"))
    path = str(tmp_path / "t")
    write_partitioned(df, path, "day")
    files = [f for f in os.listdir(f"{path}/day=2024-01-02") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(path).count() == 40000


def test_json_rows_keep_missing_values(frame):
    df = frame("state string, revenue double, share double, n bigint", ("SP", 12345678.9, 0.125, None))
    got = to_json_rows(df, ["revenue"]).first()["json"]
    assert got == '{"state":"SP","revenue":12345678.90,"share":0.125,"n":null}'


def test_export_flattens_tags(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    export_csv(frame("id string, tags array<string>", ("a", ["x", "y"])), path)
    assert read_csv(spark, path, "id string, tags string").first()["tags"] == "x,y"


def test_catalogue_snapshot_is_sorted_lines(spark, tmp_path, frame):
    df = frame(
        "product_id string, category_pt string, category_en string, tags array<string>, margin_pct double",
        ("b", "", "unknown", ["general"], 0.1),
        ("a", "x", "toys", ["kids", "giftable"], None),
    )
    path = land_jsonl(df, str(tmp_path), "c", "product_id", "2024-01-01")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0].startswith('{"product_id":"a"') and '"margin_pct":null' in lines[0]
    assert read_catalogue(spark, path).columns == [
        "product_id",
        "product_category_en",
        "tags",
        "margin_pct",
    ]


# ---- layout


def test_zorder_keeps_every_row_and_narrows_files(spark, rows_of, tmp_path):
    df = spark.range(0, 20000, 1, 4).select(
        F.format_string("c%05d", F.pmod(F.xxhash64("id"), F.lit(5000))).alias("c"),
        F.format_string("p%05d", F.pmod(F.xxhash64(-F.col("id")), F.lit(5000))).alias("p"),
        "id",
    )
    ordered = zorder(df, ["c", "p"], files=16)
    assert ordered.columns == df.columns
    assert ordered.exceptAll(df).count() == 0 and ordered.count() == 20000
    path = str(tmp_path / "z")
    ordered.write.parquet(path)
    per_file = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("p").alias("p0"), F.max("p").alias("p1"))
    )

    def hits(column, value):
        return per_file.where(f"{column}0 <= '{value}' and '{value}' <= {column}1").count()

    files = per_file.count()
    assert hits("c", "c02500") <= files * 0.6 and hits("p", "p02500") <= files * 0.6


def test_zorder_tells_long_common_prefixes_apart(spark, tmp_path):
    df = spark.range(0, 20000, 1, 4).select(
        F.format_string("customer-number-%09d", F.pmod(F.xxhash64("id"), F.lit(5000))).alias("c"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64(-F.col("id")), F.lit(3000)).cast("int")).alias("d"),
        F.col("id").cast("timestamp").cast("timestamp_ntz").alias("t"),
        (F.col("id") % 2 == 0).alias("even"),
    )
    path = str(tmp_path / "z")
    zorder(df, ["c", "d"], files=16, bits=4).write.parquet(path)
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("d").alias("d0"), F.max("d").alias("d1"))
    )
    assert files.where("'customer-number-000002500' between c0 and c1").count() <= 10
    assert files.where("date '2024-02-09' between d0 and d1").count() <= 10
    assert zorder(df, ["t", "even"], files=4).count() == 20000
    with pytest.raises(ValueError):
        zorder(df, ["c", "d"], bits=32)


def test_swapped_header_fails_both_reads(spark, tmp_path):
    (tmp_path / "x.csv").write_text("v,id\n1,a\n")
    for read in (read_csv, read_csv_text):
        with pytest.raises(Exception, match="(?i)header"):
            read(spark, str(tmp_path / "x.csv"), DDL).collect()


def test_zorder_spreads_rows_with_equal_columns(spark):
    df = spark.range(0, 8000, 1, 4).select(F.lit("one").alias("c"), F.lit(1).alias("p"), "id")
    spread = zorder(df, ["c", "p"], files=8)
    assert spread.groupBy(F.spark_partition_id()).count().count() == 8


def test_zorder_keeps_null_keys(spark, frame):
    df = frame("c string, p int", ("a", 1), (None, 2), ("b", None), (None, None))
    assert zorder(df, ["c", "p"]).count() == 4


def test_zorder_cuts_large_tables_into_more_ranges_than_configured(spark, tmp_path, monkeypatch):
    spark.range(0, 20000, 1, 4).select("id", F.xxhash64("id").alias("c"), F.lit(1).alias("p")).write.parquet(str(tmp_path / "a b"))
    df = spark.read.parquet(str(tmp_path / "a b"))
    size = sum(f.stat().st_size for f in (tmp_path / "a b").glob("*.parquet"))
    assert frame_bytes(df) == size
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr("lakemart.sinks.layout.BYTES_PER_RANGE", -(-size // (configured + 5)))
    large = zorder(df, ["c", "p"])
    assert large.rdd.getNumPartitions() == configured + 5
    assert large.exceptAll(df).count() == 0 and large.count() == 20000
    shuffled = large._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]
    assert "_row" not in shuffled
    monkeypatch.undo()
    assert zorder(df, ["c", "p"]).rdd.getNumPartitions() <= configured
