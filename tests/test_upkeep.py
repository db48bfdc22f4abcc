"""Tables and figures kept up to date by what changed."""

import glob
import os
from datetime import date, datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from lakemart.operators.quality import gate_output, in_files, in_partitions, out_of_order
from lakemart.operators.running import numbered, running_totals
from lakemart.operators.scd2 import OBSERVED, first_observed, scd2_merge, scd2_splice, with_validity
from lakemart.operators.quality import GateError
from lakemart.plans import daily_state, fact_increment, gold, upkeep
from lakemart.plans.fact_increment import read_fact, refresh_fact, unit_for
from lakemart.plans.silver import latest_snapshot, read_checked
from lakemart.schemas import CATALOGUE_DDL, TableSpec
from lakemart.session import scratch_path, scratch_scope
from lakemart.sinks.bronze import land_csv
from lakemart.sinks.buckets import merge_batch, read_buckets, read_parts
from lakemart.sinks.tables import write_table
from lakemart.sinks.recluster import file_ranges, overlap_depth, recluster_worst
from lakemart.sources.tables import drop_old_versions, path_exists, read_partitioned
from lakemart.streaming import silver
from lakemart.streaming.incremental import current_rows, ingest_incremental
from lakemart.streaming.silver import cleaned_rows, ingest_to_silver, refused_rows

KEY, TRACKED = ["product_id"], ["category"]


# ---- late versions


def versions_of(days):
    """key: versions (value, from, to), from observations {day: {key: value}}."""
    found = {}
    for key in {k for rows in days.values() for k in rows}:
        seen = [(d, rows[key]) for d, rows in sorted(days.items()) if key in rows]
        runs = [s for i, s in enumerate(seen) if i == 0 or s[1] != seen[i - 1][1]]
        starts = [date(1900, 1, 1), *[d for d, _ in runs[1:]]]
        found[key] = [(v, a, b) for (_, v), a, b in zip(runs, starts, [*starts[1:], None])]
    return found


DAYS = {
    date(2024, 1, 1): {"same": "a", "moved": "a", "back": "a", "gone": None},
    date(2024, 1, 2): {"same": "a", "moved": "b", "back": "b", "new": "x", "late": "l"},
    date(2024, 1, 3): {"same": "a", "moved": "b", "back": "a", "new": "y", "gone": None},
}


def stored(df):
    """The rows as a table, as between two runs."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("order", list(permutations(sorted(DAYS))))
def test_any_order_of_days_gives_one_history(frame, order):
    ddl = "product_id string, category string"
    history = None
    for day in order:
        rows = frame(ddl, *DAYS[day].items())
        folded = first_observed(rows, str(day)) if history is None else scd2_splice(history, rows, KEY, TRACKED, str(day))
        history = stored(folded)
    again = scd2_splice(history, frame(ddl, *DAYS[order[0]].items()), KEY, TRACKED, str(order[0]))
    for result in (history, again):
        got = {}
        for r in sorted(result.collect(), key=lambda r: r.effective_from):
            got.setdefault(r.product_id, []).append((r.category, r.effective_from, r.effective_to))
            assert r.is_current == (r.effective_to is None) and r[OBSERVED] == sorted(r[OBSERVED])
        assert got == versions_of(DAYS)


def test_a_day_corrected(frame):
    ddl = "product_id string, category string"
    history = first_observed(frame(ddl, ("p", "a")), "2024-01-01")
    for day, value in (("2024-01-02", "b"), ("2024-01-03", "a"), ("2024-01-02", "a")):
        history = stored(scd2_splice(history, frame(ddl, ("p", value)), KEY, TRACKED, day))
    (only,) = history.collect()  # the correction joins the versions on both sides of it
    assert only.is_current and only.effective_from == date(1900, 1, 1) and len(only[OBSERVED]) == 3


def test_merge_refuses_an_older_change(frame):
    ddl = "product_id string, category string"
    history = with_validity(frame(ddl, ("p", "newer"), ("q", "same")), "2024-01-05")
    with pytest.raises(Exception, match="older than the current version"):
        scd2_merge(history, frame(ddl, ("p", "late")), KEY, TRACKED, "2024-01-03").collect()
    assert scd2_merge(history, frame(ddl, ("q", "same")), KEY, TRACKED, "2024-01-03").count() == 2


# ---- bucketed tables and the stream into them

SPEC = TableSpec("things", "id string, n int, at timestamp_ntz", ("id",), ("id", "n"), False)
DDL = silver.stored_ddl(SPEC.ddl)


def files_of(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/data/*/*/*.parquet")}


def land_days(spark, root):
    """Three days: an update, an older day that comes last within its run, rows that do not fit."""
    text = "id string, n string, at string"
    days = {
        "2024-01-01": [(f"k{i}", str(i), "2024-01-01 00:00:00") for i in range(40)],
        "2024-01-02": [("k1", "100", "2024-01-02 01:00:00"), ("k1", "100", "2024-01-02 01:00:00"), ("k2", "bad", None), (None, "5", None)],
        "2024-01-03": [("k1", "7", "never"), ("k3", "300", None), ("new", "1", None), ("k4", None, None)],
    }
    for day, rows in days.items():
        yield day, land_csv(spark.createDataFrame(rows, text), root, "things", day)


def test_days_streamed_equal_a_rebuild(spark, tmp_path, rows_of):
    root, target = str(tmp_path / "bronze"), str(tmp_path / "silver")
    before = None
    for day, source in land_days(spark, root):
        ingest_to_silver(spark, source, SPEC.ddl, SPEC.keys, SPEC.required, target, str(tmp_path / "progress"), buckets=8)
        checked = read_checked(spark, f"{root}/things", SPEC)
        assert rows_of(cleaned_rows(spark, target, SPEC.ddl)) == rows_of(latest_snapshot(checked.good, SPEC.keys))
        got = refused_rows(spark, target, SPEC.ddl)
        assert rows_of(got.select("id", "n", "_reasons")) == rows_of(checked.bad.select("id", "n", "_reasons"))
        now = read_parts(spark, target)
        if before is not None:
            stayed = {b for b, f in now.folders.items() if before.folders.get(b) == f}
            assert stayed and len(stayed) < len(before.folders)  # untouched buckets keep their files
        before = now
    assert got.count() == 4 and before.buckets == 8
    # Nothing new: the table and its files stay.
    kept = files_of(target)
    ingest_to_silver(spark, source, SPEC.ddl, SPEC.keys, SPEC.required, target, str(tmp_path / "progress"), buckets=8)
    assert files_of(target) == kept


@pytest.mark.parametrize("step", ["refused", "merged"])
def test_a_killed_batch_is_neither_lost_nor_repeated(spark, tmp_path, rows_of, monkeypatch, step):
    """Killed between the writes, or before they are published; then the batch comes again."""
    target = str(tmp_path / "t")
    text = "id string, n string, at string, _corrupt_record string, ingest_date date"
    first = spark.createDataFrame([("a", "1", None, None, date(2024, 1, 1)), ("b", "x", None, None, date(2024, 1, 1))], text)
    second = spark.createDataFrame([("a", "2", None, None, date(2024, 1, 2)), ("c", "y", None, None, date(2024, 1, 2))], text)

    def store(batch, number):
        silver.store_batch(batch, number, SPEC.ddl, SPEC.keys, SPEC.required, target, 4)

    store(first, 0)
    seen = rows_of(cleaned_rows(spark, target, SPEC.ddl)), rows_of(refused_rows(spark, target, SPEC.ddl))

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "refused":
            patch.setattr(silver, "merge_batch", killed)
        else:
            patch.setattr("lakemart.sinks.buckets.write_table", killed)
        with pytest.raises(KeyboardInterrupt):
            store(second, 1)
    assert (rows_of(cleaned_rows(spark, target, SPEC.ddl)), rows_of(refused_rows(spark, target, SPEC.ddl))) == seen
    for _ in range(2):
        store(second, 1)
        assert [tuple(r)[:2] for r in cleaned_rows(spark, target, SPEC.ddl).collect()] == [("a", 2)]
        assert sorted(r.id for r in refused_rows(spark, target, SPEC.ddl).collect()) == ["b", "c"]


def test_merge_touches_its_buckets_only(spark, tmp_path, frame, rows_of):
    path, day = str(tmp_path / "t"), date(2024, 1, 1)
    rows = lambda *ids, n=0, day=day: frame(DDL, *((i, n, None, day) for i in ids))
    every = [f"k{i}" for i in range(64)]
    assert len(merge_batch(spark, path, rows(*every), DDL, ["id"], ["ingest_date"], 0, 8)) == 8
    before = files_of(path)
    touched = merge_batch(spark, path, rows("k5", n=9, day=date(2024, 1, 2)), DDL, ["id"], ["ingest_date"], 1)
    assert len(touched) == 1 and len(before & files_of(path)) == len(before)  # the version before stays readable
    assert merge_batch(spark, path, rows("k6", n=9, day=date(2024, 1, 2)), DDL, ["id"], ["ingest_date"], 1) == []
    # An older day does not undo a newer one.
    merge_batch(spark, path, rows("k5", n=1), DDL, ["id"], ["ingest_date"], 2)
    got = {r.id: r.n for r in read_buckets(spark, path, DDL).collect()}
    assert got == {i: 9 if i == "k5" else 0 for i in every}
    assert merge_batch(spark, path, rows(), DDL, ["id"], ["ingest_date"], 3) == [] and read_parts(spark, path).batch == 3
    assert all(str(k) in f for k, f in read_parts(spark, path).folders.items())
    assert read_buckets(spark, str(tmp_path / "none"), DDL).count() == 0


# ---- the fact by changed periods


@pytest.fixture
def retail(frame):
    at = lambda d, h=0: datetime(2024, d[0], d[1], h)

    def make(late=False):
        orders = [("o1", "c1", "new", at((1, 1)), None), ("o2", "c1", "new", at((1, 2)), None), ("o3", "c2", "new", at((2, 3)), None), ("o4", "c3", "new", None, None), ("o5", "c3", "new", at((3, 1)), None)]
        items = [(o, 1, "p", "s", 10.0, 1.0) for o in ("o1", "o2", "o3", "o4", "o5", "none")]
        payments = [("o1", 1, 11.0), ("o3", 1, 11.0)]
        reviews = [("r1", "o1", 5, at((1, 9)))]
        if late:
            orders[1] = ("o2", "c1", "done", at((1, 2)), at((1, 5)))
            orders[4] = ("o5", "c3", "new", at((1, 1)), None)  # moved: its day is left without lines
            items.append(("o4", 2, "p", "s", 5.0, 0.0))
            payments.append(("o2", 1, 11.0))
            reviews.append(("r2", "o1", 1, at((1, 10))))
        return {
            "orders": frame("order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz", *orders),
            "order_items": frame("order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double", *items),
            "payments": frame("order_id string, payment_sequential int, payment_value double", *payments),
            "reviews": frame("review_id string, order_id string, review_score int, review_creation_date timestamp_ntz", *reviews),
        }

    return make


@pytest.mark.parametrize("unit", ["day", "month"])
def test_changed_periods_equal_a_rebuild(spark, retail, tmp_path, rows_of, unit):
    target = str(tmp_path / "gold")
    files = lambda: set(glob.glob(f"{target}/fact_sales/*/*.parquet"))
    first, second = retail(), retail(late=True)
    refresh_fact(spark, first, target, unit)
    before = files()
    assert refresh_fact(spark, first, target, unit) == {"rewritten": 0, "emptied": 0} and files() == before
    counts = refresh_fact(spark, second, target, unit)
    assert counts == ({"rewritten": 3, "emptied": 1} if unit == "day" else {"rewritten": 2, "emptied": 1})
    want = gold.fact_sales(*(second[n] for n in ("order_items", "orders", "payments", "reviews")))
    assert rows_of(read_fact(spark, second, target)) == rows_of(want)
    kept = {f for f in before if "2024-02" in f}
    assert kept and kept <= files() and not any("2024-03" in f for f in files())


def test_lines_are_written_once(spark, retail, tmp_path, monkeypatch):
    """No copy of the lines beside the fact; where all periods changed, no table is sent around to pick their lines."""
    made, picked = [], []
    monkeypatch.setattr(fact_increment, "scratch_path", lambda s, label: made.append(label) or f"{tmp_path}/{label}-{len(made)}")
    monkeypatch.setattr(fact_increment, "fact_of_periods", lambda *a: picked.append(a))
    target, first, second = str(tmp_path / "gold"), retail(), retail()
    second["orders"] = second["orders"].withColumn("customer_id", F.lit("c9"))
    assert refresh_fact(spark, first, target, "month") == {"rewritten": 4, "emptied": 0}
    assert refresh_fact(spark, second, target, "month") == {"rewritten": 4, "emptied": 0}
    assert "lines" not in made and not picked
    assert {r.customer_id for r in read_fact(spark, second, target).collect()} == {"c9"}


def test_tables_are_sent_around_once(spark, retail, tmp_path, monkeypatch, set_conf):
    """Digests and lines come from the same shuffles; an order's row and its total lie where its items are sent."""
    set_conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    plans, target = [], str(tmp_path / "gold")
    write = fact_increment.write_partitioned

    def noted(rows, *a, **k):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *a, **k)

    refresh_fact(spark, retail(), target, "month")
    monkeypatch.setattr(fact_increment, "write_partitioned", noted)
    assert refresh_fact(spark, retail(late=True), target, "month") == {"rewritten": 2, "emptied": 1}
    placed = [line for line in plans[0].splitlines() if "REPARTITION_BY_COL" in line]
    assert sorted("ReusedExchange" in line for line in placed) == [False, True]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_periods_that_only_lost_lines(spark, retail, tmp_path, rows_of, unit):
    """Nothing is left to write, and the folders of such periods go all the same."""
    target, first = str(tmp_path / "gold"), retail()
    refresh_fact(spark, first, target, unit)
    fewer = {**first, "order_items": first["order_items"].where("order_id not in ('o3', 'o4')")}
    assert refresh_fact(spark, fewer, target, unit) == {"rewritten": 0, "emptied": 2}
    want = gold.fact_sales(*(fewer[n] for n in ("order_items", "orders", "payments", "reviews")))
    assert rows_of(read_fact(spark, fewer, target)) == rows_of(want)
    none = {**first, "order_items": first["order_items"].where("false")}
    counts = refresh_fact(spark, none, target, unit)
    assert counts == {"rewritten": 0, "emptied": 3 if unit == "day" else 2}
    assert refresh_fact(spark, first, target, unit) == {"rewritten": 5 if unit == "day" else 4, "emptied": 0}
    assert rows_of(read_fact(spark, first, target)) == rows_of(gold.fact_sales(*(first[n] for n in ("order_items", "orders", "payments", "reviews"))))


def test_orders_with_several_days(spark, retail, tmp_path, rows_of):
    """Rows of one order on several days, or without one: a change of it reaches the lines of all of them."""
    target, first = str(tmp_path / "gold"), retail()
    more = first["orders"].where("order_id = 'o1'").drop("order_purchase_timestamp")
    for month in ("2024-03-05", "2024-05-05", None):
        again = more.withColumn("order_purchase_timestamp", F.lit(month).cast("timestamp_ntz"))
        first["orders"] = first["orders"].unionByName(again)
    refresh_fact(spark, first, target, "month")
    second = {**first, "reviews": first["reviews"].withColumn("review_score", F.lit(2))}
    refresh_fact(spark, second, target, "month")
    want = gold.fact_sales(*(second[n] for n in ("order_items", "orders", "payments", "reviews")))
    assert rows_of(read_fact(spark, second, target)) == rows_of(want)


def test_unit_of_periods():
    assert unit_for(10**12, 1000) == "day" and unit_for(10**9, 1000) == "month" and unit_for(0, 0) == "month"


# ---- figures from the state of days


def test_numbers_follow_the_days(frame, rows_of):
    """Keys of a day have neighbouring numbers, so a day's bitmaps are few; bits meet before bitmaps are made."""
    keys = frame("order_id string, order_date int", ("a", 3), ("b", 1), ("c", 2), ("b", 5), (None, 1), ("d", None))
    ids = daily_state.dense_ids(keys)
    assert rows_of(ids) == rows_of(frame("order_id string, id long", ("d", 1), ("b", 2), ("c", 3), ("a", 4)))
    more = daily_state.dense_ids(frame("order_id string, order_date int", ("f", 9), ("g", 8), ("a", 1)), ids)
    assert {r.order_id: r.id for r in more.collect()} == {"d": 1, "b": 2, "c": 3, "a": 4, "g": 5, "f": 6}


def test_ids_stay_and_are_dense(frame):
    first = daily_state.dense_ids(frame("k string", ("b",), ("a",), ("b",), (None,)))
    assert {r.k: r.id for r in first.collect()} == {"a": 1, "b": 2}
    more = {r.k: r.id for r in daily_state.dense_ids(frame("k string", ("0",), ("b",), ("c",)), first).collect()}
    assert more == {"a": 1, "b": 2, "0": 3, "c": 4}


def test_state_of_days_merges_further(frame):
    fact = frame(
        "order_date date, order_id string, customer_id string, product_id string, seller_id string, gross_revenue double, review_score int, delivery_days long",
        *((date(2024, 1, 1 + i % 5), f"o{i}", f"c{i % 7}", f"p{i % 3}", "s", 1.25, i % 6 or None, i) for i in range(60)),
        (None, "x", "y", "z", "t", 9.0, 1, 1),
    )
    ids = {k: daily_state.dense_ids(fact.select(c)) for k, c in daily_state.COUNTED.items()}
    ids["orders"] = ids["orders"].withColumn("id", F.col("id") * 10_000)  # numbers of many stretches
    bitmaps, sums = daily_state.daily_bitmaps(fact, ids), daily_state.daily_sums(fact)
    for first, last in (("2024-01-01", "2024-01-05"), ("2024-01-02", "2024-01-02"), ("2023-01-01", "2023-12-31")):
        got = daily_state.kpis_between(bitmaps, sums, first, last).first()
        some = fact.where(F.col("order_date").between(first, last))
        want = some.agg(*[F.count_distinct(c) for c in daily_state.COUNTED.values()]).first()
        assert [got[k] for k in daily_state.COUNTED] == list(want)
        assert got.revenue == 1.25 * some.count()
    merged = daily_state.merge_days(bitmaps)
    assert merged.where("kind = 'customers'").agg(F.sum(F.bitmap_count("bitmap"))).first()[0] == 7


# ---- order of whole outputs


def test_one_swapped_pair_at_a_border_is_found(spark, tmp_path, frame):
    rows = [(i, str(i)) for i in range(40)]
    path = str(tmp_path / "sorted")
    for k, part in enumerate((rows[:10], rows[10:20], rows[20:40])):
        frame("n int, s string", *part).coalesce(1).write.mode("append").parquet(path)
    # Files have random names, so their order is checked by what they hold: rename them in order.
    names = sorted(glob.glob(f"{path}/*.parquet"), key=lambda f: spark.read.parquet(f).first().n)
    for k, name in enumerate(names):
        os.rename(name, f"{path}/p{k}.parquet")
    for crc in glob.glob(f"{path}/.*.crc"):
        os.remove(crc)
    order = [("n", False)]
    assert out_of_order(in_files(spark.read.parquet(path)), order).first().asDict() == {"observed": 0, "ok": True}
    os.rename(f"{path}/p0.parquet", f"{path}/q.parquet")
    assert out_of_order(in_files(spark.read.parquet(path)), order).first().observed == 1
    frames = spark.range(0, 100, 1, 4).withColumn("n", F.when(F.col("id") == 25, 24).when(F.col("id") == 24, 25).otherwise(F.col("id")))
    assert out_of_order(in_partitions(frames), order).first().observed == 1  # 24 and 25 stand in two partitions
    assert out_of_order(in_partitions(frames.where("id < 20")), order).first().ok


def test_order_with_ties_and_missing_values(frame):
    ddl, order = "a double, b string", [("a", True), ("b", False)]
    good = frame(ddl, (2.0, "x"), (1.0, "a"), (1.0, "b"), (1.0, "b"), (None, "a"), (None, None)).coalesce(1)
    bad = frame(ddl, (None, "a"), (2.0, "x")).coalesce(1)
    assert out_of_order(in_partitions(good), order).first().ok
    assert out_of_order(in_partitions(bad), order).first().observed == 1
    assert out_of_order(in_partitions(frame(ddl)), order).first().observed in (0, None)


def test_gate_output(frame):
    ranked = frame("category string, revenue double", ("b", 3.0), ("unknown", 2.0), ("a", 5.0)).coalesce(1)
    got = {r.check: r.ok for r in gate_output(ranked, "t", 3, [("revenue", True)], "category").collect()}
    assert got == {"t has 3 rows": True, "t is sorted": False, "t has no unknown category": False}


# ---- totals in two levels


def test_totals_over_many_groups_need_no_single_task(spark, plan_of):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 5).alias("v"))
    got = running_totals(df, [F.col("k").asc()], {"total": "v"})
    assert "SinglePartition" not in plan_of(got)
    last = got.agg(F.max("total"), F.count(F.lit(1)), F.max_by("total", "k")).first()
    assert tuple(last) == (2 * n, n, 2 * n)


def test_totals_skip_missing_values(frame):
    df = frame("k int, v long", (1, None), (2, 5), (3, None), (4, -2))
    assert [r.t for r in running_totals(df, [F.col("k").asc()], {"t": "v"}).orderBy("k").collect()] == [None, 5, 5, 3]
    assert running_totals(df.where("k > 9"), [F.col("k").asc()], {"t": "v"}).count() == 0
    assert [r.n for r in numbered(df, [F.col("k").desc()], "n").orderBy("k").collect()] == [4, 3, 2, 1]


# ---- the catalogue's feed, changed days, landing and export


def test_catalogue_applies_differences_only(spark, frame, tmp_path, rows_of):
    target = str(tmp_path / "catalogue")
    make = lambda *rows: frame(CATALOGUE_DDL, *((p, "", c, ["t"], m) for p, c, m in rows))
    first = make(*((f"p{i}", "a", 0.1) for i in range(30)))
    assert upkeep.refresh_catalogue(spark, first, target, "2024-01-01", buckets=8) == {"inserted": 30, "modified": 0, "total": 30}
    files = lambda: set(glob.glob(f"{target}/rows/data/*/*/*.parquet"))
    before = files()
    assert upkeep.refresh_catalogue(spark, first, target, "2024-01-02") == {"inserted": 0, "modified": 0, "total": 30}
    assert files() == before and len(glob.glob(f"{target}/feed/*")) == 1
    second = make(("p1", "b", 0.1), ("p2", "a", None), ("new", "c", 0.2))
    counts = upkeep.refresh_catalogue(spark, second, target, "2024-01-02", str(tmp_path / "bronze"))
    assert counts == {"inserted": 1, "modified": 2, "total": 31}
    got = {r.product_id: (r.category_en, r.margin_pct) for r in upkeep.catalogue_rows(spark, target).collect()}
    assert len(got) == 31 and got["p1"] == ("b", 0.1) and got["p2"] == ("a", None) and got["p3"] == ("a", 0.1)
    feed = upkeep.catalogue_feed(spark, target).where("batch = 1").orderBy("product_id").collect()
    assert [(r.product_id, r.change, r.old and r.old.category_en, r.new.category_en) for r in feed] == [
        ("new", "inserted", None, "c"), ("p1", "modified", "a", "b"), ("p2", "modified", "a", "a"),
    ]
    assert spark.read.json(str(tmp_path / "bronze" / "product_catalogue")).count() == 3
    with pytest.raises(GateError):
        upkeep.refresh_catalogue(spark, make(("x", "a", 0.1), ("x", "b", 0.1)), target, "2024-01-03")


def test_only_changed_days_are_read(spark, frame, tmp_path):
    bronze, lake = str(tmp_path / "bronze"), str(tmp_path / "silver")
    spec = TableSpec("things", "id string, n int", ("id",), ("id",), False)

    def land(day, *rows):
        land_csv(frame("id string, n int", *rows).coalesce(1), bronze, "things", day)

    def load():
        return upkeep.reload_changed_days(spark, spec, bronze, lake, buckets=4)

    def table():
        return {r.id: r.n for r in cleaned_rows(spark, f"{lake}/things", spec.ddl).collect()}

    land("2024-01-01", ("a", 1), ("b", 1), ("c", 1))
    land("2024-01-02", ("a", 2), ("b", 2), ("d", 2), (None, 9))
    assert load()["new"] == ["2024-01-01", "2024-01-02"] and table() == {"a": 2, "b": 2, "c": 1, "d": 2}
    assert load() == {"new": [], "replaced": [], "vanished": []}
    # An unchanged day is not read: its file may even be unreadable, as long as its state is the same.
    (old,) = glob.glob(f"{bronze}/things/ingest_date=2024-01-01/*.csv")
    stat, size = os.stat(old), os.path.getsize(old)
    with open(old, "r+b") as file:
        file.write(b"?" * size)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    land("2024-01-02", ("a", 20), ("b", 20), ("d", 20))
    assert load()["replaced"] == ["2024-01-02"] and table() == {"a": 20, "b": 20, "c": 1, "d": 20}
    land("2024-01-01", ("a", 1), ("b", 1), ("c", 1))
    assert load()["replaced"] == ["2024-01-01"]
    # Keys that a replaced day no longer has fall back to the day before, or go.
    land("2024-01-02", ("b", 21))
    assert load()["replaced"] == ["2024-01-02"] and table() == {"a": 1, "b": 21, "c": 1}


def test_landing_and_export_jobs(spark, frame, tmp_path):
    tables = {f"t{i}": frame("a int, tags array<string>", *((k, ["x", "y"]) for k in range(i))) for i in range(6)}
    flat = {n: df.select("a") for n, df in tables.items()}
    assert upkeep.land_tables(flat, str(tmp_path / "bronze"), "2024-01-01") == {f"t{i}": {"rows": i} for i in range(6)}
    done = upkeep.export_star(spark, tables, str(tmp_path / "export"))
    for name in ("t1", "t5"):
        sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/export/{name}/*.csv")]
        assert done[name] == {"files": len(sizes), "bytes": sum(sizes)}
    assert [r.tags for r in spark.read.csv(str(tmp_path / "export" / "t1"), header=True).collect()] == ["x,y"]


# ---- clustering again


def test_only_overlapping_partitions_are_rewritten(spark, frame, tmp_path, rows_of):
    path, ddl = str(tmp_path / "t"), "a long, b string, p int"
    day = lambda p, lo, hi: frame(ddl, *((i, str(i % 7), p) for i in range(lo, hi))).coalesce(1)
    for part in (day(1, 0, 50), day(1, 10, 60), day(1, 20, 70), day(2, 0, 50), day(2, 50, 99), day(None, 0, 9)):
        part.write.partitionBy("p").mode("append").parquet(path)
    written = read_partitioned(spark, path, ddl)
    before = rows_of(written)
    depth = lambda: {r.p: (r.depth, r.files) for r in overlap_depth(file_ranges(read_partitioned(spark, path, ddl), "p", ["a"]), "p", ["a"]).collect()}
    assert depth() == {1: (3, 3), 2: (1, 2), None: (1, 1)}
    others = set(glob.glob(f"{path}/p=2/*.parquet")) | set(glob.glob(f"{path}/p=__HIVE*/*.parquet"))
    assert recluster_worst(spark, path, ddl, "p", ["a"], deeper_than=1) == [1]
    assert depth()[1][0] == 1 and others == set(glob.glob(f"{path}/p=2/*.parquet")) | set(glob.glob(f"{path}/p=__HIVE*/*.parquet"))
    assert rows_of(read_partitioned(spark, path, ddl)) == before
    assert recluster_worst(spark, path, ddl, "p", ["a"], deeper_than=1) == []


# ---- what is left behind


def test_scratch_of_a_scope_goes(spark, frame):
    kept = scratch_path(spark, "kept")
    frame("a int", (1,)).write.parquet(kept)
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        frame("a int", (2,)).write.parquet(inner)
        assert path_exists(spark, inner)
    assert path_exists(spark, kept) and not path_exists(spark, inner)


def test_abandoned_versions_go(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame("a int", (1,)), path)
    old = "pending=20200101T000000000000"
    os.makedirs(f"{path}/{old}")
    waiting = write_table(frame("a int", (2,)), path, publish=False)["pending"]
    assert drop_old_versions(spark, path) == [old] and os.path.isdir(f"{path}/{waiting}")


def test_rows_without_key_are_kept_apart(spark, tmp_path):
    source = land_csv(spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "id string, n int"), str(tmp_path / "b"), "t", "2024-01-01")
    target = str(tmp_path / "log")
    ingest_incremental(spark, source, "id string, n int", ["id"], target, str(tmp_path / "progress"))
    assert [tuple(r) for r in current_rows(spark, target, "id string, n int", ["id"]).collect()] == [("a", 1)]
    assert sorted(r.n for r in spark.read.parquet(f"{target}/_keyless").collect()) == [2, 3]
