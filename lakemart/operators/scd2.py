"""Slowly changing dimension, type 2: history kept as half-open validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.operators.upsert import differs, pair_by_key

VALIDITY = ["effective_from", "effective_to", "is_current"]
FLOOR_DATE = "1900-01-01"
#: Days on which a version was seen, ascending. With them, days can be folded in in any order.
OBSERVED = "observed_on"


def as_date(day: str | Column) -> Column:
    return F.lit(day).cast("date") if isinstance(day, str) else day


def with_validity(df: DataFrame, effective_from: str | Column) -> DataFrame:
    """Every row as an open, current version starting at the given day."""
    return df.withColumns(
        {
            "effective_from": as_date(effective_from),
            "effective_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: str | Column,
    floor_date: str | Column = FLOOR_DATE,
) -> DataFrame:
    """Fold one day's rows into the history.

    A changed key has its current version closed at the run date and a new one opened; a new
    key opens at the floor date, so that facts older than the first load still find it;
    unchanged and missing keys stay as they are. Running the same day again changes nothing,
    and a second change on one day replaces that day's version instead of leaving an empty
    interval. Closed versions never take part in the join.

    A changed row dated before its key's current version fails the run: where it belongs cannot be told from
    intervals alone. ``scd2_splice`` takes days in any order.
    """
    today = as_date(run_date)
    columns = history.columns
    incoming = with_validity(incoming, today).select(*columns)
    pairs = pair_by_key(history.where("is_current"), incoming, keys)

    old, new = F.col("old"), F.col("new")
    opened_today = F.col("old.effective_from") == today
    too_late = F.raise_error(F.concat(F.lit("a change dated "), today.cast("string"), F.lit(" is older than the current version")))
    changed = old.isNotNull() & new.isNotNull() & differs("old", "new", tracked)

    closed = old.withField("effective_to", today).withField("is_current", F.lit(False))
    first = new.withField("effective_from", as_date(floor_date))
    in_place = new.withField("effective_from", F.col("old.effective_from"))
    versions = (
        F.when(old.isNull(), F.array(first))
        .when(changed & (F.col("old.effective_from") > today), F.array(old.withField("is_current", too_late.cast("boolean"))))
        .when(changed & opened_today, F.array(in_place))
        .when(changed, F.array(closed, new))
        .otherwise(F.array(old))
    )
    current = pairs.select(F.explode(versions).alias("v")).select("v.*")
    return history.where("not is_current").unionByName(current)


def first_observed(df: DataFrame, day: str | Column, floor_date: str | Column = FLOOR_DATE) -> DataFrame:
    """The history after its first day: every row current, known from the floor date on."""
    return with_validity(df, floor_date).withColumn(OBSERVED, F.array(as_date(day)))


def _islands(seen: DataFrame, keys: Sequence[str], tracked: Sequence[str], columns: list[str], floor: Column) -> DataFrame:
    """The history of keys from all their observations (columns, and day): runs of days of equal tracked values."""
    days = Window.partitionBy(*keys).orderBy("day")
    attributes = [c for c in columns if c not in {*keys, *VALIDITY, OBSERVED}]
    differs_from_last = reduce(or_, (~F.col(c).eqNullSafe(F.lag(c).over(days)) for c in tracked), F.lit(False))
    begins = (F.row_number().over(days) == 1) | differs_from_last
    numbered = seen.withColumn("_begins", begins.cast("int")).withColumn("_island", F.sum("_begins").over(days))
    runs = numbered.groupBy(*keys, "_island").agg(
        F.min("day").alias("_first"),
        F.min_by(F.struct(*attributes), "day").alias("_row"),
        F.array_sort(F.collect_list("day")).alias(OBSERVED),
    )
    order = Window.partitionBy(*keys).orderBy("_island")
    until = F.lead("_first").over(order)
    versions = runs.select(
        *keys,
        "_row.*",
        F.when(F.col("_island") == 1, floor).otherwise(F.col("_first")).alias("effective_from"),
        until.alias("effective_to"),
        until.isNull().alias("is_current"),
        OBSERVED,
    )
    return versions.select(*columns)


def scd2_splice(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: str | Column,
    floor_date: str | Column = FLOOR_DATE,
) -> DataFrame:
    """Fold the rows of one day into a history, whatever days it already holds.

    ``history`` carries the days on which each version was seen (``first_observed`` begins one). A row dated inside an
    interval splits it: what was seen before keeps the earlier part, what was seen later the rest, and equal
    neighbours become one version. So any order of the same days gives the same history. A day that
    comes again replaces what was seen on it. NULL tracked values equal each other.

    Keys whose last seen day is before the run's take the short way of one join with their current version; only keys
    that were seen on that day or later have their versions laid out by day again, a key's days at a time. Columns
    that are not tracked are those of a version's first day; the later part of a split version
    keeps those of the version that was split.
    """
    today, floor = as_date(run_date), as_date(floor_date)
    columns = history.columns
    arriving = first_observed(incoming, today, today).select(*columns)
    pairs = pair_by_key(history.where("is_current"), arriving, keys)

    old, new = F.col("old"), F.col("new")
    both = old.isNotNull() & new.isNotNull()
    changed = both & differs("old", "new", tracked)
    last = F.element_at(F.col(f"old.{OBSERVED}"), -1)
    again = both & ((last > today) | ((last == today) & changed))
    closed = old.withField("effective_to", today).withField("is_current", F.lit(False))
    seen_again = old.withField(OBSERVED, F.array_append(F.col(f"old.{OBSERVED}"), today))
    versions = (
        F.when(old.isNull(), F.array(new.withField("effective_from", floor)))
        .when(new.isNull() | (last == today), F.array(old))
        .when(changed, F.array(closed, new))
        .otherwise(F.array(seen_again))
    )
    in_time = pairs.where(~F.coalesce(again, F.lit(False))).select(F.explode(versions).alias("v")).select("v.*")

    late = pairs.where(again).select("new").select("new.*")
    late_keys = late.select(*keys)
    known = history.join(late_keys, list(keys), "left_semi").withColumn("day", F.explode(OBSERVED)).where(F.col("day") != today)
    seen = known.unionByName(late.withColumn("day", today))
    spliced = _islands(seen, keys, tracked, columns, floor)
    untouched = history.where("not is_current").join(late_keys, list(keys), "left_anti").select(*columns)
    return untouched.unionByName(in_time).unionByName(spliced)


def as_of_join(fact: DataFrame, history: DataFrame, key: str, date_col: str) -> DataFrame:
    """Each fact row with the version of its key that was valid on its date.

    The equality on the key drives the join, the interval only filters the few versions
    of that key. Both inputs come straight from their shuffles, so adaptive execution
    can split a hot key.
    """
    f, h = fact.alias("f"), history.alias("h")
    valid = (F.col("h.effective_from") <= F.col(f"f.{date_col}")) & (
        F.col("h.effective_to").isNull() | (F.col(f"f.{date_col}") < F.col("h.effective_to"))
    )
    attributes = [F.col(f"h.{c}") for c in history.columns if c != key]
    return f.join(h, (F.col(f"f.{key}") == F.col(f"h.{key}")) & valid).select("f.*", *attributes)
