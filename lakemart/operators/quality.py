"""Data-quality checks. The checks are lazy; ``enforce`` is the edge where a run fails."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.operators.dedup import duplicate_keys


class GateError(AssertionError):
    """A quality gate refused the data."""


def row_floor(df: DataFrame, floor: int = 0) -> DataFrame:
    """One row: how many rows there are and whether that is above the floor."""
    return df.agg(F.count(F.lit(1)).alias("observed")).select(
        "observed", F.lit(floor).cast("bigint").alias("floor"), (F.col("observed") > floor).alias("ok")
    )


def file_count(inventory: DataFrame, at_least: int) -> DataFrame:
    """One row: how many files landed and whether they are enough."""
    return inventory.agg(F.count(F.lit(1)).alias("observed")).select(
        "observed", (F.col("observed") >= at_least).alias("ok")
    )


def gate_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of keys that occur more than once."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("observed")).select(
        "observed", (F.col("observed") == 0).alias("ok")
    )


def expectations(
    df: DataFrame, checks: Mapping[str, tuple[Column, Callable[[Column], Column]]]
) -> DataFrame:
    """Evaluate named (aggregate, predicate) pairs in one pass; one row per check."""
    observed = df.agg(
        *[agg.cast("double").alias(f"_{i}") for i, (agg, _) in enumerate(checks.values())]
    )
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.coalesce(passes(F.col(f"_{i}")), F.lit(False)).alias("ok"),
            F.col(f"_{i}").alias("observed"),
        )
        for i, (name, (_, passes)) in enumerate(checks.items())
    ]
    return observed.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def in_files(written: DataFrame) -> DataFrame:
    """Rows of a written table with ``_piece`` and ``_place``: the file, in order of names, and the row within it."""
    return written.select("*", F.col("_metadata.file_name").alias("_piece"), F.col("_metadata.row_index").alias("_place"))


def in_partitions(df: DataFrame) -> DataFrame:
    """Rows of a frame with ``_piece`` and ``_place``: the partition and the row within it, as the plan makes them."""
    place = F.monotonically_increasing_id()
    return df.withColumn("_place", place).withColumn("_piece", F.shiftright("_place", 33))


def _after(left: str, right: str, order: Sequence[tuple[str, bool]]) -> Column:
    """Whether row ``left`` comes strictly after ``right`` by columns (name, descending), NULL last."""
    result = F.lit(False)
    for name, descending in reversed(order):
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        later = F.when(a.isNull(), b.isNotNull()).when(b.isNull(), F.lit(False)).otherwise(a < b if descending else a > b)
        result = later | (a.eqNullSafe(b) & result)
    return result


def out_of_order(placed: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row: neighbouring rows of a whole output that stand in the wrong order, and whether there are none.

    ``placed`` comes from ``in_files`` or ``in_partitions``; ``order`` lists columns (name, descending), missing values
    last. Rows are compared within each piece; then the ends of the pieces are compared with the beginnings of the next
    ones. No task sees more than one piece, and of the pieces only their names go to the driver.
    """
    row = placed.select("_piece", "_place", F.struct(*[n for n, _ in order]).alias("row"))
    within = Window.partitionBy("_piece").orderBy("_place")
    pairs = row.withColumn("before", F.lag("row").over(within))
    inside = pairs.where(F.col("before").isNotNull() & _after("before", "row", order)).agg(F.count(F.lit(1)).alias("n"))
    ends = row.groupBy("_piece").agg(F.min_by("row", "_place").alias("first"), F.max_by("row", "_place").alias("last"))
    pieces = sorted(r[0] for r in row.select("_piece").distinct().collect())
    steps = [x for a, b in zip(pieces, pieces[1:]) for x in (F.lit(a), F.lit(b))]
    if steps:
        nexts = ends.select(F.create_map(*steps)[F.col("_piece")].alias("_piece"), "last")
        borders = nexts.join(ends.select("_piece", "first"), "_piece").where(_after("last", "first", order))
        inside = inside.unionByName(borders.agg(F.count(F.lit(1)).alias("n")))
    return inside.agg(F.sum("n").alias("observed")).select("observed", (F.col("observed") == 0).alias("ok"))


def gate_output(
    df: DataFrame, name: str, limit: int, order: Sequence[tuple[str, bool]], category: str | None = None, unknown: str = "unknown"
) -> DataFrame:
    """check, ok, observed for a ranked answer: as many rows as asked for, in order, and no unknown category."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    checks = [n.select(F.lit(f"{name} has {limit} rows").alias("check"), (F.col("n") == limit).alias("ok"), F.col("n").cast("double").alias("observed"))]
    wrong = out_of_order(in_partitions(df), order)
    checks.append(wrong.select(F.lit(f"{name} is sorted").alias("check"), "ok", F.col("observed").cast("double").alias("observed")))
    if category is not None:
        bad = df.agg(F.count_if(F.col(category).isNull() | (F.col(category) == unknown)).alias("n"))
        checks.append(bad.select(F.lit(f"{name} has no {unknown} category").alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("double").alias("observed")))
    return reduce(DataFrame.unionByName, checks)


def enforce(checked: DataFrame, what: str) -> None:
    """Run the checks and fail when one did not pass. Reads one row per check."""
    failed = checked.where(~F.coalesce(F.col("ok"), F.lit(False))).collect()
    if failed:
        raise GateError(f"{what}: {[row.asDict() for row in failed]}")


def gate_row_floor(df: DataFrame, floor: int = 0) -> None:
    enforce(row_floor(df, floor), f"expected more than {floor} rows")


def gate_file_count(inventory: DataFrame, at_least: int) -> None:
    enforce(file_count(inventory, at_least), f"expected at least {at_least} files")
