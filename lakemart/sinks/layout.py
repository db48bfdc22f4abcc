"""Clustering a table on several columns at once by a space-filling curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.session import SHUFFLE_PARTITIONS, frame_bytes

# Ranges per column are two to this many; the range bounds come from a sample of so many rows per range.
BITS = 8
SAMPLED_PER_RANGE = 64
# Bytes of the files read per range of rows that one task sorts and writes.
BYTES_PER_RANGE = 16 * 1024**2


def range_cuts(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """The bounds that cut each column into ranges of about equal row count.

    They are quantiles of whole values, of any type that has an order, over the rows first in order of a hash: a
    bounded sample, which steers where rows lie and nothing else. Missing values are left out.
    """
    n = 1 << bits
    sample = df.orderBy(F.xxhash64(*df.columns)).limit(n * SAMPLED_PER_RANGE).select(*columns).collect()
    cuts = {}
    for c in columns:
        values = sorted(row[c] for row in sample if row[c] is not None)
        cuts[c] = [values[i * len(values) // n] for i in range(1, n)] if values else []
    return cuts


def _locate(df: DataFrame, cuts: dict[str, list], bits: int) -> DataFrame:
    """Adds ``_z_<column>``: how many cuts lie at or below the value, missing ones first.

    Found by halving the ranges, one projection per level: a comparison per bit and column, all
    in generated code, where a lambda over the bounds would be interpreted row by row.
    """
    kinds = dict(df.dtypes)
    bounds = {c: F.array(*[F.lit(v).cast(kinds[c]) for v in values]) for c, values in cuts.items()}
    located = df.withColumns({f"_z_{c}": F.lit(0) for c in cuts})
    for level in range(bits):
        step = 1 << (bits - level - 1)
        located = located.withColumns(
            {
                f"_z_{c}": F.col(f"_z_{c}")
                + F.when(F.get(bounds[c], F.col(f"_z_{c}") + (step - 1)) <= F.col(c), step).otherwise(0)
                for c in cuts
                if cuts[c]
            }
        )
    return located


def _interleave(buckets: Sequence[Column], bits: int) -> Column:
    """Bits of the buckets in turn, highest first."""
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, bucket in enumerate(reversed(buckets)):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(buckets) + place))
    return z


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    files: int | None = None,
    within: Sequence[str] = (),
    bits: int = BITS,
) -> DataFrame:
    """The same rows, range-partitioned so that rows close in all of ``columns`` share files.

    Each column is cut into 2^bits ranges of about equal row count, and the bits of a row's
    ranges are interleaved; tables of more files than 2^(bits x columns) want more bits. A hash of the row follows the curve value in the range
    partitioning, so many rows with equal columns still spread over files.

    ``within`` names partition columns of the write that follows: rows are ranged by them
    first, so a large partition value is split over tasks and small ones share one.

    Without ``files`` there are more ranges than configured shuffle partitions once those would become too large:
    range partitions are not split at run time, and a fixed number would spill at some size. The hash is computed where
    it is compared and not sent along, as it does not compress.
    """
    if bits * len(columns) > 63:
        raise ValueError(f"{bits} bits for each of {len(columns)} columns do not fit 63")
    if files is None:
        needed = -(-frame_bytes(df) // BYTES_PER_RANGE)
        files = needed if needed > int(df.sparkSession.conf.get(SHUFFLE_PARTITIONS)) else None
    located = _locate(df, range_cuts(df, columns, bits), bits)
    buckets = [F.col(f"_z_{c}") for c in columns]
    by = [*within, "_z"]
    keyed = located.select(*df.columns, _interleave(buckets, bits).alias("_z"))
    ranges = [*by, F.xxhash64(*df.columns)]
    ranged = keyed.repartitionByRange(files, *ranges) if files else keyed.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*by, *columns).select(*df.columns)
