"""Line dedup by content-defined chunks of lines: repeated multi-line chunks go, the first stays.

A chunk ends where a rolling hash over the hashes of the last ``WINDOW`` lines says so, hence
an inserted line moves the boundaries next to it only. Candidates are found by 64-bit chunk hash,
then compared as texts. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakemart.llm.tables import Scratch

#: Lines under the rolling hash, and one in how many places ends a chunk.
WINDOW, DIVISOR = 2, 4
BASE = 31
#: Where chunks have two lines at least: one in how many lines may end a chunk.
PAIRED_DIVISOR = 2


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it inside nested functions."""
    return F.transform(F.array(value), use)[0]


def line_hash(line: Column) -> Column:
    """The first 32 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _ends(hashes: Column) -> Column:
    """Indexes of the lines that end a chunk."""

    def rolled(i: Column) -> Column:
        total = F.lit(0).cast("long")
        for back in reversed(range(WINDOW)):
            at = i - back
            total = total * BASE + F.when(at >= 0, hashes[F.greatest(at, F.lit(0))]).otherwise(0)
        return total % DIVISOR == 0

    last = F.size(hashes) - 1
    return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | rolled(i))


def _paired_ends(hashes: Column) -> Column:
    """Indexes of the lines that end a chunk, so that only a text of one line is a chunk of one line.

    A line's own hash says whether it may end one; it does not directly after another that may, nor
    where it would leave the first or the last line alone.
    """
    last = F.size(hashes) - 1

    def may(i: Column) -> Column:
        return hashes[F.greatest(i, F.lit(0))] % PAIRED_DIVISOR == 0

    return F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == last) | (i > 0) & (i < last - 1) & may(i) & ((i == 1) | ~may(i - 1))
    )


def chunks(text: Column, paired: bool = False) -> Column:
    """The chunks of a text in order: n_lines and body, which joined by line breaks give the text."""
    find_ends = _paired_ends if paired else _ends
    lines = F.split(text, "\n", -1)

    def cut(lines: Column) -> Column:
        def spans(ends: Column) -> Column:
            def chunk(end: Column, k: Column) -> Column:
                start = F.when(k == 0, 0).otherwise(ends[F.greatest(k - 1, F.lit(0))] + 1)
                n = end - start + 1
                return F.struct(n.alias("n_lines"), F.array_join(F.slice(lines, start + 1, n), "\n").alias("body"))

            return F.transform(ends, chunk)

        return _let(F.transform(lines, line_hash), lambda h: _let(find_ends(h), spans))

    return _let(lines, cut)


def dedup_lines(
    spark: SparkSession, documents: DataFrame, carry: tuple[str, ...] = (), paired: bool = False
) -> DataFrame:
    """doc_id, text (without the removed chunks), n_chunks, removed (chunk numbers, ascending), and the
    columns named in ``carry``.

    One row per row of ``documents`` (doc_id, text). A chunk of two lines or more that stands at an
    earlier place too (smaller doc_id, or same document and earlier chunk) is removed; its
    line breaks go with it. Null texts stay null, with no chunks. Rows without doc_id remove nothing and keep
    all. Rows that share a doc_id hold one rank and treat equal chunk numbers alike. A document of removed
    chunks only becomes the empty text. With ``paired`` no text of several lines has a chunk of one line, so nothing is
    left of an exact copy. Other columns are ignored.
    """
    scratch = Scratch(spark, "chunks")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    placed = documents.where("doc_id is not null and text is not null").select(
        "doc_id", F.posexplode(chunks(F.col("text"), paired)).alias("k", "chunk")
    ).where("chunk.n_lines > 1")
    hashed = placed.select("doc_id", "k", F.col("chunk.body").alias("body"), F.xxhash64("chunk.body").alias("h"))
    often = scratch.write(
        hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "hashes"
    )
    # The texts of candidates only; the comparison of bytes is the equality of the grouping key.
    repeats = scratch.write(scratch.join_small(hashed, often, "h"), "repeats")
    firsts = scratch.write(
        repeats.groupBy("h", "body")
        .agg(F.min(F.struct("doc_id", "k")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "firsts",
    )
    # A table of its own: the rows of a hot chunk are sent on as they stand, or split by the skew join.
    later = scratch.join_small(repeats, firsts, ["h", "body"]).where("doc_id <> first.doc_id or k <> first.k")
    removed = scratch.write(
        later.groupBy("doc_id").agg(F.array_sort(F.collect_set("k")).alias("removed")), "removed"
    )
    parts = scratch.join_small(documents, removed, "doc_id", "left").select(
        "doc_id", "text", chunks(F.col("text"), paired).alias("chunks"), "removed", *carry
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), F.col("removed"))
    body = F.array_join(F.transform(left, lambda k: F.col("chunks")[k]["body"]), "\n")
    return parts.select(
        "doc_id",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(body).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("chunks")).alias("n_chunks"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        *carry,
    )
