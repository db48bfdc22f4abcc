"""How filters interact: what each of them removes under every order in which they can be applied.

A document is known by the set of filters it fails. Under an order of the filters, the first one of that set
removes it. Orders are numbered by their Lehmer codes, which is lexicographic order, so all orders that begin alike
are one interval of ranks: a set's removals are a few intervals for each step, however many documents have it.
Counts are added at the starts of intervals and taken off at their ends; prefix sums over the ranks give every
order's numbers. No order is ever replayed over documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakemart.llm.tables import Scratch

#: Runs of the six ASCII white-space characters, which separate words.
BETWEEN = r"[\x20\x09-\x0D]+"

LETTERS = "ABCDE"
#: The orders by rank.
ORDERS = ["".join(p) for p in permutations(LETTERS)]
SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails the filters that look at the text alone."""
    words = F.array_remove(F.split(text, BETWEEN), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _rank(prefix: tuple[int, ...]) -> int:
    """Rank of the first order that begins with ``prefix``, from its Lehmer code."""
    n = len(LETTERS)
    smaller_left = [x - sum(y < x for y in prefix[:i]) for i, x in enumerate(prefix)]
    return sum(d * factorial(n - 1 - i) for i, d in enumerate(smaller_left))


def interval_ends() -> list[tuple[int, int, int, int, int, int]]:
    """(mask, step, rank, kept, removed, redundant): changes in what becomes of a document that fails ``mask``.

    Ends that cancel, where one interval follows another, are left out.
    """
    n = len(LETTERS)
    change: dict[tuple[int, int, int], list[int]] = {}
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            first = _rank(prefix)
            before, now = sum(1 << x for x in prefix[:-1]), 1 << prefix[-1]
            for mask in range(1 << n):
                kind = 2 if mask & before and mask & now else 1 if mask & now else None if mask & before else 0
                if kind is None:  # removed before, and this filter has nothing against it
                    continue
                for rank, sign in ((first, 1), (first + factorial(n - step), -1)):
                    change.setdefault((mask, step, rank), [0, 0, 0])[kind] += sign
    return [(*key, *signs) for key, signs in change.items() if any(signs) and key[2] < len(ORDERS)]


def failing_masks(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the set of filters they fail, bit 0 for filter A.

    Equal texts meet by digest, combined in each task before they are sent. The first of each text is
    then looked up by text and doc_id, so that copies of one text are spread over all tasks.
    """
    scratch = Scratch(spark, "filter-audit")
    text = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_filters(F.col("text")).values())), F.lit(0))
    known = text.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = scratch.write(known.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")), "rows")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    judged = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    whole = (
        rows.join(firsts.hint("merge"), ["digest", "doc_id"], "left")
        .join(judged.hint("merge"), "doc_id", "left")
        .withColumn("mask", F.col("mask") + F.when(repeats, 1 << LETTERS.index("E")).otherwise(0))
    )
    return whole.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit_filters(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every part
    of ``documents`` (doc_id, text, source), each of the 120 orders of the filters, and each step of it.

    Filters: A too few words, B few distinct words, C many capitals, D special characters, E the text also
    stands under a smaller doc_id, whether or not that document was removed. A null text is empty; a null source and
    an empty one are the part ''. Rows without doc_id have no smaller one and no label; repeated
    rows count each, and are no copies of each other. Of several labels of a document, any that says 1 counts;
    null labels count as none. Parts without documents do not occur, so an empty table gives no rows. Other columns
    are ignored.
    """
    scratch = Scratch(spark, "filter-audit")
    counts = scratch.write(failing_masks(spark, documents, labels), "masks")
    # 32 sets, five steps: a table of fixed size.
    ends = spark.createDataFrame(interval_ends(), "mask int, step int, rank int, kept int, removed int, redundant int")
    single = F.col("mask").isin([1 << k for k in range(len(LETTERS))])
    zero = F.lit(0).cast("long")
    changes = counts.join(F.broadcast(ends), "mask").select(
        "part",
        "step",
        "rank",
        (F.col("kept") * F.col("n")).alias("kept"),
        (F.col("removed") * F.col("n")).alias("removed"),
        (F.col("redundant") * F.col("n")).alias("redundant"),
        F.when(single, F.col("removed") * F.col("n")).otherwise(zero).alias("unique_fails"),
        (F.col("removed") * F.col("good")).alias("good_lost"),
        (F.col("removed") * F.col("toxic")).alias("toxic_lost"),
    )
    # Every rank has a row, also where nothing changes.
    places = (
        counts.select("part")
        .distinct()
        .select("part", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
        .select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"))
        .select("*", *[zero.alias(c) for c in SUMS])
    )
    up_to = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        changes.unionByName(places)
        .groupBy("part", "step", "rank")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
        .select("part", "step", "rank", *[F.sum(c).over(up_to).alias(c) for c in SUMS])
    )
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return totals.select("part", order.alias("filter_order"), "step", *SUMS).withColumn(
        "shapley", F.sum("removed").over(Window.partitionBy("part", letter))
    )
