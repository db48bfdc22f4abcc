"""Mixing sources to target weights by entropy balancing.

The mix that meets every source's target of words and stays closest, in relative entropy, to taking each
document once takes a document of ``size`` words ``exp(lambda * size / scale)`` times, and never more often than
``MOST``. The dual problem is convex and has one unknown a source; all are solved together by Newton steps, each of which is one
distributed sum, kept between bounds that halve where a step would leave them. Documents
of one source and size have one rate, so the steps run over counts of documents by source and size.

Rates become copies by systematic rounding, large documents first: what rounding adds to or takes from a
source's words is made up for by the next smaller documents. All sums are of whole numbers, so reruns agree. Built-in
functions only.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakemart.llm.tables import Scratch
from lakemart.operators.running import numbered

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating, and how often a document may be taken at most.
WEIGHTS, MOST = (1, 2, 3), 3
#: Rates are whole billionths.
UNIT = 10**9
#: Sizes below this are told apart when copies are shared out; above, sizes that agree in their leading bits meet.
FINE = 128
WIDE = "decimal(38,0)"


def _wide(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(str(value))).cast(WIDE)


def _size_class(size: Column) -> Column:
    """A number that grows with the size: seven leading bits and the octave."""
    octave = F.length(F.bin(size)) - 7
    lead = F.conv(F.substring(F.bin(size), 1, 7), 2, 10).cast("long")
    return F.when(size < FINE, size).otherwise(octave.cast("long") * (FINE // 2) + lead)


def source_targets(scratch: Scratch, sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with weight and target: shares of all words by weight, none above MOST times
    its own words.

    Sources above their limit are held there and the rest shared out again, until none is above. A round sums two
    numbers over all sources.
    """
    order = [F.col("source").asc_nulls_last()]
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = numbered(sources, order, "number").withColumn(
        "weight", F.element_at(weights, ((F.col("number") - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    )
    ranked = scratch.write(ranked, "sources")
    most = _wide(F.col("source_size") * MOST)
    total = ranked.agg(F.coalesce(F.sum(_wide(F.col("source_size"))), _wide(0)), F.coalesce(F.sum(_wide(F.col("weight"))), _wide(1))).first()
    left, weight, held = int(total[0]), int(total[1]), -1
    while True:
        above = _wide(left) * _wide(F.col("weight")) > most * _wide(weight)
        row = ranked.agg(
            F.sum(F.when(above, most)), F.sum(F.when(~above, _wide(F.col("weight")))), F.count_if(above)
        ).first()
        if row[2] == held or row[1] is None:
            break
        held, left, weight = row[2], int(total[0]) - int(row[0] or 0), int(row[1])
    share = (_wide(left) * F.col("weight")).cast("double") / F.lit(float(weight))
    return ranked.withColumn("target", F.when(above, most.cast("double")).otherwise(share))


def _rate(lam: Column, size: Column, scale: Column) -> Column:
    """Copies of a document, in billionths."""
    tilted = F.exp(F.least(lam * size / scale, F.lit(log(MOST) + 1.0)))
    return F.least(F.round(tilted * UNIT).cast("long"), F.lit(MOST * UNIT).cast("long"))


def tilts(scratch: Scratch, cells: DataFrame, sources: DataFrame) -> DataFrame:
    """number, target, scale, lam: the solution of the dual for every source.

    ``cells`` (number, size, n) counts documents. A source is solved once its rates give its target to a
    thousandth of a word or a hundred-millionth; Newton steps that leave the bracket are replaced by its middle, so every
    source gets there.
    """
    words = _wide(F.col("size") * F.col("n"))
    scales = cells.groupBy("number").agg(
        F.try_divide(F.sum(words * _wide(F.col("size"))), F.sum(words)).cast("double").alias("scale")
    )
    solvable = (F.col("target") > 0) & (F.col("source_size") > 0)
    # At the lower end all documents, at the upper end none, are tilted enough for the target.
    low = -F.col("scale") * F.log(F.greatest(F.try_divide(F.col("source_size"), F.col("target")), F.lit(1.0)))
    high = F.col("scale") * F.lit(log(MOST))
    full = F.col("target") >= F.col("source_size") * MOST
    state = sources.join(scales.hint("merge"), "number", "left").select(
        "number",
        "target",
        F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.when(solvable & ~full, low).otherwise(0.0).alias("low"),
        F.when(solvable, high).otherwise(0.0).alias("high"),
        F.when(solvable & full, high).otherwise(0.0).alias("lam"),
        (~solvable | full).alias("solved"),
    )
    state = scratch.write(state, "state")
    while not state.agg(F.coalesce(F.bool_and("solved"), F.lit(True))).first()[0]:
        open_cells = scratch.join_small(cells, state.where("not solved"), "number")
        rate = _rate(F.col("lam"), F.col("size"), F.col("scale"))
        mass = words * _wide(rate)
        steep = F.when(rate < MOST * UNIT, mass * _wide(F.col("size"))).otherwise(_wide(0))
        sums = open_cells.groupBy("number").agg(F.sum(mass).alias("mass"), F.sum(steep).alias("steep"))
        got, slope = F.col("mass").cast("double") / UNIT, F.col("steep").cast("double") / UNIT / F.col("scale")
        off = F.col("target") - got
        lows = F.when(off > 0, F.col("lam")).otherwise(F.col("low"))
        highs = F.when(off < 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") + F.try_divide(off, slope)
        moved = state.join(sums.hint("merge"), "number", "left").select(
            "number", "target", "scale", "solved", "lam", F.col("mass").isNotNull().alias("open"),
            newton.alias("newton"), lows.alias("low"), highs.alias("high"),
            (F.abs(off) <= F.greatest(F.lit(1e-3), F.col("target") * 1e-8)).alias("met"),
        )
        middle = (F.col("low") + F.col("high")) / 2
        inside = F.coalesce((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.lit(False))
        narrow = F.col("high") - F.col("low") <= F.abs(F.col("lam")) * 1e-12
        done = F.col("solved") | F.col("met") | narrow
        step = F.when(inside, F.col("newton")).otherwise(middle)
        before, state = state, scratch.write(
            moved.select(
                "number", "target", "scale", F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(0.0)).alias("high"),
                F.when(F.coalesce(done, F.lit(True)), F.col("lam")).otherwise(step).alias("lam"),
                F.coalesce(done, F.lit(True)).alias("solved"),
            ),
            "state",
        )
        scratch.drop(before)
    return state.select("number", "target", "scale", "lam")


def _share_out(classes: DataFrame, owed: Column) -> DataFrame:
    """number, class, copies: copies for each class of sizes, from large to small.

    ``owed`` is what a source's words lack before. A class takes the copies that come closest to its own words and
    what the classes before it left over. There are at most 64 classes for each doubling of the size, so a source's classes
    are a short list whatever its number of documents.
    """
    item = F.struct((-F.col("class")).alias("c"), (F.col("words") / UNIT).cast("double").alias("words"), (F.col("mass") / UNIT).cast("double").alias("mass"), (F.col("top") / UNIT).alias("top"))
    listed = classes.groupBy("number").agg(F.sort_array(F.collect_list(item)).alias("items"), F.max(owed).alias("owed"))

    def take(state: Column, x: Column) -> Column:
        mean = F.try_divide(x["words"], x["mass"])
        most = F.floor(F.try_divide(x["mass"] * MOST, x["top"]))
        wanted = F.when(mean > 0, (x["words"] + state["owed"]) / mean).otherwise(x["mass"])
        copies = F.least(F.greatest(F.floor(wanted + 0.5), F.lit(0).cast("long")), most)
        copies = F.when(x["mass"] > 0, copies).otherwise(F.lit(0).cast("long"))
        owed_now = F.when(x["mass"] > 0, state["owed"] + x["words"] - copies * mean).otherwise(state["owed"])
        taken = F.struct((-x["c"]).alias("class"), copies.alias("copies"))
        return F.struct(owed_now.alias("owed"), F.concat(state["taken"], F.array(taken)).alias("taken"))

    empty = F.array().cast("array<struct<class:bigint,copies:bigint>>")
    done = F.aggregate("items", F.struct(F.col("owed").cast("double").alias("owed"), empty.alias("taken")), take)
    return listed.select("number", F.explode(done["taken"]).alias("t")).select("number", "t.*")


def _copies_before(k: Column) -> Column:
    """Copies of the documents of a class up to a point of its mass."""
    whole = F.call_function("div", F.col("copies").cast(WIDE) * k, F.col("class_mass"))
    return F.when(F.col("class_mass") > 0, whole).otherwise(F.lit(0).cast("long"))


def _copies_by_cell(scratch: Scratch, cells: DataFrame, targets: DataFrame) -> DataFrame:
    """``cells`` (number, size, n, rate) with class, copies (of the class), class_mass, and mass before the cell."""
    placed = cells.withColumns({"class": _size_class(F.col("size")), "mass": _wide(F.col("n")) * _wide(F.col("rate"))})
    earlier = Window.partitionBy("number", "class").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("before", F.coalesce(F.sum("mass").over(earlier), _wide(0)).cast(WIDE))
    placed = scratch.write(placed, "placed")
    classes = scratch.write(
        placed.groupBy("number", "class").agg(
            F.sum(F.col("mass") * _wide(F.col("size"))).cast(WIDE).alias("words"),
            F.sum("mass").cast(WIDE).alias("mass"),
            F.max("rate").alias("top"),
        ),
        "classes",
    )
    sums = classes.groupBy("number").agg((F.sum("words") / UNIT).cast("double").alias("expected"))
    lacking = targets.select("number", "target").join(sums.hint("merge"), "number")
    lacking = lacking.select("number", (F.col("target") - F.col("expected")).alias("owed"))
    start = scratch.write(classes.join(lacking.hint("merge"), "number"), "start")
    large = scratch.write(_share_out(start.where(F.col("class") >= FINE), F.col("owed")), "large")
    masses = classes.select("number", "class", F.col("mass").alias("class_mass"))
    shared = placed.join(masses.hint("merge"), ["number", "class"])

    def words_taken(copies: DataFrame) -> DataFrame:
        counted = shared.join(copies.hint("merge"), ["number", "class"])
        taken = _copies_before(F.col("before") + F.col("mass")) - _copies_before(F.col("before"))
        return counted.groupBy("number").agg(F.sum(taken * F.col("size")).alias("taken"))

    # What large documents were really taken for is known now; small ones, each size on its own, make up for it.
    small = start.where(F.col("class") < FINE).drop("owed")
    own = small.groupBy("number").agg((F.sum("words") / UNIT).cast("double").alias("own"))
    owed = (
        targets.select("number", "target")
        .join(own.hint("merge"), "number")
        .join(words_taken(large).hint("merge"), "number", "left")
        .select("number", (F.col("target") - F.coalesce("taken", F.lit(0)) - F.col("own")).alias("owed"))
    )
    copies = large.unionByName(_share_out(small.join(owed.hint("merge"), "number"), F.col("owed")))
    return scratch.write(shared.join(copies.hint("merge"), ["number", "class"]), "copies")


def mix_sources(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate for every row of ``documents`` (doc_id, text, source).

    ``size`` counts words (runs of anything but ASCII white space); a null or empty text has none and is taken
    once for nothing. Sources in order of code points, null last and apart from the empty one, weigh 1, 2, 3, repeating. A source's
    ``target`` is its share of all words by weight, three times its own words at most, the excess shared again.
    ``taken`` = ``copies`` x size adds up to about the target over a source, and no document is taken more than three
    times. Rows without doc_id and rows that share one are documents of their own. Equal rows may get
    different copies; apart from which of them, reruns agree. An empty table gives no rows. Other columns are ignored.
    """
    scratch = Scratch(spark, "entropy-mix")
    sized = scratch.write(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sized",
    )
    counted = scratch.write(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counted")
    sources = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = scratch.write(source_targets(scratch, sources), "targets")
    same = F.col("c.source").eqNullSafe(F.col("s.source"))
    named = counted.alias("c").join(sources.hint("merge").alias("s"), same)
    cells = scratch.write(named.select("s.number", "c.size", "c.n"), "cells")
    lams = tilts(scratch, cells, sources)
    rate = _rate(F.col("lam"), F.col("size"), F.col("scale"))
    rated = scratch.join_small(cells, scratch.write(lams, "tilts"), "number").select("number", "size", "n", rate.alias("rate"))
    copies = _copies_by_cell(scratch, rated, sources)
    facts = copies.join(sources.select("number", "source", "source_size", "target").hint("merge"), "number")
    facts = scratch.write(facts.withColumnsRenamed({"source": "of", "size": "of_size"}).drop("number"), "facts")

    # Ranks among the documents of one source and size, which may be a third of all: dealt by hash to as many
    # buckets as one of them will hold, ranked within the buckets, and counted on from bucket to bucket.
    own = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size"))
    of_cell = scratch.write(counted.select(F.col("source").alias("of"), F.col("size").alias("of_size"), "n"), "sizes")
    hashed = scratch.join_small(sized, of_cell, own).withColumn("h", F.xxhash64("doc_id"))
    bucket = F.pmod("h", F.ceil(F.sqrt("n")))
    dealt = scratch.write(hashed.select("doc_id", "source", "size", "h", bucket.alias("bucket")), "dealt")
    group = ["source", "size", "bucket"]
    ahead = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("docs"))
    buckets = scratch.write(
        counts.select(
            F.col("source").alias("of"),
            F.col("size").alias("of_size"),
            F.col("bucket").alias("of_bucket"),
            F.coalesce(F.sum("docs").over(ahead), F.lit(0)).alias("ahead"),
        ),
        "buckets",
    )
    ranks = dealt.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy("h", "doc_id")))
    ranked = scratch.join_small(ranks, buckets, own & (F.col("bucket") == F.col("of_bucket"))).select(
        "doc_id", "source", "size", (F.col("ahead") + F.col("rank")).alias("rank")
    )
    upto = F.col("before") + _wide(F.col("rank")) * _wide(F.col("rate"))
    chosen = _copies_before(upto) - _copies_before(upto - _wide(F.col("rate")))
    return scratch.join_small(ranked, facts, own).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (chosen * F.col("size")).alias("taken"),
        chosen.alias("copies"),
        (F.col("rate") / UNIT).alias("rate"),
    )


def take_copies(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """``documents`` with each row as often as ``mixed`` says, numbered by ``copy`` from 1; not taken, not there.

    doc_id has to be unique; rows without one are not taken.
    """
    wanted = mixed.where("copies > 0").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return documents.join(wanted.hint("merge"), "doc_id").select(*[documents[c] for c in documents.columns], "copy")
