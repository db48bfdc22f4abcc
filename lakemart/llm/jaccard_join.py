"""N-gram Jaccard join by group counts: near-copies of documents and the groups they form.

A document's set is that of its distinct word shingles. Shingle hashes are dealt to groups, about one
for every six shingles, and a set becomes the point of its group counts. Two sets share at most the sum of the
smaller of their counts, group by group, so a pair whose sum is too small is never compared.

Steps, each a Spark job over all documents:

1. *Frequent shingles.* Every task counts its shingles, the largest counts are added up and the
   ``FREQUENT`` most frequent ones become a list of bounded size. It only sets an order (frequent
   last), so passages that many documents share do not bring them together.
2. *Signatures.* Size, digest and point of every set, and the first shingles in that order: two sets
   that are similar enough share one of them.
3. *Cells.* The sets that share such a shingle. Cells of one set, and cells with the same members as
   another, are dropped by counts and digests that combine map-side. Each remaining cell is split by
   classes of set size, which set the number of groups; sets without another of a size in reach are dropped
   before points are sent. The rest is searched by a count-vector R-tree; only links that connect are emitted,
   at most one per member.
4. *Verification.* Sets that may be connected meet once, with their shingles, and are compared exactly.
   Pairs already known to be connected are skipped, so a group of m near-copies of one text
   costs about m comparisons.

Cells and groups above a fixed number of members are dealt to pairs of blocks, so no task holds more than
two blocks. Equal sets are linked by digest and searched once per input task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakemart.llm.components import components
from lakemart.llm.hashing import slices, windows, words
from lakemart.llm.tables import Scratch
from lakemart.llm.workers import giving_back

SHINGLE = 5
#: Similarity as a fraction: two documents link when TEN * shared >= EIGHT * union.
NUMERATOR, DENOMINATOR = 8, 10
#: Least number of groups; the larger size classes have more.
LEAST_GROUPS = 64
#: Entries of the ordering list, and of each contribution to it, which covers so many shingles.
FREQUENT, FREQUENT_PER_TASK, COUNTED_TOGETHER = 65_536, 8_192, 2_000_000
#: Members that meet in one task: of a cell (points only) and of a group (whole sets).
CELL_BLOCK, SET_BLOCK = 4_096, 1_024
FANOUT = 16

_SIGNATURE = "doc_id long, n int, d1 long, d2 long, classes array<int>, point binary, keys array<long>"


def _classes(n: int) -> list[int]:
    """Size classes (powers of two) in which a set of n shingles meets its possible partners.

    A partner has at most n * DENOMINATOR / NUMERATOR shingles if it is the larger one; the two meet in
    the class of the larger.
    """
    return sorted({n.bit_length() - 1, (n * DENOMINATOR // NUMERATOR).bit_length() - 1})


def _groups_of(size_class: int) -> int:
    return max(LEAST_GROUPS, 1 << max(0, size_class - 2))


def _needed(n_a, n_b):
    """Least number of shared shingles of two sets of these sizes."""
    total = NUMERATOR * (n_a + n_b)
    return -(-total // (NUMERATOR + DENOMINATOR))


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, owner, _, _ = words(texts)
    shingles, owner = windows(hashes, owner, len(texts), SHINGLE)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        found = np.sort(shingles[a:b])
        yield found[np.concatenate(([True], found[1:] != found[:-1]))] if b > a else found


def _point(found: np.ndarray, groups: int) -> np.ndarray:
    """Group counts; groups are the first bits of the hash, so two halves of a group add up to it."""
    shift = np.uint64(64 - (groups.bit_length() - 1))
    return np.bincount((found >> shift).astype(np.int64), minlength=groups).astype(np.uint32)


def _packed(point: np.ndarray) -> bytes:
    """Counts in one byte each, in four if one is too large."""
    return (point.astype(np.uint8) if point.max() < 256 else point).tobytes()


def _unpacked(data: bytes, n: int, groups: int) -> np.ndarray:
    """The point of a set of n shingles, folded to that many groups."""
    kind = np.uint8 if len(data) == _groups_of(_classes(n)[-1]) else np.uint32
    return np.frombuffer(data, kind).reshape(groups, -1).sum(axis=1, dtype=np.uint32)


def _count_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles seen in several documents of COUNTED_TOGETHER shingles, the most frequent ones each time."""

    def counted(found: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(found)
        found.clear()
        values.sort()
        starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        counts = np.diff(np.append(starts, len(values)).astype(np.int32))
        often = np.flatnonzero(counts > 1)
        if len(often) > FREQUENT_PER_TASK:
            often = often[np.argpartition(-counts[often], FREQUENT_PER_TASK)[:FREQUENT_PER_TASK]]
        return pa.RecordBatch.from_arrays(
            [pa.array(values[starts[often]].view(np.int64)), pa.array(counts[often], pa.int64())], ["h", "n"]
        )

    held, size = [], 0
    for batch in batches:
        for _, texts in slices(batch.column("text")):
            for found in _sets(texts):
                held.append(found)
                size += len(found)
            if size >= COUNTED_TOGETHER:
                yield counted(held)
                size = 0
    if size:
        yield counted(held)


def _signatures(frequent: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def first_keys(found: np.ndarray) -> np.ndarray:
        n = len(found)
        size = n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
            often = frequent[at] == found
            found = np.concatenate((found[~often], found[often]))
        return found[:size]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # equal sets of this task send their keys once
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch.column("text")):
                rows = []
                for doc_id, found in zip(ids[first:], _sets(texts)):
                    n = len(found)
                    if not n:
                        rows.append((doc_id, 0, 0, 0, None, None, None))
                        continue
                    d1 = int(np.bitwise_xor.reduce(found).view(np.int64))
                    d2 = int(np.sum(found * (found >> np.uint64(7) | np.uint64(1)), dtype=np.uint64).view(np.int64))
                    keys = None
                    if doc_id is not None and (d1, d2) not in seen:
                        seen.add((d1, d2))
                        keys = first_keys(found).view(np.int64)
                    classes = _classes(n)
                    point = _packed(_point(found, _groups_of(classes[-1])))
                    rows.append((doc_id, n, d1, d2, classes, point, keys))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.int64()),
                        pa.array([r[4] for r in rows], pa.list_(pa.int32())),
                        pa.array([r[5] for r in rows], pa.binary()),
                        pa.array([r[6] for r in rows], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "d1", "d2", "classes", "point", "keys"],
                )

    return run


class CountTree:
    """An R-tree over group-count points, packed in order of set size; members can be removed."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        self.points, self.sizes, self.order = points[order], sizes[order], order
        self.alive = np.ones(len(order), dtype=bool)
        self.position = np.empty(len(order), dtype=np.int64)
        self.position[order] = np.arange(len(order))
        self.levels = []  # (largest counts, smallest and largest size) per node, leaves first
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > FANOUT:
            cuts = np.arange(0, len(top), FANOUT)
            top = np.maximum.reduceat(top, cuts, axis=0)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))

    def remove(self, members: np.ndarray) -> None:
        self.alive[self.position[members]] = False

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Members whose count bound allows a link to a set of this point and size."""
        nodes = np.arange(len(self.levels[-1][0]) if self.levels else len(self.points))
        for top, low, high in reversed(self.levels):
            least = np.maximum(low[nodes], -(-NUMERATOR * size // DENOMINATOR))
            fits = (low[nodes] * NUMERATOR <= size * DENOMINATOR) & (high[nodes] * DENOMINATOR >= size * NUMERATOR)
            nodes, least = nodes[fits], least[fits]
            bound = np.minimum(top[nodes], point).sum(axis=1)
            nodes = nodes[bound >= _needed(size, least)]
            below = len(self.levels[self._depth(top) - 1][0]) if self._depth(top) else len(self.points)
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes = nodes[nodes < below]
        nodes = nodes[self.alive[nodes]]
        sizes = self.sizes[nodes]
        nodes = nodes[(sizes * NUMERATOR <= size * DENOMINATOR) & (sizes * DENOMINATOR >= size * NUMERATOR)]
        bound = np.minimum(self.points[nodes], point).sum(axis=1)
        return self.order[nodes[bound >= _needed(size, self.sizes[nodes])]]

    def _depth(self, top: np.ndarray) -> int:
        return next(i for i, level in enumerate(self.levels) if level[0] is top)


def connect(
    points: np.ndarray, sizes: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Links (member, found member) that connect what is connected; at most one per member.

    Searches breadth first and takes out what it has found, so every member is looked up once and
    pairs inside a found group are not compared again. ``linked`` keeps the truly linked ones.
    """
    tree, left, links = CountTree(points, sizes), np.ones(len(sizes), dtype=bool), []
    for seed in range(len(sizes)):
        if not left[seed]:
            continue
        left[seed] = False
        tree.remove(np.array([seed]))
        queue = [seed]
        while queue:
            at = queue.pop()
            found = tree.search(points[at], int(sizes[at]))
            if linked is not None and len(found):
                found = found[linked(at, found)]
            if len(found):
                left[found] = False
                tree.remove(found)
                queue.extend(found.tolist())
                links.extend((at, int(f)) for f in found)
    return links


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, list]]:
    """Rows of a sorted partition, one dict of lists per value of the first column."""
    key, held = None, {n: [] for n in names}
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for row in zip(*columns):
            if row[0] != key:
                if held[names[0]]:
                    yield held
                key, held = row[0], {n: [] for n in names}
            for n, value in zip(names, row):
                held[n].append(value)
    if held[names[0]]:
        yield held


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"]
    )


def _search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for group in _groups(batches, ["cell", "rep", "n", "size_class", "point"]):
        reps = group["rep"]
        if len(reps) > 1:
            size = _groups_of(group["size_class"][0])
            points = np.stack([_unpacked(p, n, size) for p, n in zip(group["point"], group["n"])])
            sizes = np.array(group["n"], dtype=np.int64)
            out += [(reps[i], reps[j]) for i, j in connect(points, sizes)]
        if len(out) > 50_000:
            yield _links(out)
            out = []
    if out:
        yield _links(out)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches, ["cell", "rep", "shingles"]):
        reps = group["rep"]
        if len(reps) < 2:
            continue
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        sizes = np.array([len(s) for s in sets])
        # Groups for the typical size; far larger sets are told apart by size and by comparison.
        groups = _groups_of(int(np.median(sizes)).bit_length() - 1)
        points = np.stack([_point(s, groups) for s in sets])

        def linked(at: int, found: np.ndarray) -> np.ndarray:
            own = sets[at]
            joined = np.concatenate([sets[f] for f in found])
            hit = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
            starts = np.concatenate(([0], np.cumsum(sizes[found])[:-1]))
            shared = np.add.reduceat(hit.astype(np.int64), starts)
            return DENOMINATOR * shared >= NUMERATOR * (len(own) + sizes[found] - shared)

        pairs = connect(points, sizes, linked)
        if pairs:
            yield _links([(reps[i], reps[j]) for i, j in pairs])


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in slices(batch.column("text")):
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, n),
                    batch.column("component").slice(first, n),
                    batch.column("n_blocks").slice(first, n),
                    pa.array([s.tobytes() for s in _sets(texts)], pa.binary()),
                ],
                ["rep", "component", "n_blocks", "shingles"],
            )


def _in_blocks(members: DataFrame, cell: str) -> DataFrame:
    """One row per pair of blocks that a member belongs to; one block (a single row) as a rule.

    Members of any two blocks meet in one task, so every pair of members does.
    """
    block = F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    return members.withColumn("block", block).select("*", other).where(
        (F.col("n_blocks") <= 2) & (F.col("other") == 0) | (F.col("n_blocks") > 2) & (F.col("other") != F.col("block"))
    ).withColumn(
        "cell",
        F.when(F.col("n_blocks") <= 2, F.xxhash64(cell)).otherwise(
            F.xxhash64(cell, F.least("block", "other"), F.greatest("block", "other"))
        ),
    )


def _keyed(named: DataFrame) -> DataFrame:
    """(doc_id, n, key) of the rows with keys, one for each key.

    Keys are cut to 48 bits, which compress better. Two that agree only so far share a cell, and what meets there is compared.
    """
    return named.where("keys is not null").select(
        "doc_id", "n", F.explode(F.transform("keys", lambda key: F.shiftrightunsigned(key, 16))).alias("key")
    )


def _cells(keyed: DataFrame) -> DataFrame:
    """(key, n_blocks) of the cells of ``keyed`` (doc_id, key) with other members than all others.

    Most keys have one member, and what is summed for it is most of what is shuffled: the two halves of one hash.
    Sums, unlike an exclusive or, tell a repeated doc_id apart; these hold 2^31 members.
    """
    member = F.xxhash64("doc_id")
    return (
        keyed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.sum(F.shiftrightunsigned(member, 32)).alias("s"),
            F.sum(member.bitwiseAND(F.lit((1 << 32) - 1))).alias("t"),
        )
        .where("c > 1")
        .groupBy("c", "s", "t")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("c") / CELL_BLOCK).cast("int").alias("n_blocks"))
    )


def _in_classes(met: DataFrame) -> DataFrame:
    """(cell, rep, size_class) of the rows of ``met`` (cell, rep, n), cells split by size class; without the rows
    that have no other in reach of their size there."""

    def size_class(n):
        return F.length(F.bin(n)) - 1

    larger = F.floor(F.col("n").cast("long") * DENOMINATOR / NUMERATOR)
    split = met.select(
        "cell", "rep", "n", F.explode(F.array_distinct(F.array(size_class(F.col("n")), size_class(larger)))).alias("size_class")
    ).select(F.xxhash64("cell", "size_class").alias("cell"), "rep", "n", "size_class")
    by_size = Window.partitionBy("cell").orderBy("n", "rep")
    size = F.col("n").cast("long")
    reached = split.select(
        "*",
        (F.lag(size).over(by_size) * DENOMINATOR >= size * NUMERATOR).alias("below"),
        (size * DENOMINATOR >= F.lead(size).over(by_size) * NUMERATOR).alias("above"),
    )
    return reached.where("below or above").select("cell", "rep", "n", "size_class")


def _frequent(documents: DataFrame) -> np.ndarray:
    """The most frequent shingle hashes, sorted: FREQUENT of them at most."""
    counted = documents.select("text").mapInArrow(giving_back(_count_frequent), "h long, n long")
    top = counted.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT)
    return np.sort(np.array([r.h for r in top.collect()], dtype=np.int64).view(np.uint64))


def jaccard_groups(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``documents`` (doc_id, text).

    component_id is the smallest doc_id that links reach, the document itself included. Texts that
    are null, empty or white space have an empty set and link with nothing. Rows without
    doc_id keep their size, have no component and link with nothing. Rows that share a doc_id are one
    node of the graph. Other columns are ignored.
    """
    scratch = Scratch(spark, "jaccard")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = spark.sparkContext.broadcast(_frequent(documents))

    def signatures(batches):
        yield from _signatures(frequent.value)(batches)

    signed = scratch.write(documents.mapInArrow(giving_back(signatures), _SIGNATURE), "signatures")
    named = signed.where("n > 0 and doc_id is not null")
    equal = scratch.write(
        named.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1"), "equal"
    )

    # Cells with other members than all others, each under its smallest shingle.
    keyed = _keyed(named)
    cells = scratch.write(_cells(keyed), "cells")
    members = scratch.join_small(keyed.select(F.col("doc_id").alias("rep"), "n", "key"), cells, "key")
    points = named.where("keys is not null").select(F.col("doc_id").alias("rep"), "n", "point")
    met = _in_classes(_in_blocks(members, "key").select("cell", "rep", "n"))
    candidates = (
        met.join(points, ["rep", "n"])
        .select("cell", "rep", "n", "size_class", "point")
        .repartition("cell")
        .sortWithinPartitions("cell", "rep")
        .mapInArrow(giving_back(_search_cells), "a long, b long")
    )
    same = named.select("doc_id", "d1", "d2", "n").join(equal, ["d1", "d2", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    candidates = scratch.write(candidates.distinct(), "candidates")
    maybe = components(candidates, scratch)
    counts = maybe.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / SET_BLOCK).cast("int").alias("n_blocks"))
    maybe = scratch.write(maybe.join(counts, "component").withColumnRenamed("node", "doc_id"), "maybe")
    sets = scratch.join_small(documents, maybe, "doc_id").select("doc_id", "text", "component", "n_blocks")
    sets = sets.mapInArrow(giving_back(_sets_of), "rep long, component long, n_blocks int, shingles binary")
    links = (
        _in_blocks(sets, "component")
        .select("cell", "rep", "shingles")
        .repartition("cell")
        .sortWithinPartitions("cell", "rep")
        .mapInArrow(giving_back(_verify), "a long, b long")
    )
    found = scratch.write(components(links.unionByName(same), scratch), "components")
    return signed.select("doc_id", F.col("n").cast("long").alias("n_shingles")).join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
