"""Product codes of vectors: each part of a vector becomes the number of its nearest codebook entry.

Which entries can be nearest is remembered for coarse grid cells. A part falls into the box of cells of ``CELL`` units a
side; an entry whose smallest distance to the box is above another entry's largest one is nearest nowhere in it. The
others are kept for the box, and only they are compared with the parts that fall into it, in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.hashing import mix
from lakemart.llm.tables import Scratch

#: Steps of a component, parts of a vector, entries of a codebook, rounds of training.
STEPS, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Units of a cell's side, a power of two.
CELL = 16
#: Cells remembered by a task for one part of the vectors; they are dropped together when there are more.
REMEMBERED = 1 << 16
#: Part-entry pairs compared at once: bounds the memory of a task.
TOGETHER = 1 << 20
#: Components from here on, in absolute value, would not leave room for exact 64-bit distances.
MOST = float(1 << 14)

#: A codebook: entries x components. Parts may differ in length where the vectors do not divide evenly.
Codebook = np.ndarray


def part_bounds(width: int) -> np.ndarray:
    """First component of each part, and the end: equal parts where the width allows."""
    return np.arange(PARTS + 1) * width // PARTS


class Cells:
    """The entries of one codebook that may be nearest, by cell."""

    def __init__(self, book: Codebook):
        self.book = book
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.corners = np.zeros((0, self.book.shape[1]), np.int64)
        self.firsts = np.zeros(1, np.int64)
        self.entries = np.zeros(0, np.int64)

    def _undominated(self, corners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries in ascending order for each box, and how many."""
        counts, found = [], []
        step = max(1, TOGETHER // (len(self.book) * max(1, self.book.shape[1])))
        for at in range(0, len(corners), step):
            low = corners[at : at + step, None, :] * CELL
            below, above = low - self.book, self.book - (low + CELL - 1)
            nearest = np.maximum(np.maximum(below, above), 0)
            farthest = np.maximum(np.abs(below), np.abs(above))
            least, most = (nearest * nearest).sum(-1), (farthest * farthest).sum(-1)
            box, entry = np.nonzero(least <= most.min(1, keepdims=True))
            counts.append(np.bincount(box, minlength=len(low)))
            found.append(entry)
        return np.concatenate(counts), np.concatenate(found)

    def _learn(self, keys: np.ndarray, corners: np.ndarray) -> None:
        if len(self.keys) + len(keys) > REMEMBERED:
            self.forget()
        counts, found = self._undominated(corners)
        slots = len(self.corners) + np.arange(len(keys))
        self.corners = np.concatenate((self.corners, corners))
        self.firsts = np.concatenate((self.firsts, self.firsts[-1] + np.cumsum(counts)))
        self.entries = np.concatenate((self.entries, found))
        order = np.argsort(both := np.concatenate((self.keys, keys)), kind="stable")
        self.keys, self.slots = both[order], np.concatenate((self.slots, slots))[order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part, the lower one on ties, and its squared distance."""
        corners = np.floor_divide(parts, CELL)
        keys = np.full(len(parts), 1, np.uint64)
        for column in corners.T:
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
        distinct, one, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > REMEMBERED:
                known[:] = False
            self._learn(distinct[~known], corners[one[~known]])
            at = np.searchsorted(self.keys, distinct)
        slots = self.slots[at][back]
        index, best = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        sizes = self.firsts[slots + 1] - self.firsts[slots]
        ends = np.cumsum(sizes)
        cut = 0
        while cut < len(parts):
            stop = max(cut + 1, int(np.searchsorted(ends, ends[cut] - sizes[cut] + TOGETHER // max(1, parts.shape[1]), side="right")))
            mine = np.arange(cut, min(stop, len(parts)))
            n = sizes[mine]
            starts = np.cumsum(n) - n
            entry = self.entries[np.arange(int(n.sum())) + np.repeat(self.firsts[slots[mine]] - starts, n)]
            apart = np.repeat(parts[mine], n, axis=0) - self.book[entry]
            distance = (apart * apart).sum(-1)
            least = np.minimum.reduceat(distance, starts)
            # Entries ascend within a part, so the first that reaches the least is the lower index.
            hits = np.flatnonzero(distance == np.repeat(least, n))
            index[mine] = entry[hits[np.searchsorted(hits, starts)]]
            best[mine] = least
            cut = int(mine[-1]) + 1
        # Two cells of one hash: compare with every entry.
        wrong = np.flatnonzero((self.corners[slots] != corners).any(-1))
        for k in wrong:
            apart = parts[k] - self.book
            distance = (apart * apart).sum(-1)
            index[k], best[k] = int(distance.argmin()), int(distance.min())
        return index, best


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as whole numbers, one a row."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * STEPS).astype(np.int64).reshape(len(column), width)


def _sums(width: int, books: list[Codebook]):
    """Per task: for every component of every entry that has parts, their sum and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, cells = part_bounds(width), [Cells(b) for b in books]
        total = np.zeros((len(books[0]) if books else 0, width), np.int64)
        count = np.zeros((len(total), PARTS), np.int64)
        for batch in batches:
            rows = _whole(batch.column("embedding"), width)
            for p in range(PARTS):
                parts = rows[:, bounds[p] : bounds[p + 1]]
                index, _ = cells[p].nearest(parts)
                count[:, p] += np.bincount(index, minlength=len(total))
                for d in range(parts.shape[1]):
                    # Sums of whole numbers below 2^53 are exact as doubles.
                    total[:, bounds[p] + d] += np.bincount(index, weights=parts[:, d], minlength=len(total)).astype(np.int64)
        entry, at = np.nonzero(np.repeat(count, np.diff(bounds), axis=1))
        part = np.searchsorted(bounds, at, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (entry, at, total[entry, at], count[entry, part])], ["entry", "at", "total", "n"]
        )

    return run


def _codes(width: int, books: list[Codebook]):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, cells = part_bounds(width), [Cells(b) for b in books]
        digits = np.array([f"{i:02x}" for i in range(ENTRIES)])
        for batch in batches:
            rows = _whole(batch.column("embedding"), width)
            found = [cells[p].nearest(rows[:, bounds[p] : bounds[p + 1]]) for p in range(PARTS)]
            letters = digits[np.stack([i for i, _ in found], axis=1)]
            codes = np.ascontiguousarray(letters).view(f"<U{2 * PARTS}").ravel() if len(rows) else []
            error = sum(e for _, e in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error)], schema=schema
            )

    return run


def _trained(vectors: DataFrame, width: int, books: list[Codebook]) -> list[Codebook]:
    """Codebooks after one round: each entry the mean of its parts, rounded down."""
    sums = vectors.mapInArrow(_sums(width, books), "entry long, at long, total long, n long")
    bounds = part_bounds(width)
    books = [b.copy() for b in books]
    # One row per component of an entry, whatever the number of vectors.
    for r in sums.groupBy("entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        part = int(np.searchsorted(bounds, r["at"], side="right")) - 1
        books[part][r["entry"], r["at"] - bounds[part]] = r["total"] // r["n"]
    return books


def compress_vectors(spark: SparkSession, vectors: DataFrame) -> tuple[DataFrame, list[Codebook]]:
    """(vec_id, label as string, code, error) for the rows of ``vectors`` (vec_id, embedding, label), and the codebooks.

    Components are whole numbers floor(256 x). Left out are vectors that are null or hold null, infinite or
    NaN components; also those with components of 2^14 or more, whose distances would not fit 64 bits, and those of
    another length than the first one's. The codebooks begin as the parts of the 64 smallest vec_id, or of all where
    there are fewer; rows that share a vec_id are ordered by their components, and rows without one are coded but begin
    no codebook. Lengths that 16 does not divide give parts that differ by one component, empty ones included. Repeated
    rows count each. Without any vec_id there are no rows and empty codebooks. Other columns are ignored.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= MOST))
    kept = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label")
    ).where(F.col("embedding").isNotNull() & ~bad)
    by_id = kept.where("vec_id is not null").orderBy("vec_id", "embedding")
    width = by_id.select(F.size("embedding")).limit(1).collect()
    first = by_id.where(F.size("embedding") == (width[0][0] if width else 0)).limit(ENTRIES).collect()
    width = width[0][0] if width else 0
    kept = kept.where(F.size("embedding") == width)
    bounds = part_bounds(width)
    begin = np.floor(np.array([r.embedding for r in first], np.float64).reshape(len(first), width) * STEPS).astype(np.int64)
    books = [begin[:, a:b] for a, b in zip(bounds, bounds[1:])]
    if not first:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), books
    for _ in range(ROUNDS):
        books = _trained(kept, width, books)
    return kept.mapInArrow(_codes(width, books), "vec_id long, label string, code string, error long"), books


def decompress_vectors(codes: DataFrame, books: list[Codebook]) -> DataFrame:
    """``codes`` with ``embedding``: the components of the entries that the codes name."""

    def entry(code, part: int):
        at = F.conv(F.substring(code, 2 * part + 1, 2), 16, 10).cast("int")
        return F.array(*[F.array(*[F.lit(int(x) / STEPS) for x in e]).cast("array<double>") for e in books[part]])[at]

    return codes.withColumn("embedding", F.concat(*[entry(F.col("code"), p) for p in range(len(books))]))


def books_digest(books: list[Codebook]) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def code_report(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: codes with the error of all vectors that share a label.

    Null labels are one label. Errors of labels are summed in each task before they are sent, and a label's sum is
    joined from a written table, so a label may hold any share of the vectors.
    """
    scratch = Scratch(spark, "vector-codes")
    coded, books = compress_vectors(spark, vectors)
    coded = scratch.write(coded, "codes")
    sums = scratch.write(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    return scratch.join_small(coded, sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
