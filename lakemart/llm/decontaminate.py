"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words, over all documents.
2. Randomised SVD of the TF-IDF matrix A of all passages (overlapping windows of words): every task adds up
   its part of Z = A^T (A R) for a random R of a few more columns than wanted. From Z and R^T Z follow the eigenvectors of
   A^T A, the right singular vectors, without another pass over the texts; the leading ones are kept. What
   a passage has outside of them - its rare words - is kept as a random sketch of fixed
   length, without which passages of one language can hardly be told apart.
3. Every passage is compared with the benchmark by cosine of both parts. Items longer than a passage are cut into
   passages too, and shorter ones meet shorter passages, so that what is compared is of about one length. Runs
   of words that a document shares with an item make it a candidate as well: an item copied word by word is
   found whatever its length. Around a candidate the longest common subsequence of words with the item decides,
   with the item's answer (its last sentence) where words have been replaced.

The benchmark is the query set; it is taken in blocks of bounded size against all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.bpe import batch_of
from lakemart.llm.hashing import NOT_ALNUM, mix, slices, words
from lakemart.llm.tables import Scratch
from lakemart.llm.workers import giving_back

#: Hashed words, latent dimensions, further columns of the random matrix, dimensions of the rest, and words of half a
#: passage (passages overlap by half).
FEATURES, RANK, MORE, REST, HALF = 1 << 14, 32, 8, 64, 16
#: Least cosine of a candidate.
COSINE = 0.45
#: Share of an item's words that must recur in order: alone, or with the answer present.
OVERLAP, OVERLAP_WITH_ANSWER = 0.75, 0.6
#: Items of fewer words must recur whole, word by word; of longer ones, a run of so many words makes a candidate.
SHORT_ITEM = 8
#: Words of half a passage, and the items (of fewer words) that meet passages of that length.
LEVELS = [(HALF, None), (HALF // 2, 3 * HALF // 2), (HALF // 4, 3 * HALF // 4)]
#: Items held by a task at once: by number and by bytes of text.
ITEM_BLOCK, ITEM_BYTES = 4_096, 4 << 20
#: Slots of the table that answers most look-ups of runs of words.
SLOTS = 1 << 22
#: Bytes of text worked on at once, and features per row of a partial sum.
STEP, CHUNK_FEATURES = 1 << 18, 512

_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(50)).astype(np.int64)


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, word hashes and their text index for a few texts at a time."""
    for first, texts in slices(pc.utf8_lower(column), STEP):
        hashes, owner, _, _ = words(texts, NOT_ALNUM)
        yield first, len(texts), hashes, owner


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES, dtype=np.int64)
    n = 0
    for batch in batches:
        n += batch.num_rows
        for _, n_texts, hashes, owner in _tokens(batch.column("text")):
            f = _feature(hashes)
            # Sorted by 16 bits at once; texts stay in order within a feature, so a repeated word stands beside itself.
            order = np.argsort(f.astype(np.uint16), kind="stable")
            f, text = f[order], owner[order]
            first = np.concatenate(([True], (f[1:] != f[:-1]) | (text[1:] != text[:-1])))[: len(f)]
            total += np.bincount(f[first], minlength=FEATURES)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(total[used], n), pa.int64())], ["f", "n"]
    )


def _halves(owner: np.ndarray, half: int = HALF) -> np.ndarray:
    """First word of every half passage."""
    n = len(owner)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if n else np.zeros(0, np.int64)
    within = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    return np.flatnonzero(within % half == 0)


def _with_zero(table: np.ndarray) -> np.ndarray:
    """The rows of a table and one of zeros, for words that are not there."""
    return np.vstack((table, np.zeros((1, table.shape[1]), table.dtype)))


def _half_sums(padded: np.ndarray, f: np.ndarray, halves: np.ndarray, half: int) -> np.ndarray:
    """Rows of ``padded`` (a table ``_with_zero``) added up over the words of each half, one place in the half at a time."""
    sizes = np.diff(np.append(halves, len(f)))
    at = np.full((len(halves), half), len(padded) - 1)
    at[np.arange(half) < sizes[:, None]] = f
    sums = padded[at[:, 0]]
    for k in range(1, half):
        sums += padded[at[:, k]]
    return sums


def _passages(sums: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of two neighbouring halves of a text (of one, if it has no more), and their first half."""
    if not len(sums):
        return sums, np.zeros(0, np.int64)
    paired = np.append(owner[1:] == owner[:-1], False)
    alone = ~paired & np.concatenate(([True], owner[1:] != owner[:-1]))
    first = np.flatnonzero(paired | alone)
    out = sums[first]
    out[paired[first]] += sums[first[paired[first]] + 1]
    return out, first


def _directions() -> np.ndarray:
    """The random matrix R."""
    return np.random.default_rng(7).standard_normal((FEATURES, RANK + MORE), dtype=np.float32)


def _sketch(idf: np.ndarray):
    """Partial sums of A^T (A R), in rows of CHUNK_FEATURES features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _with_zero(_directions() * idf[:, None])
        total = np.zeros((FEATURES, RANK + MORE))
        for batch in batches:
            for _, _, hashes, owner in _tokens(batch.column("text")):
                if not len(hashes):
                    continue
                f, halves = _feature(hashes), _halves(owner)
                projected, first = _passages(_half_sums(table, f, halves, HALF), owner[halves])
                weights, _ = _passages(np.add.reduceat(idf[f] ** 2, halves), owner[halves])
                projected /= np.maximum(weights, 1e-9)[:, None]  # rows of A have length about one
                # A word counts in the one or two passages that hold its half.
                per_half = np.zeros((len(halves), RANK + MORE), dtype=np.float32)
                per_half[first] += projected
                paired = np.append(owner[halves][1:] == owner[halves][:-1], False)[first]
                per_half[first[paired] + 1] += projected[paired]
                half_of = np.repeat(np.arange(len(halves)), np.diff(np.append(halves, len(hashes))))
                # All words of a feature side by side are added up in one pass.
                order = np.argsort(f.astype(np.uint16), kind="stable")
                ordered = f[order]
                begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
                used = ordered[begin]
                # By column: the numbers that are added up then stand side by side in memory.
                columns = np.take(np.ascontiguousarray(per_half.T), half_of[order], axis=1)
                total[used] += np.add.reduceat(columns, begin, axis=1).T * idf[used, None]
        sums = total.astype(np.float32)
        rows = [(c, sums[c * CHUNK_FEATURES : (c + 1) * CHUNK_FEATURES].tobytes()) for c in range(FEATURES // CHUNK_FEATURES)]
        yield batch_of(rows, _PARTIAL)

    return run


_PARTIAL = pa.schema([("chunk", pa.int32()), ("sums", pa.binary())])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk and task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
            total[chunk] = total.get(chunk, 0.0) + np.frombuffer(data, np.float32).astype(np.float64)
    yield batch_of([(c, t.astype(np.float32).tobytes()) for c, t in sorted(total.items())], _PARTIAL)


def leading_directions(z: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The RANK leading eigenvectors of A^T A, from Z = A^T A R and R: those of Z (R^T Z)^-1 Z^T, which is A^T A
    as far as R sees it."""
    core = directions.T @ z
    core = (core + core.T) / 2
    # A little on the diagonal keeps directions that A lacks from being divided by nothing.
    core += np.eye(len(core)) * max(float(np.trace(core)), 1e-9) * 1e-9
    values, vectors = np.linalg.eigh(core)
    values = np.maximum(values, values.max() * 1e-9)
    root = z @ (vectors / np.sqrt(values))
    return np.linalg.svd(root + 1e-12 * np.random.default_rng(8).standard_normal(z.shape), full_matrices=False)[0][:, :RANK]


def fit_space(documents: DataFrame) -> np.ndarray:
    """The vector of every hashed word (FEATURES x (RANK + REST)), from all ``documents`` (text)."""
    texts = documents.select("text")
    counts, n = np.zeros(FEATURES), 0
    frequencies = texts.mapInArrow(giving_back(_frequencies), "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    for row in frequencies.collect():  # FEATURES rows at most, and one for the number of documents
        if row.f < 0:
            n = row.n
        else:
            counts[row.f] = row.n
    idf = np.log((n + 1) / (counts + 1)).astype(np.float32) + np.float32(1e-3)
    # Partial sums are added up in two steps, so no task adds those of all tasks.
    partial = texts.mapInArrow(giving_back(_sketch(idf)), "chunk int, sums binary")
    salted = partial.withColumn("salt", F.spark_partition_id() % 16).repartition("chunk", "salt").select("chunk", "sums")
    added = salted.mapInArrow(_add_up, "chunk int, sums binary").repartition("chunk").mapInArrow(_add_up, "chunk int, sums binary")
    z = np.zeros((FEATURES, RANK + MORE))
    for row in added.collect():  # FEATURES rows of numbers, whatever the corpus
        z[row.chunk * CHUNK_FEATURES : (row.chunk + 1) * CHUNK_FEATURES] += np.frombuffer(row.sums, np.float32).reshape(-1, RANK + MORE)
    basis = leading_directions(z, _directions().astype(np.float64))
    rest = np.random.default_rng(9).standard_normal((FEATURES, REST))
    rest -= basis @ (basis.T @ rest)
    # A sketch is longer than what it stands for by the root of its dimensions.
    return (np.hstack((basis * np.sqrt(REST), rest)) * idf[:, None]).astype(np.float32)


def _hashes(text: str) -> np.ndarray:
    return words([pc.utf8_lower(text).as_py().encode()], NOT_ALNUM)[0]


class Item:
    """A benchmark item: its words as bits, for subsequences, and its answer."""

    def __init__(self, item_id: int, text: str):
        self.item_id = item_id
        self.hashes = _hashes(text)
        self.n = len(self.hashes)
        self.bits: dict[int, int] = {}
        for i, h in enumerate(self.hashes.tolist()):
            self.bits[h] = self.bits.get(h, 0) | 1 << i
        answer = _SENTENCE.split(text.strip())[-1]
        self.answer = _hashes(answer).tolist()

    def overlap(self, region: list[int]) -> int:
        """Length of the longest common subsequence with a region's words."""
        full = (1 << self.n) - 1
        row = full
        for h in region:
            match = self.bits.get(h)
            if match:
                shared = row & match
                row = ((row + shared) | (row - shared)) & full
        return self.n - row.bit_count()

    def found_in(self, region: list[int]) -> float:
        """Share of the item found, 0 if that does not make a leak."""
        if self.n < SHORT_ITEM:
            return 1.0 if _holds(region, self.hashes.tolist()) else 0.0
        share = self.overlap(region) / self.n
        if share >= OVERLAP or share >= OVERLAP_WITH_ANSWER and len(self.answer) < self.n and _holds(region, self.answer):
            return share
        return 0.0


def _holds(region: list[int], part: list[int]) -> bool:
    return any(region[i : i + len(part)] == part for i in range(len(region) - len(part) + 1)) if part else False


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _runs(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words of one text."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = mix(total + hashes[k : k + n])
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return at, total[at]


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


class Index:
    """What makes an item a candidate: vectors of its passages, and hashes of its runs of words."""

    def __init__(self, table: np.ndarray, items: list[Item]):
        self.table, self.padded, self.n_items = table, _with_zero(table), len(items)
        self.levels = []  # words of half a passage, vectors, item of each vector
        for half, below in LEVELS:
            chosen = [k for k, i in enumerate(items) if i.n >= SHORT_ITEM and (below is None or i.n < below)]
            vectors, owner = [], []
            for k in chosen:
                hashes = items[k].hashes
                whole = np.zeros(len(hashes), np.int64)
                parts = self._vectors(hashes, whole, half)[0]
                if len(hashes) <= 4 * half:
                    parts = np.vstack((parts, table[_feature(hashes)].sum(axis=0)))
                vectors.append(parts)
                owner += [k] * len(parts)
            if chosen:
                self.levels.append((half, unit_rows(np.vstack(vectors)), np.array(owner)))
        self.runs = []  # words of a run, hashes in order, item of each, slots in use
        for size in sorted({min(i.n, SHORT_ITEM) for i in items}):
            chosen = [k for k, i in enumerate(items) if min(i.n, SHORT_ITEM) == size]
            found = [np.unique(_runs(items[k].hashes, np.zeros(items[k].n, np.int64), size)[1]) for k in chosen]
            hashes, owner = np.concatenate(found), np.repeat(chosen, [len(f) for f in found])
            order = np.argsort(hashes, kind="stable")
            table = np.zeros(SLOTS, dtype=bool)
            table[_slots(hashes)] = True
            self.runs.append((size, hashes[order], owner[order], table))

    def _vectors(self, hashes: np.ndarray, owner: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of the passages, and the first word of each."""
        halves = _halves(owner, half)
        passages, first = _passages(np.add.reduceat(self.table[_feature(hashes)], halves, axis=0), owner[halves])
        return passages, halves[first]

    def _passages_by_level(self, hashes: np.ndarray, owner: np.ndarray) -> Iterator[tuple]:
        """Unit vectors of the passages of every level, and their first words: words are added up once, for the
        shortest halves, of which longer ones are made."""
        finest = min(half for half, _, _ in self.levels)
        halves = _halves(owner, finest)
        sums, texts = _half_sums(self.padded, _feature(hashes), halves, finest), owner[halves]
        for half, space, item in self.levels:
            group = _halves(texts, half // finest)
            whole = _half_sums(_with_zero(sums), np.arange(len(sums)), group, half // finest) if half > finest else sums
            passages, first = _passages(whole, texts[group])
            yield space, item, unit_rows(passages), halves[group[first]]

    def _near(self, hashes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for space, item, passages, first in self._passages_by_level(hashes, owner) if self.levels else ():
            step = max(1, (1 << 22) // len(space))
            for at in range(0, len(passages), step):
                near = passages[at : at + step] @ space.T >= COSINE
                p, j = np.divmod(np.flatnonzero(near), len(space))
                yield first[p + at], item[j]
        for size, known, item, table in self.runs:
            at, run = _runs(hashes, owner, size)
            maybe = np.flatnonzero(table[_slots(run)])
            at, run = at[maybe], run[maybe]
            low = np.searchsorted(known, run)
            shared = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == run)
            low, n = low[shared], np.searchsorted(known, run[shared], side="right") - low[shared]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(at[shared], n), item[np.repeat(low, n) + within]

    def candidates(self, hashes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int]]:
        """(word, item): the item may stand around the word; each half passage is named once an item."""
        halves = _halves(owner)
        pairs = [
            np.unique((np.searchsorted(halves, word, side="right") - 1) * self.n_items + item)
            for word, item in self._near(hashes, owner)
        ]
        pairs = np.unique(np.concatenate(pairs))
        yield from zip(halves[pairs // self.n_items].tolist(), (pairs % self.n_items).tolist())


_LEAKS = pa.schema([("doc_id", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("overlap", pa.float64())])


class Searcher:
    """The items of a block with their index, made once in each task."""

    def __init__(self, table: np.ndarray, listed: list[tuple[int, str]]):
        self.items = [i for i in (Item(*x) for x in listed) if i.n]
        self.index = Index(table, self.items) if self.items else None

    def found_in(self, texts: pa.Array) -> Iterator[tuple[int, list[dict[int, float]]]]:
        """For runs of texts the first one, and the share found of each item that is in them."""
        for first_row, n_texts, hashes, owner in _tokens(texts):
            found: list[dict[int, float]] = [{} for _ in range(n_texts)]
            if self.index and len(hashes):
                bounds = np.searchsorted(owner, np.arange(n_texts + 1))
                for start, k in self.index.candidates(hashes, owner):
                    text, item = int(owner[start]), self.items[k]
                    known = found[text]
                    if known.get(item.item_id, 0.0) >= 1.0:
                        continue
                    low = max(int(bounds[text]), start - item.n)
                    region = hashes[low : min(int(bounds[text + 1]), start + 2 * HALF + item.n)].tolist()
                    share = item.found_in(region)
                    if share > known.get(item.item_id, 0.0):
                        known[item.item_id] = share
            yield first_row, found


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in lists of bounded size, of which the driver holds one at a time."""
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "item_id is not null and text is not null"
    )
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n_blocks = max(1, -(-size.n // ITEM_BLOCK), -(-size.b // ITEM_BYTES))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for k in range(n_blocks):
        yield [tuple(r) for r in asked.where(number == k).orderBy("item_id", "text").collect()]


def clean_documents(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` (text) that hold no benchmark item, with all their columns.

    Null and empty texts hold nothing and stay; so does every row if the benchmark is empty.
    """
    table = spark.sparkContext.broadcast(fit_space(documents))
    scratch = Scratch(spark, "clean")
    for number, listed in enumerate(_item_blocks(benchmark)):
        if number:
            # The rows left by the blocks before are written, so only this block is held.
            documents = scratch.write(documents, "left")
            block.unpersist()
        block = spark.sparkContext.broadcast(listed)

        def run(batches, block=block):
            searcher = Searcher(table.value, block.value)
            for batch in batches:
                found = [hits for _, part in searcher.found_in(batch.column("text")) for hits in part]
                yield batch.filter(pa.array([not hits for hits in found], pa.bool_()))

        documents = documents.mapInArrow(giving_back(run), documents.schema)
    return documents


def find_leaks(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_ids (ascending), overlap (largest share of an item found, 0 to 1) for every row of
    ``documents`` (doc_id, text); ``benchmark`` has item_id and text.

    Null and empty texts hold nothing; items that are null, without id or without a word are never found, and nothing is
    found of an empty benchmark. Rows
    are judged each on its own (with more than one block of items, rows of one doc_id share what is found).
    Repeated item_ids are reported once. Other columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = spark.sparkContext.broadcast(fit_space(documents))
    scratch = Scratch(spark, "leaks")
    ddl, found = "doc_id long, item_ids array<long>, overlap double", []
    for number, listed in enumerate(_item_blocks(benchmark)):
        if number:
            found[-1] = scratch.write(found[-1].where(F.size("item_ids") > 0), "found")
            block.unpersist()
        block = spark.sparkContext.broadcast(listed)

        def run(batches, block=block):
            searcher = Searcher(table.value, block.value)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for first, part in searcher.found_in(batch.column("text")):
                    rows = [(ids[first + t], sorted(hits), max(hits.values(), default=0.0)) for t, hits in enumerate(part)]
                    yield batch_of(rows, _LEAKS)

        found.append(documents.mapInArrow(giving_back(run), ddl))
    if len(found) == 1:
        return found[0]
    # Rows of several blocks meet again by document: only those with leaks, beside one row each.
    hits = reduce(DataFrame.unionByName, (f.where(F.size("item_ids") > 0) for f in found))
    merged = hits.groupBy("doc_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.max("overlap").alias("overlap")
    )
    none = F.array().cast("array<long>")
    a, b = documents.select("doc_id").alias("a"), merged.alias("b")
    return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), "left").select(
        "a.doc_id", F.coalesce("b.item_ids", none).alias("item_ids"), F.coalesce("b.overlap", F.lit(0.0)).alias("overlap")
    )
