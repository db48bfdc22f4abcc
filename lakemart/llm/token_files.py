"""Token ids as compressed files: canonical length-limited Huffman codes in independent blocks.

Layout of a written folder, both tables written and read by Spark, so any store it reaches will do:

* ``codebook``: id, length. The lengths alone fix the canonical codes.
* ``blocks``: part, block, doc_ids, n_tokens, byte_starts, checkpoints, payload. A block holds whole
  documents in order; each starts at a byte of the payload, and has the bit offset of every
  ``CHECKPOINT``-th of its ids, from which decoding can start. Parts are ascending ranges of
  doc_id, blocks ascend within a part.

Ids are counted over the whole corpus first; the driver gets one count per vocabulary entry.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakemart.llm.bpe import encode_documents, in_chunks, vocabulary
from lakemart.llm.tables import Scratch

#: Longest code in bits, ids between checkpoints, and ids after which a block is closed.
MAX_BITS, CHECKPOINT, BLOCK = 20, 256, 1 << 16
#: Ids decoded together: bounds the memory of a task.
TOGETHER = 1 << 19

_U = np.uint64


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Length-limited Huffman lengths by merging pairs level by level; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    is_leaf, level = [], leaves
    for _ in range(most - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        place = np.argsort(both, kind="stable")
        is_leaf.append(place < len(leaves))
        level = both[place]
    # The first 2n - 2 items of the last level, traced back to the leaves they hold.
    need = 2 * len(used) - 2
    for flags in [*reversed(is_leaf), np.ones(len(leaves), dtype=bool)]:
        chosen = int(flags[:need].sum())
        lengths[order[:chosen]] += 1
        need = 2 * (need - chosen)
        if not need:
            break
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    if len(order):
        spans = _U(1) << (_U(MAX_BITS) - lengths[order].astype(np.uint64))
        firsts = np.concatenate(([_U(0)], np.cumsum(spans)[:-1]))
        codes[order] = firsts >> (_U(MAX_BITS) - lengths[order].astype(np.uint64))
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The id and the length for every value of the next MAX_BITS bits."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    ids, bits = np.repeat(order, spans), np.repeat(lengths[order], spans)
    short = (1 << MAX_BITS) - len(ids)
    return np.pad(ids, (0, short)).astype(np.uint32), np.pad(bits, (0, short)).astype(np.int64)


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of a document's ids, most significant first, and its checkpoints."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    starts = ends - n
    shifted = codes[ids] << (_U(64) - n.astype(np.uint64) - (starts & 31).astype(np.uint64))
    word = starts >> 5
    size = int(ends[-1] + 31 >> 5) + 1
    # Bits never overlap, so sums below 2^32 are exact.
    out = np.bincount(word, weights=(shifted >> _U(32)).astype(np.float64), minlength=size)
    out[1:] += np.bincount(word, weights=(shifted & _U(0xFFFFFFFF)).astype(np.float64), minlength=size)[:-1]
    data = out.astype(np.uint64).astype(">u4").tobytes()
    return data[: int(ends[-1] + 7 >> 3)], starts[::CHECKPOINT]


def unpack(payload: bytes, offsets: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of runs of at most CHECKPOINT ids, each from its bit offset; all runs advance together."""
    if not len(offsets):
        return np.zeros(0, dtype=np.uint32)
    words = np.frombuffer(payload + b"\0" * (16 - len(payload) % 4), dtype=">u4").astype(np.uint64)
    pairs = (words[:-1] << _U(32)) | words[1:]
    ids, bits = table
    out = np.zeros((CHECKPOINT, len(offsets)), dtype=np.uint32)
    order = np.argsort(-counts, kind="stable")
    at, left = offsets[order].copy(), counts[order]
    for step in range(int(left[0])):
        alive = int(np.searchsorted(-left, -step, side="left"))
        now = at[:alive]
        peek = (pairs[now >> 5] >> (_U(64 - MAX_BITS) - (now & 31).astype(np.uint64))) & _U((1 << MAX_BITS) - 1)
        peek = peek.astype(np.int64)
        out[step, :alive] = ids[peek]
        now += bits[peek]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out.T[back][np.arange(CHECKPOINT) < counts[:, None]]


def _narrow(kind: str, end_id: int):
    """Ids with the end id, in two bytes each where the vocabulary allows."""
    tail = np.array([end_id], dtype=kind).tobytes()

    def finish(ids: bytes) -> bytes:
        return np.frombuffer(ids, "<u4").astype(kind).tobytes() + tail

    return finish


def _count(size: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])

    return run


_CODED = pa.schema(
    [("part", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("payload", pa.binary()), ("points", pa.list_(pa.int64()))]
)
_BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("byte_starts", pa.list_(pa.int64())),
        ("checkpoints", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
_BLOCK_DDL = (
    "part int, block long, doc_ids array<long>, n_tokens array<long>, byte_starts array<long>, "
    "checkpoints array<long>, payload binary"
)


def _code(lengths: np.ndarray, bounds: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                    ids = np.frombuffer(data, kind)
                    payload, points = pack(ids, codes, lengths)
                    part = 0 if doc_id is None else 1 + int(np.searchsorted(bounds, doc_id, side="right"))
                    yield part, doc_id, len(ids), payload, points

        yield from in_chunks(rows(), _CODED, lambda r: len(r[3]) + 8 * len(r[4]) + 64)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents sorted by part and doc_id: runs of them as blocks, numbered within their part."""

    def closed(key: tuple[int, int], held: list[tuple]) -> tuple:
        sizes = [len(r[2]) for r in held]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        points = np.concatenate([np.asarray(r[3]) + 8 * s for r, s in zip(held, starts)])
        return *key, [r[0] for r in held], [r[1] for r in held], starts, points, b"".join(r[2] for r in held)

    def rows() -> Iterator[tuple]:
        part, block, held, size = None, 0, [], 0
        for batch in batches:
            for p, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (p != part or size >= BLOCK):
                    yield closed((part, block), held)
                    block, held, size = block + 1 if p == part else 0, [], 0
                elif p != part:
                    block = 0
                part = p
                held.append(row)
                size += row[1]
        if held:
            yield closed((part, block), held)

    yield from in_chunks(rows(), _BLOCK, lambda r: len(r[6]) + 64 * len(r[2]))


def write_token_files(spark: SparkSession, documents: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> None:
    """Encode ``documents`` (doc_id, text) and write them to ``folder`` in ascending doc_id order.

    Every document gets ``end_id`` after its ids, so a null or empty text is one id. Rows without doc_id
    come first; rows that share a doc_id follow each other in order of their number of ids and coded
    bytes. Other columns are ignored. An empty table writes no blocks.
    """
    scratch = Scratch(spark, "token-files")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = vocabulary(tokenizer).size
    kind = "<u2" if size <= 1 << 16 else "<u4"
    ids = encode_documents(spark, documents, tokenizer, _narrow(kind, end_id))
    ids = scratch.write(ids, "ids", compression="zstd")
    counts = np.zeros(size, dtype=np.int64)
    # At most one row per entry of the vocabulary.
    for row in ids.mapInArrow(_count(size, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    lengths = code_lengths(counts)
    used = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(used, "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [k / parts for k in range(1, parts)] or [0.5]
    bounds = documents.agg(F.percentile_approx("doc_id", cuts, 100 * parts)).first()[0] or []
    coded = ids.mapInArrow(
        _code(lengths, np.unique(np.array(bounds, dtype=np.int64)), kind),
        "part int, doc_id long, n long, payload binary, points array<long>",
    )
    coded.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "n", "payload").mapInArrow(
        _blocks, _BLOCK_DDL
    ).write.option("compression", "none").parquet(f"{folder}/blocks")
    scratch.drop(ids)


def _decode(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

        def decoded(blocks: list[dict]) -> Iterator[tuple]:
            counts = [np.asarray(b["n_tokens"]) for b in blocks]
            runs = np.concatenate([-(-c // CHECKPOINT) for c in counts])
            tokens = np.concatenate(counts)
            sizes = np.full(int(runs.sum()), CHECKPOINT)
            sizes[np.cumsum(runs) - 1] = tokens - (runs - 1) * CHECKPOINT
            shifts = np.concatenate(([0], np.cumsum([len(b["payload"]) for b in blocks])[:-1])) * 8
            offsets = np.concatenate([np.asarray(b["checkpoints"]) + s for b, s in zip(blocks, shifts)])
            ids = unpack(b"".join(b["payload"] for b in blocks), offsets, sizes, table).astype("<u4").tobytes()
            at = 0
            for b, count in zip(blocks, counts):
                start = b["block_start"]
                for doc_id, n in zip(b["doc_ids"], count.tolist()):
                    yield doc_id, start, ids[at : at + 4 * n]
                    at += 4 * n
                    start += n

        def rows() -> Iterator[tuple]:
            held, size = [], 0
            for batch in batches:
                for block in batch.to_pylist():
                    held.append(block)
                    size += sum(block["n_tokens"])
                    if size >= TOGETHER:
                        yield from decoded(held)
                        held, size = [], 0
            if held:
                yield from decoded(held)

        yield from in_chunks(rows(), schema, lambda r: len(r[2]) + 32)

    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids: every document of the files."""
    book = spark.read.schema("id long, length int").parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max((r.id for r in book), default=0) + 1, dtype=np.uint8)
    for row in book:
        lengths[row.id] = row.length
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{folder}/blocks")
    sized = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: as many as the write had partitions.
    parts = sized.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    starts = (
        sized.withColumn("block_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(parts, "part")
        .select("part", "block", (F.col("part_start") + F.col("block_start")).alias("block_start"))
    )
    # Where each block starts travels with its coded bytes, not with the ids of its documents.
    scratch = Scratch(spark, "token-starts")
    placed = scratch.join_small(blocks, scratch.write(starts, "starts"), ["part", "block"])
    return placed.select("block_start", "doc_ids", "n_tokens", "checkpoints", "payload").mapInArrow(
        _decode(lengths), "doc_id long, start long, ids binary"
    )
