"""Suffix-array dedup: every byte covered by a 100-byte string that also starts earlier is removed.

A suffix array of the whole corpus would ship each byte a hundred times, so windows that cannot repeat are
left out first. The key of a window is the smallest hash of its 32-byte grams, the same for equal windows
wherever they stand; windows that follow each other with one key make a segment.

1. The most frequent grams become a list of bounded size that is ordered last, so a common short line
   does not become the key of the windows around it.
2. Keys of all segments are counted; those of one segment only cannot hold a repeated window.
3. The bytes of the other segments meet by key, equal segments as one row. Segments of many keys are
   sorted together by a two-stage suffix sort; adjacent common prefixes of 100 bytes are repeated windows.
4. Removed spans of a document are merged and cut out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.bpe import batch_of, in_chunks
from lakemart.llm.hashing import _BYTE, byte_lists, mix, powers, slices
from lakemart.llm.suffix_array import equal_to_previous, suffix_array
from lakemart.llm.tables import Scratch

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1
#: Entries of the list of frequent grams, and of each step's contribution to it.
FREQUENT, FREQUENT_PER_STEP, OFTEN = 65_536, 2_048, 3
#: Bytes that are suffix-sorted together; a single key may have more.
SORTED_TOGETHER = 1 << 21
#: Bytes whose grams are hashed at once: the arrays of a step, eight bytes for each, stay in a core's cache.
HASHED = 1 << 17
#: Bytes of segments among which a task combines equal ones.
COMBINED = 1 << 25

_U = np.uint64


def _grams(buffer: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, 63 bits."""
    up, down = powers(len(buffer))
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buffer] * up[: len(buffer)], out=sums[1:])
    n = max(0, len(buffer) - GRAM + 1)
    return mix((sums[GRAM:] - sums[:-GRAM]) * down[:n]) >> _U(1) if n else np.zeros(0, np.uint64)


def _over_windows(values: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """The smallest (or largest) value of the WINDOW positions from each one."""
    best, span = values, 1
    while span * 2 <= WINDOW:
        best = pick(best[:-span], best[span:])
        span *= 2
    rest = WINDOW - span
    return pick(best[: len(best) - rest], best[rest:]) if rest else best


def _holds_key_twice(grams: np.ndarray, keys: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For segments of n windows from ``begin`` whether their key is a gram of two places: only then can they
    hold the same window twice."""
    edge = np.zeros(WINDOW - 1, dtype=np.uint64)
    smallest = np.flatnonzero(_over_windows(np.concatenate((edge, keys, edge)), np.maximum) == grams)
    values, index = np.unique(grams[smallest], return_inverse=True)
    places = np.sort(index << 40 | smallest)
    mine = np.searchsorted(values, keys[begin]) << 40
    at = np.searchsorted(places, mine | begin) + 1
    return (at < len(places)) & (places[np.minimum(at, len(places) - 1)] <= (mine | (begin + n + WINDOW - 2)))


class _Frequent:
    """Membership in the list of frequent grams, mostly answered by a table of bits."""

    def __init__(self, listed: np.ndarray):
        self.listed = listed
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[(listed & _U((1 << 22) - 1)).astype(np.int64)] = True

    def last(self, grams: np.ndarray) -> np.ndarray:
        """The grams with the frequent ones after all others."""
        maybe = np.flatnonzero(self.table[(grams & _U((1 << 22) - 1)).astype(np.int64)])
        if not len(maybe):
            return grams
        found = grams[maybe]
        hit = self.listed[np.minimum(np.searchsorted(self.listed, found), len(self.listed) - 1)] == found
        grams[maybe[hit]] |= _U(1 << 63)
        return grams


def _segments(texts: list[bytes], frequent: _Frequent | None, ask_twice: bool = True) -> tuple[np.ndarray, ...]:
    """Text index, key, first window and number of windows of every segment, and whether it may hold a window
    twice (none if not asked); and the texts' grams and offsets."""
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    grams = _grams(np.frombuffer(b"".join(texts), dtype=np.uint8))
    if frequent is not None:
        grams = frequent.last(grams)
    if len(grams) < WINDOW:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty.astype(np.uint64), empty, empty, empty.astype(bool), grams, offsets
    keys = _over_windows(grams, np.minimum)
    counts = np.maximum(0, sizes - LENGTH + 1)
    # Segments begin where the key changes, and at the first window of a text; those past its last window lie in no text.
    edges = np.concatenate((np.flatnonzero(keys[1:] != keys[:-1]) + 1, offsets[:-1], offsets[:-1] + counts))
    start = np.unique(edges[edges < len(keys)])
    n = np.diff(np.append(start, len(keys)))
    owner = np.searchsorted(offsets, start, side="right") - 1
    inside = start - offsets[owner] < counts[owner]
    start, n, owner = start[inside], n[inside], owner[inside]
    twice = _holds_key_twice(grams, keys, start, n) if ask_twice else np.zeros(len(start), dtype=bool)
    return owner, keys[start], start - offsets[owner], n, twice, grams, offsets


def _runs(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs of about HASHED bytes; long ones alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > HASHED:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _count_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in slices(batch.column("text")):
            parts, before = [], 0
            for run in _runs(texts):
                owner, keys, first, n, _, grams, offsets = _segments(run, None, ask_twice=False)
                if len(keys):
                    parts.append((keys, first + offsets[owner] + before, n, grams))
                    before += len(grams)
            if not parts:
                continue
            keys, begin, n, grams = map(np.concatenate, zip(*parts))
            _, index, counts = np.unique(keys, return_inverse=True, return_counts=True)
            hot = counts[index] >= OFTEN
            # All grams around keys that come often, not only those that happen to be smallest.
            steps = np.zeros(len(grams) + 1, dtype=np.int64)
            np.add.at(steps, begin[hot], 1)
            np.add.at(steps, begin[hot] + n[hot] + WINDOW - 1, -1)
            values, times = np.unique(grams[np.cumsum(steps[:-1]) > 0], return_counts=True)
            often = np.flatnonzero(times >= OFTEN)
            if len(often) > FREQUENT_PER_STEP:
                often = often[np.argpartition(-times[often], FREQUENT_PER_STEP)[:FREQUENT_PER_STEP]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(times[often], pa.int64())], ["h", "n"]
            )


_SEGMENT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("tag", pa.int64()),
        ("h", pa.int64()),
        ("first", pa.int64()),
        ("n", pa.int64()),
        ("twice", pa.bool_()),
    ]
)


def _list_segments(listed: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _Frequent(listed) if len(listed) else None
        for batch in batches:
            ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            for at, texts in slices(batch.column("text"), HASHED):
                owner, keys, first, n, twice, _, _ = _segments(texts, frequent)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[owner + at], pa.int64()),
                        pa.array(tags[owner + at], pa.int64()),
                        pa.array(keys.view(np.int64)),
                        pa.array(first, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(twice),
                    ],
                    schema=_SEGMENT,
                )

    return run


_BYTES = pa.schema(
    [
        ("h", pa.int64()),
        ("d1", pa.int64()),
        ("d2", pa.int64()),
        ("doc_id", pa.int64()),
        ("tag", pa.int64()),
        ("first", pa.int64()),
        ("end", pa.int64()),
        ("data", pa.binary()),
    ]
)
_BYTES_DDL = "h long, d1 long, d2 long, doc_id long, tag long, first long, end long, data binary"


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted segments, equal ones once for COMBINED bytes of them: the earliest, with its data.

    The others are covered whole, wherever the earliest of all stands, and come without data.
    """

    def rows() -> Iterator[tuple]:
        held: dict[tuple[int, int, int], tuple] = {}
        size = 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "tag")]
            wanted = batch.column("wanted")
            parts = [wanted.flatten().field(n).to_pylist() for n in ("h", "first", "n")]
            ends = pc.list_value_length(wanted).to_numpy(zero_copy_only=False).cumsum().tolist()
            for doc_id, tag, a, b, text in zip(*columns, [0, *ends[:-1]], ends, byte_lists(batch.column("text"))):
                for h, first, n in zip(*(p[a:b] for p in parts)):
                    end = first + n + LENGTH - 1
                    data = text[first:end]
                    key = (h, *struct.unpack("<qq", hashlib.blake2b(data, digest_size=16).digest()))
                    place = (doc_id, tag, first)
                    known = held.get(key)
                    if known is None:
                        held[key] = (*place, end, data)
                        size += len(data)
                    elif place != known[:3]:
                        early, late = sorted((known[:4], (*place, end)))
                        held[key] = (*early, data)
                        yield *key, *late, None
                    if size > COMBINED:
                        yield from ((*k, *v) for k, v in held.items())
                        held, size = {}, 0
        yield from ((*k, *v) for k, v in held.items())

    yield from in_chunks(rows(), _BYTES, lambda r: len(r[7] or b"") + 64)


_SPAN = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def repeated_spans(segments: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """Spans (doc_id, tag, start, end) covered by windows of LENGTH bytes that start earlier in another
    of the segments (doc_id, tag, first, data), or earlier in the same one."""
    doc_id, tag, first, data = zip(*segments) if segments else ((), (), (), ())
    places = [np.array(x, dtype=np.int64) for x in (doc_id, tag, first)]
    return list(zip(*(x.tolist() for x in _repeated(*places, pa.array(data, pa.large_binary())))))


def _repeated(doc_id: np.ndarray, tag: np.ndarray, first: np.ndarray, data: pa.LargeBinaryArray) -> tuple[np.ndarray, ...]:
    """The same for segments by columns: the columns of the spans."""
    by_place = np.lexsort((first, tag, doc_id))
    doc_id, tag, first = doc_id[by_place], tag[by_place], first[by_place]
    other = (doc_id[1:] != doc_id[:-1]) | (tag[1:] != tag[:-1])
    last = np.append(other | (first[1:] != first[:-1]), len(first) > 0)[: len(first)]
    by_place, doc_id, tag, first = by_place[last], doc_id[last], tag[last], first[last]
    ordered = data.take(pa.array(by_place))
    sizes = pc.binary_length(ordered).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    joined = np.frombuffer(b"".join(ordered.to_pylist()), dtype=np.uint8)
    steps = np.zeros(len(joined) + 1, dtype=np.int8)
    steps[starts] += 1
    steps[ends - LENGTH + 1] -= 1
    is_window = np.cumsum(steps[:-1], dtype=np.int8).view(bool)
    order = suffix_array(joined, LENGTH)
    order = order[is_window[order]]
    new = ~equal_to_previous(joined, order, LENGTH)
    # Buffer order is the order of places but for overlapping segments of one text: rank the places themselves.
    owner = np.repeat(np.arange(len(sizes)), sizes)
    document = np.cumsum(np.concatenate(([True], (doc_id[1:] != doc_id[:-1]) | (tag[1:] != tag[:-1])))[: len(sizes)])
    shared = ~new | np.append(~new[1:], False)[: len(new)]  # windows that stand alone repeat nothing
    order, group = order[shared], np.cumsum(new)[shared]
    mine = owner[order]
    rank = np.lexsort((order - starts[mine] + first[mine], document[mine], group))
    earliest = np.concatenate(([True], group[rank][1:] != group[rank][:-1])) if len(rank) else np.zeros(0, bool)
    repeated = np.zeros(len(joined) + 1, dtype=bool)
    repeated[order[rank[~earliest]]] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([0], repeated.view(np.int8)))))
    a, b = edges[::2], edges[1::2]
    mine = owner[a]
    at = a - starts[mine] + first[mine]
    return doc_id[mine], tag[mine], at, at + b - a + LENGTH - 1


def _spans(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SPAN)


def _sort_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, digest and place: copies are covered whole, the earliest of each go on, and as many
    whole keys as fit are sorted at once."""
    held: list[tuple] = []
    size, key, digest, earliest = 0, None, None, (0, 0, 0)

    def sorted_together() -> pa.RecordBatch:
        *places, data = zip(*held)
        return _spans(*_repeated(*map(np.concatenate, places), pa.concat_arrays(data)))

    for batch in batches:
        if not batch.num_rows:
            continue
        h, d1, d2, *place, end = (batch.column(n).to_numpy() for n in ("h", "d1", "d2", "doc_id", "tag", "first", "end"))
        new = np.ones(len(h), dtype=bool)
        new[0] = (h[0], d1[0], d2[0]) != digest
        new[1:] = (h[1:] != h[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        digest = h[-1], d1[-1], d2[-1]
        # The first row of each digest is its earliest place; that of the batch's first rows may have come before.
        at = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
        first_of = [np.where(at < 0, e, p[at]) for e, p in zip(earliest, place)]
        earliest = tuple(f[-1] for f in first_of)
        later = ~new & np.any([p != f for p, f in zip(place, first_of)], axis=0)
        if later.any():
            yield _spans(*(p[later] for p in place), end[later])
        fresh = np.flatnonzero(new)
        if not len(fresh):
            continue
        place = [p[fresh] for p in place]
        data = batch.column("data").take(pa.array(fresh)).cast(pa.large_binary())
        bytes_to = np.concatenate(([0], np.cumsum(pc.binary_length(data).to_numpy(zero_copy_only=False))))
        keys = h[fresh]
        cuts = np.flatnonzero(np.concatenate(([keys[0] != key], keys[1:] != keys[:-1])))
        key, done = keys[-1], 0
        for cut in cuts.tolist():
            if size + bytes_to[cut] - bytes_to[done] >= SORTED_TOGETHER:
                if cut > done:
                    held.append((*(p[done:cut] for p in place), data[done:cut]))
                yield sorted_together()
                held, size, done = [], 0, cut
        held.append((*(p[done:] for p in place), data[done:]))
        size += bytes_to[-1] - bytes_to[done]
    if held:
        yield sorted_together()


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for doc_id, spans, text in zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist(), byte_lists(batch.column("text"))):
                merged: list[dict] = []
                for s in sorted(spans or [], key=lambda s: s["start"]):
                    if merged and s["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                    else:
                        merged.append(dict(s))
                at, parts = 0, []
                for s in merged:
                    parts.append(text[at : s["start"]])
                    at = s["end"]
                yield doc_id, len(text), merged, b"".join([*parts, text[at:]])

    yield from in_chunks(rows(), schema, lambda r: len(r[3]) + 64)


def dedup_substrings(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs of bytes, ascending), kept (the other bytes), one row per
    row of ``documents`` (doc_id, text).

    A null text counts as empty. Rows without doc_id remove nothing and keep all. Rows that share a doc_id are
    ordered by a hash of their text, equal ones are one document. Other columns are ignored.
    """
    scratch = Scratch(spark, "suffix")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = documents.select("text").mapInArrow(_count_frequent, "h long, n long")
    top = counted.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").collect()
    listed = np.sort(np.array([r.h for r in top], dtype=np.int64).view(np.uint64))
    tagged = documents.where("doc_id is not null").withColumn("tag", F.xxhash64("text"))

    segments = scratch.write(
        tagged.where(F.octet_length("text") >= LENGTH)
        .select("doc_id", "tag", "text")
        .mapInArrow(_list_segments(listed), "doc_id long, tag long, h long, first long, n long, twice boolean"),
        "segments",
        compression="zstd",
    )
    weight = F.when(F.col("twice"), 2).otherwise(1)
    often = scratch.write(segments.groupBy("h").agg(F.sum(weight).alias("c")).where("c > 1").select("h"), "often")
    scratch.release()
    # Both lists grow with the corpus: they meet by a shuffle at every size.
    wanted = scratch.write(
        segments.join(often.hint("merge"), "h")
        .groupBy("doc_id", "tag")
        .agg(F.collect_set(F.struct("h", "first", "n")).alias("wanted")),
        "wanted",
    )
    scratch.drop(segments)
    scratch.release()
    cut = tagged.join(wanted.hint("merge"), ["doc_id", "tag"]).select("doc_id", "tag", "text", "wanted")
    cut = scratch.write(cut.mapInArrow(_cut_segments, _BYTES_DDL), "bytes", compression="zstd")
    scratch.drop(wanted)
    scratch.release()
    later = cut.where("data is null").select("doc_id", "tag", F.col("first").alias("start"), "end")
    found = (
        cut.where("data is not null")
        .repartition("h")
        .sortWithinPartitions("h", "d1", "d2", "doc_id", "tag", "first")
        .mapInArrow(_sort_keys, "doc_id long, tag long, start long, end long")
    )
    spans = scratch.write(
        later.unionByName(found).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans"
    )
    scratch.drop(cut)
    scratch.release()
    tags = documents.withColumn("tag", F.xxhash64("text"))
    # Spans grow with the corpus too, so this join shuffles at every size.
    return tags.join(spans.hint("merge"), ["doc_id", "tag"], "left").select("doc_id", "text", "spans").mapInArrow(
        _without, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )
