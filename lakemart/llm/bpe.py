"""Byte-level BPE encoding and decoding of documents, exactly as the tokenizer file defines it.

A text is cut where the tokenizer's splitting pattern always cuts: before a single space between two
characters that are no white space. The units between cuts are encoded by the library, each distinct one once per
task as a rule. Long text without such cuts is encoded as a tree: halves on their own, then a
growing window of tokens around each join is encoded again until its outermost tokens agree with both
sides. Neighbouring tokens of a BPE encoding determine its validity pair by pair, so a window that agrees
at both ends makes the joined sequence the encoding of the whole. Long documents are encoded in
pieces by different tasks.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from lakemart.llm.hashing import CHUNK
from lakemart.llm.tables import Scratch
from lakemart.llm.workers import giving_back

#: Characters of a unit above which it is encoded as a tree, and leaf size of the tree.
LONG_UNIT = 4_096
#: Characters of a document above which its pieces are encoded by different tasks.
PIECE = 65_536
#: Bytes, about, of the units of one generation; a task remembers the present and the last one.
REMEMBERED = 128 << 20
#: Bytes that a remembered unit takes besides its text and ids.
OVERHEAD = 200

_CUT = re.compile(r"(?<=\S)(?= \S)")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """The bytes of every id of one tokenizer file: all that decoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        tokens = {i: t for t, i in spec["model"]["vocab"].items()}
        tokens.update((t["id"], t["content"]) for t in spec.get("added_tokens") or [])
        byte_of = {letter: b for b, letter in enumerate(_byte_letters())}
        self.size = max(tokens, default=-1) + 1
        texts = (tokens.get(i, "") for i in range(self.size))
        self.bytes = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in texts]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 are replaced."""
        return self.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist()).decode("utf-8", errors="replace")


class Coder(Vocabulary):
    """Encodes with one tokenizer file, too."""

    def __init__(self, path: str):
        super().__init__(path)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._lengths = np.array([len(b) for b in self.bytes])
        self._letters = dict(enumerate(_byte_letters()))
        self._special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._split = re.compile("(" + "|".join(map(re.escape, self._special)) + ")") if self._special else None
        self.forget()

    def forget(self) -> None:
        """Free the memory of units."""
        self._spaced: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    @cached_property
    def _whole(self) -> Tokenizer:
        """The same merges without splitting or special tokens: encodes any bytes as one unit."""
        spec = json.loads(self.library.to_str())
        spec.update(added_tokens=[], normalizer=None, pre_tokenizer=None, post_processor=None, decoder=None)
        return Tokenizer.from_str(json.dumps(spec))

    def _library_ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _units_ids(self, words: list[str], joined: str) -> Iterator[tuple[str, bytes]]:
        """Each word and its ids with a space before it, from one call over all of them, joined by spaces."""
        data = self._library_ids([f" {joined}"])[0]
        ends = np.cumsum(self._lengths[np.frombuffer(data, dtype="<u4")])
        if joined.isascii():
            sizes = np.fromiter(map(len, words), np.int64, len(words))
        else:
            sizes = np.fromiter((len(w.encode()) for w in words), np.int64, len(words))
        cuts = (4 * (np.searchsorted(ends, np.cumsum(sizes + 1)) + 1)).tolist()
        return zip(words, map(data.__getitem__, map(slice, [0, *cuts[:-1]], cuts)))

    def _unit_ids(self, data: bytes) -> list[int]:
        return self._whole.encode(data.decode("latin-1").translate(self._letters), add_special_tokens=False).ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts of one unit, from their encodings."""
        if not left or not right:
            return left or right
        reach = 4
        while True:
            a, b = left[-reach:], right[:reach]
            window = self._unit_ids(self.decode_bytes([*a, *b]))
            agrees_left = reach >= len(left) or window[0] == a[0]
            agrees_right = reach >= len(right) or window[-1] == b[-1]
            if agrees_left and agrees_right:
                return [*left[:-reach], *window, *right[reach:]]
            reach *= 2

    def tree_ids(self, data: bytes) -> list[int]:
        """The encoding of one unit of any length."""
        parts = [self._unit_ids(data[i : i + LONG_UNIT]) for i in range(0, len(data), LONG_UNIT)] or [[]]
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def _long_ids(self, unit: str) -> bytes:
        ids: list[int] = []
        for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(unit):
            ids += self.tree_ids(unit[start:end].encode())
        return np.array(ids, dtype="<u4").tobytes()

    def _cut_ids(self, text: str) -> bytes:
        """Text with white space of any kind, cut where it certainly may be."""
        units = _CUT.split(text)
        short = iter(self._library_ids([u for u in units if len(u) <= LONG_UNIT]))
        return b"".join(self._long_ids(u) if len(u) > LONG_UNIT else next(short) for u in units)

    def _learn(self, words: list[str], joined: str) -> None:
        """Remember words that follow a single space."""
        if self._older:
            known = [w for w in words if w in self._older]
            if known:
                self._spaced.update(zip(known, map(self._older.__getitem__, known)))
                words = [w for w in words if w not in self._older]
                joined = " ".join(words)
        if len(joined) >= LONG_UNIT and max(map(len, words)) >= LONG_UNIT:
            self._spaced.update((w, self._long_ids(f" {w}")) for w in words if len(w) >= LONG_UNIT)
            words = [w for w in words if len(w) < LONG_UNIT]
            joined = " ".join(words)
        if words:
            self._spaced.update(self._units_ids(words, joined))

    def _plain_ids(self, text: str) -> bytes:
        """Text without special tokens."""
        first, *rest = text.split(" ")
        if self._held > REMEMBERED:
            self._older, self._spaced, self._held = self._spaced, {}, 0
        missing = list(set(rest).difference(self._spaced))
        joined = " ".join(missing)
        # Words next to more white space are never remembered, so such texts are found among the new words; where the
        # new words hold no white space at all there is none.
        if not first or first[-1].isspace():
            return self._cut_ids(text)
        if len(joined.split()) != len(missing) and any(not w or w[0].isspace() or w[-1].isspace() for w in missing):
            return self._cut_ids(text)
        if missing:
            self._learn(missing, joined)
            # A token has three or four bytes of text and takes four.
            self._held += 2 * len(joined) + OVERHEAD * len(missing)
        head = self._long_ids(first) if len(first) > LONG_UNIT else self._library_ids([first])[0]
        return b"".join([head, *map(self._spaced.__getitem__, rest)])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._split is None or not any(s in text for s in self._special):
            return self._plain_ids(text)
        return b"".join(
            np.array([self._special[p]], dtype="<u4").tobytes() if p in self._special else self._plain_ids(p)
            for p in self._split.split(text)
            if p
        )


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process and file."""
    return Vocabulary(path)


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder per worker process and file."""
    return Coder(path)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema
    )


def in_chunks(
    rows: Iterator[tuple], schema: pa.Schema, size_of: Callable[[tuple], int]
) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about CHUNK bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size > CHUNK:
            yield batch_of(held, schema)
            held, size = [], 0
    if held:
        yield batch_of(held, schema)


#: What becomes of a document's ids in the process that made them.
Finish = Callable[[bytes], bytes]


def as_made(ids: bytes) -> bytes:
    return ids


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_CODED_PIECE = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("k", pa.int32()), ("inside", pa.bool_()), ("ids", pa.binary())])


def _encode(path: str, finish: Finish):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        rows = (
            (doc_id, finish(code.encode(text or "")))
            for batch in batches
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
        )
        try:
            yield from in_chunks(rows, _ENCODED, lambda r: len(r[1]))
        finally:
            code.forget()  # the process serves other tasks next

    return run


def _pieces(path: str):
    """Cut long texts: at certain cuts where there are some, inside one unit where there are none."""

    def cut(text: str, code: Coder) -> Iterator[tuple[bool, bytes]]:
        held: list[str] = []
        size = 0
        for part in code._split.split(text) if code._split else [text]:
            for unit in [part] if part in code._special else _CUT.split(part):
                if size + len(unit) > PIECE and held:
                    yield False, "".join(held).encode()
                    held, size = [], 0
                if len(unit) <= PIECE:
                    held.append(unit)
                    size += len(unit)
                    continue
                for _, (start, end) in code.library.pre_tokenizer.pre_tokenize_str(unit):
                    data = unit[start:end].encode()
                    for at in range(0, len(data), PIECE):
                        yield True if at else None, data[at : at + PIECE]
        if held:
            yield False, "".join(held).encode()

    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("k", pa.int32()), ("inside", pa.bool_()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        rows = (
            (doc_id, digest, k, inside, data)
            for batch in batches
            for doc_id, digest, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "digest", "text")))
            for k, (inside, data) in enumerate(cut(text, code))
        )
        yield from in_chunks(rows, schema, lambda r: len(r[4]))

    return run


def _encode_pieces(path: str):
    """``inside``: NULL for the start of a unit cut up, true for its further parts, false for whole units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)

        def ids(inside, data: bytes) -> bytes:
            if inside is False:
                return code.encode(data.decode())
            return np.array(code.tree_ids(data), dtype="<u4").tobytes()

        rows = (
            (doc_id, digest, k, inside, ids(inside, data))
            for batch in batches
            for doc_id, digest, k, inside, data in zip(*(c.to_pylist() for c in batch.columns))
        )
        try:
            yield from in_chunks(rows, _CODED_PIECE, lambda r: len(r[4]))
        finally:
            code.forget()

    return run


def _join_pieces(path: str, finish: Finish):
    """Rows sorted by document and piece: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)

        def whole(parts: list[tuple]) -> bytes:
            joined: list[list[int]] = []
            for inside, ids in parts:
                new = np.frombuffer(ids, dtype="<u4").tolist()
                if inside and joined:
                    joined[-1] = code.join(joined[-1], new)
                else:
                    joined.append(new)
            return finish(b"".join(np.array(j, dtype="<u4").tobytes() for j in joined))

        def rows() -> Iterator[tuple]:
            key, parts = None, {}
            for batch in batches:
                for doc_id, digest, k, inside, ids in zip(*(c.to_pylist() for c in batch.columns)):
                    if (doc_id, digest) != key:
                        if parts:
                            yield *key, whole([parts[i] for i in sorted(parts)])
                        key, parts = (doc_id, digest), {}
                    parts[k] = (inside, ids)  # equal rows send equal pieces
            if parts:
                yield *key, whole([parts[i] for i in sorted(parts)])

        schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("ids", pa.binary())])
        yield from in_chunks(rows(), schema, lambda r: len(r[2]))

    return run


def encode_documents(spark: SparkSession, documents: DataFrame, path: str, finish: Finish = as_made) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) for every row of ``documents`` (doc_id, text).

    As the library encodes with add_special_tokens=False and without truncation or padding; ``path``
    names a tokenizer file of the byte-level kind, present on every executor. A null or empty text has no
    ids. A null doc_id is kept. Rows that share a doc_id are encoded each on its own. Other columns are
    ignored. ``finish`` is applied to every document's ids where they are made.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = F.length("text") > PIECE
    short = documents.where(~F.coalesce(long, F.lit(False))).mapInArrow(giving_back(_encode(path, finish)), "doc_id long, ids binary")
    scratch = Scratch(spark, "bpe")
    texts = documents.where(long).withColumn("digest", F.sha2("text", 256))
    coded = scratch.write(
        texts.select("doc_id", "digest", "text")
        .mapInArrow(giving_back(_pieces(path)), "doc_id long, digest string, k int, inside boolean, data binary")
        .repartition("doc_id", "digest", "k")
        .mapInArrow(giving_back(_encode_pieces(path)), "doc_id long, digest string, k int, inside boolean, ids binary"),
        "pieces",
    )
    whole = (
        coded.repartition("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest")
        .mapInArrow(giving_back(_join_pieces(path, finish)), "doc_id long, digest string, ids binary")
    )
    a, b = texts.select("doc_id", "digest").alias("a"), whole.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.digest") == F.col("b.digest"))
    return short.unionByName(a.join(b, same).select("a.doc_id", "b.ids"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with ``text``, as the library's decode(ids,
    skip_special_tokens=False); null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])
        rows = (
            (doc_id, ids, known.decode(ids or b""))
            for batch in batches
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist())
        )
        yield from in_chunks(rows, schema, lambda r: len(r[2]))

    return encoded.select("doc_id", "ids").mapInArrow(giving_back(run), "doc_id long, ids binary, text string")
