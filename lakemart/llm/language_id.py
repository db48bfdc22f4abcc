"""Language identification by compression: the language whose sample shortens a text most.

Each language is a raw-content zstandard dictionary made of pieces of labelled texts. A text is compressed
in blocks with every dictionary, case and punctuation aside; the smallest total wins. Where the second smallest is close, the
row is marked as rejected.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakemart.llm.workers import giving_back

UNKNOWN = "und"
#: The bounded sample that the classifier is fitted on: texts per language, and bytes taken from the
#: middle of each. All other steps see every text whole.
SAMPLE_TEXTS, SAMPLE_BYTES = 192, 512
LEVEL = 5
#: Blocks of fewer bytes are searched for matches of three bytes on: a few words have few longer ones.
SHORT, SHORT_LEVEL = 512, 19
#: A text is compressed in blocks, so that its own repetitions do not outweigh the dictionaries.
BLOCK = 4_096
#: Rows that are taken out of a batch, and sent back, at once.
ROWS = 1_000
#: Least share by which the runner-up must be larger than the winner.
MARGIN = 0.005

_NO_LETTERS = re.compile(r"[\W\d_]+")
#: Word characters that are no letters either, and the space that stands for them: fractions, raised and circled numbers.
#: They are rare, and a pattern with so many characters is slow.
_NUMBERS = {c: " " for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}
_AS_SPACE = str.maketrans(_NUMBERS)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def plain(text: str) -> bytes:
    """Lower-case letters, with one space for everything between them."""
    found = _NO_LETTERS.sub(" ", text.lower())
    if not found.isascii() and not _NUMBERS.keys().isdisjoint(found):
        found = re.sub(" +", " ", found.translate(_AS_SPACE))
    return found.encode()


def is_held_out(doc_id: Column) -> Column:
    """Rows kept from the classifier: a quarter of the ids by checksum. Rows without id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(spark: SparkSession, labelled: DataFrame) -> dict[str, bytes]:
    """One dictionary per non-null lang of ``labelled`` (doc_id, text, lang); rows without doc_id are not used.

    The texts of a language are those first in order of a hash of their doc_id, of all its texts.
    """
    known = labelled.where("doc_id is not null and lang is not null and length(text) > 0")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.select("doc_id", "lang")
        .withColumn("k", F.row_number().over(first))
        .where(F.col("k") <= SAMPLE_TEXTS)
        .select("doc_id", "lang")
        .distinct()
    )
    size = F.octet_length("text")
    start = F.greatest(F.lit(1), ((size - SAMPLE_BYTES) / 2).cast("int"))
    # At most SAMPLE_TEXTS ids a language are sent out, and as many pieces come back.
    pieces = known.join(F.broadcast(chosen), ["doc_id", "lang"]).select(
        "lang", "doc_id", F.substring(F.encode("text", "utf-8"), start, F.lit(SAMPLE_BYTES)).alias("piece")
    )
    found: dict[str, list[bytes]] = {}
    for row in pieces.orderBy("lang", F.xxhash64("doc_id"), "piece").collect():
        found.setdefault(row.lang, []).append(plain(bytes(row.piece).decode(errors="ignore")))
    return {lang: b" ".join(parts) for lang, parts in sorted(found.items())}


class Compressors:
    """The compressors of one language: for blocks as a rule, and for short ones."""

    def __init__(self, sample: bytes):
        self._made = []
        for level in (SHORT_LEVEL, LEVEL):
            data = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self._made.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False))

    def size(self, blocks: list[bytes]) -> int:
        return sum(len(self._made[len(b) >= SHORT].compress(b)) for b in blocks)


@lru_cache(maxsize=2)
def compressors_of(dictionaries: tuple[tuple[str, bytes], ...]) -> list[tuple[str, Compressors]]:
    return [(lang, Compressors(sample)) for lang, sample in dictionaries]


def classify(text: str | None, compressors: list[tuple[str, Compressors]]) -> tuple[str, float, bool]:
    """Language, score (share of the runner-up's size that the winner saves) and whether it is rejected."""
    if not text or not compressors or not has_letter(text):
        return UNKNOWN, 0.0, True
    data = plain(text)
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = sorted((c.size(blocks), lang) for lang, c in compressors)
    best, lang = sizes[0]
    if len(sizes) == 1:
        return lang, 1.0, False
    second = sizes[1][0]
    return lang, 1.0 - best / second, second - best < MARGIN * best


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]
)


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def identify_languages(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), rejected for every row of ``documents`` (doc_id, text).

    A text that is null or has no letter is ``und``, score 0, rejected; so is every text if no language
    was learned. Ties go to the first language by name and are rejected. A null doc_id is kept, rows that
    share a doc_id are judged each on its own. Other columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(tuple(dictionaries.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = compressors_of(model.value)
        for batch in _in_parts(batches):
            found = [classify(t, compressors) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[k] for f in found], _SCHEMA.field(k + 1).type) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=_SCHEMA)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        giving_back(run), "doc_id long, lang_pred string, score double, rejected boolean"
    )


def accepted(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``documents`` (text) whose language is not rejected, with all their columns."""
    model = documents.sparkSession.sparkContext.broadcast(tuple(dictionaries.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = compressors_of(model.value)
        for batch in _in_parts(batches):
            rejected = [classify(t, compressors)[2] for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return documents.mapInArrow(giving_back(run), documents.schema)
