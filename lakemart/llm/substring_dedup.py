"""Substring dedup by hashing units of text: the earliest of equal units stays.

Units are paragraphs or lines, or sentences. Sentences can also be looked up within lines: they find passages that
are set into other lines. A unit's digest covers its ASCII-lower-case bytes with white space collapsed. Digests are counted, and the
smallest place of each repeated one is found, by aggregates that combine map-side, so a line in a third of
all documents costs one row per task.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.hashing import byte_lists
from lakemart.llm.tables import Scratch

#: Units of fewer words are left alone: they repeat by chance. Sentences within lines repeat sooner than whole lines.
MIN_WORDS, MIN_WITHIN = 5, 8

_ENDS = {
    "sentence": re.compile(rb"[.!?][ \t]+|\n"),
    "line": re.compile(rb"\n"),
    "paragraph": re.compile(rb"\n[ \t\r]*(?:\n[ \t\r]*)+"),
}


def unit_spans(text: bytes, unit: str) -> list[tuple[int, int]]:
    """Byte spans of the units, each with the break that ends it; they cover the text."""
    cuts = [m.end() for m in _ENDS[unit].finditer(text)]
    return [(a, b) for a, b in zip([0, *cuts], [*cuts, len(text)]) if b > a]


def _digests(levels: Sequence[tuple[str, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Places and digests of the units of every level (unit, least number of words)."""

    def spans(text: bytes) -> Iterator[tuple[int, int, int]]:
        coarser: set[tuple[int, int]] = set()
        for unit, least in levels:
            found = unit_spans(text, unit)
            yield from ((a, b, least) for a, b in found if (a, b) not in coarser)
            coarser.update(found if len(levels) > 1 else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_lists(batch.column("text"))):
                for start, end, least in spans(text):
                    found = text[start:end].lower().split()
                    if len(found) >= least:
                        digest = hashlib.blake2b(b" ".join(found), digest_size=16).digest()
                        out.append((doc_id, start, end, *struct.unpack("<qq", digest)))
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(5)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "end", "d1", "d2"])

    return run


def _outermost(spans: list[dict]) -> list[dict]:
    """Spans in order, without those inside another."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if not out or s["end"] > out[-1]["end"]:
            out.append(s)
    return out


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the spans out of the texts."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [None if cut is None else _outermost(cut) for cut in batch.column("removed").to_pylist()]
        kept = []
        for text, valid, cut in zip(byte_lists(batch.column("text")), batch.column("text").is_valid().to_pylist(), spans):
            at, parts = 0, []
            for s in cut or []:
                parts.append(text[at : s["start"]])
                at = s["end"]
            kept.append(b"".join([*parts, text[at:]]).decode() if valid else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(kept, pa.string()), pa.array(spans, kind)], ["doc_id", "text", "removed"]
        )


def dedup_units(
    spark: SparkSession,
    documents: DataFrame,
    unit: str = "sentence",
    min_words: int = MIN_WORDS,
    within: Sequence[tuple[str, int]] = (),
) -> DataFrame:
    """doc_id, text (without the removed units), removed (their spans in bytes of the given text).

    One row per row of ``documents`` (doc_id, text). Units are ranked by doc_id, then by place; all
    but the first of equal units go. ``within`` adds finer units (unit, least number of words) that go where the unit around
    them stays; a span inside another is not listed. Null texts stay null. Rows without doc_id have no rank: they
    remove nothing and keep all. Rows that share a doc_id hold one rank and treat equal places alike.
    Other columns are ignored.
    """
    scratch = Scratch(spark, "units")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    units = scratch.write(
        documents.where("doc_id is not null and text is not null").mapInArrow(
            _digests([(unit, min_words), *within]), "doc_id long, start long, end long, d1 long, d2 long"
        ),
        "units",
    )
    digest = ["d1", "d2"]
    # These lists grow with the corpus: they meet by a shuffle at every size.
    often = scratch.write(units.groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(digest), "often")
    repeats = scratch.write(units.join(often.hint("merge"), digest), "repeats")
    firsts = scratch.write(repeats.groupBy(digest).agg(F.min(F.struct("doc_id", "start")).alias("first")), "firsts")
    later = repeats.join(firsts.hint("merge"), digest).where("doc_id <> first.doc_id or start <> first.start")
    spans = scratch.write(
        later.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed")), "spans"
    )
    return documents.join(spans.hint("merge"), "doc_id", "left").mapInArrow(
        _without, "doc_id long, text string, removed array<struct<start: long, end: long>>"
    )
