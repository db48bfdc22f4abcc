"""Edge cases of each operator on small hand-made frames."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm import bpe, embedding_dedup, jaccard_join, suffix_dedup, token_files
from lakemart.llm.components import components
from lakemart.llm.decontaminate import Item, clean_documents, find_leaks
from lakemart.llm.language_id import accepted, has_letter, identify_languages, learn, plain
from lakemart.llm.license_scan import known_licenses, scan_licenses
from lakemart.llm.line_dedup import dedup_lines
from lakemart.llm.queries import TOKENIZER
from lakemart.llm.substring_dedup import dedup_units
from lakemart.llm.suffix_array import suffix_array
from lakemart.llm.tables import Scratch
from tests_llm_helpers import groups, shingles

WORDS = [f"word{i}" for i in range(400)]
CLASHING = "doc_id long, text string, h long, n int, tag string, rep string, component string, k int, cell string, removed string, ids string, digest string"


def text_of(seed, n, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture
def docs(frame):
    """Rows with columns that have the names of an operator's own."""

    def make(*rows):
        return frame(CLASHING, *((i, t, 1, 2, "a", None, "c", None, "d", "e", "f", None) for i, t in rows))

    return make


@pytest.fixture
def odd(docs):
    """Null and empty texts, white space, a missing id, a repeated row, and an id with two texts."""
    long = text_of(1, 80)
    return docs((1, long), (2, None), (3, ""), (4, " \n\t "), (None, long), (None, None), (5, long), (5, long), (6, "a"), (6, text_of(2, 60)))


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# op1


@pytest.fixture
def vectors(frame):
    return lambda *rows: frame("vec_id long, embedding array<float>, label int, cell long, w int", *((i, v, 0, 1, 2) for i, v in rows))


def test_embedding_edge_cases(spark, vectors):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [1.0, None]), (9, []), (10, [1.0, 0.0, 0.0]), (11, [0.0, -1.0]), (None, [1.0, 0.0]), (12, [0.95, 0.3]),
    ]
    found = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.embedding_groups(spark, vectors(*rows)).collect()}
    assert len(found) == len(rows)
    assert found[1] == (3, 1, True) and found[2] == (3, 1, False) and found[12] == (3, 1, False)
    for alone in (4, 5, 6, 7, 8, 9, 10, 11):
        assert found[alone] == (0, alone, True)
    assert found[None][0] == 0


def test_embedding_empty_and_threshold(spark, vectors):
    assert embedding_dedup.embedding_groups(spark, vectors()).count() == 0
    exact = [(1, [1.0, 0.0]), (2, [0.9, float(np.sqrt(1 - 0.81))])]
    assert {r.n_links for r in embedding_dedup.embedding_groups(spark, vectors(*exact), threshold=0.899).collect()} == {1}
    assert {r.n_links for r in embedding_dedup.embedding_groups(spark, vectors(*exact), threshold=0.901).collect()} == {0}


def test_embedding_blocks_and_pivots_lose_no_link(spark, vectors, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    points = [c + rng.normal(size=6) * s for c in centres for s in (0.02, 0.2, 0.5) for _ in range(8)]
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "AT_ONCE", 7)
    df = vectors(*((i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)))
    found = {r.vec_id: r.n_links for r in embedding_dedup.embedding_groups(spark, df).collect()}
    x = np.array(points, dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.9).sum(axis=1) - 1
    assert [found[i] for i in range(len(points))] == want.tolist() and want.max() > 5


def test_embedding_pairs_far_from_the_threshold_take_single_precision(monkeypatch):
    rng = np.random.default_rng(6)
    around = rng.normal(size=64)
    close = [around / np.linalg.norm(around) + rng.normal(size=64) * 0.06 for _ in range(200)]
    angle = np.arccos(0.9)
    at_threshold = [np.eye(64)[0] * np.cos(angle * k) + np.eye(64)[1] * np.sin(angle * k) for k in range(4)]
    points = [*rng.normal(size=(600, 64)), *close, *at_threshold]
    data, ids = [p.tobytes() for p in points], list(range(len(points)))
    exact, together = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: exact.append(len(a)) or together(how, a, b))
    monkeypatch.setattr(embedding_dedup, "TOGETHER", 3)
    block = embedding_dedup._Block(0.9)
    block.add(ids, [1] * len(ids), data)
    edges = [e for i in range(0, len(ids), 256) for e in block.meet(ids[i : i + 256], [1] * len(ids[i : i + 256]), data[i : i + 256])]
    x = np.array([p / np.abs(p).max() for p in points])
    cosines = np.array([[a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) for b in x] for a in x])
    want = (cosines >= 0.9) & ~np.eye(len(x), dtype=bool)
    assert block.counts() == list(zip(ids, want.sum(axis=1).tolist())) and 0 < want[600:].sum() < 200 * 200
    smallest = np.array(ids)
    for _ in range(50):
        for a, b in edges:
            smallest[[a, b]] = min(smallest[a], smallest[b])
    assert all(smallest[i] == smallest[want[i]].min(initial=i) for i in ids)
    assert 6 <= sum(exact) <= 0.01 * len(x) ** 2 and max(exact) <= 3


# op2


def test_jaccard_edge_cases(spark, odd):
    found = as_rows(jaccard_join.jaccard_groups(spark, odd), "doc_id", "n_shingles", "component_id")
    want = [(1, 76, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (None, 76, None), (None, 0, None), (5, 76, 1), (5, 76, 1), (6, 1, 6), (6, 56, 6)]
    assert found == sorted(want, key=repr)


def test_jaccard_empty_table_and_short_texts(spark, docs):
    assert jaccard_join.jaccard_groups(spark, docs()).count() == 0
    found = as_rows(jaccard_join.jaccard_groups(spark, docs((1, "A b"), (2, "a  B"), (3, "a b c"), (4, "b a"))), "doc_id", "component_id")
    assert found == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_jaccard_blocks_and_classes_lose_no_link(spark, docs, monkeypatch):
    """Near-copies of several sizes, a common line, and blocks far smaller than the groups."""
    rng, rows = random.Random(9), []
    line = " ".join(WORDS[:12])
    for base in range(12):
        words = text_of(base, rng.choice([30, 62, 130, 300])).split()
        for _ in range(rng.choice([1, 4, 20])):
            copy = list(words)
            for _ in range(rng.randrange(1 + len(words) // 45)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
            rows.append((len(rows) + 1, f"{' '.join(copy)} {line}"))
    for name in ("CELL_BLOCK", "SET_BLOCK"):
        monkeypatch.setattr(jaccard_join, name, 3)
    found = dict(as_rows(jaccard_join.jaccard_groups(spark, docs(*rows)), "doc_id", "component_id"))
    assert found == groups({i: shingles(t) for i, t in rows})


def test_jaccard_cells_of_millions(spark, frame):
    many = spark.range(1 << 21).select(F.col("id").alias("doc_id"), F.explode(F.array(F.lit(6), F.lit(5)).cast("array<long>")).alias("key"))
    few = frame("doc_id long, key long", (1, 7), (1, 7), (2, 7), (3, 8), (3, 8), (2, 8), (4, 9))
    found = {r.key: r.n_blocks for r in jaccard_join._cells(many.unionByName(few)).collect()}
    assert found == {5: (1 << 21) // jaccard_join.CELL_BLOCK, 7: 1, 8: 1}


def test_jaccard_sends_no_points_of_sets_without_another_in_reach(frame):
    met = frame("cell long, rep long, n int", *((7, i, n) for i, n in enumerate([100, 79, 80, 126, 300, 300, 10, 1])), (8, 8, 100))
    rows = [(r.rep, r.size_class) for r in jaccard_join._in_classes(met).collect()]
    # 80 meets 100 in the class of the larger, 100 meets neither 79 nor 126, 300 its equal in both classes.
    assert sorted(rows) == [(0, 6), (1, 6), (2, 6), (4, 8), (5, 8)]
    sizes = [*range(1, 40), 4095, 4096, 4097, 5119, 5120, 5121]
    pairs = {(a, b) for a in range(len(sizes)) for b in range(a) if 10 * sizes[b] >= 8 * sizes[a]}
    for a, b in pairs:
        left, right = ({*jaccard_join._classes(sizes[i])} for i in (a, b))
        two = frame("cell long, rep long, n int", (1, a, sizes[a]), (1, b, sizes[b])) if a > 38 else None
        assert left & right and (two is None or {r.size_class for r in jaccard_join._in_classes(two).collect()} == left & right)


def test_jaccard_cells_shuffle_little(frame):
    keyed = jaccard_join._keyed(frame("doc_id long, n int, keys array<long>", (1, 2, [-1, 1 << 40]), (2, 1, None)))
    assert sorted(tuple(r) for r in keyed.collect()) == [(1, 2, 1 << 24), (1, 2, (1 << 48) - 1)]
    sums = re.findall(r"partial_(\w+)", jaccard_join._cells(keyed)._jdf.queryExecution().executedPlan().toString().split("partial_count")[-1])
    assert sums == ["sum", "sum"]


def test_jaccard_limit_is_included(spark, docs):
    a = [f"w{i}" for i in range(22)]  # 18 shingles, 16 of them shared with 18: 16 / 20
    b = a[:20] + ["x", "y"]
    assert as_rows(jaccard_join.jaccard_groups(spark, docs((1, " ".join(a)), (2, " ".join(b)))), "component_id") == [(1,), (1,)]


# op3


def spans(df):
    return {r.doc_id: [(s.start, s.end) for s in r.spans] for r in df.collect()}


def test_suffix_edge_cases(spark, odd):
    found = suffix_dedup.dedup_substrings(spark, odd).collect()
    assert len(found) == 10
    n = len(text_of(1, 80))
    removed = sorted((r.doc_id or 0, r.n_bytes - len(r.kept)) for r in found)
    assert removed == sorted([(1, 0), (2, 0), (3, 0), (4, 0), (0, 0), (0, 0), (5, n), (5, n), (6, 0), (6, 0)])


def test_suffix_empty_and_repetitive(spark, docs):
    assert suffix_dedup.dedup_substrings(spark, docs()).count() == 0
    found = spans(suffix_dedup.dedup_substrings(spark, docs((1, "a" * 500), (2, "ab" * 60), (3, "a" * 99), (4, "é" * 60))))
    assert found == {1: [(1, 500)], 2: [(2, 120)], 3: [], 4: [(2, 120)]}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([b"ab", b"a", b"abcdefg", b"xyzxyzw"]), st.integers(100, 400), st.integers(0, 9)), min_size=1, max_size=6))
def test_repeated_spans_by_brute_force(parts):
    texts = [bytes(random.Random(seed).choice(letters) for _ in range(n // 2)) * 2 for letters, n, seed in parts]
    texts = [t for t in texts if len(t) >= 100]
    found = suffix_dedup.repeated_spans([(i, 0, 0, t) for i, t in enumerate(texts)])
    covered = [set() for _ in texts]
    for i, _, start, end in found:
        covered[i].update(range(start, end))
    seen = set()
    for i, t in enumerate(texts):
        want = set()
        for at in range(len(t) - 99):
            if t[at : at + 100] in seen:
                want.update(range(at, at + 100))
            seen.add(t[at : at + 100])
        assert covered[i] == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([1, 2, 3, 255]), min_size=1, max_size=200), st.sampled_from([8, 24, 100]))
def test_suffix_array_is_sorted(values, depth):
    data = bytes(values)
    order = suffix_array(np.frombuffer(data, np.uint8), depth).tolist()
    assert sorted(order) == list(range(len(data)))
    assert [data[i : i + depth] for i in order] == sorted(data[i : i + depth] for i in order)


# op4


def test_license_forms(spark, docs):
    mit = "Copyright (c) 2020 Someone\n\nPermission is hereby granted"
    rows = docs(
        (1, "Released under the MIT Licence!"), (2, "text\n * released under  the MIT license\nmore"), (3, None), (4, ""),
        (5, "released under the MIT"), (6, "© X\nReleased under the MIT License."), (None, mit), (7, "same"), (7, "same"),
    )
    found = {r.doc_id: r for r in scan_licenses(rows, known_licenses(spark)).collect()}
    assert found[1].license_id == found[6].license_id == "MIT"
    assert found[2].license_id is None and found[2].notices == ["MIT"] and found[2].n_notices == 1
    assert [found[i].license_id for i in (3, 4, 5, None)] == [None] * 4
    assert found[3].canonical_sha256 == hashlib.sha256(b"").hexdigest() and found[7].n_rows == 2
    assert scan_licenses(docs(), known_licenses(spark)).count() == 0


def test_known_licenses_match_themselves(spark):
    known = known_licenses(spark)
    own = known.select(F.monotonically_increasing_id().alias("doc_id"), F.upper(F.regexp_replace("text", "\n", "  ")).alias("text"), "license_id")
    found = {r.doc_id: r.license_id for r in scan_licenses(own, known).collect()}
    assert all(found[r.doc_id] == r.license_id for r in own.collect())


def test_whole_licenses_titled_and_reflowed(spark, docs):
    import re
    import textwrap
    from pathlib import Path

    from lakemart.llm import license_scan

    texts = {f.name.removesuffix(".txt").removesuffix(".regents"): f.read_text() for f in Path(license_scan.__file__).with_name("licenses").glob("*.txt")}
    texts |= {i: t for i, t in license_scan._NOTICES if "\n\n" in t}
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= set(texts)
    rows, want = [], []
    for name, text in texts.items():
        titled = f"{license_scan._TITLES.get(name, [''])[-1]}\n\nCopyright (c) 2021, Some One\nAll rights reserved.\n\n{text}"
        forms = [text, f"Copyright 2020 Some One\n\n{text}"] + [titled] * (name in license_scan._TITLES)
        for width in range(24, 110, 7):
            lines = [p if re.search(r"(?i)\(c\)\s+([\d<_]|year)|\[yyyy", p) else textwrap.fill(p, width, break_long_words=False) for p in text.split("\n\n")]
            forms.append("\n\n".join(lines))
        for form in forms:
            want.append((len(rows), name))
            rows.append((len(rows), form))
    found = {r.doc_id: r.license_id for r in scan_licenses(docs(*rows), known_licenses(spark)).collect()}
    assert [(i, n, found[i]) for i, n in want if found[i] != n] == []
    prose = docs((1, "copyright holders be liable"), (2, "(c) you must retain"), (3, "Copyright The Some Authors\nReleased under the MIT License"), (4, "Copyright: Some One\nReleased under the MIT License"))
    found = {r.doc_id: r for r in scan_licenses(prose, known_licenses(spark)).collect()}
    assert found[1].canonical_sha256 == hashlib.sha256(b"copyright owner be liable").hexdigest()
    assert found[2].canonical_sha256 == hashlib.sha256(b"c you must retain").hexdigest()
    assert found[3].license_id == found[4].license_id == "MIT"


# op5, op6


def test_units(spark, docs):
    line = "one two three four five"
    rows = docs((2, f"{line}\nown text of number two here"), (1, f"Own text first. {line.upper()}\nshort one"), (3, None), (4, ""), (None, line), (5, "short one"))
    found = {r.doc_id: r for r in dedup_units(spark, rows).collect()}
    assert found[2].text == "own text of number two here" and [(s.start, s.end) for s in found[2].removed] == [(0, 24)]
    assert found[1].removed is None and found[None].text == line and found[5].text == "short one"
    assert found[3].text is None and found[4].text == ""
    assert dedup_units(spark, docs()).count() == 0


def test_units_of_paragraphs(spark, docs):
    part = "one two three\nfour five six"
    found = {r.doc_id: r.text for r in dedup_units(spark, docs((1, f"{part}\n\nend of the first text here"), (2, f"start of the second text here\n\n{part}")), unit="paragraph").collect()}
    assert found == {1: f"{part}\n\nend of the first text here", 2: "start of the second text here\n\n"}


def test_line_chunks_survive_shifts(spark, docs):
    block = "\n".join(text_of(k, 6) for k in range(40))
    rows = docs((1, block), (2, f"a new first line\n{block}"), (3, None), (4, ""), (None, block), (5, "x"), (6, block), (6, block))
    result = dedup_lines(spark, rows, carry=("tag",)).collect()
    found = {r.doc_id: r for r in result}
    assert len(result) == 8 and found[1].text == block and found[None].text == block
    assert len(found[2].text) < len(block) / 2 and found[2].text.startswith("a new first line")
    assert found[3].text is None and found[3].n_chunks == 0 and found[4].text == "" and found[5].tag == "a"
    assert all(len(c.text) < len(block) / 4 for c in result if c.doc_id == 6)
    assert dedup_lines(spark, docs()).count() == 0


def test_line_copies_leave_nothing(spark, docs, frame):
    """Exact copies of texts of several lines, in the pipeline's stage; no two texts share lines."""
    import corpus_pipeline

    texts = {k: "\n".join(text_of(500 * k + j, 6) for j in range(2 + k)) for k in range(30)}
    rows = [(i + 100 * copy, t, "en", "x", len(t)) for copy in range(2) for i, t in texts.items()]
    kept = corpus_pipeline.line_dedup(spark, frame("doc_id long, text string, lang string, source string, n_chars long", *rows), "")
    assert {r.doc_id: r.text for r in kept.collect()} == texts
    inserted = f"{texts[29]}\nan added last line"
    found = {r.doc_id: r for r in dedup_lines(spark, docs((1, texts[29]), (2, inserted), (3, None), (4, ""), (5, "x"), (6, "x")), paired=True).collect()}
    assert found[1].text == texts[29] and found[2].text.endswith("an added last line") and len(found[2].text) < len(inserted) / 2
    assert found[3].text is None and [found[i].text for i in (4, 5, 6)] == ["", "x", "x"]


# op7


def test_languages(spark, docs, frame):
    english, other = "the and of that which there ".split(), "der und das nicht aber schon ".split()
    labelled = frame("doc_id long, text string, lang string", *((i, text_of(i, 60, english if i % 2 else other), "en" if i % 2 else "de") for i in range(60)), (99, None, "fr"), (100, "x", None))
    model = learn(spark, labelled)
    assert list(model) == ["de", "en"]
    rows = docs((1, "THE, AND of that"), (2, "und das nicht"), (3, None), (4, ""), (5, "12 34 !"), (None, "which there"), (6, "there " * 9000))
    found = {r.doc_id: r for r in identify_languages(rows, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, 5, None, 6)] == ["en", "de", "und", "und", "und", "en", "en"]
    assert found[3].score == 0 and found[3].rejected and not found[1].rejected
    assert {r.doc_id for r in accepted(rows, model).collect()} == {1, 2, None, 6}
    assert {r.lang_pred for r in identify_languages(rows, {}).collect()} == {"und"}
    assert identify_languages(docs(), model).count() == 0


def test_numbers_are_no_letters():
    assert not any(map(has_letter, ("½ ² ①", "12 ٣", "_", "", "!"))) and all(map(has_letter, ("a", "½x", "日", "é")))
    assert plain("½Ab①c_D² e") == b" ab c d e"


# op8, op10


LIBRARY = Tokenizer.from_file(TOKENIZER)
PARTS = ["a", "the ", " ", "  ", "\n", "\t", "é", "日本", "<|endoftext|>", "'s", "12", "!?", "\x1c", "aaaa", "==", "😀", " ", " x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60))
def test_encoding_equals_the_library(parts):
    coder, text = bpe.coder(TOKENIZER), "".join(parts)
    before, bpe.LONG_UNIT = bpe.LONG_UNIT, 8
    try:
        found = coder.encode(text)
    finally:
        bpe.LONG_UNIT = before
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(found, "<u4").tolist() == ids
    assert coder.decode(found) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_long_texts_in_pieces(spark, docs, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 300)
    monkeypatch.setattr(bpe, "LONG_UNIT", 50)
    rng = random.Random(4)
    texts = [text_of(3, 900), "a" * 2000, "".join(rng.choice("abcde") for _ in range(3000)), "x  y" * 400 + "<|endoftext|>" * 30, "日本語" * 500, None, ""]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[1])]
    encoded = bpe.encode_documents(spark, docs(*rows), TOKENIZER)
    found = sorted(((-1 if r.doc_id is None else r.doc_id), bytes(r.ids), r.text) for r in bpe.decode_documents(encoded, TOKENIZER).collect())
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((-1 if i is None else i, np.array(ids, "<u4").tobytes(), t or ""))
    assert found == sorted(want)
    assert bpe.encode_documents(spark, docs(), TOKENIZER).count() == 0


def test_token_files_edge_cases(spark, docs, tmp_path):
    rows = [(7, text_of(1, 2000)), (3, None), (5, ""), (None, "none"), (9, "tie"), (9, "tie tie"), (1, "a")]
    token_files.write_token_files(spark, docs(*rows), TOKENIZER, str(tmp_path / "files"))
    found = sorted((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_token_files(spark, str(tmp_path / "files")).collect())
    start = 0
    for (at, doc_id, ids), (want_id, text) in zip(found, [rows[3], rows[6], rows[1], rows[2], rows[0], rows[4], rows[5]]):
        assert (at, doc_id, ids) == (start, want_id, [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0])
        start += len(ids)
    token_files.write_token_files(spark, docs(), TOKENIZER, str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=3000), st.integers(1, 6))
def test_huffman_round_trip(values, power):
    ids = np.array(values) ** power % 5003
    counts = np.bincount(ids, minlength=5003)
    lengths = token_files.code_lengths(counts)
    assert lengths.max() <= token_files.MAX_BITS and sum(2.0 ** -int(n) for n in lengths[lengths > 0]) <= 1
    payload, points = token_files.pack(ids, token_files.canonical_codes(lengths), lengths)
    runs = np.full(len(points), token_files.CHECKPOINT)
    runs[-1] = len(ids) - token_files.CHECKPOINT * (len(points) - 1)
    assert token_files.unpack(payload, points, runs, token_files.decoding_table(lengths)).tolist() == ids.tolist()


def test_lengths_are_limited():
    counts = np.array([2**k for k in range(40)])
    lengths = token_files.code_lengths(counts, most=7)
    assert lengths.max() == 7 and sum(2.0 ** -int(n) for n in lengths) == 1


# op9


def test_leaks(spark, docs, frame):
    item = text_of(77, 40) + ". The answer is forty two."
    words = item.split()
    paraphrase = " ".join(f"new{i}" if i in (5, 13, 21, 30) else w for i, w in enumerate(words))
    half = " ".join(words[:14]) + " " + text_of(5, 60)
    rows = docs(
        (1, f"{text_of(1, 200)} {item} {text_of(2, 100)}"), (2, f"{text_of(3, 150)} {paraphrase} {text_of(4, 90)}"),
        (3, half), (4, None), (5, ""), (None, item.upper()), (6, text_of(6, 400)), (7, "tiny item here"),
        *((i, text_of(i, 120)) for i in range(20, 60)),
    )
    benchmark = frame("item_id long, text string, doc_id string", (10, item, "x"), (11, None, "x"), (12, "", "x"), (13, "Tiny, item!", "x"), (None, item, "x"), (10, item, "x"))
    found = {r.doc_id: r for r in find_leaks(spark, rows, benchmark).collect()}
    assert found[1].item_ids == found[2].item_ids == found[None].item_ids == [10] and found[7].item_ids == [13]
    assert all(not found[i].item_ids for i in (3, 4, 5, 6, *range(20, 60)))
    assert found[1].overlap == 1.0 and 0.8 < found[2].overlap < 1
    kept = {r.doc_id for r in clean_documents(spark, rows, benchmark).collect()}
    assert kept == {3, 4, 5, 6, *range(20, 60)}
    assert find_leaks(spark, docs(), benchmark).count() == 0
    assert not [r for r in find_leaks(spark, rows, benchmark.where("item_id < 0")).collect() if r.item_ids]


def test_leaks_fold_case_of_all_letters(spark, docs, frame):
    item = text_of(8, 30, ["éré", "übel", "años", "çan", "la", "öde", "ñu", "eau"])
    rows = docs((1, f"{text_of(1, 50)} {item.upper()} {text_of(2, 50)}"), (2, text_of(3, 90)))
    found = {r.doc_id: r.item_ids for r in find_leaks(spark, rows, frame("item_id long, text string", (4, item))).collect()}
    assert found == {1: [4], 2: []}


@pytest.mark.parametrize("lengths", [[*range(1, 41)], [60, 100, 160, 300, 400, 600, 800, 1000]])
def test_leaks_of_every_length(spark, docs, frame, lengths):
    """Copies word by word of short and long items, each in a longer document, and one copied with changes."""
    many = [f"w{i}" for i in range(5000)]
    items = [(n, text_of(1000 + n, n, many)) for n in lengths]
    rows = [(n, f"{text_of(2000 + n, 150 + n % 37, WORDS)} {t} {text_of(3000 + n, 170, WORDS)}") for n, t in items]
    changed = [(n, " ".join(f"new{i}" if i % 7 == 3 else w for i, w in enumerate(t.split()))) for n, t in items if n >= 12]
    rows += [(5000 + n, f"{text_of(4000 + n, 150 + n % 37, WORDS)} {t} {text_of(5000 + n, 170, WORDS)}") for n, t in changed]
    found = {r.doc_id: r for r in find_leaks(spark, docs(*rows), frame("item_id long, text string", *items)).collect()}
    assert [n for n, _ in items if n not in found[n].item_ids or found[n].overlap < 1] == []
    assert [n for n, _ in changed if n not in found[5000 + n].item_ids] == []
    assert all(set(r.item_ids) <= {r.doc_id % 5000, *range(1, 4)} for r in found.values())


def test_leaks_in_blocks_of_items(spark, docs, frame, monkeypatch):
    from lakemart.llm import decontaminate

    items = [(i, text_of(100 + i, 30)) for i in range(9)]
    rows = docs(*((i, f"{text_of(i, 40)} {t} {items[(i + 1) % 9][1]}") for i, t in items), (50, text_of(50, 90)))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 2)
    plain_rows = clean_documents(spark, rows, frame("item_id long, text string", *items))
    assert plain_rows.columns == rows.columns
    found = {r.doc_id: r.item_ids for r in find_leaks(spark, rows, frame("item_id long, text string", *items)).collect()}
    assert found == {**{i: sorted([i, (i + 1) % 9]) for i in range(9)}, 50: []}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=12), st.lists(st.sampled_from("abcde"), max_size=20))
def test_common_subsequence(item, region):
    from lakemart.llm.hashing import NOT_ALNUM, words

    found = Item(1, " ".join(item)).overlap(words([" ".join(region).encode()], NOT_ALNUM)[0].tolist())
    table = [[0] * (len(region) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(region):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    assert found == table[-1][-1]


# shared


def test_components(spark, frame):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(40)]
    found = dict(as_rows(components(frame("a long, b long", *links), Scratch(spark, "test")), "node", "component"))
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert found == {i: root(i) for i in parent if any(i in link and link[0] != link[1] for link in links)}


def test_leading_directions_are_those_of_the_matrix():
    """A matrix of known singular vectors, with noise: the leading ones are found, in order and at right angles."""
    from lakemart.llm import decontaminate as d

    rng = np.random.default_rng(3)
    true = np.linalg.qr(rng.standard_normal((d.FEATURES, d.RANK + d.MORE)))[0]
    values = 2.0 ** -np.arange(d.RANK + d.MORE)
    directions = rng.standard_normal((d.FEATURES, d.RANK + d.MORE))
    found = d.leading_directions(true @ (values[:, None] * (true.T @ directions)), directions)
    assert found.shape == (d.FEATURES, d.RANK) and np.allclose(found.T @ found, np.eye(d.RANK), atol=1e-6)
    assert (np.abs((found * true[:, : d.RANK]).sum(0))[:12] > 0.99).all()
    assert np.isfinite(d.leading_directions(np.zeros((d.FEATURES, d.RANK + d.MORE)), directions)).all()


# op3, in parts
def _arrow(names, columns, kinds):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def test_segments_of_many_texts_are_those_of_each():
    texts = [b"", text_of(1, 90).encode(), b"x" * 99, b"", b"y" * 100, text_of(2, 300).encode() * 2, b"", b"z" * 250]
    together = suffix_dedup._segments(texts, None)
    at = list(zip(*(x.tolist() for x in together[:5])))
    alone = [(i, *row[1:]) for i, t in enumerate(texts) for row in zip(*(x.tolist() for x in suffix_dedup._segments([t], None)[:5]))]
    assert sorted(at) == sorted(alone) and {i for i, *_ in at} == {1, 4, 5, 7}
    assert not suffix_dedup._segments(texts, None, ask_twice=False)[4].any()


@pytest.mark.parametrize("together", [1, 1 << 21])
def test_sorted_keys_in_batches_of_any_size(monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "SORTED_TOGETHER", together)
    one, two = (text_of(k, 60).encode()[:200] for k in (1, 2))
    # Copies of one digest: the earliest goes on, the others are covered; a second digest of the key shares 120 bytes.
    rows = [(5, 1, 1, d, 0, 0, 200, one) for d in (1, 2, 2, 3)] + [(5, 2, 2, 4, 0, 10, 210, one[:120] + two[:80])]
    rows += [(6, 3, 3, 1, 0, 300, 500, two), (6, 3, 3, 9, 7, 0, 200, two)]
    names, kinds = ["h", "d1", "d2", "doc_id", "tag", "first", "end", "data"], [pa.int64()] * 7 + [pa.binary()]
    for size in (1, 3, 100):
        parts = (_arrow(names, zip(*rows[i : i + size]), kinds) for i in range(0, len(rows), size))
        found = [r for b in suffix_dedup._sort_keys(parts) for r in b.to_pylist()]
        assert sorted(tuple(r.values()) for r in found) == [(2, 0, 0, 200), (2, 0, 0, 200), (3, 0, 0, 200), (4, 0, 10, 130), (9, 7, 0, 200)]


def test_copies_are_not_sorted_again(monkeypatch):
    sorted_rows = []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_rows.append(len(keys[0])) or lexsort(keys))
    data = np.frombuffer(text_of(3, 400).encode() * 3, np.uint8)
    order = suffix_array(data, 100)
    assert [bytes(data[i : i + 100]) for i in order] == sorted(bytes(data[i : i + 100]) for i in range(len(data)))
    # Before, every round sorted every copy: twelve times the positions that are sorted directly.
    assert sum(sorted_rows) < len(data)
