"""The stages of the pipeline on odd rows and empty tables, and operators on very long texts."""

import hashlib

import numpy as np
import pytest
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import decontaminate, hashing, language_id
from lakemart.llm import token_files, workers
from lakemart.llm.decontaminate import find_leaks
from lakemart.llm.line_dedup import dedup_lines
from lakemart.llm.queries import TOKENIZER
from lakemart.llm.substring_dedup import dedup_units
from lakemart.llm.suffix_dedup import dedup_substrings
from test_llm_operators import text_of

DDL = "doc_id long, text string, lang string, source string, n_chars long, component string, h long, removed string, ids string, item_ids int"
ENGLISH, GERMAN = "the and of that which there was ".split(), "der und das nicht aber schon ist ".split()
COLUMNS = list(corpus_pipeline.COLUMNS)
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture
def docs(frame):
    return lambda *rows: frame(DDL, *((i, t, lang, "s", n, "c", 1, "r", "i", 2) for i, t, lang, n in rows))


def two_languages():
    return [(100 + i, text_of(i, 60, ENGLISH if i % 2 else GERMAN), "en" if i % 2 else "de", 5) for i in range(40)]


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)


def test_language_stage(spark, docs):
    odd = [(1, None, "en", None), (2, "", None, 0), (3, "12 ½ !", "de", 1), (None, "the and of that", None, 1), (4, "the and of that", "en", 1), (4, "the and of that", "en", 1)]
    kept = STAGES["language_id"](spark, docs(*two_languages(), *odd), "")
    assert kept.columns == COLUMNS and ids(kept)[-1] is None
    assert [i for i in ids(kept) if i is not None and i < 100] == [4, 4]
    assert STAGES["language_id"](spark, docs(), "").count() == 0


def test_line_stage(spark, docs):
    body = "\n".join(text_of(k, 9) for k in range(12))
    odd = [(1, body, "a", 7), (2, body, None, 7), (3, None, "a", None), (4, "", "a", 0), (None, body, "a", 7), (5, "x", "a", 1), (5, "x", "a", 1)]
    kept = STAGES["line_dedup"](spark, docs(*odd), "")
    assert kept.columns == COLUMNS and ids(kept) == sorted([1, 3, 4, 5, 5, None], key=repr)
    assert {r.text for r in kept.where("doc_id is null or doc_id = 1").collect()} == {body}
    assert STAGES["line_dedup"](spark, docs(), "").count() == 0


def test_copies_stage(spark, docs):
    long = text_of(1, 200)
    odd = [(3, long, "a", 1), (2, long, "a", 1), (9, long + " more", None, 1), (4, None, "a", None), (5, None, "a", None), (6, "", "a", 0), (None, long, "a", 1), (7, "z", "a", 1), (7, "z", "a", 1)]
    kept = STAGES["near_copies"](spark, docs(*odd), "")
    assert kept.columns == COLUMNS and ids(kept) == sorted([2, 4, 5, 6, 7, 7, None], key=repr)
    assert STAGES["near_copies"](spark, docs(), "").count() == 0


def test_clean_and_encoding_stages(spark, docs, frame, tmp_path):
    item = text_of(77, 30)
    frame("item_id long, text string", (1, item), (2, None)).write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = [(1, f"{text_of(1, 50)} {item} {text_of(2, 50)}", "a", 1), (2, None, None, None), (3, "", "a", 0), (None, item, "a", 1), (4, "fine", "a", 1), (4, "fine", "a", 1)]
    kept = STAGES["decontamination"](spark, docs(*odd), str(tmp_path))
    assert kept.columns == COLUMNS and ids(kept) == [2, 3, 4, 4]
    coded = STAGES["encoding"](spark, kept, str(tmp_path)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id, r.n_tokens > 0, r.decoded_sha256 == empty) for r in coded) == [(2, False, True), (3, False, True), (4, True, False), (4, True, False)]
    assert STAGES["encoding"](spark, docs(), "").count() == 0
    # An empty benchmark removes nothing.
    frame("item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert len(ids(STAGES["decontamination"](spark, docs(*odd), str(tmp_path / "none")))) == len(odd)


def test_very_long_texts(spark, docs, frame, tmp_path):
    """Texts of 150,000 words, seven times the longest of the data, in every operator that works within texts."""
    many = [f"w{i}" for i in range(3000)]
    lines = [text_of(k, 15, many) for k in range(10_000)]
    long, item = "\n".join(lines), text_of(9, 40)
    middle = f"{long}\n{item}\n{long[::-1]}"
    rows = docs((1, long, "a", 1), (2, long, "a", 1), (3, middle, "a", 1))
    units = {r.doc_id: r for r in dedup_units(spark, rows, "line").collect()}
    assert units[1].text == long and units[2].text == "" and long not in units[3].text and item in units[3].text
    chunks = {r.doc_id: r.text for r in dedup_lines(spark, rows, paired=True).collect()}
    assert chunks[1] == long and not chunks[2] and len(chunks[3]) < len(long) * 1.1
    kept = {r.doc_id: r for r in dedup_substrings(spark, rows).collect()}
    assert len(kept[1].kept) == len(long) and len(kept[2].kept) == 0 and len(kept[3].kept) <= len(middle) - len(long) + 200
    found = {r.doc_id: r.item_ids for r in find_leaks(spark, rows, frame("item_id long, text string", (5, item))).collect()}
    assert found == {1: [], 2: [], 3: [5]}
    folder = str(tmp_path / "files")
    token_files.write_token_files(spark, rows, TOKENIZER, folder)
    library = Tokenizer.from_file(TOKENIZER)
    ids_of = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_token_files(spark, folder).collect()}
    assert ids_of[2] == [*library.encode(long, add_special_tokens=False).ids, 0] == ids_of[1]
    assert ids_of[3] == [*library.encode(middle, add_special_tokens=False).ids, 0]


def test_worker_holds_a_part_of_a_batch_at_a_time(monkeypatch):
    """Batches hold 10,000 texts; what is copied out of them, and sent back, is bounded."""
    sizes = []
    whole = hashing.byte_lists
    monkeypatch.setattr(hashing, "byte_lists", lambda column: sizes.append(len(column)) or whole(column))
    texts = ["ab" * (k % 7) if k % 11 else None for k in range(500)] + ["x" * 300, "", None]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()).slice(3)):
        sizes.clear()
        found = list(hashing.slices(column, 100))
        assert [t for _, part in found for t in part] == [(t or "").encode() for t in column.to_pylist()]
        assert [at for at, _ in found] == [sum(len(part) for _, part in found[:k]) for k in range(len(found))]
        assert all(len(part) == 1 or sum(map(len, part)) + len(part) - 1 <= 100 for _, part in found)
        assert max(sizes) <= 101
    assert list(hashing.slices(pa.array([], pa.string()))) == []
    parts = list(language_id._in_parts(iter([pa.record_batch({"text": pa.array(["a"] * 2500)})])))
    assert [p.num_rows for p in parts] == [1000, 1000, 500]


def test_document_frequencies_count_a_word_once_a_text():
    texts = ["Cat dog cat", "dog", None, "", "cat, CAT! bird"]
    (found,) = decontaminate._frequencies(iter([pa.record_batch({"text": pa.array(texts)}), pa.record_batch({"text": pa.array([], pa.string())})]))
    counts = dict(zip(found.column("f").to_pylist(), found.column("n").to_pylist()))
    words = {int(decontaminate._feature(decontaminate._hashes(w))[0]): n for w, n in (("cat", 2), ("dog", 2), ("bird", 1))}
    assert counts == {**words, -1: 5}


def test_workers_get_few_rows_and_encode_apart_from_decoding(spark, docs, set_conf):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_conf(**{key: "10000"})
    coded = STAGES["encoding"](spark, docs((1, "a b", "en", 3), (2, None, "en", None)), "")
    assert 0 < int(spark.conf.get(key)) <= 1_000
    # One worker a task: the ids that are decoded come from a written table.
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: r.n_tokens for r in coded.collect()} == {1: 2, 2: 0}


def test_tasks_give_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(workers, "give_back", lambda: given.append(1))
    run = workers.giving_back(lambda batches: (b for b in batches))
    assert list(run(iter([1, 2]))) == [1, 2] and given == [1]
    part = run(iter([1, 2]))
    next(part)
    part.close()
    assert given == [1, 1]
