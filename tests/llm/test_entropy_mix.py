"""Source mixing against a plain solution of the same problem."""

import math
import random
import re

import pytest

from lakemart.llm.entropy_mix import mix_sources, take_copies
from lakemart.operators.running import numbered
from pyspark.sql import functions as F


def plain_targets(sizes):
    """Shares by weight, limited to three times a source's own words; ``sizes`` by source."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in held)
        weights = sum(w for s, w in weight.items() if s not in held) or 1
        above = {s for s in order if s not in held and left * weight[s] > 3 * sizes[s] * weights}
        if not above:
            return {s: 3.0 * sizes[s] if s in held else left * weight[s] / weights for s in order}
        held |= above


def plain_rates(sizes, target):
    """Rates min(3, exp(l * size)) that give the target, by halving."""
    low, high = -100.0, 100.0
    for _ in range(300):
        mid = (low + high) / 2
        got = sum(s * min(3.0, math.exp(min(mid * s, 50))) for s in sizes)
        low, high = (mid, high) if got < target else (low, mid)
    return [min(3.0, math.exp(min(high * s, 50))) for s in sizes]


@pytest.fixture
def documents(frame):
    ddl = "doc_id long, text string, source string, size int, n int, h long, number int, target string, bucket int, rank int"
    return lambda *rows: frame(ddl, *((*r, 1, 2, 3, 4, "t", 5, 6) for r in rows))


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size = int(rng.paretovariate(0.9)) + (i % 7 == 0) * 300
        rows.append((i, " ".join(["w"] * min(size, 4000)), rng.choice(["a", "b", "b", "b", "c", "é", "", None, "A"])))
    return rows


def test_targets_rates_and_copies(spark, documents, rows_of, plan_of, set_conf):
    rows = corpus(3, 400)
    mixed = mix_sources(spark, documents(*rows))
    plan = plan_of(mixed)
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    got = {r.doc_id: r for r in mixed.collect()}
    assert len(got) == len(rows)
    assert sum(abs(r.copies - r.rate) < 1 for r in got.values()) > 0.9 * len(rows)
    by_source = {}
    for i, text, source in rows:
        by_source.setdefault(source, []).append((i, words(text)))
    targets = plain_targets({s: sum(n for _, n in d) for s, d in by_source.items()})
    for source, found in by_source.items():
        sizes = [n for _, n in found]
        rates = plain_rates(sizes, targets[source])
        for (i, n), rate in zip(found, rates):
            r = got[i]
            assert (r.size, r.source_size) == (n, sum(sizes)) and r.target == pytest.approx(targets[source], rel=1e-12)
            assert r.taken == r.copies * n and 0 <= r.copies <= 3
            assert r.rate == pytest.approx(rate, abs=1e-3)
        taken = sum(got[i].taken for i, _ in found)
        assert abs(taken - targets[source]) <= max(3, min(sizes)) + 0.002 * targets[source]


    # Another order of the rows and other partitions give the same copies.
    set_conf(spark__sql__shuffle__partitions="3")
    assert rows_of(mix_sources(spark, documents(*rows[::-1]).repartition(5))) == rows_of(mixed)


def test_odd_rows(spark, documents):
    long = "w " * 200_000
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t", None), (None, "x y", "a"), (4, "x y z", "b"), (4, "x y z", "b"), (5, long, "c"), (6, " ", "")]
    got = mix_sources(spark, documents(*rows)).collect()
    assert sorted(r.size for r in got) == [0, 0, 0, 1, 2, 3, 3, 200_000]
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in got)
    sources = plain_targets({"a": 2, None: 0, "b": 6, "c": 200_000, "": 1})
    assert {r.target for r in got} == {sources[s] for s in sources}
    assert mix_sources(spark, documents()).count() == 0
    assert [r.taken for r in mix_sources(spark, documents((1, None, None), (2, " ", "a"))).collect()] == [0, 0]


def test_hot_source_of_one_size(spark, documents):
    """Equal documents share a rate; their copies add up to the target to the word."""
    rows = [(i, "a b c d", "hot") for i in range(900)] + [(1000 + i, "a b", "x") for i in range(450)] + [(2000 + i, "a", "y") for i in range(600)]
    got = mix_sources(spark, documents(*rows)).collect()
    for size in (4, 2, 1):
        mine = [r for r in got if r.size == size]
        assert mine[0].target == pytest.approx(plain_targets({"hot": 3600, "x": 900, "y": 600})[{4: "hot", 2: "x", 1: "y"}[size]])
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= size


def test_copies_taken(spark, documents, rows_of):
    docs = documents((1, "x", "a"), (2, "y", "b"), (3, None, None))
    mixed = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "doc_id long, copies long")
    taken = take_copies(docs, mixed)
    assert taken.columns == [*docs.columns, "copy"] and rows_of(taken.select("doc_id", "copy")) == [(1, 1), (1, 2), (3, 1)]


def test_numbering_in_ranges(spark, frame):
    names = frame("name string", *((f"s{i:03}",) for i in range(50)), (None,), ("",))
    got = numbered(names, [F.col("name").asc_nulls_last()], "k").orderBy("k").collect()
    assert [r.k for r in got] == list(range(1, 53)) and got[0].name == "" and got[-1].name is None
