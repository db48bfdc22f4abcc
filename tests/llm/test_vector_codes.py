"""Product codes against comparing every part with every entry."""

import math

import numpy as np
import pytest

from lakemart.llm import vector_codes
from lakemart.llm.vector_codes import Cells, books_digest, code_report, compress_vectors, decompress_vectors, part_bounds


def plain(rows, begin=64):
    """code, error and codebooks by the definition; ``rows`` (vec_id, vector) are fit to be kept, sorted by id, and the
    first ``begin`` begin the codebooks."""
    whole = [[math.floor(256 * x) for x in v] for _, v in rows]
    bounds = part_bounds(len(whole[0])).tolist()
    books = [[v[a:b] for v in whole[:begin]] for a, b in zip(bounds, bounds[1:])]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(2):
        for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
            mine = {}
            for v in whole:
                mine.setdefault(nearest(v[a:b], books[p])[1], []).append(v[a:b])
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k])] if k in mine else e for k, e in enumerate(books[p])]
    found = [[nearest(v[a:b], books[p]) for p, (a, b) in enumerate(zip(bounds, bounds[1:]))] for v in whole]
    return ["".join(f"{k:02x}" for _, k in f) for f in found], [sum(d for d, _ in f) for f in found], books


@pytest.fixture
def vectors(frame):
    ddl = "vec_id long, embedding array<float>, label int, code string, error int, of string, part int"
    return lambda *rows: frame(ddl, *((i, v, label, "c", 1, "o", 2) for i, v, label in rows))


def clustered(seed, n, width, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (9, width))
    return (centres[rng.integers(0, 9, n)] + rng.normal(0, spread, (n, width))).astype(np.float32).tolist()


def test_codes_by_definition(spark, vectors):
    rows = [(10 * i, v, i % 3 or None) for i, v in enumerate(clustered(1, 300, 32))]
    rows += [(5000, rows[0][1], 1), (5001, rows[0][1], 1)]
    got = {r.vec_id: r for r in code_report(spark, vectors(*rows[::-1]).repartition(7)).collect()}
    codes, errors, books = plain([(i, v) for i, v, _ in rows])
    assert [got[i].code for i, _, _ in rows] == codes and [got[i].error for i, _, _ in rows] == errors
    labels = {}
    for (_, _, label), e in zip(rows, errors):
        labels[label] = labels.get(label, 0) + e
    assert all(got[i].label_error == labels[label] for i, _, label in rows)
    assert {r.codebooks_sha256 for r in got.values()} == {books_digest([np.array(b) for b in books])}


def test_odd_vectors(spark, vectors, rows_of):
    good = clustered(2, 5, 17)  # 16 does not divide 17
    rows = [(k, v, 0) for k, v in enumerate(good)]
    bad = [(9, None, 0), (-1, [None, *good[0][1:]], 0), (-2, [math.inf, *good[0][1:]], 0), (-3, [math.nan, *good[0][1:]], None)]
    bad += [(-4, [1e30, *good[0][1:]], 0), (50, good[0][:5], 0)]
    odd = [(None, good[2], None), (3, good[3], 1)]
    codes, books = compress_vectors(spark, vectors(*rows, *bad, *odd))
    kept = [*sorted((i, v) for i, v, _ in [*rows, odd[1]]), odd[0][:2]]
    want, errors, _ = plain(kept, begin=6)
    assert len(books[0]) == 6  # five vectors and the repeated row
    found = sorted(((r.vec_id, r.code, r.error) for r in codes.collect()), key=repr)
    assert found == sorted(((i, c, e) for (i, _), c, e in zip(kept, want, errors)), key=repr)
    assert code_report(spark, vectors()).count() == 0
    assert code_report(spark, vectors((1, None, 1))).count() == 0
    back = decompress_vectors(codes, books).collect()
    assert all(len(r.embedding) == 17 for r in back)


@pytest.mark.parametrize("remembered", [1 << 16, 8])
def test_cells_leave_out_no_nearest_entry(monkeypatch, remembered):
    """Ties, parts on the borders of cells, a forgetful memory, and colliding hashes."""
    monkeypatch.setattr(vector_codes, "REMEMBERED", remembered)
    rng = np.random.default_rng(5)
    book = rng.integers(-60, 60, (64, 4))
    book[7] = book[3]
    parts = np.concatenate((rng.integers(-80, 80, (4000, 4)), book, book + 1, 16 * rng.integers(-5, 5, (200, 4)), [[4_000_000, -4_000_000, 0, 0]]))
    apart = parts[:, None, :] - book
    distance = (apart * apart).sum(-1)
    cells = Cells(book)
    for _ in range(2):
        index, best = cells.nearest(parts)
        assert (index == distance.argmin(1)).all() and (best == distance.min(1)).all()
    if remembered > 8:
        assert np.diff(cells.firsts).mean() < 32  # most entries are dominated
    monkeypatch.setattr(vector_codes, "mix", lambda x: x & np.uint64(7))
    index, best = Cells(book).nearest(parts)
    assert (index == distance.argmin(1)).all() and (best == distance.min(1)).all()
