"""The filter audit against a replay of every order over every document."""

import re
from collections import Counter
from itertools import permutations

import pytest

from lakemart.llm.filter_audit import ORDERS, SUMS, audit_filters, interval_ends

LONG = " ".join(f"word{i}" for i in range(60))


def fails(rows):
    """The letters of the filters that each row (doc_id, text, source) fails."""
    found = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copies = [i for i, t, _ in rows if (t or "") == text and i is not None and doc_id is not None and i < doc_id]
        found.append(
            {
                letter
                for letter, bad in zip(
                    "ABCDE",
                    (
                        len(words) < 50,
                        100 * len(set(words)) < 65 * len(words),
                        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                        bool(re.search("[#$%&*|]", text)),
                        bool(copies),
                    ),
                )
                if bad
            }
        )
    return found


def replay(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, shapley = {}, Counter()
    masks = fails(rows)
    for part in {s or "" for _, _, s in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [(r, m) for r, m in zip(rows, masks) if (r[2] or "") == part]
            everyone = left
            for step, letter in enumerate(order, 1):
                gone = [r for r, m in left if letter in m]
                left = [(r, m) for r, m in left if letter not in m]
                shapley[part, letter] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(letter in m for _, m in everyone) - len(gone),
                    sum(m == {letter} for _, m in everyone),
                    sum(r[0] in good for r in gone),
                    sum(r[0] in toxic for r in gone),
                ]
    return sorted((*key, *v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items())


@pytest.fixture
def documents(frame):
    """Columns whose names the operator uses itself, too."""
    ddl = "doc_id long, text string, source string, mask int, part string, n int, good int, step int, digest string, first int"
    return lambda *rows: frame(ddl, *((*r, 1, "p", 2, 3, 4, "d", 5) for r in rows))


ODD = [
    (1, LONG, "a"),
    (2, LONG, "a"),
    (2, LONG, "a"),
    (3, LONG, None),
    (4, LONG + " # X", "b"),
    (5, LONG.upper(), "b"),
    (6, None, "b"),
    (7, "", ""),
    (8, " \n\t\x0b ", "a"),
    (9, "a b " * 40, "c"),
    (10, ("Long WORDS " * 4000) + "ö|", "c"),
    (11, "a b c " + LONG, "c"),
    (None, LONG, "a"),
    (None, None, None),
]


def test_every_order_replayed(spark, documents, frame, rows_of):
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (5, 1, 1), (None, 1, 1), (77, 1, 1)]
    got = audit_filters(spark, documents(*ODD), frame("doc_id long, quality int, toxic int, n int", *((*x, 1) for x in labels)))
    assert got.columns == ["part", "filter_order", "step", *SUMS, "shapley"]
    assert rows_of(got) == sorted(replay(ODD, labels), key=repr)


def test_empty_tables(spark, documents, frame):
    none = frame("doc_id long, quality int, toxic int")
    assert audit_filters(spark, documents(), none).count() == 0
    one = audit_filters(spark, documents((1, "x", "a")), none).where("filter_order = 'ABCDE'").orderBy("step").collect()
    assert [r.removed for r in one] == [1, 0, 0, 0, 0] and [r.shapley for r in one] == [120, 0, 0, 0, 0]


def test_copies_are_spread(spark, documents, frame, plan_of):
    """The look-up of firsts joins by text and doc_id, so one text is no hot key."""
    from lakemart.llm.filter_audit import failing_masks

    plan = plan_of(failing_masks(spark, documents(*ODD), frame("doc_id long, quality int, toxic int")))
    assert "SortMergeJoin [digest" in plan and "doc_id" in plan.split("SortMergeJoin [digest")[1].split("]")[0]


def test_orders_and_intervals():
    assert len(ORDERS) == 120 and ORDERS[0] == "ABCDE" and ORDERS[-1] == "EDCBA" and ORDERS == sorted(ORDERS)
    # A document that fails B only is removed at step 1 by the orders that begin with B: one interval.
    assert sorted(e for e in interval_ends() if e[0] == 2 and e[1] == 1 and e[4]) == [(2, 1, 24, -1, 1, 0), (2, 1, 48, 1, -1, 0)]
