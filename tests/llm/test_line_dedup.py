"""Line dedup against pairwise comparison."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opslake.llm import line_dedup as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.text("abé", max_size=14), st.text("abé", max_size=14), st.integers(0, 4))
def test_within_equals_the_distance(a, b, limit):
    assert L.within(a, b, limit) == (distance(a, b) <= limit)


def brute(docs, max_edits, per_edit):
    """Texts by row, by comparing every line with every earlier one."""
    order = sorted({(i is None, i or 0, t) for i, t in docs if t is not None}, key=lambda x: x[:2])
    seen, kept = [], {}
    for none, i, t in order:
        left, lost = [], False
        for line in t.split("\n"):
            s = line.strip(L.BLANKS)
            if s:
                limits = ((x, min(max_edits, min(len(s), len(x)) // per_edit)) for x in seen)
                if any(s == x or abs(len(s) - len(x)) <= limit and limit and distance(s, x) <= limit for x, limit in limits):
                    lost = True
                    seen.append(s)
                    continue
                seen.append(s)
            left.append(line)
        text = "\n".join(left)
        kept[(None if none else i, t)] = None if lost and not text.split() else text
    return kept


def edited(rng, s, n):
    for _ in range(n):
        k = rng.randrange(len(s) + 1)
        s = rng.choice([s[:k] + "x" + s[k:], s[:k] + s[k + 1:], s[:k] + "é" + s[k + 1:]])
    return s


@pytest.mark.parametrize("max_edits,block", [(0, 1024), (1, 1024), (2, 1024), (2, 4), (3, 8)])
def test_equals_brute_force(spark, max_edits, block):
    rng = random.Random(max_edits)
    base = ["".join(rng.choice("abc dé") for _ in range(rng.randrange(12, 30))).strip() + "zz" for _ in range(12)]
    docs = [(i, "\n".join([edited(rng, rng.choice(base), rng.randrange(4)) for _ in range(rng.randrange(1, 5))] + ["short", "shirt"] * (i % 2)))
            for i in range(60)]
    docs += [(60, None), (61, ""), (62, "  \n\t"), (63, docs[0][1]), (63, docs[0][1]), (None, docs[3][1] + "\nown line of no one id"),
             (64, "y" * 900), (65, "y" * 900 + "x"), (66, "Again and again\r\n Again and again \nAgain and again")]
    df = spark.createDataFrame([(i, t, len(t or ""), "e") for i, t in docs], "doc_id long, text string, n_chars long, line string")
    got = sorted(L.line_dedup(df.repartition(4), max_edits, 7, length_col="n_chars", block=block).collect(), key=str)
    want = brute(docs, max_edits, 7)
    expect = []
    for i, t in docs:
        text = t if t is None else want[(i, t)]
        if not (t is not None and text is None):
            expect.append((i, text, len(text or ""), "e"))
    assert sorted((tuple(r) for r in got), key=str) == sorted(expect, key=str)


def test_short_copies_go_and_short_near_ones_stay(spark):
    docs = [(1, "Les.\nDes.\nSubscribe to our newsletter"), (2, "Les.\nown line\nSubscribe to our newsletter"),
            (3, "Subscribe to our newsletters\nownline"), (4, "Les.")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, removed string")
    got = {r.doc_id: (r.text, r.removed) for r in L.line_dedup(df, removals="removed").collect()}
    assert got == {1: (docs[0][1], None), 2: ("own line", [0, 2]), 3: ("ownline", [0])}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.line_dedup(df, removals="lines").collect() == []
