"""Pfair schedule: release times, deadlines, deviation, the mixture's end."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opslake.llm import mixing as M


def plain_period(shares):
    """Earliest deadline first, slot by slot: (source, block) of every slot of a period."""
    total, done, out = sum(shares), [0] * len(shares), []
    for slot in range(total):
        ready = [(-(-(done[k] + 1) * total // w), -w, done[k], k) for k, w in enumerate(shares)
                 if done[k] < w and done[k] * total // w <= slot]
        *_, k = min(ready)
        out.append((k, done[k]))
        done[k] += 1
    return out


def unrolled(runs, number):
    """(source, block) by slot, given the names of the sources of each share."""
    return [(number[w][q + k], i) for w, i, q, _, n in sorted(runs, key=lambda r: r[3]) for k in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=30))
def test_period_is_the_plain_one_and_deviates_less_than_a_block(weights):
    number = {w: [k for k, x in enumerate(weights) if x == w] for w in weights}
    runs = M.period({w: len(ks) for w, ks in number.items()})
    got, total, done = unrolled(runs, number), sum(weights), Counter()
    assert got == plain_period(weights)
    for t, (k, j) in enumerate(got):
        assert j == done[k]
        done[k] += 1
        assert all(abs(done[s] * total - w * (t + 1)) < total for s, w in enumerate(weights))


def test_runs_do_not_grow_with_the_sources():
    few, many = M.period({1: 50, 7: 20, 100: 2}), M.period({1: 50_000, 7: 20_000, 100: 2_000})
    assert len(many) <= 2 * (1 + 7 + 100) and len(few) <= 2 * (1 + 7 + 100)
    assert sum(n for *_, n in many) == 50_000 + 7 * 20_000 + 100 * 2_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 40)), min_size=1, max_size=12))
def test_phases_place_every_block_once(sources):
    lengths = Counter(sources)
    number, seen = {}, Counter()
    for k, (w, b) in sorted(enumerate(sources), key=lambda x: -x[1][1]):
        number[k] = (w, seen[w])
        seen[w] += 1
    spans, runs = M.phases(lengths)
    order = {}
    for k, (w, b) in enumerate(sources):
        for i in range(b):
            ((p, per, total, start, first),) = [(p, per, total, start, first) for p, x, start, end, per, total, first in spans
                                                if x == w and start <= i < end]
            j = i - start
            ((t, q0),) = [(t, q0) for rp, x, place, q0, q1, t in runs
                          if (rp, x, place) == (p, w, j % per) and q0 <= number[k][1] < q1]
            slot = first + j // per * total + t + number[k][1] - q0
            assert slot not in order and j * total // per <= slot - first < -(-(j + 1) * total // per)
            order[slot] = (k, i)
    done = Counter()
    for slot in sorted(order):
        k, i = order[slot]
        assert i == done[k]
        done[k] += 1
    assert done == Counter({k: b for k, (_, b) in enumerate(sources)})


ROWS = ([(i, f"text {i}", "hot", "a") for i in range(300)] + [(1000 + i, "same", "b", "x") for i in range(70)]
        + [(2000 + i, None, None, "y") for i in range(50)] + [(None, "no id", "b", "z"), (3000, "t", "unlisted", "q")]
        + [(5, "text 5", "hot", "a")] * 2)


@pytest.mark.parametrize("block", [1, 4])
def test_schedule_and_mixture(spark, block, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_RANGE", 37)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, extra string").repartition(5)
    shares = {"hot": 3, "b": 2, None: 1}
    weight = {**shares, "unlisted": 1}
    rows = M.schedule(docs, shares, block).collect()
    assert Counter((r.doc_id, r.text, r.source, r.extra) for r in rows) == Counter(ROWS)
    rows.sort(key=lambda r: r.position)
    assert len({r.position for r in rows}) == len(rows)
    slots = {}
    for r in rows:
        slots.setdefault(r.slot, []).append(r)
    done, size, total = Counter(), Counter(r.source for r in rows), sum(weight.values())
    for t in sorted(slots):
        r = slots[t][0]
        assert {(x.source, x.block) for x in slots[t]} == {(r.source, done[r.source])}
        assert len(slots[t]) == min(block, size[r.source] - block * done[r.source])
        assert r.release <= t < r.deadline
        done[r.source] += 1
        if r.phase == 0:
            assert all(abs(done[s] * total - w * (t + 1)) < total for s, w in weight.items() if block * done[s] < size[s])
    got = [tuple(r) for r in M.mix(docs, shares, block).collect()]
    assert [g[2] for g in got] == [r.source for r in rows] and Counter(got) == Counter(ROWS)


def test_three_hundred_sources_have_shares_of_their_own(spark):
    """Each is within a block of its own target while it lasts, the hot one and the small ones."""
    docs = spark.createDataFrame([(k * 1000 + i, f"t {k} {i}", f"s{k}") for k in range(300)
                                  for i in range(600 if k == 0 else 4 + k % 23)], "doc_id long, text string, source string")
    shares = M.smoothed_shares(docs)
    weight = {r.source: r.share for r in shares.collect()}
    assert len(weight) == 300 and weight["s0"] == 100
    rows = sorted(M.schedule(docs, shares, block=2).collect(), key=lambda r: r.position)
    assert len(rows) == docs.count() and len({r.position for r in rows}) == len(rows)
    assert len({r.source for r in rows if r.phase == 0}) == 300
    size, done, total = Counter(r.source for r in rows), Counter(), sum(weight.values())
    for r in rows:
        assert r.release <= r.slot < r.deadline
        if r.phase == 0 and r.position % 2 == 0:
            done[r.source] += 1
            if done[r.source] % 5 == 0:
                assert all(abs(done[s] * total - w * (r.slot + 1)) < total for s, w in weight.items() if 2 * done[s] < size[s])


def test_schedule_names_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a", "x", 5)], "doc_id long, text string, source string, Slot long")
    with pytest.raises(ValueError):
        M.schedule(docs, {})
    assert M.schedule(docs, {}, prefix="m_").select("Slot", "m_slot").collect() == [(5, 0)]


def test_shares_and_empty(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, slot string")
    shares = lambda e, d=docs: {r.source: r.share for r in M.smoothed_shares(d, e).collect()}
    assert shares(0) == {None: 100, "b": 100, "hot": 100, "unlisted": 100}
    assert shares(1)["hot"] == 100 and shares(1)[None] == round(5000 / 302)
    for wrong in ({"hot": 0}, {"hot": 1.5}):
        with pytest.raises(ValueError):
            M.schedule(docs.drop("slot"), wrong)
    with pytest.raises(ValueError):
        M.schedule(docs.drop("slot"), spark.createDataFrame([("hot", -1)], "source string, share long"))
    none = docs.limit(0)
    assert shares(0.5, none) == {}
    assert M.mix(none, {}).collect() == [] and M.mix(none, {"a": 1}).collect() == []
    assert M.mix(docs, {"hot": 1, "absent": 1}).count() == len(ROWS)
    doubled = spark.createDataFrame([("hot", 2), ("hot", 1), ("b", None)], "source string, share long")
    assert M.mix(docs, doubled).count() == len(ROWS)
