"""Substring dedup against a dictionary of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from opslake.llm import substring_dedup as S


def plain(docs, window):
    """(id, words, removed, digest) of each row."""
    last = 1 << 63
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    first = {}
    for (i, _), words in zip(docs, split):
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            first[key] = min(first.get(key, last), last if i is None else i)
    out = []
    for (i, _), words in zip(docs, split):
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < (last if i is None else i):
                gone.update(range(at, at + window))
        kept = " ".join(w for at, w in enumerate(words) if at not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(spark, docs, window, parts=4):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    out = S.substring_dedup(df.withColumns({"pos": S.F.lit(1), "name": S.F.lit("x"), "spans": S.F.lit(2)}), window)
    assert out.columns == ["doc_id", "text", "pos", "name", "spans", "dedup"]
    return sorted((str(r.doc_id), r.dedup.n_words, r.dedup.n_removed, hashlib.sha256(r.dedup.kept.encode()).hexdigest())
                  for r in out.select("doc_id", "dedup").collect())


def prose(rng, n, vocabulary):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randrange(50, 140), 900) for _ in range(6)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += prose(rng, rng.randrange(0, 60), 900)
            p = passages[rng.randrange(6)]
            a, b = sorted((rng.randrange(len(p) + 1), rng.randrange(len(p) + 1)))
            words += p if rng.random() < 0.5 else p[a:b]
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    base = docs[7][1].split()
    for i in range(60, 75):  # near and exact copies
        words = base * (1 + i % 2)
        for _ in range(i % 3):
            words[rng.randrange(len(words))] = "changed"
        docs.append((i, " ".join(words)))
    rng.shuffle(docs)
    return docs + [(200, None), (201, ""), (202, " \n\t"), (203, "É x " * 80), (204, "É x " * 70), (None, docs[5][1]), (None, docs[5][1]),
                   (205, docs[3][1]), (205, docs[3][1]), (205, docs[4][1]), docs[9], docs[9], (206, " ".join(base[:49])), (207, " ".join(base[:50]))]


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_equal_all_windows(spark, seed):
    docs = documents(seed)
    want = plain(docs, 50)
    assert sum(w[2] for w in want) > 3000
    assert got(spark, docs, 50) == want


@pytest.mark.parametrize("window,vocabulary", [(2, 4), (3, 2), (5, 2), (8, 2), (8, 3), (13, 2)])
def test_loops_and_branches(spark, window, vocabulary):
    """Few words: nodes with many branches, cycles and repeats within a document."""
    rng = random.Random(window * 10 + vocabulary)
    docs = [(i // 2 if i % 9 == 0 else i, " ".join(prose(rng, rng.randrange(0, 40), vocabulary))) for i in range(80)]
    docs += [(100 + i, "a " * (10 + i)) for i in range(5)] + [(110 + i, "a b " * (10 + i)) for i in range(5)]
    assert got(spark, docs, window) == plain(docs, window)


def test_long_text_and_empty_table(spark):
    rng = random.Random(9)
    long = prose(rng, 200_000, 5000)
    docs = [(3, " ".join(long)), (2, " ".join(long[150_000:150_300])), (5, " ".join(long[:1000] + ["x"] + long[1000:2000]))]
    assert got(spark, docs, 50, 2) == plain(docs, 50)
    assert got(spark, [], 50, 1) == []
    with pytest.raises(ValueError):
        S.substring_dedup(spark.createDataFrame([], "doc_id long, text string"), 1)


def test_nodes_left_out_are_no_joints():
    """Only a small part of the nodes of two near copies is made."""
    rng = random.Random(1)
    a = prose(rng, 3000, 10 ** 6)
    b = a[:1500] + ["new"] + a[1500:]
    x, y = (S.Document([w.encode() for w in t], 50) for t in (a, b))
    where = {}
    for d, doc in enumerate((x, y)):
        around, inner = doc.neighbours()
        for i, name in enumerate(doc.names.tolist()):
            where.setdefault(name, []).append((d, around[i] if inner[i] else None))
    marks = {name: len({s[1] for s in seen}) == 1 and seen[0][1] is not None for name, seen in where.items() if len({s[0] for s in seen}) > 1}
    made = x.near_joints({p: marks[n] for p, n in zip(x.anchors.tolist(), x.names.tolist()) if n in marks})
    assert {0, len(a) - 49, 1500 - 49, 1500} <= set(made.tolist()) and len(made) < 400


def test_query(spark, tmp_path):
    docs = documents(3)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = S.op11_substring_dedup(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in map(tuple, out.collect())) == plain(docs, 50)


def test_span_hashes():
    words = S.word_hashes([b"a", b"b", b"a", b"b", b"a"])
    p = S.Prefix(words)
    one, two = p.span(np.array([0, 1]), np.array([2, 3])), p.span(np.array([2, 3]), np.array([4, 5]))
    assert one.tolist() == two.tolist() == p.strings(2)[:2].tolist() and one[0] != one[1]
