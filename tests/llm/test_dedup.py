"""SimHash and embedding near-dedup against pairwise comparison."""

import inspect
import random

import numpy as np
import pytest
import xxhash

from opslake.llm import embedding_dedup as E
from opslake.llm import simhash as S


def components(n, pairs):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


TEXTS = [None, "", " \n\t", "one", "One", "two words", "a b c", "A  b\tc", "ÀB éÉ x y", " x y  z", "long " * 5000]


def documents():
    rng = random.Random(3)
    docs = [(i, t, "a", 0) for i, t in enumerate(TEXTS)]
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(300)]
        for k in range(8):
            words = base[:]
            for _ in range(k // 2):
                words[rng.randrange(300)] = "new"
            docs.append((100 + g * 8 + k, " ".join(words), "b", k))
    return docs + [docs[20], docs[20], (None, "alone without an id", "c", 0), (None, docs[30][1], "c", 1),
                   (101, "another text of one id", "d", 2), docs[3]]


def test_simhash_equals_pairwise(spark):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string, fp string, grp long").repartition(4)
    fps = [plain_fingerprint(t) for _, t, *_ in docs]
    assert [S.fingerprint(t) for _, t, *_ in docs] == fps
    pairs = [(a, b) for a in range(len(docs)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    label = components(len(docs), pairs)
    least = {g: min((docs[i][0] for i in range(len(docs)) if label[i] == g and docs[i][0] is not None), default=None) for g in label}
    got = sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in S.simhash_components(df).collect()), key=str)
    assert got == sorted(((d[0], f, least[g]) for d, f, g in zip(docs, fps, label)), key=str)
    kept = [tuple(r) for r in S.simhash_dedup(df).collect()]
    assert len(kept) == len(set(label))
    assert sorted((k[0] for k in kept), key=str) == sorted(least.values(), key=str)
    assert all(k in docs for k in kept)
    assert S.simhash_components(df.limit(0)).collect() == [] and S.simhash_dedup(df.limit(0)).collect() == []


def test_other_distances(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (1 << 64) - 1 for b in base for _ in range(20)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for bits in (0, 1, 2, 3, 5):
        got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in S.links(df, bits).collect()}
        assert got == {frozenset((a, b)) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= bits}


@pytest.mark.parametrize("block", [4096, 8])
def test_embeddings_equal_pairwise(spark, block):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for _ in range(12):
        c = rng.normal(size=24)
        for _ in range(10):
            rows.append((k, (c + rng.normal(size=24) * 0.12).astype(np.float32).tolist()))
            k += 1
    rows += [(k + i, rows[3][1]) for i in range(40)] + [(9, rows[9][1])]
    odd = [(500, None), (501, []), (502, [0.0] * 24), (503, [float("nan")] * 24), (504, [1.0] * 23 + [None]), (505, [float("inf")] * 24),
           (506, [0.0] * 24), (507, [3.0, 4.0]), (508, [6.0, 8.0]), (None, rows[0][1])]
    every = rows + odd
    df = spark.createDataFrame([(i, v, 7) for i, v in every], "vec_id long, embedding array<float>, n long").repartition(3)

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(np.float64)
        return x / np.linalg.norm(x)

    u = [unit(v) for _, v in every]
    pairs = [(a, b) for a in range(len(u)) for b in range(a)
             if u[a] is not None and u[b] is not None and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.9]
    label = components(len(u), pairs)
    n = [sum(i in p for p in pairs) for i in range(len(u))]
    least = {g: min((every[i][0] for i in range(len(u)) if label[i] == g and every[i][0] is not None), default=None) for g in label}
    want = sorted(((every[i][0], n[i], least[label[i]], every[i][0] == least[label[i]]) for i in range(len(u))), key=str)
    got = sorted((tuple(r) for r in E.embedding_dedup(df, block=block).collect()), key=str)
    assert got == want
    assert E.embedding_dedup(df.limit(0)).collect() == []


@pytest.mark.parametrize("dim", [64, 384])
def test_pairs_at_the_threshold_meet(dim):
    """Recall of the index, with its own parameters, over random pairs at cosine 0.9 exactly."""
    index = {k: p.default for k, p in inspect.signature(E.embedding_links).parameters.items()}
    rng = np.random.default_rng(dim)
    a = rng.standard_normal((400, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((400, dim))
    side -= (side * a).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * side / np.linalg.norm(side, axis=1, keepdims=True)
    keys = [E.bucket_keys(x, index["tables"], index["hashes"], index["probes"], index["seed"]) for x in (a, b)]
    met = [bool(set(p) & set(q)) for p, q in zip(keys[0].tolist(), keys[1].tolist())]
    assert np.mean(met) >= 0.98
