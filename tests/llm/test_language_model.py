"""The model against a dictionary implementation, and that it is a distribution."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from opslake.llm import language_model as L


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(train, order):
    """Counts of words and ends, and p(context, word); a context is a tuple of at most order - 1 tokens."""
    uni, levels = Counter(), [Counter() for _ in range(order + 1)]
    for t in train:
        s = ("<s>", *words(t), "</s>")
        uni.update(s[1:])
        for k in range(2, order + 1):
            levels[k].update(s[i:i + k] for i in range(len(s) - k + 1) if k == order or i == 0)
    for k in range(order - 1, 0, -1):  # below the highest order: distinct tokens before, but for what begins a text
        levels[k].update(g[1:] for g in levels[k + 1])
    d = [None] + [L.discounts(*(sum(n == k for n in c.values()) for k in (1, 2, 3, 4))) for c in levels[1:]]
    after = defaultdict(Counter)
    for c in levels[1:]:
        for g, n in c.items():
            after[g[:-1]][g[-1]] += n

    def p(ctx, w):
        own, k = after.get(ctx), len(ctx) + 1
        if not own:
            return p(ctx[1:], w) if ctx else 1.0 / (len(uni) + 1)
        low = p(ctx[1:], w) if ctx else 1 / (len(uni) + 1)
        c = sum(own.values())
        return max(own[w] - d[k][min(own[w], 3)], 0) / c + sum(d[k][min(n, 3)] for n in own.values()) / c * low

    return uni, p


DOCS = [(i, t, "x") for i, t in enumerate(
    [None, "", "a b a b a c", "The the THE end", "a b c d e f g", "a\tb\x0bc\nd", "ÄB äb Äb", "zz " * 400, " ", "a b", "b c d a",
     "rare only here", "a b a b", "the end of a b", "c a b d", "one two three", "three two one"] * 3)]


@pytest.fixture(params=[(8_000_000, 2), (40, 2), (8_000_000, 3), (40, 3)])
def rows(spark, monkeypatch, request):
    chars, order = request.param
    monkeypatch.setattr(L, "BUCKET_CHARS", chars)
    monkeypatch.setattr(L, "BUFFER", 100)
    monkeypatch.setattr(L, "SCORE_BUFFER", 50)
    docs = spark.createDataFrame([*DOCS, (None, "a b", "y")], "doc_id long, text string, score string").repartition(3)
    spark.createDataFrame([*DOCS, (None, "a b", "y")], "doc_id long, text string, score string")
    fold = L.F.crc32(L.F.coalesce(L.F.col("doc_id").cast("string"), L.F.lit("")).cast("binary")) % 10 == 0
    model = L.train(docs.where(~fold), order=order)
    return L.Model(model), L.score(docs, model).collect(), order


def test_equals_a_dictionary_model(rows):
    model, got, order = rows
    train = [t for i, t, _ in DOCS if zlib.crc32(str(i).encode()) % 10]
    uni, p = brute(train, order)
    n, v = sum(uni.values()), len(uni)
    assert (model.tokens, model.types) == (n, v)
    assert len(got) == len(DOCS) + 1
    texts = {i: t for i, t, _ in DOCS} | {None: "a b"}
    for r in got:
        s = ["<s>", *words(texts[r.doc_id]), "</s>"]
        assert r.n_tokens == len(s) - 1
        assert r.n_known == sum(uni[w] > 0 for w in s[1:])
        assert r.base_score == pytest.approx(sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s[1:]))
        assert r.score == pytest.approx(sum(
            math.log10(p(tuple(s[max(0, i - order + 1):i]), s[i])) for i in range(1, len(s))))
    for a in [("a",), ("the",), ("<s>",), ("never",), ("<s>", "a"), ("a", "b"), ("never", "b")]:
        assert sum(p(a, w) for w in uni) + p(a, "unknown") == pytest.approx(1.0)


@pytest.mark.parametrize("order", [2, 3])
def test_no_training_text_and_empty_table(spark, order):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = L.train(none, order=order)
    assert L.score(none, model).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [r.score for r in L.score(some, model).collect()] == [0.0, 0.0]


def test_blocks_round_trip():
    import numpy as np

    rng = np.random.default_rng(1)
    ctx, word = rng.integers(0, 1 << 56, 1000), rng.integers(0, 1 << 56, 1000)
    n = rng.integers(1, 100_000, 1000)
    order = np.argsort(ctx, kind="stable")
    for a, b in zip(L.decode_pairs(L.encode_pairs(ctx, word, n)), (ctx, word, n)):
        assert (a == b[order]).all()
    last = ctx % 1000
    assert (L.decode_pairs(L.encode_pairs(ctx, word, n, last))[3] == last[order]).all()


def test_totals_are_not_cut_to_32_bits():
    import numpy as np

    ids, cols = np.array([5, 6]), [np.array([2**32 + 5, 1]), np.array([255, 256])]
    kind, got, col = L.decode_stats(L.encode_stats(L.TOKEN, ids, cols))
    assert kind == L.TOKEN and got.tolist() == [5, 6] and col.tolist() == [[2**32 + 5, 1], [255, 256]]


def test_open_arrays_are_bounded(tmp_path):
    """3,000 buckets: all are looked up, few are open."""
    import os

    import numpy as np

    for b in range(3000):
        L._save(f"{tmp_path}/pairs-{b}.npy", np.array([b], np.uint64))
        L._save(f"{tmp_path}/pairsn-{b}.npy", np.array([b + 1], np.uint16))
    model = L.Model({"path": str(tmp_path), "sums": dict.fromkeys(L.SUMS, 0)})
    before = len(os.listdir("/proc/self/fd"))
    key = np.arange(3100)
    got = model._find("pairs", key.astype(np.uint64), key, np.zeros(3100, np.int64))
    assert got.tolist() == [*range(1, 3001), *[0] * 100]
    assert len(os.listdir("/proc/self/fd")) - before <= L.MAPS + 1


def test_model_with_frequent_and_other_contexts(spark, monkeypatch):
    """Contexts of frequent words lie in several buckets, those of others in one."""
    import os

    monkeypatch.setattr(L, "BUCKET_CHARS", 320)
    monkeypatch.setattr(L, "BUFFER", 100)
    monkeypatch.setattr(L, "SCORE_BUFFER", 200)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, score string").repartition(3)
    model = L.train(docs)
    names = {f.split("-")[0] for f in os.listdir(model["path"])}
    assert {"triples", "pairs", "contexts", "shared", "tokens"} <= names
    _, p = brute([t for _, t, _ in DOCS], 3)
    texts = {i: t for i, t, _ in DOCS}
    got = L.score(docs, model).collect()
    assert len(got) == len(DOCS)
    for r in got:
        s = ["<s>", *words(texts[r.doc_id]), "</s>"]
        assert r.score == pytest.approx(sum(math.log10(p(tuple(s[max(0, i - 2):i]), s[i])) for i in range(1, len(s))))


def test_little_more_than_the_model_is_on_disk(spark):
    """Some seven bytes an entry; nothing else is left in the shared folder."""
    import os

    import numpy as np

    rng = np.random.default_rng(2)
    texts = [(i, " ".join(f"w{x}" for x in rng.integers(0, 2000, 400))) for i in range(70)]
    streams = [("<s>", *words(t), "</s>") for _, t in texts]
    triples = {s[i:i + 3] for s in streams for i in range(len(s) - 2)}
    entries = len(triples) + len({g[1:] for g in triples}) + len(streams) + len({g[:2] for g in triples})
    entries += 3 * len({w for s in streams for w in s})
    model = L.train(spark.createDataFrame(texts, "doc_id long, text string"))
    files = [f for f in os.listdir(model["path"]) if f != "words"]
    assert sum(os.path.getsize(f"{model['path']}/{f}") for f in files) < 7.3 * entries + 4096 * len(files)
    root = os.path.dirname(model["path"])
    left = [f for d in os.listdir(root) if d.startswith("llm-counts") for _, _, fs in os.walk(f"{root}/{d}") for f in fs]
    assert left == []


def test_blocks_of_frequent_words_are_small():
    import numpy as np

    rng = np.random.default_rng(3)
    ctx, word, last = (rng.zipf(1.2, 50_000) % 100_000 for _ in range(3))
    ctx, word, last = np.unique(np.stack([ctx, word, last]).astype(np.int64), axis=1)
    assert len(L.encode_pairs(ctx, word, np.ones(len(ctx), np.int64), last)) < 5 * len(ctx)


@pytest.mark.parametrize("n", [1, 300, 50_000])
def test_shelf_finds_exactly_its_keys(n):
    import numpy as np

    rng = np.random.default_rng(n)
    key = rng.integers(0, 1 << 56, n)
    key = np.unique(np.concatenate([key, key[:100] ^ 1, key[:100] ^ 3, [0, (1 << 56) - 1]]))  # neighbours
    cols = [rng.zipf(1.5, len(key)).astype(np.int64) for _ in range(4)]
    cols[0][0], cols[1][-1] = 2**40, 32
    for k in (1, 4):
        table = L.Shelf(L.shelf(key, cols[:k]))
        order = rng.permutation(len(key))
        assert (table.get(key[order]) == np.stack(cols[:k], axis=1)[order]).all()
        other = np.setdiff1d(np.concatenate([key[:200] ^ 2, key[-200:] ^ 4, rng.integers(0, 1 << 56, 1000)]), key)
        assert (table.get(other) == 0).all()
    assert table.get(np.zeros(0, np.int64)).shape == (0, 4)


def test_streams_follow_the_words_of_the_contract(tmp_path):
    import pyarrow as pa

    (tmp_path / "words").write_bytes("the\nä".encode())
    (tmp_path / "none").write_bytes(b"")
    texts = ["", None, "  The\tthe\x0bTHE\x0c\x1cthe \r\n ä ", "Ä ä\xa0b the", " ", "x\0 \0 x"]
    for name in ("words", "none"):
        ids = L.Tokens(f"{tmp_path}/{name}")
        for rows in (pa.array(texts), pa.array(["skipped row", *texts]).slice(1)):
            stream, n = ids.stream(rows)
            own = iter(stream.tolist())
            seen = {}
            for t, k in zip(texts, n.tolist()):
                s = [next(own) for _ in range(k + 1)]
                assert (s[0], s[-1]) == (L.START, L.END)
                assert len(words(t)) == k - 1
                for w, i in zip(words(t), s[1:-1]):
                    assert seen.setdefault(w, i) == i
            assert list(own) == [] and len(set(seen.values())) == len(seen)
            assert min(seen.values()) >= (L.END + 1 if name == "words" else L.HASHED)
    assert (seen["the"] >= L.HASHED) and L.Tokens(f"{tmp_path}/words").stream(pa.array(["the ä"]))[0].tolist() == [L.START, 3, 4, L.END]


def test_grams_of_more_ids_than_fit_one_key():
    import numpy as np

    ids = np.arange(3, 3 + (1 << 21), dtype=np.int64)
    stream = np.concatenate([[L.START], ids, [L.END, L.START], ids[:5], [L.END]])
    ctx, word, n, before = L.distinct_grams(stream, 3, stream[:-1] != L.END)
    twice = (ctx < 7) & (before < 7) & (word < 8)
    assert (n == np.where(twice & (word != L.END), 2, 1)).all()
    assert len(n) == len(ids) + 1 + 1 and (before[ctx == L.START] == 0).all()
    longer = (ctx > 3) & (word > 2)
    assert (before[longer] + 2 == word[longer]).all() and (ctx[longer] + 1 == word[longer]).all()


def test_a_look_up_opens_few_files_however_many_buckets(tmp_path):
    import os

    import numpy as np

    rng = np.random.default_rng(5)
    key, bucket = np.unique(rng.integers(0, 1 << 56, 20_000)), None
    bucket = rng.integers(0, 300, len(key))
    bucket[bucket == 70] = 71  # no shelf
    n = rng.zipf(1.5, len(key)).astype(np.int64)
    for b in np.unique(bucket).tolist():
        L._save(f"{tmp_path}/pairs-{b}.npy", L.shelf(key[bucket == b], [n[bucket == b]]))
    for g in [*range(8), 3]:
        L.join_shelves(str(tmp_path), "pairs", g, 8, 300)
    assert sorted(os.listdir(tmp_path)) == [f"pairs-group-{g}.npy" for g in range(8)]
    model = L.Model({"path": str(tmp_path), "groups": 8, "sums": dict.fromkeys(L.SUMS, 0)})
    assert (model._counts("pairs", key, bucket, 1)[:, 0] == n).all()
    assert (model._counts("pairs", key, (bucket + 1) % 300, 1) == 0).all()
    assert (model._counts("pairs", key, np.full(len(key), -1), 1) == 0).all()
    assert (model._counts("pairs", key, np.full(len(key), 70), 1) == 0).all()
