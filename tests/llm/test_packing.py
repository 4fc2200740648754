"""Packing: exact ids, each id in one piece, limits, padding, defined cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opslake.llm import packing as P

FILE = P.tokenizer_file()
TEXTS = [None, "", " ", "Hello, world.", "it's the 'S don't we'LL " * 30, "a" * 9000, "ÀÉ éè ß İstanbul ΑΣ σς ﬁ Å é  x y",
         "<|endoftext|> a<|startoftext|>b", "1234 56.7 x_y--z!? ...", "word " * 5000, "日本語 テキスト\nline\r\nnext\x0b\x0cend\ttab",
         "the cat sat on the mat. " * 40, "end.", "́alone ̀", "née!?;: œuvre × ÷ ªº"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def whole(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END_ID], dtype="<u4")


def test_chunks_equal_whole_texts(tokenizer):
    got = P.ChunkTokenizer(FILE).encode([t or "" for t in TEXTS])
    for t, ids in zip(TEXTS, got):
        assert ids.tolist() == whole(tokenizer, t).tolist()[:-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_any_text(texts):
    one = P.worker_tokenizer(FILE)
    for t, ids in zip(texts, one.encode(texts)):
        assert ids.tolist() == one.tokenizer.encode(t, add_special_tokens=False).ids


def check(rows, capacity, segments):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for parts in by.values():
        parts.sort(key=lambda r: r.offset)
        end = 0
        for r in parts:
            assert r.offset == end and r.length > 0
            end += r.length
        assert end <= capacity and len(parts) <= segments
        assert end == capacity or end & (end - 1) == 0
    return by


@pytest.mark.parametrize("capacity,segments", [(2048, 512), (64, 3), (16, 1)])
def test_pieces_cover_each_document_once(spark, tokenizer, capacity, segments, monkeypatch):
    docs = [(i, t, i, "z") for i, t in enumerate(TEXTS * 3)] + [(None, "no id", 1, "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string, sequence_id long, start string").repartition(3)
    rows = P.pack(df, FILE, capacity=capacity, max_segments=segments, max_loss=capacity).collect()
    check(rows, capacity, segments)
    texts = {i: t for i, t, *_ in docs}
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(texts)
    for i, parts in by.items():
        ids, at = whole(tokenizer, texts[i]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_loss_limit_and_prompts(spark):
    docs = spark.createDataFrame([(i, "answer words here " * (i % 7), "question " * (i % 5)) for i in range(60)],
                                 "doc_id long, text string, prompt string").coalesce(1)
    rows = P.pack(docs, FILE, capacity=128, max_segments=8, max_loss=20, prompt_col="prompt", with_ids=True).collect()
    by = check(rows, 128, 8)
    for parts in by.values():
        loss = 0
        for r in parts:
            head = r.doc_id % 5
            loss += max(0, r.start + r.length - max(r.start, head))
            assert len(r.ids) == r.length
        assert loss <= 20
    got = defaultdict(dict)
    for r in rows:
        got[r.doc_id][r.start] = r.ids
    for i in range(60):
        ids = [x for _, part in sorted(got[i].items()) for x in part]
        assert len(ids) == i % 5 + 3 * (i % 7) + 1


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []
