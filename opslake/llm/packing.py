"""Packing: vector bin packing of tokenised examples into training sequences.

An example is a list of token ids, of which the first ``prompt`` ones bear no
loss. A sequence has simultaneous limits on tokens, segments and loss-bearing
tokens. Bins are filled one at a time by the dot-product heuristic: of the
pieces that fit, the one whose (tokens, segment, loss) demand has the largest
weighted dot product with the room left goes in; the weights are the mean
demands of the waiting pieces. When nothing fits, the best piece is cut to fill
the room exactly, so padding appears only where the segment or loss limit binds.
What is left at the end of a partition is cut into sequences whose lengths are
powers of two, which need no padding.

Scale: one narrow pass over the documents, no shuffle. Each task packs its own
partition from a bounded pool of waiting pieces; sequence ids carry the
partition number, so a retried task gives the same rows. Tokenising goes through
a bounded cache of white-space-delimited chunks (the tokenizer drops white space,
so chunks are independent), which is exact: see tests/llm/test_packing.py.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslake.llm._common import read_table

CAPACITY = 2048
END_ID = 1
POOL = 2048         # pieces that wait at most in a task
CACHE = 700_000     # chunks whose ids are kept in a Python worker
SLICE = 1_000_000   # characters tokenised at once
PARTITION_SHIFT = 36


class _Index(dict):
    """chunk -> number; new chunks are numbered and listed as they come."""

    def __init__(self):
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class ChunkTokenizer:
    """Token ids of texts by way of a bounded cache of chunks between white space.

    New chunks of Latin letters (one word to the tokenizer) are encoded many at
    a time and told apart by the ids that end words; letters with punctuation
    after them are put together of both; all others are encoded one by one."""

    PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,;:!?]*)")
    JOINED = 512

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.index, self.flat = _Index(), np.zeros(0, np.uint32)
        self.start, self.length = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of chunks of letters."""
        texts = [" ".join(chunks[i:i + self.JOINED]) for i in range(0, len(chunks), self.JOINED)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        if len(ends) != len(chunks):
            raise ValueError("the tokenizer does not end every word with </w>")
        return flat, np.diff(ends, prepend=0)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries numbered ``at``, one after another, and where each ends."""
        length = self.length[at]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[at] - (ends - length), length) + np.arange(total)], ends

    def _append(self, numbers: np.ndarray, flat: np.ndarray, length: np.ndarray) -> None:
        self.start[numbers] = len(self.flat) + np.cumsum(length) - length
        self.length[numbers] = length
        self.flat = np.concatenate([self.flat, flat])

    def _learn(self) -> None:
        new, known = self.index.new, len(self.length)
        if not new:
            return
        plain, other, whole, left, right = [], [], [], [], []
        for k, chunk in enumerate(new, known):  # letters and marks of a chunk join the list while it is read
            m = self.PLAIN.fullmatch(chunk)
            if not m:
                other.append(k)
            elif m[2]:
                whole.append(k)
                left.append(self.index[m[1]])
                right.append(self.index[m[2]])
            else:
                plain.append(k)
        grown = np.zeros(len(new), np.int64)
        self.start, self.length = np.concatenate([self.start, grown]), np.concatenate([self.length, grown])
        self._append(np.array(plain, np.int64), *self._plain([new[k - known] for k in plain]))
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([new[k - known] for k in other], add_special_tokens=False)]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        self._append(np.array(other, np.int64), np.fromiter(chain.from_iterable(ids), np.uint32, int(length.sum())), length)
        pairs = np.array([left, right], np.int64).T.ravel()
        flat, ends = self._gather(pairs)
        self._append(np.array(whole, np.int64), flat, np.diff(ends[1::2], prepend=0))
        self.index.new = []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; equal to encoding the whole texts."""
        if len(self.index) > CACHE:
            self._reset()
        split = [self._lower(t).replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self._learn()
        ids, ends = self._gather(at)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    @staticmethod
    def _lower(text: str) -> str:
        """Latin-1 texts in lower case, as the tokenizer does first; others as they are."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def worker_tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer and cache for each Python worker, kept across its tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Packs pieces into sequences; ``out`` gets (key, start, ids, total, sequence, offset)."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int, first_sequence: int = 0, pool: int = POOL):
        if min(capacity, max_segments, max_loss) < 1:
            raise ValueError("limits must be at least 1")
        self.limits = np.array([capacity, max_segments, max_loss], float)
        self.capacity, self.max_segments, self.max_loss = capacity, max_segments, max_loss
        self.sequence, self.out, self.pool, self.most = first_sequence, [], [], pool

    @staticmethod
    def _loss(a: int, b: int, prompt: int) -> int:
        return max(0, b - max(a, prompt))

    def _prefix(self, a: int, b: int, prompt: int, room: int, loss: int) -> int:
        """The largest end of a piece from a that has at most room tokens and loss loss-bearing ones."""
        return min(b, a + room, max(a, prompt) + loss)

    def add(self, key, ids: np.ndarray, prompt: int = 0) -> None:
        a, n = 0, len(ids)
        while a < n:
            b = self._prefix(a, n, prompt, self.capacity, self.max_loss)
            if b - a == self.capacity:
                self._emit([(key, ids, a, b)])
            else:
                self.pool.append((key, ids, a, b, prompt))
            a = b
        if len(self.pool) >= self.most:
            self._pack(self.most // 2)

    def _emit(self, parts: list) -> None:
        offset = 0
        for key, ids, a, b in parts:
            self.out.append((key, a, ids[a:b], len(ids), self.sequence, offset))
            offset += b - a
        self.sequence += 1

    def _pack(self, leave: int) -> None:
        """Fill bins until at most ``leave`` pieces wait."""
        pool = self.pool
        demand = np.array([[b - a, 1, self._loss(a, b, p)] for _, _, a, b, p in pool], float)
        alive = np.ones(len(pool), bool)
        weight = demand.mean(0) / self.limits / self.limits ** 2 if len(pool) else None
        left = len(pool)
        while left > leave:
            room, parts = self.limits.copy(), []
            while left:
                fits = alive & (demand[:, 0] <= room[0]) & (demand[:, 2] <= room[2]) if room[1] >= 1 else None
                if fits is not None and fits.any():
                    score = np.where(fits, demand @ (weight * room), -1.0)
                    i = int(score.argmax())
                    key, ids, a, b, prompt = pool[i]
                    parts.append((key, ids, a, b))
                    room -= demand[i]
                    alive[i] = False
                    left -= 1
                    continue
                if fits is None or room[0] < 1:
                    break
                # Nothing fits whole: cut the piece that fills most of the room.
                score = np.where(alive, np.minimum(demand, room) @ (weight * room), -1.0)
                i = int(score.argmax())
                key, ids, a, b, prompt = pool[i]
                end = self._prefix(a, b, prompt, int(room[0]), int(room[2]))
                if end <= a:
                    break
                parts.append((key, ids, a, end))
                room -= [end - a, 1, self._loss(a, end, prompt)]
                pool[i] = (key, ids, end, b, prompt)
                demand[i] = [b - end, 1, self._loss(end, b, prompt)]
            self._close(parts)
        self.pool = [x for x, here in zip(pool, alive) if here]

    def _close(self, parts: list) -> None:
        """A full bin is a sequence; others become sequences of power-of-two lengths."""
        total = sum(b - a for _, _, a, b in parts)
        while total:
            size = self.capacity if total == self.capacity else 1 << (total.bit_length() - 1)
            now, need = [], size
            while need:
                key, ids, a, b = parts.pop(0)
                take = min(need, b - a)
                now.append((key, ids, a, a + take))
                if a + take < b:
                    parts.insert(0, (key, ids, a + take, b))
                need -= take
            self._emit(now)
            total -= size

    def finish(self) -> None:
        self._pack(0)

    def drain(self) -> list:
        out, self.out = self.out, []
        return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, max_segments: int = 512,
         max_loss: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
         end_id: int = END_ID, with_ids: bool = False, order: list[Column] | None = None, pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids with ``with_ids``).

    An example is the prompt's tokens (no loss; none without ``prompt_col``),
    the text's tokens and ``end_id``. Each id lies in exactly one piece. A
    sequence has at most ``capacity`` tokens, ``max_segments`` pieces and
    ``max_loss`` loss-bearing tokens, and is padded to ``capacity`` unless its
    length is a power of two. With ``order`` the examples are packed in that order
    and sequence ids rise with it: only the ``pool`` neighbours that wait together
    can change places.

    Defined cases: null prompts and texts are empty (the example is its end
    id); null ids are carried; repeated rows are packed each; very long texts
    are cut into full sequences; an empty table gives an empty result; extra
    columns are ignored."""
    prompt = F.col(f"`{prompt_col}`").cast("string") if prompt_col else F.lit(None).cast("string")
    if order:
        docs = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                      prompt.alias("prompt"))
    fields = [T.StructField("doc_id", T.LongType())] + [
        T.StructField(n, T.LongType(), False)
        for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    names = [f.name for f in fields]

    def rows(out: list) -> pa.RecordBatch:
        cols = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                pa.array([len(r[2]) for r in out], pa.int64()),
                pa.array([zlib.crc32(r[2].astype("<u4").tobytes()) for r in out], pa.int64())]
        cols += [pa.array([r[i] for r in out], pa.int64()) for i in (3, 4, 5)]
        if with_ids:
            cols.append(pa.array([r[2].astype(np.int32) for r in out], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_tokenizer(tokenizer_path)
        packer = Packer(capacity, max_segments, max_loss, TaskContext.get().partitionId() << PARTITION_SHIFT, pool)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            at = 0
            while at < len(keys):
                texts, prompts, size, to = [], [], 0, at
                while to < len(keys) and size < SLICE:
                    texts.append(batch.column(1)[to].as_py() or "")
                    prompts.append(batch.column(2)[to].as_py() or "")
                    size += len(texts[-1]) + len(prompts[-1])
                    to += 1
                lead = encoder.encode(prompts) if prompt_col else None
                for i, body in enumerate(encoder.encode(texts)):
                    head = lead[i] if lead else body[:0]
                    packer.add(keys[at + i], np.concatenate([head, body, end]), len(head))
                at = to
                if packer.out:
                    yield rows(packer.drain())
        packer.finish()
        if packer.out:
            yield rows(packer.drain())

    return src.mapInArrow(run, T.StructType(fields))


def tokenizer_file() -> str:
    """The public vocabulary file of the contract (a parameter of ``pack``)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: the pieces of all documents."""
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_file())
