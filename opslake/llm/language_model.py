"""LM scoring: interpolated modified Kneser-Ney n-grams of order 2 or 3, counted in Spark.

Counting: each task turns its documents into token ids, counts its n-grams of the
highest order in bounded buffers and emits one sorted block per model bucket; a
shuffle by bucket merges the blocks. A word's id is its place in a bounded list of
frequent words, or else a 56-bit hash: the list, taken from a sample, only makes
blocks small and spreads frequent words, and no count depends on it. The bucket is
that of an n-gram's last two words, so a bucket also has all left neighbours of its
bigrams, which the lower order counts. A context is dealt by its last word: a
frequent one goes to all buckets by its successor, so nothing meets in one task
whole; any other has all its successors in one. Each bucket is written as a shelf
(sorted 56-bit n-gram hashes without the bits that their place gives, and counts)
in the shared folder; what words and contexts with a frequent word need (counts,
successors by count class, distinct contexts) is merged in a second, smaller
shuffle. The buckets are counted in ``ROUNDS`` rounds and shuffle files and partial
counts go as soon as they are merged, so that little more than the model is on disk.

Scoring: one narrow pass. Tasks memory-map the arrays and look queries up by
binary search; the shelves of many buckets are joined into one of ``GROUPS`` files
and at most ``MAPS`` arrays are open, so neither a worker's memory nor its
descriptors nor the look-ups of a text grow with the model. Counts are exact up to 64 bits.

The counts of either order cover every training document whole.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import SPACE_CLASS, Scratch, ascii_lower, mounted_path, read_table

START, END = 1, 2            # token hashes of the text's begin and end
CODES = 1 << 17              # words with short ids: END + 1 and on, by falling frequency
CODE_BYTES = 4096            # of such a word at most
CODE_CHARS = 32_000_000      # characters of the sample they are taken from
HASHED = END + 1 + CODES     # ids from here on are hashes
ROUNDS = 2                   # in which the buckets are counted
BUCKET_CHARS = 8_000_000     # characters of training text a bucket
TOKEN_BUCKETS = 8            # buckets to one token bucket
GROUPS, GROUP = 64, 2048     # files of an array, or as many as hold GROUP buckets each
BUFFER = 2_500_000           # tokens counted at once in a task
SCORE_BUFFER = 8_000_000     # bytes of text scored at once in a task
MAPS = 64                    # arrays a scoring task has open
SMALL, TUPLES = 32, 255       # a shelf codes its most frequent tuples of counts below SMALL in a byte
COUNT, CONT, TOTAL, N1, N2, N3 = range(6)  # of a token; a longer context has the last four
NONE = np.zeros(0, np.int64)


class Tokens:
    """Word ids: of a listed word its place, else its hash."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            listed = np.array(f.read().split(), object)
        listed = self._hash(listed)
        by = np.argsort(listed)
        self.listed, self.codes = listed[by], by + END + 1

    @staticmethod
    def _hash(words: np.ndarray) -> np.ndarray:
        return np.maximum((pd.util.hash_array(words, categorize=False) >> np.uint64(8)).astype(np.int64), HASHED)

    def ids(self, words: pa.Array) -> np.ndarray:
        """The id of each distinct word; 0 of the empty one, which lies beside white space at an end."""
        h = self._hash(words.to_numpy(zero_copy_only=False))
        if len(self.listed):
            at = np.minimum(np.searchsorted(self.listed, h), len(self.listed) - 1)
            h = np.where(self.listed[at] == h, self.codes[at], h)
        return np.where(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False), 0, h)

    def stream(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """START, the lower-cased words' ids and END of each text; the texts' numbers of words and ends."""
        words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        places, first = words.flatten().dictionary_encode(), words.offsets.to_numpy()
        ids = self.ids(places.dictionary.cast(pa.binary()))
        ids = ids[places.indices.to_numpy()]
        n = np.diff(np.concatenate([[0], np.cumsum(ids > 0)])[first - first[0]]) + 2
        end = np.cumsum(n)
        out = np.zeros(int(n.sum()), np.int64)
        out[end - n], out[end - 1] = START, END
        out[out == 0] = ids[ids > 0]
        return out, n - 1


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of pieces of a column with some ``size`` bytes; a longer text is whole."""
    piece = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    cut = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), len(piece)]
    for a, b in zip(cut, cut[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)


def pair_key(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hash of (context, word)."""
    with np.errstate(over="ignore"):
        h = ctx.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h = (h + word.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h * np.uint64(0x94D049BB133111EB)


def gram_key(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    """56-bit hash of (context, word)."""
    return (pair_key(ctx, word) >> np.uint64(8)).astype(np.int64)


def pair_bucket(ctx: np.ndarray, word: np.ndarray, buckets: int, light: int) -> np.ndarray:
    """Ids below ``light`` are of frequent words."""
    return (ctx + np.where(ctx < light, word, 0)) % buckets


def context(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """56-bit hash of a context of two tokens."""
    return np.maximum((pair_key(first, second) >> np.uint64(8)).astype(np.int64), END + 1)


def grams(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token before, context, word) of every word and end in a stream of texts.
    Only where the context isn't START is the token before it of the same text."""
    before, ctx, word = np.concatenate([[END], stream[:-2]]), stream[:-1], stream[1:]
    real = ctx != END
    return before[real], ctx[real], word[real]


def summed(key: np.ndarray, *counts: np.ndarray):
    """Distinct keys ascending, where each first stands, and sums of the counts."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], order[first], [np.add.reduceat(c[order], first) if len(first) else c[:0] for c in counts]


def distinct_ids(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids ascending, and the place among them of each token; only hashes are sorted."""
    small = stream < HASHED
    there = np.zeros(HASHED, bool)
    there[stream[small]] = True
    low = np.flatnonzero(there)
    high, place = np.unique(stream[~small], return_inverse=True)
    out = np.empty(len(stream), np.int64)
    out[small], out[~small] = (np.cumsum(there) - 1)[stream[small]], place + len(low)
    return np.concatenate([low, high]), out


def distinct_grams(stream: np.ndarray, order: int, take: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct n-grams of a stream of texts as (context, word, count, token before), by
    context, word and token before; that is 0 in an n-gram of two tokens. ``take``: whether
    the n-gram whose word is one place on counts."""
    ids, rank = distinct_ids(stream)
    before, ctx, word = np.concatenate([[0], rank[:-2] + 1]), rank[:-1], rank[1:]
    before = np.where(stream[:-1] == START, 0, before) if order > 2 else np.zeros_like(before)
    bits, pairs = int(len(ids)).bit_length(), None
    mask = (1 << bits) - 1
    key = (ctx << bits | word)[take]
    if 3 * bits > 63:
        pairs, key = np.unique(key, return_inverse=True)
    key = np.sort(key << bits | before[take])
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(first, len(key)))
    key = key[first]
    before, key = key & mask, key >> bits
    if pairs is not None:
        key = pairs[key]
    return ids[key >> bits], ids[key & mask], n, np.where(before > 0, ids[before - 1], 0)


def _groups(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, its places in order) of each distinct value of 0 and more."""
    if len(of):
        by = np.argsort(of.astype(np.int16) if of.max() < 1 << 15 else of, kind="stable")
        first = np.flatnonzero(_runs_of(of[by]))
        yield from ((k, p) for k, p in zip(of[by[first]].tolist(), np.split(by, first[1:])) if k >= 0)


def _pack(*cols: np.ndarray) -> bytes:
    """Columns of 64 bits as compressed byte planes without those that are all zero."""
    used, planes = [], []
    for c in cols:
        p = np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8).T
        some = p.any(axis=1)
        used.append(some)
        planes.append(p[some].tobytes())
    raw = b"".join(planes)
    return (np.array([len(cols[0]), len(raw)], "<i8").tobytes() + np.packbits(used, axis=1).tobytes()
            + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b""))


def _unpack(blob: bytes, width: int) -> list[np.ndarray]:
    n, size = np.frombuffer(blob, "<i8", 2).tolist()
    used = np.unpackbits(np.frombuffer(blob, np.uint8, width, 16)).reshape(width, 8).astype(bool)
    raw = np.frombuffer(pa.decompress(blob[16 + width:], size, codec="zstd", asbytes=True) if size else b"", np.uint8).reshape(-1, n)
    out, at = [], 0
    for some in used:
        p = np.zeros((n, 8), np.uint8)
        p[:, some] = raw[at:at + some.sum()].T
        at += some.sum()
        out.append(p.view("<i8").ravel())
    return out


def _runs_of(*cols: np.ndarray) -> np.ndarray:
    """Whether a row begins a run of equal values in all columns."""
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return new


def _steps(col: np.ndarray, new: np.ndarray) -> np.ndarray:
    """A run's first value, then the differences."""
    return np.where(new, col, np.diff(col, prepend=col[:1]))


def _sums(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    total, first = np.cumsum(steps), np.flatnonzero(new)
    return total - np.repeat(total[first] - steps[first], np.diff(np.append(first, len(steps))))


def encode_pairs(ctx: np.ndarray, word: np.ndarray, n: np.ndarray, last: np.ndarray | None = None) -> bytes:
    """A block of n-grams by context, small if words and ``last`` (one more token) ascend in their runs."""
    order = np.argsort(ctx, kind="stable")
    ctx, word, n = ctx[order], word[order], n[order]
    cols = [np.diff(ctx, prepend=0), _steps(word, _runs_of(ctx)), n]
    if last is not None:
        cols.append(_steps(last[order], _runs_of(ctx, word)))
    return bytes([len(cols)]) + _pack(*cols)


def decode_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    ctx, word, n, *last = _unpack(blob[1:], blob[0])
    ctx = np.cumsum(ctx)
    word = _sums(word, _runs_of(ctx))
    return ctx, word, n, _sums(last[0], _runs_of(ctx, word)) if last else None


def encode_stats(kind: int, ids: np.ndarray, cols: list[np.ndarray]) -> bytes:
    """A block of ids, small if they ascend, with columns."""
    return bytes([kind, len(cols)]) + _pack(np.diff(ids, prepend=0), *cols)


def decode_stats(blob: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    ids, *cols = _unpack(blob[2:], blob[1] + 1)
    return blob[0], np.cumsum(ids), np.stack(cols)


def shelf(key: np.ndarray, cols: list[np.ndarray], bits: int = 8) -> np.ndarray:
    """Bytes of a table of ascending 56-bit keys and up to four counts each. A key's first
    ``bits`` (8 or 16) are given by its slot; its counts are one of ``TUPLES`` tuples or stand apart."""
    n, width, end = len(key), len(cols), 24 - bits
    slots = np.searchsorted(key, np.arange((1 << bits) + 1, dtype=np.int64) << (56 - bits))
    col = np.stack(cols)
    small = np.flatnonzero((col < SMALL).all(axis=0))
    code = np.full(n, TUPLES, np.uint8)
    tuples = (col[:, small] * SMALL ** np.arange(width)[:, None]).sum(axis=0)
    times = np.bincount(tuples, minlength=TUPLES)
    table = np.argsort(-times, kind="stable")[:TUPLES]
    of = np.full(len(times), TUPLES, np.uint8)
    of[table] = np.arange(TUPLES)
    code[small] = of[tuples]
    apart = np.flatnonzero(code == TUPLES)
    out = Shelf(np.zeros(Shelf.size(n, width, bits, 1, len(apart)), np.uint8), (n, width, bits, 1, len(apart)))
    out.table[:], out.large[:], out.apart[:], out.slots[:] = table, col[:, apart].T, apart, slots
    out.top[:], out.end[:], out.code[:] = key >> end & 0xFFFFFFFF, key & ((1 << end) - 1), code
    return out.raw


class Shelf:
    """Look-ups in the bytes of ``shelf``, or of several buckets' shelves one after another."""

    def __init__(self, raw: np.ndarray, head: tuple | None = None):
        self.raw = raw
        if head:
            raw[:40].view("<i8")[:] = head
        self.n, self.width, self.bits, self.buckets, apart = raw[:40].view("<i8").tolist()
        at = 40

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            at, begin = at + n * np.dtype(kind).itemsize, at
            return raw[begin:at].view(kind)

        self.table = take(self.buckets * TUPLES, "<i8")
        self.large = take(apart * self.width, "<i8").reshape(apart, self.width)
        self.apart, self.slots, self.top = (take(k, "<u4") for k in (apart, (self.buckets << self.bits) + 1, self.n))
        self.end = take(self.n, "u1" if self.bits == 16 else "<u2")
        self.code = take(self.n, "u1")

    @staticmethod
    def size(n: int, width: int, bits: int, buckets: int, apart: int) -> int:
        return 40 + 8 * (buckets * TUPLES + apart * width) + 4 * (apart + (buckets << bits) + 1 + n) + n * (2 if bits == 16 else 3)

    def get(self, key: np.ndarray, bucket: np.ndarray | int = 0) -> np.ndarray:
        """The counts of each key in its bucket; zeros where it isn't there."""
        out = np.zeros((len(key), self.width), np.int64)
        bucket, bits = np.broadcast_to(np.asarray(bucket, np.int64), key.shape), 24 - self.bits
        slot = bucket << self.bits | key >> (56 - self.bits)
        top = (key >> bits & 0xFFFFFFFF).astype(np.uint32)
        low, last = self.slots[slot].astype(np.int64), self.slots[slot + 1].astype(np.int64)
        high = last
        for _ in range(int((last - low).max(initial=0)).bit_length()):
            mid = (low + high) >> 1
            less = (low < high) & (self.top.take(mid, mode="clip") < top)
            low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
        at = np.flatnonzero(low < last)
        at = at[self.top[low[at]] == top[at]]
        hits, end = [], key & ((1 << bits) - 1)
        while len(at):  # more than once only where neighbours have the same top bits
            same = self.end[low[at]] == end[at]
            hits.append(at[same])
            at = at[~same]
            low[at] += 1
            at = at[low[at] < last[at]]
            at = at[self.top[low[at]] == top[at]]
        hit = np.concatenate(hits) if hits else at
        code = self.code[low[hit]]
        listed = code < TUPLES
        tuples = self.table[bucket[hit[listed]] * TUPLES + code[listed]]
        out[hit[listed]] = tuples[:, None] // SMALL ** np.arange(self.width) % SMALL
        out[hit[~listed]] = self.large[np.searchsorted(self.apart, low[hit[~listed]])]
        return out


def join_shelves(path: str, name: str, group: int, groups: int, buckets: int) -> None:
    """Put the shelves of every ``groups``-th bucket from ``group`` on into one file, and delete
    them: a look-up then opens as many files however many buckets there are."""
    files = [f"{path}/{name}-{b}.npy" for b in range(group, buckets, groups)]
    target, there = f"{path}/{name}-group-{group}.npy", [os.path.exists(f) for f in files]
    if any(there) and not os.path.exists(target):  # else done by an earlier attempt
        parts = [Shelf(np.load(f, mmap_mode="r")) if have else None for f, have in zip(files, there)]
        some = [p for p in parts if p]
        head = (sum(p.n for p in some), some[0].width, some[0].bits, len(parts), sum(len(p.apart) for p in some))
        own = f"{target}.{uuid.uuid4().hex}"
        out = Shelf(np.lib.format.open_memmap(own, "w+", np.uint8, (Shelf.size(*head),)), head)
        n = apart = 0
        for i, p in enumerate(parts):
            slots = slice(i << out.bits, (i + 1) << out.bits)
            out.slots[slots] = n
            if p:
                out.slots[slots] += p.slots[:-1]
                out.table[i * TUPLES:(i + 1) * TUPLES] = p.table
                out.large[apart:apart + len(p.apart)], out.apart[apart:apart + len(p.apart)] = p.large, p.apart + np.uint32(n)
                out.top[n:n + p.n], out.end[n:n + p.n], out.code[n:n + p.n] = p.top, p.end, p.code
                n, apart = n + p.n, apart + len(p.apart)
        out.slots[-1] = n
        out.raw.flush()
        os.replace(own, target)
    for f in files:
        if os.path.exists(f):
            os.remove(f)


def _count_blocks(path: str, buckets: int, light: int, order: int, part: int):
    """Blocks of the buckets of one of ``ROUNDS`` rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, held, size = Tokens(f"{path}/words"), [], 0

        def flush() -> pa.RecordBatch:
            stream = np.concatenate(held)
            take = (pair_bucket(stream[:-1], stream[1:], buckets, light) % ROUNDS == part) & (stream[:-1] != END)
            out = []
            if take.any():
                ctx, word, n, before = distinct_grams(stream, order, take)
                out = [(b, encode_pairs(ctx[p], word[p], n[p], before[p]))
                       for b, p in _groups(pair_bucket(ctx, word, buckets, light))]
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                               pa.array([o[1] for o in out], pa.binary())], ["bucket", "block"])

        for b in batches:
            for _, texts in slices(b.column(0), 2 * BUFFER):
                held.append(tokens.stream(texts)[0])
                size += len(held[-1])
                if size >= BUFFER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _save(path: str, array: np.ndarray) -> None:
    """Written whole or not at all; a repeated task writes the same file again."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        np.save(f, array)
    os.replace(own, path)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """(key, rows) of each run of the first column; rows come sorted by it."""
    key, rows = None, []
    for b in batches:
        for k, *rest in zip(*(c.to_pylist() for c in b.columns)):
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append(rest)
    if rows:
        yield key, rows


def _classes(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


TOKEN, WORD, CONTEXT = range(3)  # kinds of blocks of counts
SUMS = ["n1", "n2", "n3", "n4", "m1", "m2", "m3", "m4", "tokens", "types", "texts", "pairs", "t1", "t2", "t3", "t4"]


def _merge_pairs(path: str, token_buckets: int, light: int, bits: int):
    """Writes the n-gram arrays of a bucket and those of contexts that lie in it whole;
    yields counts of words and of the other contexts."""

    def followers(ctx: np.ndarray, n: np.ndarray, *more: np.ndarray):
        return summed(ctx, n, *(x.astype(np.int64) for x in (n == 1, n == 2, n > 2)), *more)

    def save(name: str, bucket: int, key: np.ndarray, *cols: np.ndarray) -> None:
        _save(f"{path}/{name}-{bucket}.npy", shelf(key, cols, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(batches):
            ctx, word, n, before = (np.concatenate(x) for x in zip(*(decode_pairs(r[0]) for r in rows)))
            counts, classes, longer, raw = [], [0, 0, 0, 0], before != 0, n
            if longer.any():
                u, v, w = (x[longer] for x in (before, ctx, word))
                two = context(u, v)
                key, at, (n3,) = summed(gram_key(two, w), n[longer])
                save("triples", bucket, key, n3)
                u, v, w, two, classes = u[at], v[at], w[at], two[at], _classes(n3)
                where, at, stats = followers(two, n3)
                whole = v[at] >= light
                if whole.any():
                    save("contexts", bucket, where[whole], *(x[whole] for x in stats))
                if not whole.all():
                    where, at, stats = where[~whole], at[~whole], [x[~whole] for x in stats]
                    by = np.lexsort((u[at], v[at]))
                    counts.append((CONTEXT, where[by], v[at][by], [x[by] for x in (u[at], *stats)]))
                # The order below counts the distinct tokens before a bigram.
                ctx, word, raw, n = (np.concatenate([x[~longer], y]) for x, y in (
                    (ctx, v), (word, w), (n, n3), (n, np.ones(len(v), np.int64))))
            key, at, (n, raw) = summed(gram_key(ctx, word), n, raw)
            ctx, word = ctx[at], word[at]
            save("pairs", bucket, key, n)
            ids, _, stats = followers(ctx, n, raw)
            counts.append((TOKEN, ids, ids, stats))
            ids, _, cont = summed(word, np.ones(len(word), np.int64))
            counts.append((WORD, ids, ids, cont))
            out = [(-1, np.array([*_classes(n), *classes], np.int64).tobytes())]
            for kind, where, ids, cols in counts:
                out += [(b, encode_stats(kind, ids[p], [x[p] for x in cols])) for b, p in _groups(where % token_buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.binary())], ["bucket", "block"])

    return run


def _merge_tokens(path: str, bits: int):
    """Writes the token and context arrays of a bucket; yields its sums."""
    columns = {TOKEN: [TOTAL, N1, N2, N3, COUNT], WORD: [CONT]}

    def save(name: str, bucket: int, key: np.ndarray, col: np.ndarray) -> None:
        _save(f"{path}/{name}-{bucket}.npy", key)
        _save(f"{path}/{name}n-{bucket}.npy", np.ascontiguousarray(col.T).astype(np.min_scalar_type(int(col.max(initial=0)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(batches):
            if bucket < 0:
                sums = [*np.sum([np.frombuffer(r[0], np.int64) for r in rows], axis=0).tolist(), *[0] * 8]
            else:
                ids, cols, longer = [NONE], [np.zeros((6, 0), np.int64)], []
                for (raw,) in rows:
                    kind, some, got = decode_stats(raw)
                    if kind == CONTEXT:
                        longer.append((context(got[0], some), got[1:]))
                        continue
                    col = np.zeros((6, len(some)), np.int64)
                    col[columns[kind]] = got
                    ids.append(some)
                    cols.append(col)
                if longer:
                    key, _, col = summed(np.concatenate([x for x, _ in longer]), *np.concatenate([x for _, x in longer], axis=1))
                    _save(f"{path}/shared-{bucket}.npy", shelf(key, col, bits))
                key, _, col = summed(np.concatenate(ids), *np.concatenate(cols, axis=1))
                col = np.stack(col)
                start = key == START
                docs = int(col[COUNT][start].sum())
                often = (col > 255).any(axis=0)
                for name, some in (("tokens", ~often), ("often", often)):
                    if some.any():
                        save(name, bucket, key[some], col[:, some])
                cont = col[CONT]
                sums = [*[0] * 8, int(col[COUNT][~start].sum()), int((~start).sum()), docs, int(cont.sum()), *_classes(cont)]
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()) for s in sums], SUMS)

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2, 3 and more (Chen and
    Goodman); 1/2, 1 and 3/2 where a count class is empty."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(d, 0.0, [0.0, 1.0, 2.0, 3.0])


class Model:
    """The arrays of a trained model, memory-mapped, at most ``MAPS`` at a time."""

    def __init__(self, spec: dict):
        self.spec, self.maps = spec, OrderedDict()
        s = spec["sums"]
        self.d3 = discounts(s["m1"], s["m2"], s["m3"], s["m4"])
        self.d2 = discounts(s["n1"], s["n2"], s["n3"], s["n4"])
        self.d1 = discounts(s["t1"], s["t2"], s["t3"], s["t4"])
        self.tokens = s["tokens"] + s["texts"]  # N: words and one end a text
        self.types = s["types"]
        held_back = self.d1[1:] @ [s["t1"], s["t2"], self.types - s["t1"] - s["t2"]]
        self.low = held_back / s["pairs"] if s["pairs"] else 1.0  # the unknown share, over types and one unknown

    def _map(self, name: str) -> np.ndarray | None:
        if name in self.maps:
            self.maps.move_to_end(name)
        else:
            path = f"{self.spec['path']}/{name}.npy"
            self.maps[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
            if len(self.maps) > MAPS:
                self.maps.popitem(last=False)
        return self.maps[name]

    def _find(self, name: str, key: np.ndarray, bucket: np.ndarray, out: np.ndarray) -> np.ndarray:
        order = np.lexsort((key, bucket))
        where, first = np.unique(bucket[order], return_index=True)
        for b, p in zip(where.tolist(), np.split(order, first[1:])):
            have = self._map(f"{name}-{b}")
            if have is None:
                continue
            at = np.minimum(np.searchsorted(have, key[p]), len(have) - 1)
            hit = have[at] == key[p]
            out[p[hit]] = self._map(f"{name}n-{b}")[at[hit]]
        return out

    def _counts(self, name: str, key: np.ndarray, bucket: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(key), width), np.int64)
        for g, p in _groups(np.where(bucket < 0, -1, bucket % self.spec["groups"])):
            have = self._map(f"{name}-group-{g}")
            if have is not None:
                out[p] = Shelf(np.asarray(have)).get(key[p], bucket[p] // self.spec["groups"])
        return out

    @staticmethod
    def _level(n: np.ndarray, d: np.ndarray, stats: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Discounted share of the counts plus what is held back, by the order below;
        the order below alone where the context is unknown."""
        total = np.maximum(stats[:, 0], 1)
        p = np.maximum(n - d[np.minimum(n, 3)], 0) / total + stats[:, 1:] @ d[1:] / total * lower
        return np.where(stats[:, 0] > 0, p, lower)

    def score(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and log10 probability of every token after a START, in order."""
        real = stream[:-1] != END
        ids, inverse = distinct_ids(stream)
        stats = np.zeros((len(ids), 6), np.int64)
        for name in ("tokens", "often"):
            self._find(name, ids, ids % self.spec["token_buckets"], stats)
        stats[ids == END, COUNT] = self.spec["sums"]["texts"]
        before, ctx, word = grams(stream)
        c, w = inverse[:-1][real], inverse[1:][real]
        cont, pairs = stats[:, CONT], self.spec["sums"]["pairs"]
        p1 = np.maximum(cont - self.d1[np.minimum(cont, 3)], 0) / max(1, pairs) + self.low / (self.types + 1)
        light, buckets = self.spec["light"], self.spec["buckets"]
        bucket = pair_bucket(ctx, word, buckets, light)
        p = self._level(self._counts("pairs", gram_key(ctx, word), bucket, 1)[:, 0], self.d2, stats[:, TOTAL:][c], p1[w])
        if self.spec["order"] > 2:
            at = np.flatnonzero(ctx != START)
            two = context(before[at], ctx[at])
            n = self._counts("triples", gram_key(two, word[at]), bucket[at], 1)[:, 0]
            whole = ctx[at] >= light
            found = self._counts("contexts", two, np.where(whole, bucket[at], -1), 4)
            found += self._counts("shared", two, np.where(whole, -1, two % self.spec["token_buckets"]), 4)
            p[at] = self._level(n, self.d3, found, p[at])
        return stats[w, COUNT], np.log10(p)


def list_words(src: DataFrame, chars: int, path: str) -> int:
    """Write the words that get short ids: the most frequent ones, at most ``CODES``, of evenly
    spaced texts with some ``CODE_CHARS`` characters. Any list gives the same counts. Returns
    the first id of a word that fills less than a small part of a bucket."""
    every = int(chars // CODE_CHARS) + 1
    some = src.where(F.monotonically_increasing_id() % every == 0)
    words = (some.select(F.explode(F.split(ascii_lower(F.col("text")), SPACE_CLASS)).alias("w"))
             .where(F.octet_length("w").between(1, CODE_BYTES)).groupBy("w").count().where("count > 1")
             .orderBy(F.desc("count"), "w").limit(CODES).collect())
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/words", "wb") as f:
        f.write(b"\n".join(r.w.encode("utf-8", "surrogatepass") for r in words))
    return END + 1 + sum(r["count"] * every > BUCKET_CHARS // 32 for r in words)


def train(docs: DataFrame, text_col: str = "text", order: int = 3) -> dict:
    """Count all of ``docs`` and write the model of order 2 or 3; returns what ``Model``
    needs (the folder, bucket numbers and sixteen sums: a bounded record)."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    chars = src.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(chars // BUCKET_CHARS) + 1
    token_buckets = buckets // TOKEN_BUCKETS + 1
    groups, bits = max(GROUPS, buckets // GROUP + 1), 16 if min(chars, BUCKET_CHARS) > 1 << 20 else 8
    path = mounted_path(spark, "model")
    light = list_words(src, chars, path)
    block, scratch = "bucket long, block binary", Scratch(spark, "counts")
    merged = [scratch.keep(src.mapInArrow(_count_blocks(path, buckets, light, order, k), block)
                           .repartition("bucket").sortWithinPartitions("bucket")
                           .mapInArrow(_merge_pairs(path, token_buckets, light, bits), block), f"merged-{k}")
              for k in range(min(ROUNDS, buckets))]
    sums = scratch.keep(reduce(DataFrame.unionAll, merged).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _merge_tokens(path, bits), ", ".join(f"{n} long" for n in SUMS)), "sums")
    row = sums.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in SUMS]).first()
    scratch.drop("sums", *[f"merged-{k}" for k in range(len(merged))])
    arrays = [(n, buckets) for n in ("triples", "pairs", "contexts")] + [("shared", token_buckets)]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                name, of = arrays[i % len(arrays)]
                join_shelves(path, name, i // len(arrays), groups, of)
            yield b

    some = len(arrays) * min(groups, buckets)
    spark.range(0, some, 1, min(some, 2 * GROUPS)).mapInArrow(join, "id long").agg(F.count("id")).first()
    return {"path": path, "order": order, "groups": groups, "buckets": buckets, "light": light, "token_buckets": token_buckets, "sums": row.asDict()}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) of every row.

    ``score`` is the log10 probability of the text's words and its end;
    ``base_score`` that of an add-0.1 unigram model on the same counts.

    Defined cases: null texts count as empty (one end token); words never seen
    take the unknown share; with no training text at all every score is 0; null
    ids and repeated rows stay rows; very long texts are scored whole; an empty
    table gives an empty result; extra columns are ignored."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, tokens = Model(model), Tokens(f"{model['path']}/words")
        floor = lm.tokens + 0.1 * (lm.types + 1)

        def scored(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
            stream, length = tokens.stream(texts)
            count, logp = lm.score(stream)
            at = np.cumsum(length) - length
            base = np.add.reduceat(np.log10((count + 0.1) / floor), at)
            total = np.add.reduceat(logp, at)
            cols = [ids, pa.array(length, pa.int64()),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), at)), pa.array(base), pa.array(total),
                    pa.array(10.0 ** np.minimum(-total / length, 300))]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

        for b in batches:
            for first, texts in slices(b.column(1), SCORE_BUFFER):
                yield scored(b.column(0).slice(first, len(texts)), texts)

    return src.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double")


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Contract query: train on nine tenths of the documents, score all."""
    docs = read_table(spark, sf_dir, "documents")
    fold = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 10 == 0
    model = train(docs.where(~fold(F.col("doc_id"))))
    lm = Model(model)
    return score(docs, model).select(
        "doc_id", fold(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(lm.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
