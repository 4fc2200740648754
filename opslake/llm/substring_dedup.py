"""Substring dedup: De Bruijn compaction over words.

A window of ``window`` words is an edge from its first window - 1 words to its
last ones (nodes). A node is a joint if documents with different ids hold it
and its occurrences do not all come from one word before and go on to one word
after (an end of a document counts as another word). Between joints paths do not
branch, so all occurrences of such a path are equal from joint to joint: it is
compacted to one edge, named by its joints, its length and a fingerprint of the
words between, taken from its source coordinates (prefix hashes of the document
at both ends; 192 bits with the joints' own). Compacted edges of several documents
are the long repeated spans; the smallest id keeps its copy.

Scale: nodes are not made for every word. First, documents are compacted in the
sparse graph of anchors: of the k-word strings of each node the one with the
smallest hash, so equal nodes share an anchor (about one word in 17). A joint
holds an anchor that different documents share and one whose neighbours
differ, so only nodes around such anchors are made and joined: the ends of
shared passages, not their insides. All degrees are counted by partial
aggregation; joins are on hashes, and a passage that a third of all documents
share is one row a map task there. Texts move twice, keyed by document. Tables
in between go once the next one is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import Scratch, read_table

WINDOW = 50
CUT = "struct<n_words: bigint, n_removed: bigint, kept: string>"
ROWS = 1 << 16  # rows of a result batch
WRAP = 1 << 64
# Odd multipliers of the prefix hash and the mixing (fixed values, any odd numbers serve).
BASE, STIR = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
INVERSE = pow(BASE, -1, WRAP)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of BASE and INVERSE, as far as a text was long


def words_of(text: bytes | None) -> list[bytes]:
    """Words between \\x20 and \\x09-\\x0D: what bytes.split cuts at."""
    return (text or b"").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of BASE and of its inverse, wrapped."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((BASE, INVERSE)):
            all_ = np.full(2 * n, base, np.uint64)
            all_[0] = 1
            _powers[i] = np.multiply.accumulate(all_)
    return _powers[0][:n + 1], _powers[1][:n + 1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned longs (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(STIR)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(BASE)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hashes of all spans of a document by two differences of prefix sums."""

    def __init__(self, words: np.ndarray) -> None:
        up, self.down = powers(len(words))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def strings(self, k: int) -> np.ndarray:
        """The hashes of all spans of k words, in order."""
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * self.down[:n] + np.uint64(k))


def _sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or largest (``pick``) of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        a, size = pick(a[:len(a) - size], a[size:]), size * 2
    return pick(a[:len(a) - (width - size)], a[width - size:]) if size < width else a


class Document:
    """Anchors and nodes of one document of at least ``window`` words."""

    def __init__(self, words: list[bytes], window: int) -> None:
        self.node = window - 1
        self.k = self.node // 3 + 1
        self.hashes = word_hashes(words)
        self.prefix = Prefix(self.hashes)
        strings = self.prefix.strings(self.k)
        width = self.node - self.k + 1
        self.least = _sliding(strings, width, np.minimum)  # of each node
        edge = np.zeros(width - 1, np.uint64)
        taken = _sliding(np.concatenate([edge, self.least, edge]), width, np.maximum)
        self.anchors = np.flatnonzero(strings == taken)
        self.names = strings[self.anchors]

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of the words from the anchor before to the one after each
        anchor, and whether there are both."""
        both = self.prefix.span(self.anchors[:-1], self.anchors[1:] + self.k)
        none = np.zeros(1, np.uint64)
        inner = np.ones(len(self.anchors), bool)
        inner[[0, -1]] = False
        return mixed(np.concatenate([none, both])) + np.concatenate([both, none]), inner

    def near_joints(self, marks: dict[int, bool]) -> np.ndarray:
        """Places of the nodes that may be joints. ``marks``: the anchors, by place,
        that several documents share, and whether their neighbours are always the same.

        A node whose least anchor isn't shared is in one document only. If all
        anchors that it holds have the same neighbours wherever they are, all its
        occurrences have the same words up to the anchors beyond its ends."""
        shared = np.array([a in marks for a in self.anchors.tolist()], bool)
        plain = np.array([marks.get(a, False) for a in self.anchors.tolist()], bool)
        at = np.arange(len(self.least))
        first = np.searchsorted(self.anchors, at)
        last = np.searchsorted(self.anchors, at + self.node - self.k, side="right")
        bends = np.concatenate([[0], np.cumsum(~plain)])
        return np.flatnonzero(np.isin(self.least, self.names[shared]) & (bends[last] > bends[first]))


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _around(x: np.ndarray, known: np.ndarray, doc: int, copy: int, at: np.ndarray) -> pa.Array:
    """What stands around each place; where one side is missing, a value of its own."""
    own = mixed((at.astype(np.uint64) * np.uint64(BASE)) ^ np.uint64(copy % WRAP)) ^ np.uint64(doc % WRAP)
    return pa.array(_signed(np.where(known, x, mixed(own))))


def _merged(parts: Iterator[list[pa.Array]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``ROWS`` rows out of small lists of columns."""
    held: list[list[pa.Array]] = []
    for part in parts:
        held.append(part)
        if sum(len(p[0]) for p in held) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held)], names)


def _same(n: int, value: int) -> pa.Array:
    return pa.array(np.full(n, value, np.int64))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, copy, text as bytes): documents with a null id come last; ``copy`` tells texts of one id apart."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(text).alias("copy"),
                       text.cast("binary").alias("text"))


# Of (name, around, doc): whether several documents hold a string, and whether all its occurrences have the same around.
SHARED, PLAIN = "min(doc) < max(doc) AS shared", "min(around) = max(around) AS plain"


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """(doc, copy, pos, name, around) of every anchor of ``keyed`` documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for doc, copy, text in zip(*(c.to_pylist() for c in batch.columns)):
                    words = words_of(text)
                    if len(words) >= window:
                        d = Document(words, window)
                        n, at = len(d.anchors), d.anchors
                        yield [_same(n, doc), _same(n, copy), pa.array(at.astype(np.int32)), pa.array(_signed(d.names)),
                               _around(*d.neighbours(), doc, copy, at)]
        return _merged(parts(), ["doc", "copy", "pos", "name", "around"])

    return docs.mapInArrow(run, "doc long, copy long, pos int, name long, around long")


def node_rows(docs: DataFrame, window: int) -> DataFrame:
    """(doc, copy, pos, name, around, sum) of the nodes that may be joints: hash of the
    words around, and prefix sum. ``docs`` has ``marks``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for i, (doc, copy, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
                    d = Document(words_of(text), window)
                    at = d.near_joints({m["pos"]: m["plain"] for m in batch.column(3)[i].as_py()})
                    if not len(at):
                        continue
                    end = at + d.node
                    word = np.concatenate([np.zeros(1, np.uint64), d.hashes, np.zeros(1, np.uint64)])
                    around = mixed(word[at]) + word[end + 1]
                    yield [_same(len(at), doc), _same(len(at), copy), pa.array(at.astype(np.int32)), pa.array(_signed(d.prefix.span(at, end))),
                           _around(around, (at > 0) & (end < len(d.hashes)), doc, copy, at), pa.array(_signed(d.prefix.sums[at]))]
        return _merged(parts(), ["doc", "copy", "pos", "name", "around", "sum"])

    return docs.mapInArrow(run, "doc long, copy long, pos int, name long, around long, sum long")


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compacted edges between neighbouring joints, from joints by document and place."""
    names = ["doc", "copy", "start", "edges", "from", "to", "between"]
    was = None
    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            doc, copy, pos, name, total = row
            if was and was[:2] == row[:2]:
                if pos == was[2]:
                    continue  # the same row stands twice in the input
                between = (total - was[4]) * pow(INVERSE, was[2], WRAP)
                out.append((doc, copy, was[2], pos - was[2], was[3], name, (between + (1 << 63)) % WRAP - (1 << 63)))
            was = row
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, copy, spans): word spans (start, length) of each document that are
    covered by windows which a document with a smaller id holds as well."""
    tables = Scratch(docs.sparkSession, "substring-dedup")
    texts = keyed(docs, id_col, text_col)
    anchors = tables.keep(anchor_rows(texts, window), "anchors")
    # Written before they are joined: a join can split a hot name only if both sides come from a shuffle of its own.
    shared = tables.keep(anchors.groupBy("name").agg(F.expr(SHARED), F.expr(PLAIN)).where("shared").select("name", "plain"), "shared")
    marks = anchors.select("doc", "copy", "pos", "name").join(shared, "name").groupBy("doc", "copy").agg(
        F.sort_array(F.collect_set(F.struct("pos", "plain"))).alias("marks"))
    marks = tables.keep(marks.where(F.exists("marks", lambda m: ~m["plain"])), "marks")
    tables.drop("anchors", "shared")
    nodes = tables.keep(node_rows(texts.join(marks, ["doc", "copy"]).select("doc", "copy", "text", "marks"), window), "nodes")
    tables.drop("marks")
    joints = tables.keep(nodes.groupBy("name").agg(F.expr(SHARED), F.expr(PLAIN)).where("shared AND NOT plain").select("name"), "joints")
    found = nodes.select("doc", "copy", "pos", "name", "sum").join(joints, "name", "left_semi").select("doc", "copy", "pos", "name", "sum")
    path = ["edges", "from", "to", "between"]
    kind = ", ".join(f"{c} long" for c in ["doc", "copy", "start"] + path)
    edges = tables.keep(found.repartition("doc", "copy").sortWithinPartitions("doc", "copy", "pos").mapInArrow(_edges, kind), "edges")
    tables.drop("nodes", "joints")
    first = edges.groupBy(*path).agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last")
    first = tables.keep(first, "first")
    later = edges.join(first, path).where("doc > first")
    span = F.struct("start", (F.col("edges") + window - 1).alias("length"))
    spans = tables.keep(later.groupBy("doc", "copy").agg(F.sort_array(F.collect_set(span)).alias("spans")), "spans")
    tables.drop("edges", "first")
    return spans


def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, some in zip(text.to_pylist(), spans.to_pylist()):
        words = words_of(t)
        kept, at, gone = [], 0, 0
        for s in some or ():
            kept += words[at:s["start"]]
            gone += max(0, s["start"] + s["length"] - max(at, s["start"]))
            at = max(at, s["start"] + s["length"])
        out.append((len(words), gone, b" ".join(kept + words[at:]).decode()))
    n, gone, kept = zip(*out) if out else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                      ["n_words", "n_removed", "kept"])


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", out_col: str = "dedup") -> DataFrame:
    """``docs`` with ``out_col``: n_words, n_removed and kept, the words that are
    left joined by one space. A word goes if a window over it also starts in a
    document with a smaller id; windows are judged on the input.

    Defined cases: null and empty texts have no words; documents with fewer words
    than the window lose none; a null id counts as the largest, so such documents
    lose words but no other with null id does by them; rows with equal id do not
    remove words from each other; very long texts are taken whole; an empty table
    gives an empty result; other columns stay, but one named ``out_col`` is replaced."""
    if window < 2:
        raise ValueError("a window has two words at least")
    spans = repeated_spans(docs, window, id_col, text_col).toDF("__sd_doc", "__sd_copy", "__sd_spans")
    text = F.col(f"`{text_col}`").cast("string")
    on = (F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)) == F.col("__sd_doc")) & (F.xxhash64(text) == F.col("__sd_copy"))
    return docs.join(spans, on, "left").withColumn(out_col, F.arrow_udf(_cut, CUT)(text.cast("binary"), F.col("__sd_spans"))).drop(*spans.columns)


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document: its words, how many go as repeats of a smaller id, and the digest of the rest."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup(docs).select("doc_id", "dedup")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "dedup.n_words", "dedup.n_removed",
                      F.sha2("dedup.kept", 256).alias("kept_sha256"))
