"""Secret scans by dictionary-primed zstandard novelty.

Base spans come from three patterns. The method adds a span for every candidate
string in a sensitive context that does not compress: its marginal compressed
size, primed with an identifier dictionary and the code or text around it, is
the size of (context + candidate) less that of the context alone. Words and
identifiers that occur around it or in the dictionary cost a few bytes; random
keys cost about their length. Copies of the candidate itself are blanked in what
primes the compressor, so a key that stands several times is found at each place.

The identifier dictionary holds the most frequent words of the corpus, counted
over all documents in Spark; its size is a documented bound (``dictionary_bytes``),
which is also what is shipped to the tasks. Scale: two passes over the texts; the
only shuffle is of per-batch word counts.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslake.llm._common import read_table, written

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINT = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
# A run of the characters secrets are made of; AWS-style and hexadecimal spans lie inside such runs.
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
SENSITIVE = re.compile(
    r"passw|passwd|pwd|secret|token|api.?key|auth|bearer|credential|private|access.?key|signature|[\"']?key[\"']?\s*[:=]",
    re.I | re.A)
# Parts of a long word: a letter and the lower-case letters after it, at most 15 together.
PART = re.compile(r"[A-Za-z][a-z]{3,14}(?![a-z])")
MIN_ASSIGN, MIN_ACCESS = 12, 18
CONTEXT = 64       # characters before a candidate that must hold a sensitive word
SURROUND = 2048    # characters around it that prime the compressor
MIN_NOVELTY = 0.7  # compressed bytes per byte
DICTIONARY_BYTES = 32_768
COUNTED = 200_000   # distinct words that a task counts before it passes them on


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns; leftmost, non-overlapping per kind."""
    found = []
    if ASSIGN_HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    for run in RUN.finditer(text):
        a, b = run.span()
        if "AKIA" in run.group():
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= MIN_ACCESS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b)]
    return sorted(found)


class Novelty:
    """Marginal compressed size of a string given its surroundings and a dictionary."""

    def __init__(self, dictionary: bytes):
        import zstandard

        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)

    def ratio(self, around: bytes, candidate: bytes) -> float:
        size = len(self.compressor.compress(around + b"\n" + candidate)) - len(self.compressor.compress(around + b"\n"))
        return size / max(1, len(candidate))


def surroundings(text: str, a: int, b: int) -> str:
    """``SURROUND`` characters before and after the candidate, with every copy of
    it, and of the value in ``name=value``, blanked, also one cut at the far end."""
    word, n = text[a:b], b - a
    before, after = text[max(0, a - SURROUND - n):a], text[b:b + SURROUND + n]
    value = word.rpartition("=")[2]
    for copy in (word, value) if len(value) >= 16 else (word,):
        before, after = (x.replace(copy, "\n" * len(copy)) for x in (before, after))
    return before[-SURROUND:] + after[:SURROUND]


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Incompressible runs after a sensitive word, where no base span lies."""
    found = []
    for run in RUN.finditer(text):
        a, b = run.span()
        word = run.group().strip(".=-/")
        a += run.group().find(word) if word else 0
        b = a + len(word)
        if len(word) < 16 or not any(c.isalpha() for c in word):
            continue
        if any(s < b and e > a for s, _, e in base):
            continue
        if not SENSITIVE.search(text, max(0, a - CONTEXT), a):
            continue
        if novelty.ratio(surroundings(text, a, b).encode("utf-8", "surrogatepass"), word.encode()) >= MIN_NOVELTY:
            found.append((a, 3, b))
    return found


def identifier_dictionary(docs: DataFrame, text_col: str = "text", max_bytes: int = DICTIONARY_BYTES) -> bytes:
    """The most frequent words of 4 to 15 characters, and parts of words of 16
    to 32, over all documents, the most frequent last (nearest, so cheapest to refer to). At most ``max_bytes``
    come to the driver."""
    src = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts(seen: Counter) -> Iterator[pa.RecordBatch]:
            # A copied secret must not prime the compressor for itself: longer words count by their parts only.
            parts: Counter = Counter()
            for w, n in seen.items():
                if 4 <= len(w) < 16:
                    parts[w] += n
                elif 16 <= len(w) <= 32 and not any(c.isdigit() for c in w):
                    for part in PART.findall(w):
                        parts[part] += n
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()), pa.array(list(parts.values()), pa.int64())],
                                                 ["word", "n"])

        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                if t.is_valid:
                    seen.update(t.as_py().split())
                    if len(seen) >= COUNTED:
                        yield from counts(seen)
                        seen = Counter()
        yield from counts(seen)

    words = src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    words = written(words, "words")
    # The count beyond which words fill the dictionary, from a bounded histogram; only those words are sorted.
    bins = words.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(
        F.sum(F.octet_length("word") + 1).alias("bytes"), F.min("n").alias("least")).collect()
    least, filled = 0, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        filled += r["bytes"]
        if filled > max_bytes:
            least = r["least"]
            break
    top = words.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(max_bytes // 5).collect()
    out: list[bytes] = []
    size = 0
    for r in top:
        w = r["word"].encode("utf-8", "surrogatepass")
        if size + len(w) + 1 > max_bytes:
            break
        out.append(w)
        size += len(w) + 1
    return b" ".join(reversed(out))


def scan_secrets(docs: DataFrame, dictionary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): every secret span of every whole text as an array of
    (kind, start, end) in code points, end exclusive, by start, then kind.

    Defined cases: null and empty texts have no spans; null ids and repeated
    rows stay rows of their own; very long texts are scanned whole; an empty
    table gives an empty result; extra columns are ignored."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for b in batches:
            out = []
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                every = sorted(base + novel_spans(text, base, novelty))
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in every])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return src.mapInArrow(run, schema)


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts and digests of the spans of every document."""
    docs = read_table(spark, sf_dir, "documents")
    spans = scan_secrets(docs, identifier_dictionary(docs))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.concat_ws(",", F.transform(F.filter("spans", lambda s: s["kind"] != "novel"), text))
    return spans.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(base, 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform("spans", text)).alias("spans"))
