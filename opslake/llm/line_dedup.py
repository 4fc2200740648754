"""Line dedup: segment-partition edit join.

All lines that aren't blank are compared. A line goes when an earlier line (by
doc_id, then line number) equals it or lies within the threshold of the shorter
of both: one edit for each ``per_edit`` characters, ``max_edits`` at most. Lines
shorter than ``per_edit`` must be equal. Each distinct line is cut in
threshold-plus-one segments; a line within the threshold holds one of them
unchanged, close to its place, so lines probe length-aware substring indexes: for
every admissible length and segment, the few substrings whose shift the other
segments can still make up for (multi-match-aware selection). Lines that meet are
verified by a banded bit-parallel edit distance.

Scale: texts are never shuffled whole. One shuffle holds a hashed key for each
segment and probe (12 a line for 2 edits); a batch enters a line once, so a line
that is a third of all rows is one entry a batch. Only lines whose key meets another
line's (some percent) move with their text. A key with more than ``BLOCK`` lines
is cut into blocks whose pairs go to different tasks. No pair is emitted: a task
reports lines that have an earlier neighbour. Joins that move all lines or texts
are merge joins of written tables at every size: their hot keys can be split.
Tables and shuffle files of finished steps go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import Scratch, read_table

MAX_EDITS = 2
PER_EDIT = 20  # characters for each edit that a line may have
BLOCK = 1024
LINES = 8192  # lines whose keys are made at once
BLANKS = " \t\r\x0b\x0c"


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance of a and b is at most ``limit``.

    Equal ends are cut off; then vertical differences of the band of
    2 * limit + 1 diagonals are kept as bits of two integers, one step a
    character. The distance is read along the diagonal of the end cell, on
    which values never fall, so the scan stops once it is over the limit."""
    if len(a) > len(b):
        a, b = b, a
    gap = len(b) - len(a)
    if gap > limit:
        return False
    head = _common_prefix(a, b)
    a, b = a[head:], b[head:]
    tail = _common_prefix(a[::-1], b[::-1])
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not a:
        return True
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    width = 2 * limit + 1
    mask, top, end = (1 << width) - 1, 1 << (width - 1), limit - gap
    up = ((1 << limit) - 1) << (limit + 1)  # rows 1 .. limit of column 0 rise by one each
    down, distance = 0, gap
    for j, ch in enumerate(b):
        shift = j - limit  # the band's lowest row, as a place in a
        same = places.get(ch, 0)
        same = (same >> shift if shift >= 0 else same << -shift) & mask
        rise, fall = up >> 1 | top, down >> 1
        diagonal = ((((same & rise) + rise) ^ rise) | same | fall) & mask
        across_up = (fall | ~(diagonal | rise)) & mask
        across_down = diagonal & rise
        across_up = (across_up << 1 | 1) & mask
        across_down = (across_down << 1) & mask
        up = (across_down | ~(diagonal | across_up)) & mask
        down = across_up & diagonal
        if j >= gap and not diagonal >> end & 1:
            distance += 1
            if distance > limit:
                return False
    return True


def _common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def allowed(length: int, max_edits: int, per_edit: int) -> int:
    """The edits between a line of this length and a longer one."""
    return min(max_edits, length // per_edit)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, copy, line, text, h1, h2): the lines that aren't blank, without
    blanks at their ends. ``copy`` tells rows with one id apart by their text."""
    text = F.col(f"`{text_col}`").cast("string")
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(text).alias("copy"),
                    F.posexplode(F.split(text, "\n")).alias("line", "text"))
    d = d.select("doc", "copy", "line", F.trim("text", F.lit(BLANKS)).alias("text")).where("text <> ''")
    return d.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))


@lru_cache(maxsize=1 << 14)
def key_plan(length: int, max_edits: int, per_edit: int) -> tuple[list[tuple[int, int, int]], int]:
    """(start, end, seed) of the substrings a line of this length is entered or
    probes under, and how many of them, the first, are its own segments. The
    seed tells the indexed line's length and the segment's number."""
    own, probes = [], []
    for short in range(max_edits + 1):  # the indexed line may be shorter by so much
        n = length - short
        limit = allowed(n, max_edits, per_edit)
        parts = limit + 1
        if short > limit or not limit or n < parts:
            continue
        first_long = parts - n % parts  # the last segments have one more
        for i in range(parts):
            size = n // parts + (i >= first_long)
            start = n // parts * i + max(0, i - first_long)
            for by in range(max(-i, short - (limit - i)), min(i, short + limit - i) + 1):
                if 0 <= start + by and start + by + size <= length:
                    (own if short == by == 0 else probes).append((start + by, start + by + size, n * (max_edits + 1) + i))
    return own + probes, len(own)


def line_keys(docs: DataFrame, max_edits: int, per_edit: int, text_col: str) -> DataFrame:
    """(key, line): hashed segments and probes of every line that may have an edit,
    each line once a batch. ``line`` is the line's hash (as Spark's xxhash64)
    with its lowest bit set where the key is one of its own segments."""
    src = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))

    def entries(lines: list[str]) -> pa.RecordBatch:
        digest = xxhash.xxh64_intdigest
        plans = [key_plan(len(s), max_edits, per_edit) for s in lines]
        keys = np.array([digest(s[a:b], seed) for s, (plan, _) in zip(lines, plans) for a, b, seed in plan], np.uint64)
        count = np.array([len(plan) for plan, _ in plans])
        rank = np.arange(len(keys)) - np.repeat(np.cumsum(count) - count, count)
        line = np.array([digest(s, 42) for s in lines], np.uint64).view(np.int64) & ~np.int64(1)
        line = np.repeat(line, count) | (rank < np.repeat([own for _, own in plans], count))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(line)], ["key", "line"])

    def keyed(lines: set[str]) -> Iterator[pa.RecordBatch]:
        some = [s for s in lines if allowed(len(s), max_edits, per_edit)]
        for at in range(0, len(some), LINES):
            yield entries(some[at:at + LINES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines: set[str] = set()
            for t in batch.column(0):
                if t.is_valid:
                    lines.update(s.strip(BLANKS) for s in t.as_py().split("\n") if len(s) >= per_edit)
                if len(lines) >= LINES:
                    yield from keyed(lines)
                    lines = set()
            yield from keyed(lines)

    return src.mapInArrow(run, "key long, line long")


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, line) rows sorted by key, those whose key has an own segment of
    one line and any entry of another. Runs may span batches: of an unfinished
    run only the distinct rows seen so far are held until a second line shows."""
    held = np.zeros((0, 2), np.int64)

    def good(rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return rows
        start = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        name = rows[:, 1] >> 1
        some_own = np.maximum.reduceat(rows[:, 1] & 1, start) > 0
        two = np.minimum.reduceat(name, start) != np.maximum.reduceat(name, start)
        return rows[np.repeat(some_own & two, np.diff(np.append(start, len(rows))))]

    def out(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(rows := good(rows)):
            rows = np.unique(rows, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["key", "line"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([held, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)])
        last = rows[:, 0] == rows[-1, 0]
        held = np.unique(rows[last], axis=0)
        yield from out(rows[~last])
    yield from out(held)


def near_lines(docs: DataFrame, lines: DataFrame, max_edits: int, per_edit: int, text_col: str,
               block: int = BLOCK) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within
    the threshold. ``lines`` is ``lines_of(docs)``."""
    tables = Scratch(docs.sparkSession, "line-dedup")
    met = line_keys(docs, max_edits, per_edit, text_col).repartition("key").sortWithinPartitions("key").mapInArrow(
        _meeting, "key long, line long")
    met = tables.keep(met.select("key", F.col("line").bitwiseAND(F.lit(-2)).alias("name"),
                                 F.col("line").bitwiseAND(F.lit(1)).alias("own")).distinct(), "keys")
    # An earlier instance comes first: null ids last, then by id, text and line number.
    place = F.struct(F.col("doc").isNull().alias("none"), F.coalesce("doc", F.lit(0)).alias("doc"), "copy", "line")
    names = tables.keep(met.select("name").distinct(), "names")
    texts = lines.drop("h2").withColumn("name", F.col("h1").bitwiseAND(F.lit(-2))).join(names.hint("merge"), "name", "left_semi")
    texts = texts.withColumn("h2", F.xxhash64(F.lit(1), "text")).groupBy("name", "h1", "h2").agg(
        F.min(place).alias("place"), F.first("text").alias("text"))
    members = tables.keep(met.join(texts, "name").groupBy("key", "h1", "h2").agg(
        F.max("own").alias("own"), F.first("place").alias("place"), F.first("text").alias("text")), "members")
    members = members.select("key", "h1", "h2", "own", "text", "place.*")
    hot = tables.keep(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block), "hot")
    m = members.withColumn("i", F.lit(0)).withColumn("j", F.lit(0)).withColumn("side", F.lit(0))
    if not hot.isEmpty():
        blocks = F.ceil(F.coalesce("size", F.lit(1)) / block).cast("int")
        m = (members.join(hot, "key", "left").withColumn("nb", blocks)
             .withColumn("mine", F.pmod(F.xxhash64("h1", "h2"), F.col("nb")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
             .withColumn("side", (F.col("mine") > F.col("other")).cast("int")))
    m = m.select("key", "i", "j", "side", "own", "none", "doc", "copy", "line", "h1", "h2", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, rows = None, []

        def later(rows: list) -> list[tuple[int, int]]:
            """Hashes of the lines of a run with an earlier neighbour in it."""
            rows.sort(key=lambda r: r[2:8])
            found = []
            for b, right in enumerate(rows):
                for left in rows[:b]:
                    if across and left[0] == right[0] or not (left[1] or right[1]):
                        continue
                    if within(left[8], right[8], allowed(min(len(left[8]), len(right[8])), max_edits, per_edit)):
                        found.append(right[6:8])
                        break
            return found

        out: list[tuple[int, int]] = []
        across = False
        for batch in (b.slice(at, BLOCK) for b in batches for at in range(0, b.num_rows, BLOCK)):
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:3] != run:
                    if len(rows) > 1:
                        across = run[1] != run[2]
                        out += later(rows)
                    run, rows = r[:3], []
                rows.append(r[3:])
            if out:
                yield _pairs(out)
                out = []
        if len(rows) > 1:
            across = run[1] != run[2]
            out = later(rows)
            if out:
                yield _pairs(out)

    near = m.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(verify, "h1 long, h2 long")
    near = tables.keep(near.distinct(), "near")
    tables.drop("keys", "names", "members", "hot")
    return near


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["h1", "h2"])


def removed_lines(docs: DataFrame, max_edits: int = MAX_EDITS, per_edit: int = PER_EDIT, id_col: str = "doc_id",
                  text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc, copy, lines): the line numbers (from 0) that go, by document."""
    lines = lines_of(docs, id_col, text_col)
    near = near_lines(docs, lines, max_edits, per_edit, text_col, block).withColumn("near", F.lit(True))
    tables = Scratch(docs.sparkSession, "line-dedup")
    every = tables.keep(lines.select("doc", "copy", "line", "h1", "h2"), "lines")
    place = F.struct(F.col("doc").isNull().alias("none"), F.coalesce("doc", F.lit(0)).alias("doc"), "copy", "line")
    classes = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).join(
        near, ["h1", "h2"], "left")
    classes = tables.keep(classes.where("near OR first <> last").select(
        "h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")), "classes")
    gone = every.join(classes.hint("merge"), ["h1", "h2"]).where(F.col("near") | (place != F.col("first")))
    removed = tables.keep(gone.groupBy("doc", "copy").agg(F.sort_array(F.collect_set("line")).alias("lines")), "removals")
    tables.drop("lines", "classes")
    return removed


def line_dedup(docs: DataFrame, max_edits: int = MAX_EDITS, per_edit: int = PER_EDIT, id_col: str = "doc_id",
               text_col: str = "text", length_col: str | None = None, removals: str | None = None,
               block: int = BLOCK) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one.

    Lines are split at \\n and compared without blanks at their ends; shorter
    ones than ``min_chars`` characters stay. A document that loses lines and has
    no word left goes. ``length_col`` gets the new length in characters of texts
    that changed; ``removals`` names a column to add with the removed line
    numbers (null where none); one of ``docs`` of that name is replaced.

    Defined cases: null and empty texts have no lines and stay as they are;
    documents with a null id come last; rows with equal id and text are one
    document (both lose the same lines); one id with different texts is
    ordered by text hash; very long lines are compared whole; an empty table
    gives an empty result; other columns stay."""
    gone = removed_lines(docs, max_edits, per_edit, id_col, text_col, block)
    names = [f"__ld_{c}" for c in gone.columns]
    gone = gone.toDF(*names)
    text = F.col(f"`{text_col}`").cast("string")
    joined = docs.join(gone.hint("merge"), F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(names[0]))
                       & (F.xxhash64(text) == F.col(names[1])), "left")
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(names[2], i))
    joined = joined.withColumn("__ld_text", F.when(F.col(names[2]).isNotNull(), F.array_join(left, "\n")))
    joined = joined.where(F.col("__ld_text").isNull() | F.rlike("__ld_text", F.lit(r"[^\x20\x09-\x0D]")))
    out = []
    for c in docs.columns:
        if c == removals:
            continue
        if c == text_col:
            out.append(F.coalesce("__ld_text", F.col(f"`{c}`")).alias(c))
        elif c == length_col:
            kind = dict(docs.dtypes)[c]
            out.append(F.when(F.col("__ld_text").isNotNull(), F.length("__ld_text").cast(kind))
                       .otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    if removals:
        out.append(F.col(names[2]).alias(removals))
    return joined.select(*out)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document that stays, with its new text and the removed line numbers."""
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup(docs, length_col="n_chars", removals="removed_lines")
