"""Mixing sources to target weights by Pfair scheduling. DataFrame functions only.

Each source's documents, in an order shuffled by hash, make blocks of ``block``
documents. Block i of a source of weight w is released in slot floor(i / w)
and due by slot ceil((i + 1) / w); every slot goes to the released block with the
earliest deadline. So in every prefix of the slots each source is less than one
block away from its target. Weights are integer shares, any number of sources
has a share of its own, and the schedule repeats every sum(shares) slots.

Sources of one share release and owe their blocks at the same slots, so the
schedule of a period is a list of runs: block i of the sources q to q + n of a
share stands in n slots in a row. Its length depends on the distinct shares (at
most about twice their sum), not on the number of sources.

No document is dropped or repeated. A source that has run out leaves its slots
empty: ``position`` skips them, so the others keep their proportions. After the
period in which sources with a ``1 / RENEW``th of the shares have run out, a new
phase begins: a schedule of the sources that are left.

Scale: the schedule needs each document's rank in its source. A source is dealt
to hash ranges of some ``ROWS_PER_RANGE`` rows; counts by (source, range) are
aggregated first, and ranks are counted within a range only, so a source with a
third of all rows is spread over a third of the ranges. Sources are numbered the
same way. The driver gets the number of sources by (share, blocks), at most
sqrt(2 * all blocks) rows a share.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from opslake.llm._common import read_table, sized, written

BLOCK = 16
ROWS_PER_RANGE = 1_000
FINE_BITS = 12     # hash ranges of a source that are counted
SOURCE_BITS = 10   # hash ranges of the sources of one share and length
GRAIN = 100        # share of the largest source in derived weights
RENEW = 8
BROADCAST_RUNS = 500_000


def period(sources: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """The runs of one period, given the number of sources of each share:
    (share, block within the period, first source, slot, length), all from 0.
    Earliest deadline first among released blocks, ties by larger share."""
    total = sum(w * m for w, m in sources.items())
    release = [(0, w, 0) for w in sources]
    ready: list[tuple[int, int, int, int]] = []
    out, slot = [], 0
    heapq.heapify(release)
    while slot < total:
        while release and release[0][0] <= slot:
            _, w, i = heapq.heappop(release)
            heapq.heappush(ready, (-(-(i + 1) * total // w), -w, i, 0))
        due, w, i, q = heapq.heappop(ready)
        w = -w
        n = min(sources[w] - q, (release[0][0] if release else total) - slot)
        if slot + n > due:
            raise AssertionError("a deadline was missed")
        out.append((w, i, q, slot, n))
        slot += n
        if q + n < sources[w]:
            heapq.heappush(ready, (due, -w, i, q + n))
        elif i + 1 < w:
            heapq.heappush(release, ((i + 1) * total // w, w, i + 1))
    return out


def phases(lengths: dict[tuple[int, int], int]) -> tuple[list[tuple], list[tuple]]:
    """The whole schedule, given the number of sources of each (share, blocks).
    The sources of a share are numbered with the longest first.

    Returns rows (phase, share, first block, past its last, blocks a period, slots
    a period, first slot) and rows (phase, share, block within the period, first
    source, past its last, slot)."""
    used = {w: 0 for w, _ in lengths}
    spans, runs, first, phase = [], [], 0, 0
    while True:
        left = {(w, b): m for (w, b), m in lengths.items() if b > used[w]}
        if not left:
            return spans, runs
        unit = math.gcd(*(w for w, _ in left))
        alive: Counter = Counter()
        ends: Counter = Counter()  # shares that run out, by period
        for (w, b), m in left.items():
            alive[w // unit] += m
            ends[-(-(b - used[w]) * unit // w)] += w // unit * m
        total, gone = sum(w * m for w, m in alive.items()), 0
        for periods in sorted(ends):
            gone += ends[periods]
            if gone * RENEW >= total:
                break
        runs += [(phase, w * unit, i, q, q + n, slot) for w, i, q, slot, n in period(alive)]
        for w in alive:
            until = used[w * unit] + periods * w
            spans.append((phase, w * unit, used[w * unit], until, w, total, first))
            used[w * unit] = until
        first += periods * total
        phase += 1


def smoothed_shares(docs: DataFrame, exponent: float = 0.5, source_col: str = "source") -> DataFrame:
    """(source, share) of every source: shares proportional to (documents of the
    source) ** exponent, the largest being ``GRAIN``, the least 1. 0 gives equal
    shares, 1 those of the corpus."""
    n = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(GRAIN * F.pow(F.col("n") / n.agg(F.max("n")).scalar(), F.lit(float(exponent))))
    return n.select("source", F.greatest(F.lit(1), share).cast("long").alias("share"))


SCHEDULE = ["phase", "block", "slot", "position", "release", "deadline"]


def _source_key(source: Column) -> list[Column]:
    """A source as columns that are never null, to join on."""
    return [source.isNull().alias("__mx_none"), F.coalesce(source, F.lit("")).alias("__mx_source")]


def _numbered(sources: DataFrame) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """``sources`` with their number __mx_q among those of their share, longest
    first, and the number of sources by (share, blocks)."""
    group = ["__mx_share", "__mx_blocks", "__mx_part"]
    sources = sources.withColumn("__mx_part", F.shiftrightunsigned(F.xxhash64("__mx_none", "__mx_source"), 64 - SOURCE_BITS))
    parts = written(sources.groupBy(*group).agg(F.count(F.lit(1)).alias("n")), "mix-parts")
    lengths = {(r[0], r[1]): r["n"] for r in parts.groupBy("__mx_share", "__mx_blocks").agg(F.sum("n").alias("n")).collect()}
    longer, rows = Counter(), []
    for w, b in sorted(lengths, key=lambda x: (x[0], -x[1])):
        rows.append((w, b, longer[w]))
        longer[w] += lengths[w, b]
    offset = sources.sparkSession.createDataFrame(rows, "__mx_share long, __mx_blocks long, __mx_longer long")
    before = Window.partitionBy(*group[:2]).orderBy("__mx_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__mx_first")).join(offset, group[:2])
    row = F.row_number().over(Window.partitionBy(*group).orderBy("__mx_none", "__mx_source")) - 1
    q = (F.col("__mx_longer") + F.col("__mx_first") + F.col("__mx_at")).alias("__mx_q")
    return sources.withColumn("__mx_at", row).join(parts, group).select("__mx_none", "__mx_source", "__mx_share", q), lengths


def schedule(docs: DataFrame, shares: dict | DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", seed: int = 11, prefix: str = "") -> DataFrame:
    """``docs`` with the columns phase, block, slot, position, release and
    deadline (longs; the names get ``prefix``). Slots are numbered over all
    phases; ``position`` orders the mixture (slot * block + place in the block).

    ``shares`` are positive integers by source: a mapping, or a table (source,
    share) of any size; None is the null source. A source that isn't listed, or
    with a null share, has share 1; of a source listed twice the larger holds.

    Defined cases: null ids, sources and texts are values of their own; ties of
    the hash order are broken by id and text hash, and rows equal in all three
    are interchangeable; repeated rows are scheduled each; a source with a share
    and no documents takes no slot; the last block of a source may hold less;
    an empty table gives an empty result; other columns stay. Where ``docs`` has
    a column of the same name as a new one, the names need a ``prefix``: else it
    raises."""
    taken = {c.lower() for c in docs.columns} & {(prefix + c).lower() for c in SCHEDULE}
    if taken:
        raise ValueError(f"documents have columns {sorted(taken)}; give a prefix")
    spark = docs.sparkSession
    if isinstance(shares, dict):
        if any(w != int(w) or w < 1 for w in shares.values()):
            raise ValueError("shares are positive integers")
        shares = spark.createDataFrame([(s, int(w)) for s, w in shares.items()], "source string, share long")
    given = shares.select(*_source_key(F.col("source").cast("string")), F.col("share").cast("long").alias("s"))
    given = given.groupBy("__mx_none", "__mx_source").agg(F.max("s").alias("__mx_given"))
    key = ["__mx_none", "__mx_source"]
    source = F.col(f"`{source_col}`").cast("string")
    d = (docs.select("*", *_source_key(source))
         .withColumn("__mx_id", F.col(f"`{id_col}`").cast("long"))
         .withColumn("__mx_copy", F.xxhash64(F.col(f"`{text_col}`").cast("string"), source))
         .withColumn("__mx_h", F.xxhash64(F.lit(seed), "__mx_id", "__mx_copy")))
    # Ranges of the hash, in its order, first fine, then as wide as the rows ask for.
    fine = F.shiftright("__mx_h", 64 - FINE_BITS).cast("long") + (1 << (FINE_BITS - 1))
    counts = written(d.groupBy(*key, fine.alias("__mx_fine")).agg(F.count(F.lit(1)).alias("n")), "mix-ranges")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    width = max(1, (1 << FINE_BITS) * ROWS_PER_RANGE // max(1, total))
    sources = counts.groupBy(*key).agg(F.ceil(F.sum("n") / block).alias("__mx_blocks")).join(given, key, "left")
    sources = written(sources.select(*key, "__mx_blocks", F.coalesce("__mx_given", F.lit(1)).alias("__mx_share")), "mix-sources")
    numbered, lengths = _numbered(sources)
    if any(w < 1 for w, _ in lengths):
        raise ValueError("shares are positive integers")
    ranges = counts.groupBy(*key, F.floor(F.col("__mx_fine") / width).alias("__mx_range")).agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*key).orderBy("__mx_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*key, "__mx_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__mx_before"))
    inside = Window.partitionBy(*key, "__mx_range").orderBy(
        "__mx_h", F.col("__mx_id").asc_nulls_last(), "__mx_copy")
    d = d.withColumn("__mx_range", F.floor(fine / width)).withColumn("__mx_row", F.row_number().over(inside) - 1)
    d = d.join(sized(written(ranges.join(numbered, key), "mix-before")), [*key, "__mx_range"])
    rank = F.col("__mx_before") + F.col("__mx_row")
    d = d.withColumn("__mx_block", F.floor(rank / block)).withColumn("__mx_within", rank % block)

    spans, runs = phases(lengths)
    span = spark.createDataFrame(spans, "__mx_phase int, __mx_sw long, __mx_from long, __mx_to long, __mx_per long, "
                                 "__mx_total long, __mx_start long")
    run = spark.createDataFrame(runs, "__mx_rphase int, __mx_rw long, __mx_place long, __mx_q0 long, __mx_q1 long, __mx_slot long")
    d = d.join(F.broadcast(span), (F.col("__mx_share") == F.col("__mx_sw")) & (F.col("__mx_block") >= F.col("__mx_from"))
               & (F.col("__mx_block") < F.col("__mx_to")))
    d = d.withColumn("__mx_j", F.col("__mx_block") - F.col("__mx_from"))
    d = d.join(F.broadcast(run) if len(runs) <= BROADCAST_RUNS else run,
               (F.col("__mx_phase") == F.col("__mx_rphase")) & (F.col("__mx_share") == F.col("__mx_rw"))
               & (F.col("__mx_j") % F.col("__mx_per") == F.col("__mx_place"))
               & (F.col("__mx_q") >= F.col("__mx_q0")) & (F.col("__mx_q") < F.col("__mx_q1")))
    at = F.expr("__mx_start + (__mx_j div __mx_per) * __mx_total + __mx_slot + __mx_q - __mx_q0")
    release = F.expr("__mx_start + __mx_j * __mx_total div __mx_per")
    due = F.expr("__mx_start + ((__mx_j + 1) * __mx_total + __mx_per - 1) div __mx_per")
    values = [F.col("__mx_phase"), F.col("__mx_block"), at, at * block + F.col("__mx_within"), release, due]
    return d.select(*[F.col(f"`{c}`") for c in docs.columns],
                    *[v.cast("long").alias(prefix + n) for n, v in zip(SCHEDULE, values)])


def mix(docs: DataFrame, shares: dict | DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The documents in the order of the mixture, with unchanged columns: each
    partition (and so each written file) is a stretch of it. See ``schedule``."""
    d = schedule(docs, shares, block, id_col, text_col, source_col, prefix="__mx_out_")
    ordered = d.repartitionByRange("__mx_out_position").sortWithinPartitions("__mx_out_position")
    return ordered.select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The schedule of every document, sources weighted by the square root of their size."""
    docs = read_table(spark, sf_dir, "documents")
    return schedule(docs, smoothed_shares(docs, 0.5)).select("doc_id", "source", *SCHEDULE)
