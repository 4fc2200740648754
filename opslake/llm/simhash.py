"""SimHash near-dedup with multi-index hashing.

Fingerprints are 64-bit SimHashes over word shingles. Two fingerprints link
when they differ in at most ``max_bits`` bits. Candidates come from a
multi-index: a fingerprint is cut in ``max_bits // 2 + 1`` segments; by the
pigeonhole principle two linked fingerprints differ by at most one bit in one
segment, so each fingerprint probes the Hamming ball of radius 1 around each of
its segments, fetches the table entries with that segment value, and the whole
distance is verified.

Scale: texts are read once and leave the scan as (id, fingerprint). Equal
fingerprints collapse (partial aggregation) before anything is joined, so a
group of copies is one table entry. Every fingerprint has a bounded number of
neighbours (at most 43,744 values lie within 3 bits), so the links are linear
in the number of distinct fingerprints. Segments are 32 bits wide for 3 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import connected_components, read_table, sized, written

BITS = 64
SEED = 42
CHUNK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text: A-Z lower-cased, words between ASCII white space,
    space-joined shingles with repeats (fewer words: the whole sequence; none:
    zero); a bit is 1 if set in over half of the shingles' XXH64 values."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    ones, total, part = np.zeros(BITS, np.int64), 0, []

    def count(part: list[int]) -> np.ndarray:
        octets = np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8)
        return np.unpackbits(octets, axis=1).sum(0, dtype=np.int64)

    for g in grams:
        part.append(digest(g, SEED))
        if len(part) == CHUNK:
            ones, total, part = ones + count(part), total + len(part), []
    if part:
        ones, total = ones + count(part), total + len(part)
    return int(np.packbits(2 * ones > total).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, copy, fp) for every row of ``docs``; fp is the fingerprint as a
    signed long, copy the text's hash, which tells rows with one id apart.

    Null texts count as empty (fingerprint 0); null ids and repeated rows stay
    rows of their own; other columns are not read."""
    text = F.col(f"`{text_col}`").cast("string")
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("copy"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["id", "copy", "fp"])

    return src.mapInArrow(run, "id long, copy long, fp long")


def links(distinct_fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b) pairs of different fingerprints within ``max_bits`` bits, each
    once or twice. ``distinct_fps`` has one column fp without repeats."""
    parts = max_bits // 2 + 1
    cuts = [BITS * i // parts for i in range(parts + 1)]
    table, probe = [], []
    for s in range(parts):
        width = cuts[s + 1] - cuts[s]
        mask = (1 << width) - 1
        value = F.shiftrightunsigned("fp", cuts[s])
        seg = value if width == BITS else value.bitwiseAND(F.lit(mask))
        table.append(F.struct(F.lit(s).alias("seg"), seg.alias("key"), F.lit(0).alias("near")))
        probe.append(F.struct(F.lit(s).alias("seg"), seg.alias("key"), F.lit(0).alias("near")))
        # Of two values one bit apart, one has that bit clear: setting clear bits reaches every neighbour once.
        for bit in range(width):
            one = 1 << bit
            one -= (1 << BITS) if one >= 1 << (BITS - 1) else 0
            flip = F.when(seg.bitwiseAND(F.lit(one).cast("long")) == 0,
                          F.struct(F.lit(s).alias("seg"), seg.bitwiseOR(F.lit(one).cast("long")).alias("key"),
                                   F.lit(1).alias("near")))
            probe.append(flip)
    t = distinct_fps.select(F.col("fp").alias("b"), F.explode(F.array(*table)).alias("k")).select(
        "b", F.col("k.seg").alias("seg"), F.col("k.key").alias("key"))
    p = (distinct_fps.select(F.col("fp").alias("a"), F.explode(F.array(*probe)).alias("k"))
         .where(F.col("k").isNotNull())
         .select("a", F.col("k.seg").alias("seg"), F.col("k.key").alias("key"), F.col("k.near").alias("near")))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    once = (F.col("near") == 1) | (F.col("a") < F.col("b"))
    p, t = p.alias("p"), t.alias("t")
    return p.join(t, (F.col("p.seg") == F.col("t.seg")) & (F.col("p.key") == F.col("t.key")) & once
                  & (F.col("a") != F.col("b")) & close).select("a", "b")


def components(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, grp, component_id) per distinct fingerprint of ``fps`` (id, fp):
    grp is the component's smallest fingerprint, component_id the smallest id
    in the component (null if all its ids are null)."""
    per = written(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-fps")
    comp = connected_components(links(per.select("fp"), max_bits))
    named = per.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("grp"))
    alone = named.groupBy("grp").agg(F.min("first").alias("component_id"))
    return named.join(alone, "grp").select("fp", "grp", "component_id")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, copy, fp (signed long), grp, component_id.

    Defined cases: null or empty texts have fingerprint 0 and link like any
    other; null ids never name a component unless it has no other id; repeated
    rows give repeated result rows; an empty table gives an empty result; extra
    columns, whatever their names, are ignored."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash")
    return fps.join(components(fps, max_bits), "fp").select("id", "copy", "fp", "grp", "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of every component the row with the
    smallest id. Where several rows of a component carry that id, the smallest
    text hash decides, then the smallest hash of the whole row. Columns are
    unchanged."""
    key, copy = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    every = simhash_components(docs, shingle, max_bits, id_col, text_col)
    stay = every.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("grp", "id", "copy").agg(
        F.count(F.lit(1)).alias("n"))
    stay = written(stay.groupBy("grp").agg(F.min(F.struct("copy", "id", "n")).alias("s")).select(
        F.col("s.id").alias("__sh_id"), F.col("s.copy").alias("__sh_copy"), F.col("s.n").alias("__sh_n")), "simhash-keep")
    same = key.eqNullSafe(F.col("__sh_id")) & (copy == F.col("__sh_copy"))
    once = docs.join(sized(stay), same, "left_semi")
    again = stay.where("__sh_n > 1")
    if again.isEmpty():
        return once
    # Repeated rows that stay: one of each.
    first = docs.join(sized(stay.where("__sh_n = 1")), same, "left_semi")
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    rows = docs.join(sized(again), same).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(*plain).alias("tie"), "__sh_id", "__sh_copy")
    chosen = rows.groupBy("__sh_id", "__sh_copy").agg(F.min_by("row", "tie").alias("row")).select("row.*")
    return first.unionByName(chosen)


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: doc_id, fingerprint, component_id of every document."""
    got = simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")
