"""A training corpus from ``documents``: quality rules, line dedup, SimHash
near-dedup, mixing sources to target weights, packing.

Each stage is one operator of ``opslake.llm`` over all that the stage before it
kept. All take nulls, repeated rows, empty and very long texts as their operator
states; empty tables give empty results; columns besides those of ``documents`` are
carried up to the last stage. Between stages the rows are written as Parquet in the shared folder and
read again, so a lost executor costs the current stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm import line_dedup, mixing, packing, quality, simhash
from opslake.llm._common import read_table, written

SHINGLE, MAX_BITS = 3, 3   # SimHash contract
MIXING_EXPONENT = 0.5      # source weights: square root of their documents
NEIGHBOURS = 256           # documents of the mixture that are packed together


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, quality.trusted_ids(read_table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which no word is left."""
    return line_dedup.line_dedup(docs, length_col="n_chars")


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.simhash_dedup(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: each file is a stretch of it."""
    return mixing.mix(docs, mixing.smoothed_shares(docs, MIXING_EXPONENT))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences of at most 2048 tokens, numbered in the
    order of the mixture: its files in order of their names (they have the number of
    their stretch), their rows as they stand. ``docs`` is what the stage before wrote."""
    order = F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")
    return packing.pack(docs.select("*", *order), packing.tokenizer_file(), order=[F.col("__file"), F.col("__row")], pool=NEIGHBOURS)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# Edit joins, SimHash and bin packing have no SQL form: see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
