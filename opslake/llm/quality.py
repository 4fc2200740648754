"""Quality rules: hashed n-gram log-likelihood ratio, DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 5-word windows.
The method hashes every text's words and word pairs into ``BUCKETS`` buckets and
fits two multinomials: one of the raw corpus (all documents, add-one), one of the
trusted target (documents labelled quality 1, not toxic), smoothed towards the first. A document's score is
the mean log-likelihood ratio of its n-grams; it fails below ``MIN_SCORE``.

Scale: two scans of the texts, no text is shuffled. Counts are partially
aggregated to at most ``BUCKETS`` rows a task; the ratios are one array of
``BUCKETS`` doubles. The trusted sample is bounded (``max_trusted`` documents,
by smallest hash of the id), and so is its broadcast id list; the raw counts
cover every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import SPACE_CLASS, read_table, written

BUCKETS = 1 << 14
MAX_TRUSTED = 200_000
PRIOR = 1_000.0        # n-grams of the raw corpus that the target starts from
MIN_SCORE = -0.15      # mean log ratio (nats an n-gram) below which a document fails
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
WINDOW = 5


def _words(text: Column) -> Column:
    """Words between ASCII white space, as an array."""
    return F.array_remove(F.split(text, SPACE_CLASS), "")


def _joined(left: Column, right: Column, by: int) -> Column:
    """left[i] hashed with right[i + by], where both exist."""
    n = F.least(F.size(left), F.size(right) - by)
    return F.when(n > 0, F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(by + 1), n),
                                    lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, text, word, pair): the whole row, and the hashes of every
    word and every word pair of its text."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    d = d.select("*", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("word"))
    return d.select("*", _joined(F.col("word"), F.col("word"), 1).alias("pair"))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row with one array: log(target share / raw share) by bucket.

    ``trusted`` has one column, the distinct ids of the (bounded) target."""
    d = hashed(docs, id_col, text_col).join(
        F.broadcast(trusted.select(F.col(trusted.columns[0]).alias("doc_id"), F.lit(1).alias("target"))), "doc_id", "left")
    grams = d.select(F.explode(F.concat("word", "pair")).alias("h"), F.coalesce("target", F.lit(0)).alias("t"))
    counts = grams.groupBy(F.pmod("h", F.lit(BUCKETS)).cast("int").alias("b")).agg(
        F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    counts = written(counts, "gram-counts")  # at most BUCKETS rows
    sums = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    at = sums.select("raws", "targets", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("b")).join(
        counts, "b", "left")
    # The raw share with add-one smoothing is the prior mean of the target share: without target text all ratios are 0.
    raw = (F.coalesce("raw", F.lit(0)) + 1.0) / (F.coalesce("raws", F.lit(0)) + float(BUCKETS))
    target = (F.coalesce("target", F.lit(0)) + PRIOR * raw) / (F.coalesce("targets", F.lit(0)) + PRIOR)
    ratio = at.select("b", F.log(target / raw).alias("r"))
    return ratio.agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "r"))), lambda x: x["r"].cast("float")).alias("ratios"))


def base_counts(d: DataFrame) -> DataFrame:
    """``hashed`` rows with the base columns added."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    d = d.select("*", lines.alias("lines"), _joined(F.col("pair"), F.col("pair"), 2).alias("four"))
    d = d.select("*", _joined(F.col("four"), F.col("word"), WINDOW - 1).alias("five")).drop("four")
    again = F.size(F.array_distinct("five")) < F.size("five")
    places = F.when(again, F.sort_array(F.transform("five", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.select("*", places.alias("places"))
    same = lambda x, j: F.coalesce(F.get("places", j)["h"] == x["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter("places", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    d = d.select("*", starts.alias("starts")).drop("places", "five")
    steps = F.zip_with(F.slice("starts", F.lit(1), F.size("starts") - 1), F.slice("starts", F.lit(2), F.size("starts") - 1),
                       lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda acc, x: acc + x)
    return d.select(
        "*", F.size("word").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("starts") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words")).drop("lines", "starts")


def judge(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row (the whole row), doc_id, the base counts,
    base_failed, score, kept.

    Defined cases: null texts count as empty (no words, so base_failed); null
    ids and repeated rows stay rows; with no trusted documents every score is 0;
    an empty table gives an empty result; very long texts are judged whole;
    extra columns are ignored."""
    ratios = log_ratios(docs, trusted, id_col, text_col).scalar()
    d = base_counts(hashed(docs, id_col, text_col)).withColumn("ratios", ratios)
    grams = F.concat("word", "pair")
    total = F.aggregate(grams, F.lit(0.0), lambda acc, h: acc + F.get("ratios", F.pmod(h, F.lit(BUCKETS)).cast("int")))
    d = d.withColumn("score", F.when(F.size(grams) > 0, total / F.size(grams)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.select("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"),
                    (~failed & F.coalesce(F.col("score") >= min_score, F.lit(False))).alias("kept"), "score")


def keep_good(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with unchanged columns."""
    # Not where("kept"): the optimizer moves a filter below the projections and so writes out all their
    # expressions inside one another. A generator stays where it is.
    row = F.explode(F.when(F.col("kept"), F.array("row"))).alias("row")
    return judge(docs, trusted, min_score, id_col, text_col).select(row).select("row.*")


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of the target: labelled quality 1, never toxic or of quality 0; at
    most ``max_trusted`` of them, those with the smallest hash."""
    ids = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 AND t = 0")
    ids = ids.select("doc_id", F.xxhash64("doc_id").alias("h"))
    # Only ids up to the range of the hash in which the last one lies are sorted.
    part = F.shiftright("h", 48)
    upto, held = None, 0
    for r in sorted(ids.groupBy(part.alias("part")).count().collect(), key=lambda r: r["part"]):
        upto, held = r["part"], held + r["count"]
        if held >= max_trusted:
            break
    return ids.where(part <= F.lit(upto)).orderBy("h", "doc_id").limit(max_trusted).select("doc_id")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts and verdict of every document."""
    return judge(read_table(spark, sf_dir, "documents"), trusted_ids(read_table(spark, sf_dir, "labels"))).drop("row")
