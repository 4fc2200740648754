"""Landing CSV files into bronze by column name (SRC1–SRC7).

Open-source Spark has neither ``skipRows`` nor a rescued-data column, and its CSV
reader takes columns by position. So files are read as lines, and everything
else is an expression over a line:

* A line is split into an array of fields: separators inside quotes stay, doubled
  quotes are one; a quote that is never closed is text. An empty field without
  quotes is null. No line is ever dropped, however many fields it has.
* A line that holds at least half of the known column names is its file's header.
  The header of each file is one row (path, names); rows are joined to it and
  take their values by name. Files may have their columns in any order, lack some
  (null) or have others.
* What did not fit is kept in ``_rescued_data``, a JSON map: ``_c<position>`` for
  fields beyond the header, the name for columns that aren't known, ``_fields``
  (their number) for a line with too few, and ``_file``. Null if all fitted.
* The preamble is a line without any separator (or one that matches a pattern) in
  the first block of its file. Nothing else is left out but empty lines.
* Headers and preambles are counted by ``observe`` on the bronze write. A load
  whose files do not have one header and ``preamble_lines`` preambles each fails
  before silver (``LandingCheck.verify``), so a truncated line that looks like
  a preamble, or a file without a header, is never lost or loaded silently.

Scale: lines of large files are split across tasks by Spark. The header table has
a row a file; it is written to the shared folder before it is joined, so Spark
broadcasts it by its known size or, with very many files, joins by shuffle. Making
it reads the files once more, but only lines that hold one of the names are parsed.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opslake import spec
from opslake.operators.mirror import rename
from opslake.operators.once import once
from opslake.session import shared_root


class HeaderMismatch(ValueError):
    pass


@dataclass(frozen=True)
class CsvFormat:
    sep: str = ";"
    encoding: str = "UTF-8"
    quote: str | None = '"'      # doubled inside quotes; None: quoting disabled
    preamble_lines: int = 1
    preamble_regex: str | None = None   # default: no separator in the line


UTF8_QUOTED = CsvFormat()
LATIN1_UNQUOTED = CsvFormat(encoding="ISO-8859-1", quote=None)


def fields_of(line: Column, fmt: CsvFormat = UTF8_QUOTED) -> Column:
    """The fields of a line, as an array of strings (null: empty without quotes)."""
    sep = re.escape(fmt.sep)
    plain = F.transform(F.split(line, sep, -1), lambda f: F.nullif(f, F.lit("")))
    if fmt.quote is None:
        return plain
    q = re.escape(fmt.quote)
    # Possessive, so that a long field takes no stack. Every match begins at a separator (one is put in front).
    raw = F.regexp_extract_all(F.concat(F.lit(fmt.sep), line), F.lit(f"{sep}(?:{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?={sep}|$)|[^{sep}]*+)"), F.lit(0))

    def value(f: Column) -> Column:
        text = F.substr(f, F.lit(2))
        quoted = (F.length(text) > 1) & F.startswith(text, F.lit(fmt.quote)) & F.endswith(text, F.lit(fmt.quote))
        inner = F.replace(F.substr(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0))), F.lit(fmt.quote * 2), F.lit(fmt.quote))
        return F.when(quoted, inner).otherwise(F.nullif(text, F.lit("")))

    # A line without any quote needs no more than its separators.
    return F.when(F.contains(line, F.lit(fmt.quote)), F.transform(raw, value)).otherwise(plain)


def read_lines(lines: DataFrame, fmt: CsvFormat) -> DataFrame:
    """(_line, _path, _file, _block) of a text read, batch or streaming."""
    text = F.col("value") if fmt.encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), fmt.encoding)
    meta = "_metadata.file_path", "_metadata.file_name", "_metadata.file_block_start"
    return lines.select(F.regexp_replace(text, "\r$", "").alias("_line"), *(F.col(m).alias(n) for m, n in zip(meta, ("_path", "_file", "_block"))))


@dataclass
class LandingCheck:
    """What a bronze load saw of headers and preambles, to verify after it. In
    a micro-batch the number of files isn't known beforehand (None); then the
    files that gave rows are the least number of headers."""

    label: str
    files: int | None
    preamble_lines: int
    observation: Observation

    def verify(self, at_least: int = 0) -> dict[str, int]:
        got = {k: int(v or 0) for k, v in self.observation.get.items()}
        files = max(got["headers"], at_least) if self.files is None else self.files
        want = {"headers": files, "preambles": files * self.preamble_lines}
        if got != want:
            raise HeaderMismatch(f"{self.label}: {files} files have {got}, expected {want}")
        return got


def _names(fields: Column) -> Column:
    return F.transform(fields, lambda f: F.trim(F.replace(F.coalesce(f, F.lit("")), F.lit("\ufeff"), F.lit(""))))


def _is_header(names: Column, header: list[str]) -> Column:
    return 2 * F.size(F.array_intersect(names, F.array(*[F.lit(h) for h in header]))) >= len(header)


def _names_one(header: list[str]) -> Column:
    """A cheap first test: whether the line holds one of so many known column
    names (the longest) that a line with half of all cannot lack them."""
    some = sorted(header, key=len, reverse=True)[:len(header) // 2 + 1]
    return reduce(or_, [F.contains(F.col("_line"), F.lit(h)) for h in some])


def header_table(lines: DataFrame, header: list[str], fmt: CsvFormat) -> DataFrame:
    """The header of each file (the first in order of names if it has several):
    (_path, _width, _at: the place of each known column, null if it lacks,
    _others: place and name of the columns that aren't known). A header that
    names a column twice raises when it is read."""
    known = F.array(*[F.lit(h) for h in header])
    some = lines.where(_names_one(header))
    some = once(some, _names=_names(fields_of(F.col("_line"), fmt))).where(_is_header(F.col("_names"), header))
    some = some.groupBy("_path").agg(F.min("_names").alias("_names"))
    names = F.col("_names")
    message = F.concat(F.lit("a column stands twice in the header of "), F.col("_path"))
    places = F.transform(known, lambda h: F.nullif(F.array_position(names, h), F.lit(0)).cast("int") - 1)
    others = F.filter(F.transform(names, lambda n, i: F.struct(i.alias("i"), n.alias("name"))), lambda x: ~F.array_contains(known, x["name"]))
    twice = F.size(F.array_distinct(names)) < F.size(names)
    return some.select("_path", F.when(twice, F.raise_error(message).cast("int")).otherwise(F.size(names)).alias("_width"),
                       places.alias("_at"), others.alias("_others"))


def parse_lines(lines: DataFrame, headers: DataFrame, header: list[str], fmt: CsvFormat = UTF8_QUOTED,
                observation: Observation | None = None) -> DataFrame:
    """Rows of ``read_lines`` by the names of their file's header, with what was
    rescued and ``_file``; ``observation`` counts headers and preambles."""
    rows = once(lines.where(F.trim("_line") != ""), _fields=fields_of(F.col("_line"), fmt))
    fields = F.col("_fields")
    is_preamble = F.lit(False)
    if fmt.preamble_lines:
        matches = F.rlike("_line", F.lit(fmt.preamble_regex)) if fmt.preamble_regex else ~F.contains(F.col("_line"), F.lit(fmt.sep))
        is_preamble = (F.col("_block") == 0) & matches
    rows = rows.withColumn("_kind", F.when(_names_one(header) & _is_header(_names(fields), header), "header").when(is_preamble, "preamble").otherwise("data"))
    if observation is not None:
        rows = rows.observe(observation, F.count_if(F.col("_kind") == "header").alias("headers"),
                            F.count_if(F.col("_kind") == "preamble").alias("preambles"))
    rows = rows.where(F.col("_kind") == "data").join(headers, "_path", "left")
    width, none = F.coalesce("_width", F.lit(0)), F.array().cast("array<struct<key: string, value: string>>")

    def entry(key: Column, value: Column) -> Column:
        return F.struct(key.cast("string").alias("key"), value.cast("string").alias("value"))

    others = F.coalesce(F.filter(F.transform("_others", lambda o: entry(o["name"], F.get(fields, o["i"]))), lambda e: e["value"].isNotNull()), none)
    beyond = F.when(F.size(fields) > width, F.transform(
        F.slice(fields, width + 1, F.greatest(F.size(fields) - width, F.lit(0))),
        lambda f, i: entry(F.concat(F.lit("_c"), width + i), F.coalesce(f, F.lit(""))))).otherwise(none)
    short = F.when(F.size(fields) < width, F.array(entry(F.lit("_fields"), F.size(fields)))).otherwise(none)
    rows = rows.withColumn("_misfits", F.when((F.size(fields) != width) | (F.size("_others") > 0), F.concat(others, beyond, short)))
    rescued = F.when(F.size("_misfits") > 0, F.to_json(F.map_from_entries(F.concat("_misfits", F.array(entry(F.lit("_file"), F.col("_file")))))))
    return rows.select(*[F.get(fields, F.get("_at", F.lit(i))).alias(h) for i, h in enumerate(header)], rescued.alias(spec.COL_RESCUED), "_file")


def read_landing(spark: SparkSession, path: str, header: list[str], fmt: CsvFormat = UTF8_QUOTED,
                 checks: list[LandingCheck] | None = None) -> DataFrame:
    """All-string rows of the files under ``path`` (glob allowed), columns
    named as in ``header``, plus ``_rescued_data`` and ``_file``. With ``checks``,
    a check to verify after the rows are written is added to it."""
    raw = spark.read.text(path)
    lines = read_lines(raw, fmt)
    headers = written_headers(lines, header, fmt)
    if checks is None:
        return parse_lines(lines, headers, header, fmt)
    seen = Observation(f"landing:{len(checks)}:{os.path.basename(path)}")
    checks.append(LandingCheck(path, len(raw.inputFiles()), fmt.preamble_lines, seen))
    return parse_lines(lines, headers, header, fmt, seen)


def written_headers(lines: DataFrame, header: list[str], fmt: CsvFormat) -> DataFrame:
    """The header table as a file in the shared folder: its size is known to the join."""
    spark = lines.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/landing-headers/{uuid.uuid4().hex}"
    headers = header_table(lines, header, fmt)
    headers.coalesce(1).write.parquet(path)
    return spark.read.schema(headers.schema).parquet(path)


def flights_bronze(df: DataFrame) -> DataFrame:
    """Cleaned landing rows → bronze.vra columns."""
    header = [raw for raw, _ in spec.FLIGHT_SOURCE_COLUMNS]
    return df.select(
        *[F.col(f"`{h}`") for h in header],
        spec.COL_RESCUED,
        F.col("_file").alias(spec.COL_SOURCE_FILE),
        F.current_timestamp().alias(spec.COL_INGESTED),
    )


def land_flights(spark: SparkSession, path: str, fmt: CsvFormat = UTF8_QUOTED,
                 checks: list[LandingCheck] | None = None) -> DataFrame:
    """bronze.vra: the 12 source columns as text, what was rescued, source file,
    ingestion time."""
    header = [raw for raw, _ in spec.FLIGHT_SOURCE_COLUMNS]
    return flights_bronze(read_landing(spark, path, header, fmt, checks))


def land_aerodromes(spark: SparkSession, path: str, fmt: CsvFormat = LATIN1_UNQUOTED,
                    checks: list[LandingCheck] | None = None) -> DataFrame:
    header = [raw for raw, _ in spec.AERODROME_SOURCE_COLUMNS]
    df = read_landing(spark, path, header, fmt, checks)
    return rename(df, spec.AERODROME_SOURCE_COLUMNS).withColumn(spec.COL_INGESTED, F.current_timestamp())


def land_airlines(spark: SparkSession, path: str, file_label: str, fmt: CsvFormat = UTF8_QUOTED,
                  checks: list[LandingCheck] | None = None) -> DataFrame:
    """One airline registry file; provenance is the given file name (SRC6)."""
    header = [raw for raw, _ in spec.AIRLINE_SOURCE_COLUMNS]
    df = read_landing(spark, path, header, fmt, checks)
    return rename(df, spec.AIRLINE_SOURCE_COLUMNS).select(
        "*", F.lit(file_label).alias(spec.COL_SOURCE_FILE), F.current_timestamp().alias(spec.COL_INGESTED))


def csv_sources(spark: SparkSession, flights_glob: str, references_dir: str):
    """Sources for the pipeline from landed files: monthly flight files and
    the three registries (SRC7: one bronze table per registry file)."""
    from opslake.plans.lakehouse import Sources
    from opslake.sources.seeds import operation_codes

    checks: list[LandingCheck] = []
    registries = {
        f: land_airlines(spark, f"{references_dir}/{f}", f, checks=checks)
        for f in (spec.NATIONAL_AIRLINES_FILE, spec.FOREIGN_AIRLINES_FILE)
    }
    return Sources(
        flights=land_flights(spark, flights_glob, checks=checks),
        airline_registries=registries,
        aerodromes=land_aerodromes(spark, f"{references_dir}/AerodromosPublicos.csv", checks=checks),
        codes=operation_codes(spark),
        checks=checks,
    )
