"""Declarative data contract in warn mode (DC2–DC5).

A contract is an ordered list of :class:`Rule` (name, passing predicate). One
list yields everything, with SQL's three-valued logic kept as the reference
has it:

* quarantine membership — some predicate is FALSE (``WHERE NOT (P1 AND … Pn)``;
  a row whose only defect is a NULL predicate is *not* quarantined);
* reasons — every predicate that is not TRUE, in rule order, joined by ' | ';
* metrics — per rule, rows whose predicate is not TRUE; counted in the same
  pass as the write via ``DataFrame.observe`` or as a one-row aggregate.

Nothing is dropped from the audited table; the quarantine is a copy.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    passes: Column


def _not_true(rule: Rule) -> Column:
    return ~F.coalesce(rule.passes, F.lit(False))


def all_pass(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.passes for r in rules])


def violated(rules: list[Rule]) -> Column:
    """TRUE when some rule is FALSE; NULL (→ filtered out) when the only
    defects are NULL predicates."""
    return ~all_pass(rules)


def reasons(rules: list[Rule], separator: str) -> Column:
    """Names of the rules that are not TRUE, in rule order; '' when none."""
    return F.concat_ws(separator, *[F.when(_not_true(r), F.lit(r.name)) for r in rules])


def metric_columns(rules: list[Rule], violated_name: str = "quarantined", rows_name: str = "rows",
                   only_null_name: str | None = "null_only_not_quarantined") -> list[Column]:
    """Aggregates: rows, failures per rule, quarantined rows, and rows whose
    defects are all NULL predicates (listed with reasons, not quarantined)."""
    cols = [F.count(F.lit(1)).alias(rows_name)]
    cols += [F.count_if(_not_true(r)).alias(r.name) for r in rules]
    cols.append(F.count_if(F.coalesce(violated(rules), F.lit(False))).alias(violated_name))
    if only_null_name:
        any_not_true = reduce(lambda a, b: a | b, [_not_true(r) for r in rules])
        cols.append(F.count_if(any_not_true & all_pass(rules).isNull()).alias(only_null_name))
    return cols


def audit(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One-row DataFrame of contract metrics (partial aggregation, one pass)."""
    return df.agg(*metric_columns(rules))


def observe(df: DataFrame, rules: list[Rule], name: str = "contract") -> tuple[DataFrame, Observation]:
    """Attach the metrics to ``df``: they are filled by whatever action runs
    ``df`` (e.g. the write), without a second scan."""
    obs = Observation(name)
    return df.observe(obs, *metric_columns(rules)), obs


def quarantine(df: DataFrame, rules: list[Rule], reason_column: str, separator: str,
               stamp_column: str | None = None) -> DataFrame:
    """Diagnostic copy of the rows that break at least one rule, with reasons."""
    out = df.where(violated(rules)).withColumn(reason_column, reasons(rules, separator))
    if stamp_column:
        out = out.withColumn(stamp_column, F.current_timestamp())
    return out


def violation_mask(rules: list[Rule]) -> Column:
    """A bit for each rule that is not TRUE, the first rule being bit 0."""
    return reduce(lambda a, b: a + b, [F.when(_not_true(r), 1 << i).otherwise(0) for i, r in enumerate(rules)])


def rule_patterns(df: DataFrame, rules: list[Rule], groups: dict[str, Column]) -> DataFrame:
    """How often each combination of violated rules occurs: over all rows and by
    each of ``groups``, by one aggregation over grouping sets (one shuffle).
    (level: all or the group's name, the groups, mask, rules: their names, flights)."""
    names = list(groups)
    rows = df.select(*[v.alias(n) for n, v in groups.items()], violation_mask(rules).alias("mask"))
    sets = [["mask"], *[[n, "mask"] for n in names]]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *names, "mask").agg(
        F.count(F.lit(1)).alias("flights"), *[F.grouping(n).alias(f"_{n}") for n in names])
    level = F.coalesce(*[F.when(F.col(f"_{n}") == 0, n) for n in names], F.lit("all"))
    failed = F.concat_ws(" | ", *[F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, r.name) for i, r in enumerate(rules)])
    return out.select(level.alias("level"), *names, "mask", failed.alias("rules"), "flights")
