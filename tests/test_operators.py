"""Operators on small tables: survivors, checksums, rule combinations."""

from pyspark.sql import functions as F

from opslake.operators.checksum import reconcile
from opslake.operators.contract import Rule, rule_patterns
from opslake.operators.dedup import keep_first


def test_keep_first_names_the_row_that_survives(spark):
    rows = [("k", None, "b.csv", "x"), ("k", None, "a.csv", "z"), ("k", None, "a.csv", "y"), ("k", 1, "c.csv", None), (None, None, None, "w")]
    df = spark.createDataFrame(rows, "a string, b int, file string, extra string")
    got = sorted(map(tuple, keep_first(df.repartition(3), ["a", "b"], ["file"], ["extra"]).collect()), key=str)
    assert got == sorted([("k", None, "a.csv", "y", 3), ("k", 1, "c.csv", None, 1), (None, None, None, "w", 1)], key=str)


def test_content_differs_where_counts_agree(spark):
    kind = "file string, a string, b string"
    left = [("same", "x", "y"), ("same", "x", "y"), ("same", None, "n"), ("swapped", "x", "y"), ("moved null", None, "v"),
            ("copies", "x", "x"), ("copies", "x", "x"), ("copies", "z", "z"), ("gone", "x", "y"), (None, "x", "y")]
    right = [("same", None, "n"), ("same", "x", "y"), ("same", "x", "y"), ("swapped", "y", "x"), ("moved null", "v", None),
             ("copies", "x", "x"), ("copies", "z", "z"), ("copies", "z", "z"), ("new", "x", "y"), (None, "x", "y")]
    out = reconcile(spark.createDataFrame(left, kind).repartition(3), spark.createDataFrame(right, kind), "file", ["a", "b"], ("old", "new"))
    got = {r.file: (r.old_rows, r.new_rows, r.content_equal) for r in out.collect()}
    assert got == {"same": (3, 3, True), "swapped": (1, 1, False), "moved null": (1, 1, False), "copies": (3, 3, False),
                   "gone": (1, 0, False), "new": (0, 1, False), None: (1, 1, True)}


def test_rule_combinations(spark):
    df = spark.createDataFrame([(1, "f"), (5, "f"), (None, "g"), (5, None), (5, "f")], "v int, file string")
    rules = [Rule("small", F.col("v") < 3), Rule("known", F.col("v").isNotNull())]
    out = rule_patterns(df, rules, {"file": F.col("file"), "odd": F.col("v") % 2 == 1})
    got = {(r.level, r.file, r.odd, r.mask): (r.rules, r.flights) for r in out.collect()}
    assert got == {
        ("all", None, None, 0): ("", 1), ("all", None, None, 1): ("small", 3), ("all", None, None, 3): ("small | known", 1),
        ("file", "f", None, 0): ("", 1), ("file", "f", None, 1): ("small", 2), ("file", "g", None, 3): ("small | known", 1),
        ("file", None, None, 1): ("small", 1), ("odd", None, True, 0): ("", 1), ("odd", None, True, 1): ("small", 3),
        ("odd", None, None, 3): ("small | known", 1)}
