"""Views refreshed by parts equal the reports over whole tables."""

import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from opslake import spec
from opslake.operators import partials
from opslake.operators.publish import read_published
from opslake.plans import reports, views
from opslake.plans.lakehouse import Sources
from opslake.plans.pipeline import published_lakehouse
from opslake.sources.csv_landing import UTF8_QUOTED, csv_sources, read_lines
from opslake.streaming import incremental
from test_csv_landing import FLIGHT_HEADER, _row, _write, files  # noqa: F401  (fixture)


def _rows(df):
    return sorted(map(str, df.collect()))


def _stamps(root, pattern):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(os.path.join(root, pattern, "*.parquet"))}


def test_views_after_two_batches(spark, files, tmp_path):  # noqa: F811
    vra, ref = files
    root, later = str(tmp_path / "lake"), str(tmp_path / "later.csv")
    flight = ["SBGR", "SBRJ", "2026-10-01 10:00:00", "2026-10-01 10:30:00", "2026-10-01 11:00:00",
              "2026-10-01 11:05:00", "REALIZADO", "N/A"]
    _write(later, ["Atualizado em 01/11/2026", FLIGHT_HEADER, _row("AZU", "9000", "0", "N", *flight),
                   _row("AZU", "9000", "0", "N", *flight), _row("TAM", "9001", "0", "N", *flight[:6], "CANCELADO", "N/A"),
                   _row("AZU", "3003", "0", "N", "SBGR", "SBRJ", "null", "null", "null", "null", "CANCELADO", "N/A")])
    handler = incremental.IncrementalFlights(csv_sources(spark, f"{vra}/*.csv", ref), root)
    handler(read_lines(spark.read.text(f"{vra}/VRA_20268.csv"), UTF8_QUOTED), 0)
    old = {"silver/contract_parts/_batch=0": None, "gold/*_view_parts/_month=202608": None}
    old = {p: _stamps(root, p) for p in old}
    assert all(old.values())
    handler(read_lines(spark.read.text(later), UTF8_QUOTED), 1)
    handler(read_lines(spark.read.text(later), UTF8_QUOTED), 1)  # a replay changes nothing

    # parts of the first batch and of untouched months are not written again
    assert old == {p: _stamps(root, p) for p in old}
    incremental.publish(incremental.Lakehouse(handler.registries).silver_airlines, root, "silver.airlines")
    incremental.publish(incremental.Lakehouse(handler.registries).silver_aerodromes, root, "silver.aerodromes")
    incremental.publish(incremental.Lakehouse(handler.registries).silver_codes, root, "silver.operation_codes")
    lh = published_lakehouse(spark, Sources(None, {}, None, None), root)
    for view, report in zip(views.REPORT_VIEWS, (reports.punctuality_by_airline, reports.top_routes, reports.top_cancellations,
                                                 reports.monthly_trend, reports.hourly_cascade)):
        got, told = incremental.read_view(spark, root, view), report(lh.obt)
        assert _rows(got.select(*told.columns)) == _rows(told), view
        assert all("_view_parts/" in f for f in got.inputFiles())
    got = incremental.read_view(spark, root, "contract_view")
    assert all("/contract_parts/" in f for f in got.inputFiles())
    whole = lh.contract_metrics.first()
    assert whole["quarantined"] > 0
    for total, name in [("rows", "flights"), ("quarantined", "quarantined"), *[(n, n) for n in spec.RULE_NAMES]]:
        assert got.agg(F.sum(f"`{name}`")).first()[0] == whole[total], name
    assert read_published(spark, root, "gold.obt_flights").count() == incremental.read_view(spark, root, "profile_view").first().flights


@pytest.mark.parametrize("sizes", [[1], [5000, 1, 20000], [300] * 20])
def test_sketches_of_parts_are_within_their_error(spark, sizes):
    rng = random.Random(7)
    rows = [(p, f"v{rng.randrange(6000)}", rng.randrange(-500, 5000)) for p, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "part int, name string, delay int")
    measures = [partials.distinct("name", F.col("name")), partials.quantiles("delay", F.col("delay"), [0.1, 0.5, 0.9])]
    got = partials.merged(partials.parts(df, ["part"], [], measures), [], measures).first()
    exact = len({r[1] for r in rows})
    assert abs(got.name - exact) <= 3 * partials.HLL_ERROR * exact
    delays, n = [r[2] for r in rows], len(rows)
    for rank, value in zip([0.1, 0.5, 0.9], got.delay):
        near = 3 * partials.KLL_ERROR
        assert sum(d < value for d in delays) <= (rank + near) * n and sum(d <= value for d in delays) >= (rank - near) * n


def test_parts_of_nulls_and_of_nothing(spark):
    schema = "part int, k string, v int, ok boolean"
    measures = [partials.count("rows"), partials.count("good", F.col("ok")), partials.total("sum", F.col("v")),
                partials.mean("mean", F.col("v")), partials.distinct("names", F.col("v")),
                partials.quantiles("half", F.col("v"), [0.5])]
    df = spark.createDataFrame([(0, None, None, None), (1, None, None, False), (0, "a", 1, True), (1, "a", 4, None),
                                (None, "a", 4, True)], schema)
    got = {r.k: r for r in partials.merged(partials.parts(df, ["part"], ["k"], measures), ["k"], measures).collect()}
    assert tuple(got[None])[1:] == (2, 0, None, None, 0, None)
    assert tuple(got["a"])[1:6] == (3, 2, 9, 3.0, 2) and got["a"].half[0] in (1, 4)
    empty = spark.createDataFrame([], schema)
    assert partials.merged(partials.parts(empty, ["part"], ["k"], measures), ["k"], measures).count() == 0


def test_an_empty_text_is_a_value_of_a_distinct_count(spark):
    rows = spark.createDataFrame([(p, v) for p in (1, 2) for v in ("", "a", "b", None)], "part int, v string")
    measure = [partials.distinct("v", F.col("v"))]
    assert partials.merged(partials.parts(rows, ["part"], [], measure), [], measure).first().v == 3


def test_the_sketch_profile_sorts_no_rows(spark):
    from opslake.plans import catalog
    df = catalog.query("sketch_profile")(spark, "/root/testdata/sf0.001")
    tree = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[icao" in tree and not re.search(r"SortAggregate\(key=\[[^\]]*gid", tree)
