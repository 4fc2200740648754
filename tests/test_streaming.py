"""Incremental landing (Structured Streaming) equals a full refresh."""

import os
import shutil
import tempfile

import pytest

from opslake import spec
from opslake.operators.publish import read_published
from opslake.plans import gate, reports
from opslake.plans.lakehouse import Sources
from opslake.plans.pipeline import published_lakehouse, run_full_refresh
from opslake.sources.csv_landing import csv_sources
from opslake.streaming import incremental
from rows import lake, leg, named
from test_csv_landing import files  # noqa: F401  (fixture)


def _same(a, b):
    cols = [c for c in a.columns if not c.startswith("_")]
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_equals_full_refresh(spark, files):  # noqa: F811
    vra, ref = files
    inbox = tempfile.mkdtemp(prefix="opslake-inbox-")
    for f in sorted(os.listdir(vra)):
        shutil.copy(os.path.join(vra, f), inbox)
    src = csv_sources(spark, f"{vra}/*.csv", ref)
    full_root = tempfile.mkdtemp(prefix="opslake-full-")
    run_full_refresh(spark, src, full_root, run_gate=False)

    inc_root = tempfile.mkdtemp(prefix="opslake-inc-")
    q = incremental.start(spark, inbox, src, inc_root, max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    assert q.lastProgress is not None

    for name in ("silver.vra", "gold.fact_flights", "gold.obt_flights", "silver.vra_quarentena", "gold.dim_airport"):
        inc = read_published(spark, inc_root, name)
        full = read_published(spark, full_root, name)
        assert _same(inc, full), name
    # two files, one micro-batch each
    assert read_published(spark, inc_root, "bronze.vra").count() == 10
    assert sorted(r[0] for r in spark.read.parquet(os.path.join(inc_root, "bronze", "vra"))
                  .select("_batch").distinct().collect()) == [0, 1]
    assert spec.REASONS_COLUMN in read_published(spark, inc_root, "silver.vra_quarentena").columns

    # the gate and the reports run over the incremental root; the two layouts refuse each other
    pub = published_lakehouse(spark, Sources(None, {}, None, None), inc_root)
    assert all(r[2] for r in gate.run_gate(pub))
    assert reports.punctuality_by_airline(pub.obt).count() > 0
    with pytest.raises(ValueError, match="root of its own"):
        run_full_refresh(spark, src, inc_root)
    with pytest.raises(ValueError, match="root of its own"):
        incremental.start(spark, inbox, src, full_root)


def test_undated_rows_spread_over_buckets(spark):
    undated = dict.fromkeys(spec.TIMESTAMP_COLUMNS, "null")
    legs = named(**{f"u{i}": undated for i in range(200)}) + [leg(**undated, flight_number="copy")] * 9 + [
        leg(), leg(scheduled_departure="null", flight_number="half")]
    rows = lake(spark, legs).silver_flights.withColumn("m", incremental.month_key()).collect()
    buckets = {r.m for r in rows if r.m < 0}
    assert len(buckets) > 40 and min(buckets) >= -64
    assert {r.m for r in rows if r.flight_number in ("plain", "half")} == {203103}
    assert len({r.m for r in rows if r.flight_number == "copy"}) == 1


def test_replayed_epoch_is_idempotent(spark, files):  # noqa: F811
    vra, ref = files
    src = csv_sources(spark, f"{vra}/*.csv", ref)
    root = tempfile.mkdtemp(prefix="opslake-replay-")
    from opslake.sources.csv_landing import UTF8_QUOTED, read_lines
    batch = read_lines(spark.read.text(f"{vra}/VRA_20268.csv"), UTF8_QUOTED)
    handler = incremental.IncrementalFlights(src, root)
    handler(batch, 7)
    first = read_published(spark, root, "gold.fact_flights").count()
    handler(batch, 7)  # the same epoch again, as after a failure
    assert read_published(spark, root, "gold.fact_flights").count() == first
    assert read_published(spark, root, "silver.vra").count() == 8


def test_a_file_that_fails_leaves_every_table(spark, files, tmp_path):  # noqa: F811
    """A good batch, then a file without a header: bronze and silver stay as they were."""
    from opslake.sources.csv_landing import UTF8_QUOTED, HeaderMismatch, read_lines
    vra, ref = files
    root = str(tmp_path / "lake")
    handler = incremental.IncrementalFlights(csv_sources(spark, f"{vra}/*.csv", ref), root)
    handler(read_lines(spark.read.text(f"{vra}/VRA_20268.csv"), UTF8_QUOTED), 0)
    (tmp_path / "bad.csv").write_text("preamble\nTAM;3000;0\nTAM;3001;0\n")
    with pytest.raises(HeaderMismatch):
        handler(read_lines(spark.read.text(f"{tmp_path}/bad.csv"), UTF8_QUOTED), 1)
    assert read_published(spark, root, "bronze.vra").count() == read_published(spark, root, "silver.vra").count() == 8
