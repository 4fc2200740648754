"""Physical-plan assertions: the shapes we rely on at scale."""

import contextlib
import io
import re

import pytest

from opslake.plans.lakehouse import from_driver_tables
from opslake.plans import catalog, gate, reports

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_fact_has_one_shuffle_and_broadcast_lookups(spark):
    lh = from_driver_tables(spark, SF)
    text = formatted(lh.fact)
    # code tables are broadcast by their known size; the dedup is one hash exchange
    assert text.count("BroadcastExchange") >= 2
    assert "SinglePartition" not in text
    assert "Window" not in text  # dedup is an aggregate, not a window sort


def test_dedup_uses_partial_aggregation(spark):
    lh = from_driver_tables(spark, SF)
    text = formatted(lh.fact)
    # a HashAggregate both below and above the dedup exchange (map-side combine)
    assert text.count("HashAggregate") >= 2


def test_obt_adds_no_shuffle_over_fact(spark):
    lh = from_driver_tables(spark, SF)
    f, o = formatted(lh.fact), formatted(lh.obt)
    shuffles = lambda t: t.count("Exchange hashpartitioning") + t.count("Exchange rangepartitioning")
    assert shuffles(o) == shuffles(f)


def test_scan_is_pruned_and_filters_pushed(spark):
    lh = from_driver_tables(spark, SF)
    text = formatted(lh.bronze_flights)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," in text
    assert "l_extendedprice" not in text
    # a report over published data pushes its filter into the scan
    import tempfile
    from opslake.operators.publish import publish, read_published
    root = tempfile.mkdtemp(prefix="plan-")
    publish(lh.obt, root, "gold.obt_flights")
    obt = read_published(spark, root, "gold.obt_flights")
    text = formatted(reports.punctuality_by_airline(obt))
    assert "PushedFilters: [IsNotNull(flight_status), EqualTo(flight_status,REALIZADO)]" in text
    assert "ReadSchema: struct<airline_name:string,departure_delay_min:int,arrival_delay_min:int," in text


def test_share_of_total_is_a_scalar_subquery_not_a_cross_join(spark):
    lh = from_driver_tables(spark, SF)
    text = formatted(reports.carrier_share(lh.obt))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Subquery" in text


@pytest.mark.parametrize("name", ["punctuality_conflicts", "recovery_analysis", "cascade_view", "hourly_cascade"])
def test_times_are_parsed_once_whatever_filter_looks_at_them(spark, name):
    """Written out at every place the filter names them, they make methods over 8,000 bytes, which the JVM does not compile."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = catalog.query(name)(spark, SF)
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_orphans_by_origin_read_the_dedup_of_all_steps(spark):
    """As many as the anti join finds, with no filter moved below the dedup (whose exchange the gate's counts then share)."""
    lh = from_driver_tables(spark, SF)
    tree = gate._orphans_by_origin(lh.fact, lh.dim_airport)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "o_custkey" in line and "concat" in line for line in tree.splitlines())
    fact = spark.createDataFrame([(v,) for v in ("A", "B", "B", "C", "", None)], "icao_origin string")
    dim = spark.createDataFrame([("A",), ("A",), (None,)], "icao_airport string")
    found = gate._orphans_by_origin(fact, dim).agg({"_n": "sum"}).first()[0]
    assert found == gate.orphan_rows(fact, dim).count() == 3
