"""Full refresh end to end: publish, read back, gate."""

import tempfile

import pytest

from opslake.operators.publish import read_published
from opslake.plans import gate
from opslake.plans.lakehouse import Lakehouse, from_driver_tables
from opslake.plans.pipeline import published_lakehouse, run_full_refresh
from rows import leg, sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    root = tempfile.mkdtemp(prefix="opslake-test-")
    lh = from_driver_tables(spark, SF)
    return lh, run_full_refresh(spark, lh.sources, root)


def test_every_layer_is_published_with_observed_counts(spark, run):
    lh, res = run
    for name, p in res.tables.items():
        assert read_published(spark, res.root, name).count() == p.rows, name
    assert res.tables["silver.vra"].rows == res.tables["bronze.vra"].rows
    assert res.tables["gold.obt_flights"].rows == res.tables["gold.fact_flights"].rows


def test_contract_metrics_ride_on_the_quarantine_write(spark, run):
    lh, res = run
    expected = lh.contract_metrics.first().asDict()
    assert res.contract == expected
    assert res.tables["silver.vra_quarentena"].rows == expected["quarantined"]


def test_gate_passes_on_a_good_load(run):
    _, res = run
    assert res.gate and all(r[2] for r in res.gate)


def test_published_tables_equal_the_lazy_layers(spark, run):
    lh, res = run
    pub = published_lakehouse(spark, lh.sources, res.root)
    cols = [c for c in pub.obt.columns if not c.startswith("_")]
    a, b = pub.obt.select(*cols), lh.obt.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerun_is_idempotent(spark, run):
    lh, res = run
    again = run_full_refresh(spark, lh.sources, res.root, run_gate=False)
    assert {k: p.rows for k, p in again.tables.items()} == {k: p.rows for k, p in res.tables.items()}


def test_gate_fails_on_a_perfectly_clean_load(spark):
    """A load with no quarantined row breaks 'quarantine is diagnostic' (0 < q)."""
    lh = Lakehouse(sources(spark, [leg()]))
    with pytest.raises(gate.GateFailed, match="quarantine_is_diagnostic"):
        gate.run_gate(lh)


def test_gate_reports_orphan_origins(spark):
    lh = Lakehouse(sources(spark, [leg(), leg(icao_destination="KZZZ")]))
    # a dimension that lost a row must fail the origin check
    broken = Lakehouse(lh.sources, published={"gold.dim_airport": lh.dim_airport.where("icao_airport <> 'SBAA'")})
    results = {r.check_name: r for r in gate.gate_results(broken).collect()}
    assert results["origin_airports_in_dim"].passed is False
    assert results["origin_airports_in_dim"].observed == 2


def test_published_tables_answer_plain_sql(spark):
    root = tempfile.mkdtemp(prefix="opslake-sql-")
    lh = from_driver_tables(spark, SF)
    run_full_refresh(spark, lh.sources, root, run_gate=False, catalog=True)
    n = spark.sql("SELECT COUNT(*) AS n FROM gold.obt_flights").first().n
    assert n == lh.fact.count()
    got = spark.sql("""
        SELECT airline_name, COUNT(*) AS flights,
               SUM(CAST(departure_punctual AS INT)) * 100.0 / COUNT(*) AS dep_on_time_pct
        FROM gold.obt_flights WHERE flight_status = 'REALIZADO'
        GROUP BY airline_name ORDER BY dep_on_time_pct DESC""").count()
    assert got > 0
    # a second run overwrites and the catalog sees the new files
    run_full_refresh(spark, lh.sources, root, run_gate=False, catalog=True)
    assert spark.sql("SELECT COUNT(*) AS n FROM gold.obt_flights").first().n == n


def test_parse_losses_are_observed_on_the_bronze_write(spark, run):
    lh, res = run
    names = {f"{c}_unparsable" for c in ["scheduled_departure", "actual_departure", "scheduled_arrival",
                                         "actual_arrival"]}
    got = res.parse_losses
    assert got["scheduled_departure_unparsable"] == 0 and got["actual_arrival_unparsable"] == 0
    # the projection writes 'bad-ts' for every part key divisible by 37
    bad = lh.silver_flights.sparkSession.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where(
        "l_partkey % 37 = 0").count()
    dupes = lh.silver_flights.sparkSession.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where(
        "l_partkey % 37 = 0 AND l_orderkey % 100 = 0").count()
    assert got["scheduled_arrival_unparsable"] == bad + dupes
    assert set(got) == names


def test_range_layout_gives_disjoint_sorted_files(spark):
    import glob
    import pyarrow.parquet as pq
    from opslake import spec
    from opslake.operators.publish import publish
    root = tempfile.mkdtemp(prefix="opslake-range-")
    lh = from_driver_tables(spark, SF)
    lead, split = spec.LAYOUT["gold.fact_flights"]
    p = publish(lh.fact, root, "gold.fact_flights", cluster_by=lead + split, mode="range",
                columns=spec.FACT_COLUMNS, partitions=4)
    assert p.rows == lh.fact.count()
    ranges = []
    for f in sorted(glob.glob(f"{p.path}/*.parquet")):
        col = pq.read_table(f, columns=["scheduled_departure_date"]).column(0).to_pylist()
        vals = [v for v in col if v is not None]
        if vals:
            assert vals == sorted(vals)            # sorted within the file
            ranges.append((min(vals), max(vals)))
    ranges.sort()
    for (lo1, hi1), (lo2, hi2) in zip(ranges, ranges[1:]):
        assert hi1 <= lo2                          # files hold disjoint date ranges


def test_column_profile_with_sketch(spark):
    from opslake.operators.profile import column_profile
    lh = from_driver_tables(spark, SF)
    prof = {r.column_name: r for r in column_profile(lh.fact.select("flight_status", "departure_delay_min"),
                                                     distinct=True).collect()}
    assert prof["flight_status"].approx_distinct == 2    # CANCELADO, REALIZADO (NULL not counted)
    assert prof["departure_delay_min"].null_count > 0


def test_a_failing_write_leaves_the_old_table(spark):
    from pyspark.sql import functions as F
    from opslake.operators.publish import publish, versions
    root = tempfile.mkdtemp(prefix="opslake-versions-")
    for n in (5, 6, 7):
        publish(spark.range(n), root, "gold.t")
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, root, "gold.t")
    assert read_published(spark, root, "gold.t").count() == 7
    assert len(versions(spark, root, "gold.t")) == 2      # the current and the previous one


def test_a_date_filter_reads_few_files(spark):
    from opslake import spec
    from opslake.operators.publish import publish
    root = tempfile.mkdtemp(prefix="opslake-skip-")
    fact = from_driver_tables(spark, SF).fact
    lead, split = spec.LAYOUT["gold.fact_flights"]
    publish(fact, root, "gold.fact_flights", cluster_by=lead + split, partitions=8)
    table = read_published(spark, root, "gold.fact_flights")
    first = table.agg({"scheduled_departure_date": "min"}).first()[0]
    from pyspark.sql import functions as F
    month = table.where(F.col("scheduled_departure_date").between(first, F.date_add(F.lit(first), 30)))
    assert len(table.inputFiles()) == 8
    assert month.select(F.input_file_name()).distinct().count() <= 2


def test_a_filter_on_any_curve_column_reads_few_files(spark, tmp_path):
    """Along the curve, a date, an airline or a scope opens fewer than half the files; the rows stay."""
    from pyspark.sql import functions as F
    from opslake import spec
    from opslake.operators.publish import publish
    obt = from_driver_tables(spark, SF).obt
    lead, split = spec.LAYOUT["gold.obt_flights"]
    table = {}
    for mode in ("curve", "range"):
        publish(obt, f"{tmp_path}/{mode}", "gold.obt_flights", cluster_by=lead + split, curve_by=lead, partitions=64, mode=mode)
        table[mode] = read_published(spark, f"{tmp_path}/{mode}", "gold.obt_flights")
    assert table["curve"].columns == table["range"].columns
    curve, plain = (df.drop("_processed_at") for df in table.values())          # the time of the run
    assert curve.exceptAll(plain).isEmpty() and plain.exceptAll(curve).isEmpty()

    def opened(df, column, low, high):
        """Files whose minimum and maximum of the column allow a row of the filter, and all."""
        ends = df.groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        return sum(e.lo is not None and e.lo <= high and e.hi >= low for e in ends), len(ends)

    wide = {}
    for column in lead:
        values = [r[0] for r in table["curve"].where(F.col(column).isNotNull()).groupBy(column).count().orderBy("count", column).collect()]
        rare = values[len(values) // 2]
        wide[column] = {mode: opened(df, column, rare, rare) for mode, df in table.items()}
        some, every = wide[column]["curve"]
        assert every > 32 and some < every / 2, (column, wide[column])
    assert wide["airline_name"]["curve"][0] < wide["airline_name"]["range"][0]


def test_curve_of_nulls_one_value_and_no_rows(spark):
    from opslake.operators.curve import curve_key, cut_points
    df = spark.createDataFrame([(None, "a"), (1, "a"), (2, None), (3, "a")], "x int, y string")
    cuts = cut_points(df, ["x", "y"])
    assert cuts == {"x": [(1, 10), (2, 11)], "y": []}
    # Bits of 0, 10 and 21 at every second place, the ones of the other column between them.
    assert [r[0] for r in df.select(curve_key(df, cuts)).collect()] == [0, 0, 0b0010001000, 0b1000100010]
    assert [r[0] for r in df.select(curve_key(df, {"x": cuts["x"]})).collect()] == [0, 0, 10, 21]
    none = df.limit(0)
    assert none.select(curve_key(none, cut_points(none, ["x", "y"]))).collect() == []


@pytest.mark.parametrize("layout", ["curve"])
def test_full_refresh_along_the_curve(spark, run, layout, tmp_path):
    lh, res = run
    other = run_full_refresh(spark, lh.sources, str(tmp_path), layout=layout)
    assert {n: t.rows for n, t in other.tables.items()} == {n: t.rows for n, t in res.tables.items()}


def test_a_failing_landing_or_gate_leaves_every_table(spark, tmp_path):
    """A good load, then one whose landing fails and one whose gate fails: nothing changes."""
    import glob
    from opslake.sources.csv_landing import HeaderMismatch
    root = str(tmp_path)

    def state():
        pub = published_lakehouse(spark, None, root)
        return {n: sorted(map(str, df.collect())) for n, df in pub.published.items()}

    good = sources(spark, [leg(), leg(icao_destination="KZZZ"), leg(icao_airline="ZZZ")])
    run_full_refresh(spark, good, root)
    before, folders = state(), sorted(glob.glob(f"{root}/*/*/version-*"))

    class Bad:
        def verify(self):
            raise HeaderMismatch("two files have one header")

    missing = sources(spark, [leg(icao_airline="YYY")])
    missing.checks.append(Bad())
    with pytest.raises(HeaderMismatch):
        run_full_refresh(spark, missing, root)
    assert state() == before
    with pytest.raises(gate.GateFailed):
        run_full_refresh(spark, sources(spark, [leg()]), root)  # a perfectly clean load fails the gate
    assert state() == before and sorted(glob.glob(f"{root}/*/*/version-*")) == folders


def test_a_commit_switches_all_tables_and_clears_what_is_stale(spark, tmp_path):
    import os
    from opslake.operators.publish import commit, commits, stage, versions
    root = str(tmp_path)
    for n in (1, 2):
        commit(spark, root, [stage(spark.range(n), root, "gold.a"), stage(spark.range(10 * n), root, "gold.b")])
    stage(spark.range(99), root, "gold.a")                                   # a run that ended before its commit
    assert (read_published(spark, root, "gold.a").count(), read_published(spark, root, "gold.b").count()) == (2, 20)
    commit(spark, root, [stage(spark.range(3), root, "gold.a")])             # gold.b stays as it was
    assert (read_published(spark, root, "gold.a").count(), read_published(spark, root, "gold.b").count()) == (3, 20)
    assert [spark.read.parquet(v).count() for v in versions(spark, root, "gold.a")] == [2, 3]
    assert len(os.listdir(f"{root}/commits")) == 2 and len(commits(spark, root, 5)) == 2
