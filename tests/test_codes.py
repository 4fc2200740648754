"""Airline codes and report order."""

from pyspark.sql import functions as F

from opslake.plans import reports
from opslake.sources.opsdata import airline_code


def test_long_supplier_keys_keep_their_own_codes(spark):
    keys = [7, 9_999, 10_000, 123_450, 123_459]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select(airline_code(F.col("k")).alias("code"))
    assert [r.code for r in df.collect()] == ["A0007", "A9999", "A10000", "A123450", "A123459"]


def test_reports_come_sorted(spark):
    rows = [("B", "x", 5, 1, 2, True), ("A", "x", 6, 1, 2, True), ("C", "x", None, 1, 2, False), (None, "x", 5, 1, 2, True)]
    obt = spark.createDataFrame(
        [(a, reports.spec.STATUS_COMPLETED, h, d, r, p) for a, _, h, d, r, p in rows],
        "airline_name string, flight_status string, scheduled_departure_hour int, departure_delay_min int, "
        "arrival_delay_min int, departure_punctual boolean")
    assert [r.airline_name for r in reports.punctuality_by_airline(obt).collect()] == [None, "A", "B", "C"]
    assert [r.scheduled_departure_hour for r in reports.hourly_cascade(obt).collect()] == [None, 5, 6]
