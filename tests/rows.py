"""Invented flights and registries for small tests.

``leg(...)`` is a flight as a dict by silver column name. Times are minutes
after ``START`` (ints or floats), or raw text as it would stand in the file.
``lake(spark, legs)`` is the lake over them; ``cases(df)`` maps the flight
number, which tests use as the name of the case, to its row.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from opslake import spec
from opslake.plans.lakehouse import Lakehouse, Sources
from opslake.sources.seeds import operation_codes

START = datetime(2031, 3, 10, 6, 0)   # a Monday
LANDED = datetime(2031, 4, 1)

PLAIN = dict(icao_airline="VCA", flight_number="plain", di_code="0", line_type_code="N", icao_origin="SBAA",
             icao_destination="SBBB", scheduled_departure=0, actual_departure=4, scheduled_arrival=90,
             actual_arrival=92, flight_status=spec.STATUS_COMPLETED, justification_code="N/A", _file="a.csv")

# (code, legal name, status, registry file)
CARRIERS = [("VCA", "VOO CASCATA", "ATIVA", spec.NATIONAL_AIRLINES_FILE),
            ("DUO", "DUO ANTES", "INATIVA", spec.NATIONAL_AIRLINES_FILE),
            ("DUO", "DUO DEPOIS", "ATIVA", spec.NATIONAL_AIRLINES_FILE),
            ("XAL", "EXTRA AIR", "ATIVA", spec.FOREIGN_AIRLINES_FILE)]
# (code, name, municipality, state, altitude)
SITES = [("SBAA", "CAMPO ALFA", "Vila Alfa", "Norte", "12,5"), ("SBBB", "CAMPO BETA", "Vila Beta", "Sul", "2.000,5"),
         ("SNCC", "CAMPO GAMA", None, "Sul", "7"), ("", "SEM CODIGO", "Nada", "Nada", "0")]


def leg(**changes) -> dict:
    return PLAIN | changes


def _text(value) -> str | None:
    return str(START + timedelta(minutes=value)) if isinstance(value, (int, float)) else value


def sources(spark: SparkSession, legs: list[dict]) -> Sources:
    raw = [raw for raw, _ in spec.FLIGHT_SOURCE_COLUMNS]
    data = [[_text(x[name]) for _, name in spec.FLIGHT_SOURCE_COLUMNS] + [None, x["_file"], LANDED] for x in legs]
    schema = ", ".join(f"`{c}` string" for c in [*raw, spec.COL_RESCUED, spec.COL_SOURCE_FILE])
    flights = spark.createDataFrame(data, f"{schema}, `{spec.COL_INGESTED}` timestamp")

    def registry(columns: list[str], rows: list[dict], **extra) -> DataFrame:
        df = spark.createDataFrame([[r.get(c) for c in columns] for r in rows], ", ".join(f"{c} string" for c in columns))
        return df.withColumns({k: F.lit(v) for k, v in extra.items()} | {spec.COL_INGESTED: F.lit(LANDED)})

    airline_columns = [name for _, name in spec.AIRLINE_SOURCE_COLUMNS]
    site_columns = [name for _, name in spec.AERODROME_SOURCE_COLUMNS]
    return Sources(
        flights=flights,
        airline_registries={
            file: registry(airline_columns, [dict(icao=code, legal_name=name, status=status)
                                             for code, name, status, f in CARRIERS if f == file],
                           **{spec.COL_SOURCE_FILE: file})
            for file in (spec.NATIONAL_AIRLINES_FILE, spec.FOREIGN_AIRLINES_FILE)},
        aerodromes=registry(site_columns, [
            dict(icao=code, name=name, municipality=town, state=state, altitude=altitude)
            for code, name, town, state, altitude in SITES]),
        codes=operation_codes(spark),
    )


def lake(spark: SparkSession, legs: list[dict]) -> Lakehouse:
    return Lakehouse(sources(spark, legs))


def named(**by_name: dict) -> list[dict]:
    """A leg per case: its name becomes the flight number."""
    return [leg(**changes, flight_number=name) for name, changes in by_name.items()]


def cases(df: DataFrame) -> dict[str, Row]:
    return {r.flight_number: r for r in df.collect()}
