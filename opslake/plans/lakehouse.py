"""The layer graph: bronze sources → silver → contract → gold, all lazy.

``Lakehouse`` only composes DataFrames; nothing runs until a consumer acts
(a report, the gate, or ``publish``). When the layers are published, the next
layer reads the *written* table instead of recomputing its inputs (see
``opslake.plans.pipeline``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from opslake import spec
from opslake.operators.contract import audit, quarantine
from opslake.plans import gold, silver


@dataclass
class Sources:
    """Bronze inputs."""

    flights: DataFrame
    airline_registries: dict[str, DataFrame]
    aerodromes: DataFrame
    codes: DataFrame
    checks: list = field(default_factory=list)  # landing checks to verify once bronze is written


@dataclass
class Lakehouse:
    sources: Sources
    flight_spec: spec.FlightSpec = field(default_factory=spec.FlightSpec)
    # Published layers that replace the lazy ones (name → DataFrame read back).
    published: dict[str, DataFrame] = field(default_factory=dict)

    def _get(self, name: str, build):
        return self.published[name] if name in self.published else build()

    # ---------------------------------------------------------------- bronze
    @property
    def bronze_flights(self) -> DataFrame:
        return self._get("bronze.vra", lambda: self.sources.flights)

    # ---------------------------------------------------------------- silver
    @cached_property
    def silver_flights(self) -> DataFrame:
        return self._get("silver.vra", lambda: silver.silver_flights(self.bronze_flights))

    @cached_property
    def silver_airlines(self) -> DataFrame:
        return self._get("silver.airlines", lambda: silver.silver_airlines(self.sources.airline_registries))

    @cached_property
    def silver_aerodromes(self) -> DataFrame:
        return self._get("silver.aerodromes", lambda: silver.silver_aerodromes(self.sources.aerodromes))

    @cached_property
    def silver_codes(self) -> DataFrame:
        return self._get("silver.operation_codes", lambda: silver.silver_codes(self.sources.codes))

    # -------------------------------------------------------------- contract
    @cached_property
    def rules(self):
        return silver.flight_rules(self.flight_spec)

    @cached_property
    def marked(self) -> DataFrame:
        return silver.mark_flights(self.silver_flights, self.silver_aerodromes, self.silver_airlines)

    @cached_property
    def contract_metrics(self) -> DataFrame:
        return audit(self.marked, self.rules)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._get("silver.vra_quarentena", lambda: quarantine(
            self.marked, self.rules, spec.REASONS_COLUMN, spec.REASON_SEPARATOR, spec.COL_QUARANTINED))

    # ------------------------------------------------------------------ gold
    @cached_property
    def best_airline(self) -> DataFrame:
        return gold.best_airline(self.silver_airlines)

    @cached_property
    def best_aerodrome(self) -> DataFrame:
        return gold.best_aerodrome(self.silver_aerodromes)

    @cached_property
    def dim_airport(self) -> DataFrame:
        return self._get("gold.dim_airport", lambda: gold.dim_airport(
            self.silver_flights, self.best_aerodrome))

    @cached_property
    def fact(self) -> DataFrame:
        return self._get("gold.fact_flights", lambda: gold.fact_flights(
            self.silver_flights, self.best_airline, self.silver_codes, self.flight_spec))

    @cached_property
    def obt(self) -> DataFrame:
        return self._get("gold.obt_flights", lambda: gold.obt_flights(
            self.fact, self.best_aerodrome))


def from_driver_tables(spark: SparkSession, root: str) -> Lakehouse:
    """Lakehouse over the flight-shaped projection of the driver tables."""
    from opslake.sources import opsdata, seeds

    return Lakehouse(Sources(
        flights=opsdata.bronze_flights(spark, root),
        airline_registries=opsdata.bronze_airline_registries(spark, root),
        aerodromes=opsdata.bronze_aerodromes(spark, root),
        codes=seeds.operation_codes(spark),
    ))
