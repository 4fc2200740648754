"""Specifications: every constant of the flight-operations domain lives here.

The operators in ``opslake.operators`` are generic (rules, lookups, keys are
parameters); this module binds them to the flight domain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Source column names of the monthly flight-step CSV, in file order, and the
# snake_case names the silver mirror gives them.
FLIGHT_SOURCE_COLUMNS = [
    ("ICAO Empresa Aérea", "icao_airline"),
    ("Número Voo", "flight_number"),
    ("Código Autorização (DI)", "di_code"),
    ("Código Tipo Linha", "line_type_code"),
    ("ICAO Aeródromo Origem", "icao_origin"),
    ("ICAO Aeródromo Destino", "icao_destination"),
    ("Partida Prevista", "scheduled_departure"),
    ("Partida Real", "actual_departure"),
    ("Chegada Prevista", "scheduled_arrival"),
    ("Chegada Real", "actual_arrival"),
    ("Situação Voo", "flight_status"),
    ("Código Justificativa", "justification_code"),
]

# Aerodrome registry CSV columns (ISO-8859-1, no quoting) and bronze names.
AERODROME_SOURCE_COLUMNS = [
    ("Código OACI", "icao"),
    ("CIAD", "ciad"),
    ("Nome", "name"),
    ("Município", "municipality"),
    ("UF", "state"),
    ("Município Servido", "served_municipality"),
    ("UF Servido", "served_state"),
    ("Latitude", "latitude"),
    ("Longitude", "longitude"),
    ("Altitude", "altitude"),
    ("Situação", "status"),
]

# Airline registry CSV columns (UTF-8, '"' quoting) and bronze names.
AIRLINE_SOURCE_COLUMNS = [
    ("ICAO", "icao"),
    ("Estrangeira", "iata_code"),
    ("Razao", "legal_name"),
    ("Servico", "service"),
    ("Cidade", "city"),
    ("UF", "state"),
    ("Ativa", "status"),
]

NATIONAL_AIRLINES_FILE = "pda_empresas_aereas_nacionais.csv"
FOREIGN_AIRLINES_FILE = "pda_empresas_aereas_estrangeiros.csv"
REGISTRY_NATIONAL = "national"
REGISTRY_FOREIGN = "foreign"

# Operation-code seed (domain, code, description). Code '1' is deliberately absent.
OPERATION_CODES = [
    ("di_code", "0", "Etapa Regular"),
    ("di_code", "2", "Etapa Extra"),
    ("di_code", "3", "Etapa de Retorno"),
    ("di_code", "4", "Inclusão de Etapa"),
    ("di_code", "6", "Etapa Não Remunerada Sem Transporte de Objetos"),
    ("di_code", "7", "Etapa de Voo de Fretamento"),
    ("di_code", "9", "Etapa de Voo Charter"),
    ("di_code", "D", "Etapa de Voo Duplicada"),
    ("di_code", "E", "Etapa Não Remunerada Com Transporte de Objetos"),
    ("line_type_code", "N", "Doméstica Mista"),
    ("line_type_code", "C", "Doméstica Cargueira"),
    ("line_type_code", "I", "Internacional Mista"),
    ("line_type_code", "G", "Internacional Cargueira"),
]
DOMAIN_DI = "di_code"
DOMAIN_LINE_TYPE = "line_type_code"

# Text markers in the raw flight file.
NULL_LITERAL = "null"
NOT_APPLICABLE = "N/A"

# Flight status values.
STATUS_COMPLETED = "REALIZADO"
STATUS_CANCELLED = "CANCELADO"
KNOWN_STATUSES = (STATUS_COMPLETED, STATUS_CANCELLED)

# Registry status that wins when an airline code has several records.
AIRLINE_ACTIVE = "ATIVA"

# Plausible delay window in minutes (inclusive) and the punctuality threshold.
DELAY_MIN = -120
DELAY_MAX = 1440
PUNCTUAL_MAX = 15

# Flight scope from the line-type code.
DOMESTIC_LINE_TYPES = ("N", "C")
INTERNATIONAL_LINE_TYPES = ("I", "G")
SCOPE_DOMESTIC = "Domestico"
SCOPE_INTERNATIONAL = "Internacional"
SCOPE_UNCLASSIFIED = "Nao classificado"

# Airport country by ICAO prefix.
BRAZIL_ICAO_PATTERN = "^S[BDIJNSW]"
COUNTRY_BRAZIL = "Brasil"
COUNTRY_ABROAD = "Exterior"

# Fallback labels: prefix + code + suffix.
AIRLINE_FALLBACK = ("COMPANHIA NAO CADASTRADA (", ")")
CODE_FALLBACK = ("Codigo nao catalogado (", ")")
AIRPORT_FALLBACK = ("AEROPORTO FORA DO CADASTRO ANAC (", ")")

# Weekday names, Spark dayofweek 1 = Sunday ... 7 = Saturday.
WEEKDAYS = ["domingo", "segunda", "terca", "quarta", "quinta", "sexta", "sabado"]

# Separator of the quarantine reason list.
REASON_SEPARATOR = " | "

# Data-contract rule names, in rule order.
RULE_NAMES = [
    "horarios_previstos_presentes",
    "situacao_voo_conhecida",
    "chegada_prevista_depois_da_partida_prevista",
    "chegada_real_depois_da_partida_real",
    "atraso_partida_plausivel",
    "atraso_chegada_plausivel",
    "empresa_no_cadastro_anac",
    "aeroporto_origem_no_cadastro_anac",
    "aeroporto_destino_no_cadastro_anac",
]

# Membership flag column names added by the contract's mark step.
FLAG_ORIGIN = "origem_no_cadastro"
FLAG_DESTINATION = "destino_no_cadastro"
FLAG_AIRLINE = "empresa_no_cadastro"
REASONS_COLUMN = "motivos_quarentena"

# Audit columns (current_timestamp-valued; never part of a compared result).
COL_INGESTED = "_ingerido_em"
COL_SOURCE_FILE = "_arquivo_origem"
COL_RESCUED = "_rescued_data"
COL_TRANSFORMED = "_transformed_at"
COL_PROCESSED = "_processed_at"
COL_QUARANTINED = "_quarentenado_em"
AUDIT_COLUMNS = (COL_INGESTED, COL_TRANSFORMED, COL_PROCESSED, COL_QUARANTINED)

# Exact-duplicate grain of a flight step.
DEDUP_KEYS = [
    "icao_airline", "flight_number", "di_code", "line_type_code", "icao_origin",
    "icao_destination", "scheduled_departure", "actual_departure", "scheduled_arrival",
    "actual_arrival", "flight_status",
]

# The four timestamp columns and the prefix of their derived date/time columns.
TIMESTAMP_COLUMNS = ["scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival"]

# Output column orders (table contracts): fixed values as well.

SILVER_VRA_COLUMNS = [
    "icao_airline", "flight_number", "di_code", "line_type_code", "icao_origin", "icao_destination",
    "scheduled_departure", "scheduled_departure_date", "scheduled_departure_time",
    "actual_departure", "actual_departure_date", "actual_departure_time",
    "scheduled_arrival", "scheduled_arrival_date", "scheduled_arrival_time",
    "actual_arrival", "actual_arrival_date", "actual_arrival_time",
    "flight_status", "justification_code",
    "departure_delay_min", "arrival_delay_min", "minutes_recovered",
    COL_SOURCE_FILE, COL_INGESTED, COL_TRANSFORMED,
]

SILVER_AIRLINE_COLUMNS = [
    "icao", "iata_code", "legal_name", "service", "city", "state", "status", "registry_origin",
    COL_SOURCE_FILE, COL_INGESTED, COL_TRANSFORMED,
]

SILVER_AERODROME_COLUMNS = [
    "icao", "ciad", "name", "municipality", "state_name", "served_municipality", "served_state_name",
    "latitude_dms", "longitude_dms", "altitude_m", "status", COL_INGESTED, COL_TRANSFORMED,
]

DIM_AIRPORT_COLUMNS = [
    "icao_airport", "airport_name", "airport_municipality", "airport_state", "airport_country",
    "in_anac_registry", COL_PROCESSED,
]

FACT_COLUMNS = [
    "icao_airline", "airline_name", "airline_registry", "flight_number",
    "di_code", "di_description", "line_type_code", "line_type_description", "flight_scope",
    "icao_origin", "icao_destination", "route",
    "scheduled_departure", "scheduled_departure_date", "scheduled_departure_time",
    "scheduled_departure_hour", "day_of_week", "reference_month",
    "actual_departure", "scheduled_arrival", "actual_arrival",
    "departure_delay_min", "arrival_delay_min", "minutes_recovered", "delay_out_of_range",
    "departure_punctual", "arrival_punctual",
    "flight_status", "flight_cancelled", "flight_completed", COL_PROCESSED,
]

OBT_COLUMNS = [
    "icao_airline", "airline_name", "flight_number",
    "di_code", "di_description", "line_type_code", "line_type_description", "flight_scope",
    "icao_origin", "origin_airport_name", "origin_municipality", "origin_state", "origin_country",
    "icao_destination", "destination_airport_name", "destination_municipality",
    "destination_state", "destination_country",
    "route_icao", "route_municipalities",
    "scheduled_departure", "scheduled_departure_date", "scheduled_departure_time",
    "scheduled_departure_hour", "day_of_week", "reference_month",
    "actual_departure", "scheduled_arrival", "actual_arrival",
    "departure_delay_min", "arrival_delay_min", "minutes_recovered", "delay_out_of_range",
    "departure_punctual", "arrival_punctual",
    "flight_status", "flight_completed", "flight_cancelled", COL_PROCESSED,
]

# ---------------------------------------------------------------------------
# Our own settings from here on.
# ---------------------------------------------------------------------------

# Physical layout of published tables: (clustering columns of the reference,
# extra columns that split hot values). A local sort uses the clustering
# columns only; a range layout uses both, so one airline or one day cannot
# become one giant file.
LAYOUT = {
    "silver.vra": (["scheduled_departure"], ["icao_airline", "flight_number"]),
    "gold.fact_flights": (["scheduled_departure_date", "airline_name"], ["flight_number", "scheduled_departure"]),
    "gold.obt_flights": (["scheduled_departure_date", "airline_name", "flight_scope"],
                         ["flight_number", "scheduled_departure"]),
}


@dataclass(frozen=True)
class Lookup:
    """A code → description lookup with a fallback label for unknown codes."""

    domain: str
    code_column: str
    output_column: str
    fallback: tuple[str, str] = CODE_FALLBACK


@dataclass(frozen=True)
class FlightSpec:
    """Binds the generic operators to the flight-step table."""

    dedup_keys: list[str] = field(default_factory=lambda: list(DEDUP_KEYS))
    delay_min: int = DELAY_MIN
    delay_max: int = DELAY_MAX
    punctual_max: int = PUNCTUAL_MAX
    lookups: tuple[Lookup, ...] = (
        Lookup(DOMAIN_DI, "di_code", "di_description"),
        Lookup(DOMAIN_LINE_TYPE, "line_type_code", "line_type_description"),
    )


FLIGHTS = FlightSpec()
