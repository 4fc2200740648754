"""CSV landing on generated files (UTF-8 quoted and Latin-1 unquoted)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from opslake import spec
from opslake.plans.pipeline import run_full_refresh
from opslake.sources.csv_landing import HeaderMismatch, csv_sources, land_aerodromes, land_flights

FLIGHT_HEADER = ";".join(raw for raw, _ in spec.FLIGHT_SOURCE_COLUMNS)


def _write(path, lines, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="\n") as f:
        f.write("\n".join(lines) + "\n")


def _row(*fields):
    return ";".join(fields)


@pytest.fixture(scope="module")
def files():
    d = tempfile.mkdtemp(prefix="opslake-csv-")
    vra, ref = os.path.join(d, "VRA"), os.path.join(d, "references")
    os.makedirs(vra)
    os.makedirs(ref)
    base = ["SBGR", "SBRJ", "2026-08-01 10:00:00", "2026-08-01 10:10:00", "2026-08-01 11:00:00",
            "2026-08-01 11:05:00", "REALIZADO", "N/A"]
    _write(os.path.join(vra, "VRA_20268.csv"), [
        "Atualizado em 01/09/2026",
        FLIGHT_HEADER,
        _row("TAM", "3000", "0", "N", *base),                                   # normal
        _row("TAM", '"30;01"', "0", "N", *base),                                # quoted separator
        _row("TAM", '"30""02"', "0", "N", *base),                               # doubled quotes
        _row("AZU", "3003", "0", "N", "SBGR", "SBRJ", "null", "null", "null", "null", "CANCELADO", "N/A"),
        _row("AZU", "3004", "0", "N", "SBGR", "SBRJ", "01/08/2026 10:00", "2026-08-01 10:10:00",
             "2026-08-01 11:00:00", "2026-08-01 11:05:00", "REALIZADO", "N/A"),  # unparsable time
        _row("GLO", "3005", "0", "N", *base, "EXTRA"),                          # too many fields
        _row("GLO", "3006", "0", "N", "SBGR"),                                  # too few fields
        _row("TAM", "3007", "0", "N", "SBGR", "KJFK", *base[2:6], "REALIZADO", "Justificação"),  # accents
    ])
    _write(os.path.join(vra, "VRA_20269.csv"), [
        "Atualizado em 01/10/2026",
        FLIGHT_HEADER,
        _row("TAM", "3000", "0", "N", *base),
        _row("TAM", "3000", "0", "N", *base),                                   # exact duplicate
    ])
    aero_header = ";".join(raw for raw, _ in spec.AERODROME_SOURCE_COLUMNS)
    _write(os.path.join(ref, "AerodromosPublicos.csv"), [
        "Cadastro de aeródromos públicos",
        aero_header,
        "SBGR;SP0002;GUARULHOS;Guarulhos;São Paulo;São Paulo;São Paulo;23° 26' S;46° 28' W;760,5;Operacional",
        "SBRJ;RJ0001;SANTOS \"DUMONT;Rio de Janeiro;Rio de Janeiro;Rio de Janeiro;Rio de Janeiro;22° S;43° W;"
        "1.234,5;Operacional",
    ], encoding="latin-1")
    air_header = ";".join(raw for raw, _ in spec.AIRLINE_SOURCE_COLUMNS)
    _write(os.path.join(ref, spec.NATIONAL_AIRLINES_FILE), [
        "Empresas nacionais", air_header,
        'TAM;JJ;"TAM LINHAS AEREAS; S.A.";REGULAR;SAO PAULO;SP;ATIVA',
        "AZU;AD;AZUL LINHAS AEREAS;REGULAR;BARUERI;SP;ATIVA",
    ])
    _write(os.path.join(ref, spec.FOREIGN_AIRLINES_FILE), [
        "Empresas estrangeiras", air_header,
        "AAL;AA;AMERICAN AIRLINES;REGULAR;DALLAS;;ATIVA",
    ])
    return vra, ref


def test_flight_files_land_every_data_row(spark, files):
    vra, _ = files
    df = land_flights(spark, f"{vra}/*.csv")
    rows = df.collect()
    assert len(rows) == 10                       # 8 + 2 data rows; preambles and headers dropped
    by_number = {r["Número Voo"]: r for r in rows}
    assert "30;01" in by_number                  # quoted separator kept in the value
    assert '30"02' in by_number                  # doubled quote unescaped
    assert by_number["3007"]["Código Justificativa"] == "Justificação"
    assert by_number["3003"]["Partida Prevista"] == "null"
    assert {r[spec.COL_SOURCE_FILE] for r in rows} == {"VRA_20268.csv", "VRA_20269.csv"}


def test_malformed_rows_are_rescued_not_dropped(spark, files):
    vra, _ = files
    df = land_flights(spark, f"{vra}/*.csv").where(F.col(spec.COL_RESCUED).isNotNull())
    got = {r["Número Voo"]: r for r in df.collect()}
    assert set(got) == {"3005", "3006"}
    assert got["3005"]["Código Justificativa"] == "N/A"      # leading values kept
    assert json.loads(got["3005"][spec.COL_RESCUED]) == {"_c12": "EXTRA", "_file": "VRA_20268.csv"}
    assert json.loads(got["3006"][spec.COL_RESCUED]) == {"_fields": "5", "_file": "VRA_20268.csv"}
    assert got["3006"]["ICAO Aeródromo Origem"] == "SBGR"
    assert got["3006"]["Partida Prevista"] is None


def test_latin1_unquoted_registry(spark, files):
    _, ref = files
    df = land_aerodromes(spark, f"{ref}/AerodromosPublicos.csv")
    rows = {r.icao: r for r in df.collect()}
    assert set(rows) == {"SBGR", "SBRJ"}
    assert rows["SBGR"].state == "São Paulo"
    assert rows["SBRJ"].name == 'SANTOS "DUMONT'   # unbalanced quote is plain text
    assert rows["SBRJ"].altitude == "1.234,5"


GOOD = FLIGHT_HEADER.split(";")
ROW = ";".join(f"v{i}" for i in range(len(GOOD)))
VALUES = {h: f"v{i}" for i, h in enumerate(GOOD)}
# Header and one row of the same values -> columns that are null, what is rescued.
ORDERS = {
    "as known": (GOOD, [], {}),
    "reversed": (GOOD[::-1], [], {}),
    "added": ([*GOOD[:3], "Other", *GOOD[3:], "Last"], [], {"Other": "more", "Last": "more"}),
    "missing": (GOOD[:4] + GOOD[5:], [GOOD[4]], {}),
    "renamed": (["Other", *GOOD[1:]], [GOOD[0]], {"Other": "more"}),
    "spaces and a mark": (["\ufeff" + GOOD[0], f" {GOOD[1]} ", *GOOD[2:]], [], {}),
}


def test_columns_land_by_name_whatever_their_order(spark, tmp_path):
    """Files of all orders in one load, each with a header of its own."""
    for i, (header, _, _) in enumerate(ORDERS.values()):
        values = [VALUES.get(h.strip().lstrip("\ufeff"), "more") for h in header]
        _write(str(tmp_path / f"VRA_{i}.csv"), ["preamble", ";".join(header), ";".join(values)])
    checks = []
    df = land_flights(spark, f"{tmp_path}/*.csv", checks=checks)
    rows = {r[spec.COL_SOURCE_FILE]: r for r in df.collect()}
    assert len(rows) == len(ORDERS)
    for i, (_, nulls, rescued) in enumerate(ORDERS.values()):
        row = rows[f"VRA_{i}.csv"]
        assert [row[h] for h in GOOD] == [None if h in nulls else v for h, v in VALUES.items()]
        kept = json.loads(row[spec.COL_RESCUED] or "{}")
        assert kept == (rescued | {"_file": f"VRA_{i}.csv"} if rescued else {})


def test_a_column_that_stands_twice_fails_the_load(spark, tmp_path):
    _write(str(tmp_path / "VRA_1.csv"), ["preamble", ";".join([*GOOD, GOOD[0]]), ROW])
    with pytest.raises(Exception, match="stands twice in the header"):
        land_flights(spark, f"{tmp_path}/*.csv")


def test_fields_of_a_line(spark):
    """The splitter against Python's csv module, and lines that no parser agrees on."""
    import csv
    import random
    from opslake.sources.csv_landing import LATIN1_UNQUOTED, fields_of
    rng = random.Random(1)
    rows = [[rng.choice(["", "a", "é b", "x;y", 'say "so"', '"', ";", "a" * 20000]) for _ in range(rng.randrange(1, 9))] for _ in range(200)]
    lines = [";".join('"' + f.replace('"', '""') + '"' if rng.random() < 0.3 or set(f) & set(';"') else f for f in row) for row in rows]
    want = [next(csv.reader([line], delimiter=";")) or [""] for line in lines]
    odd = {'a;"b;c': ["a", '"b', "c"], 'a;"b"c;d': ["a", '"b"c', "d"], ";": [None, None], '""': [""], '"': ['"'], 'a"b;c': ['a"b', "c"]}
    df = spark.createDataFrame([(line,) for line in lines + list(odd)], "line string")
    got = [r.f for r in df.select(fields_of(F.col("line")).alias("f")).collect()]
    assert [[f or "" for f in row] for row in got[:200]] == want
    assert got[200:] == list(odd.values())
    plain = spark.createDataFrame([('a;"b;;c',)], "line string").select(fields_of(F.col("line"), LATIN1_UNQUOTED)).first()[0]
    assert plain == ["a", '"b', None, "c"]


@pytest.mark.parametrize("lines", [
    ["preamble", ROW, ROW],                                  # no header line
    ["preamble", FLIGHT_HEADER, ROW, "truncated", ROW],      # a line that only looks like a preamble
    ["pre;amble", FLIGHT_HEADER, ROW],                       # a preamble with a separator
])
def test_miscounted_lines_fail_before_silver(spark, tmp_path, lines):
    _write(str(tmp_path / "VRA_1.csv"), lines)
    checks = []
    land_flights(spark, f"{tmp_path}/*.csv", checks=checks).write.format("noop").mode("overwrite").save()
    with pytest.raises(HeaderMismatch):
        checks[0].verify()


def test_counts_of_good_files(spark, tmp_path):
    for i in range(3):
        _write(str(tmp_path / f"VRA_{i}.csv"), ["preamble", FLIGHT_HEADER, ROW, ROW])
    checks = []
    land_flights(spark, f"{tmp_path}/*.csv", checks=checks).write.format("noop").mode("overwrite").save()
    assert checks[0].verify() == {"headers": 3, "preambles": 3}


def test_pipeline_from_landed_files(spark, files):
    vra, ref = files
    src = csv_sources(spark, f"{vra}/*.csv", ref)
    root = tempfile.mkdtemp(prefix="opslake-csvrun-")
    res = run_full_refresh(spark, src, root)
    assert res.tables["bronze.vra"].rows == 10
    assert res.tables["silver.vra"].rows == 10
    assert res.tables["gold.fact_flights"].rows == 8   # three copies of one flight across two files
    checks = {r[0]: r for r in res.gate}
    assert checks["rescued_rows"][3] == 2                        # warned, not failed
    assert res.contract["empresa_no_cadastro_anac"] == 2         # GLO is not registered
    assert res.contract["aeroporto_destino_no_cadastro_anac"] == 2   # KJFK and the truncated row


def test_landing_query_keeps_its_rows_in_place_and_its_code_short(spark):
    """Rows are not shuffled to their file's header, and the JVM compiles no method over 8,000 bytes."""
    import contextlib
    import io
    import re
    from opslake.plans import catalog
    df = catalog.landing_query("landing_summary")(spark, "/root/testdata/sf0.001")
    tree = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_path" not in tree
    text = io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(text):
            catalog.landing_query("landing_summary")(spark, "/root/testdata/sf0.001").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
