"""Flight-shaped bronze tables projected from the driver's TPC-H-style tables.

The projection (FIXTURES.md §4) gives every operator realistic input whose size
grows with the data: one flight step per ``lineitem ⋈ orders`` row, airline
registry rows from ``supplier``, aerodrome registry rows from ``nation``. Every
defect the contract must catch (NULL codes, literal 'null', unparsable times,
implausible delays, unknown status, exact duplicates, …) is derived from key
arithmetic, so the same rows come out of the DuckDB oracle.

All bronze columns are text, as landed from CSV.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake import spec
from opslake.operators.once import once
from opslake.sources.tables import read_table

# Fixture parameters (FIXTURES.md §4): modulus → branch.
DI_BY_LINENUMBER = ["0", "2", "3", "4", "D", "E", "1"]
LINE_TYPE_BY_RETURNFLAG = {"A": "N", "N": "I", "R": "X"}


def icao_code(k: Column) -> Column:
    """SBkk for k < 12, SNkk for k < 18, else KXkk (foreign)."""
    prefix = F.when(k < 12, F.lit("SB")).when(k < 18, F.lit("SN")).otherwise(F.lit("KX"))
    return F.concat(prefix, F.lpad(k.cast("string"), 2, "0"))


def airline_code(suppkey: Column) -> Column:
    digits = suppkey.cast("string")
    padded = F.when(suppkey.between(0, 9999), F.lpad(digits, 4, "0")).otherwise(digits)  # never cut
    return F.when(suppkey >= 0, F.concat(F.lit("A"), padded)).otherwise(F.format_string("A%04d", suppkey.cast("long")))


def _text_ts(ts: Column) -> Column:
    # NTZ → 'yyyy-MM-dd HH:mm:ss' without any session-zone conversion.
    return ts.cast("string")


def bronze_flights(spark: SparkSession, root: str) -> DataFrame:
    """bronze.vra: one row per line item, plus an exact copy for every line of
    an order whose key is a multiple of 100 (the duplicates gold removes)."""
    li = read_table(spark, root, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"])
    od = read_table(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))

    pk = F.col("l_partkey")
    q = F.col("l_quantity").cast("int")
    cancelled_order = F.col("o_orderstatus") == F.lit("P")
    dep_offset = (
        F.when(pk % 97 == 0, F.lit(4320))
        .when(pk % 101 == 0, F.lit(-600))
        .when(pk % 107 == 0, F.lit(-120))
        .when(pk % 109 == 0, F.lit(1440))
        .when(pk % 113 == 0, F.lit(1442))
        .otherwise(q - 25)
    )
    arr_offset = F.when(pk % 89 == 0, F.lit(2000)).otherwise((q * 7) % 50 - 20)
    sched = F.timestamp_add("MINUTE", pk % 1440, F.col("o_orderdate"))
    actual_dep = F.timestamp_add("SECOND", dep_offset * 60 - F.col("l_linenumber") * 10, sched)
    sched_arr = F.timestamp_add("MINUTE", F.when(pk % 103 == 0, F.lit(-5)).otherwise(F.lit(60)), sched)
    actual_arr = F.timestamp_add("MINUTE", arr_offset + 60, sched)
    null_text = F.lit(spec.NULL_LITERAL)

    line_type = F.lit(None).cast("string")
    for flag, code in reversed(list(LINE_TYPE_BY_RETURNFLAG.items())):
        line_type = F.when(F.col("l_returnflag") == flag, F.lit(code)).otherwise(line_type)

    values = {
        "icao_airline": F.when(pk % 211 == 0, F.lit(None).cast("string")).otherwise(airline_code(F.col("l_suppkey"))),
        "flight_number": pk.cast("string"),
        "di_code": F.try_element_at(F.array(*[F.lit(c) for c in DI_BY_LINENUMBER]), F.col("l_linenumber")),
        "line_type_code": line_type,
        "icao_origin": icao_code(F.col("o_custkey") % 25),
        "icao_destination": F.when(pk % 223 == 0, F.lit("")).otherwise(icao_code(F.col("l_suppkey") % 25)),
        "scheduled_departure": F.when(pk % 33 == 0, null_text).otherwise(_text_ts(sched)),
        "actual_departure": F.when(cancelled_order, null_text).otherwise(_text_ts(actual_dep)),
        "scheduled_arrival": F.when(pk % 37 == 0, F.lit("bad-ts")).otherwise(_text_ts(sched_arr)),
        "actual_arrival": F.when(cancelled_order, null_text).otherwise(_text_ts(actual_arr)),
        "flight_status": (
            F.when(pk % 251 == 0, F.lit(None).cast("string"))
            .when(pk % 257 == 0, F.lit("DESCONHECIDO"))
            .when(cancelled_order, F.lit(spec.STATUS_CANCELLED))
            .otherwise(F.lit(spec.STATUS_COMPLETED))
        ),
        "justification_code": F.when(F.col("l_linenumber") % 2 == 1, F.lit(spec.NOT_APPLICABLE))
        .otherwise(F.col("l_returnflag")),
    }
    source_file = F.concat(
        F.lit("VRA_"), F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), F.lit(".csv")
    )
    # Exact duplicates without a second scan/join: generate the copy in place.
    copies = F.when(F.col("l_orderkey") % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = j.select(
        F.explode(copies).alias("_copy"),
        *[values[silver].alias(raw) for raw, silver in spec.FLIGHT_SOURCE_COLUMNS],
        F.lit(None).cast("string").alias(spec.COL_RESCUED),
        source_file.alias(spec.COL_SOURCE_FILE),
        F.current_timestamp().alias(spec.COL_INGESTED),
    )
    return out.drop("_copy")


OTHER_COLUMN = "Observação"


def landing_lines(spark: SparkSession, root: str) -> DataFrame:
    """The flights as lines of ``;`` files (_line, _path, _file, _block), with a
    preamble and a header each. Files of even years have their first two columns
    swapped, those of years divisible by three lack the last column, those of the
    last three months have a column more. Lines whose flight number is a multiple
    of 31 end after five fields; of 29, have two fields too many. Texts have
    quotes and separators within where the number is a multiple of 13, and
    quotes without need where it is one of 7."""
    flights = bronze_flights(spark, root)
    file, n = F.col(spec.COL_SOURCE_FILE), F.col("`Número Voo`").cast("long")
    year, added = F.substring(file, 5, 4).cast("int"), F.length(file) == 14
    names = [raw for raw, _ in spec.FLIGHT_SOURCE_COLUMNS]

    def laid_out(cells: Column, *more: Column) -> Column:
        """Those of ``cells`` (of all names, then of the added column) that the file has, in its order, and ``more``."""
        none, last = F.array().cast("array<string>"), len(names)
        return F.concat(F.when(year % 2 == 0, F.array(F.get(cells, F.lit(1)), F.get(cells, F.lit(0)))).otherwise(F.slice(cells, 1, 2)), F.slice(cells, 3, 1),
                        F.when(added, F.slice(cells, last + 1, 1)).otherwise(none), F.slice(cells, 4, last - 4),
                        F.when(year % 3 == 0, none).otherwise(F.slice(cells, last, 1)), *more)

    def rendered(value: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        needed = (value == "") | F.contains(value, F.lit(";")) | F.contains(value, F.lit('"'))
        return F.when(value.isNull(), "").when(needed | (F.col("_n") % 7 == 0), quoted).otherwise(value)

    cells = [F.col(f"`{name}`") for name in names]
    cells[-1] = F.when(n % 13 == 0, F.concat(F.lit("x;"), cells[-1], F.lit('"q'))).otherwise(cells[-1])
    other = F.when(n % 5 != 0, F.concat(F.lit("obs "), (n % 7).cast("string")))
    # Out of generators: no step is repeated wherever a line is looked at, and each cell is rendered by the same small
    # expression (written out cell by cell, the code of a row is too long for the JVM to compile).
    data = once(flights.select(file, n.alias("_n"), F.array(*cells, other).alias("_cells")), _n=F.col("_n"), _cells=F.transform("_cells", rendered))
    n = F.col("_n")
    extra = F.when((n % 29 == 0) & (n % 31 != 0), F.array(F.lit("EXTRA"), F.lit(""))).otherwise(F.array().cast("array<string>"))
    fields = F.slice(laid_out(F.col("_cells"), extra), F.lit(1), F.when(n % 31 == 0, 5).otherwise(len(names) + 3))
    data = once(data, _line=F.array_join(fields, ";")).select("_line", file.alias("_file"))
    top = F.array(F.concat(F.lit("Updated for "), file), F.array_join(laid_out(F.array(*[F.lit(name) for name in [*names, OTHER_COLUMN]])), ";"))
    heads = flights.select(spec.COL_SOURCE_FILE).distinct().select(F.explode(top).alias("_line"), file.alias("_file"))
    return data.unionByName(heads).select("_line", F.concat(F.lit("inbox/"), "_file").alias("_path"), "_file", F.lit(0).cast("long").alias("_block"))


def bronze_airline_registries(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """National and foreign airline registries (one bronze table per file).

    Every supplier whose key is not 9 mod 10 is an airline 'A<key>'; keys that
    are multiples of 7 carry a second, inactive 'OLD …' record.
    """
    s = read_table(spark, root, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    s = s.where(F.col("s_suppkey") % 10 != 9)
    version = F.explode(
        F.when(F.col("s_suppkey") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ).alias("_version")
    rows = s.select("*", version)
    old = F.col("_version") == 1
    inactive = (F.col("s_acctbal") < 0) | (F.col("s_suppkey") % 14 == 0) | old
    registry = rows.select(
        airline_code(F.col("s_suppkey")).alias("icao"),
        F.lit(None).cast("string").alias("iata_code"),
        F.when(old, F.concat(F.lit("OLD "), F.col("s_name"))).otherwise(F.col("s_name")).alias("legal_name"),
        F.lit(None).cast("string").alias("service"),
        F.concat(F.lit("CITY "), F.col("s_nationkey").cast("string")).alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.when(inactive, F.lit("INATIVA")).otherwise(F.lit(spec.AIRLINE_ACTIVE)).alias("status"),
        (F.col("s_nationkey") < 5).alias("_national"),
    )
    out = {}
    for file, national in ((spec.NATIONAL_AIRLINES_FILE, True), (spec.FOREIGN_AIRLINES_FILE, False)):
        out[file] = registry.where(F.col("_national") == F.lit(national)).drop("_national").select(
            "*", F.lit(file).alias(spec.COL_SOURCE_FILE), F.current_timestamp().alias(spec.COL_INGESTED)
        )
    return out


def bronze_aerodromes(spark: SparkSession, root: str) -> DataFrame:
    """Aerodrome registry from ``nation`` (always 25 rows: a bounded table).

    Keys below 18 except 3 are registered; key 4 has a second record that sorts
    first by name; one record has an empty ICAO code.
    """
    n = read_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    k = F.col("n_nationkey")
    ks = k.cast("string")

    def row(icao, name, municipality, state, altitude):
        return [
            icao.alias("icao"),
            F.concat(F.lit("CIAD"), F.lpad(ks, 4, "0")).alias("ciad"),
            name.alias("name"),
            municipality.alias("municipality"),
            state.alias("state"),
            municipality.alias("served_municipality"),
            state.alias("served_state"),
            F.concat(ks, F.lit("° S")).alias("latitude"),
            F.concat(ks, F.lit("° W")).alias("longitude"),
            altitude.alias("altitude"),
            F.lit("ATIVO").alias("status"),
        ]

    main = n.where((k < 18) & (k != 3)).select(*row(
        icao_code(k), F.col("n_name"), F.concat(F.lit("CITY "), ks),
        F.concat(F.lit("STATE "), F.col("n_regionkey").cast("string")),
        F.when(k == 7, F.lit("1.234,5")).otherwise(F.concat((k * 10).cast("string"), F.lit(",5"))),
    ))
    alt = n.where(k == 4).select(*row(
        icao_code(k), F.concat(F.lit("ALT "), F.col("n_name")), F.lit("CITY X"), F.lit("STATE X"), F.lit("1,0"),
    ))
    empty = n.where(k == 0).select(*row(F.lit(""), F.lit("EMPTY"), F.lit("E"), F.lit("E"), F.lit("0")))
    return main.unionByName(alt).unionByName(empty).withColumn(spec.COL_INGESTED, F.current_timestamp())


def site_code(custkey: Column) -> Column:
    return F.format_string("C%05d", F.floor(custkey / 3).cast("long"))


def bronze_sites(spark: SparkSession, root: str) -> DataFrame:
    """An aerodrome registry that grows with the tables: a record per customer,
    three to a code (every 50th record has none), decimal-comma altitudes, every
    ninth with a thousands separator."""
    cu = read_table(spark, root, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    k, text = F.col("c_custkey"), F.lit(None).cast("string")
    nation, segment = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    altitude = F.when(k % 9 == 0, F.lit("1.000,5")).otherwise(F.concat(nation, F.lit(","), (k % 10).cast("string")))
    values = {
        "icao": F.when(k % 50 == 0, F.lit("")).otherwise(site_code(k)), "ciad": k.cast("string"),
        "name": F.col("c_name"), "municipality": F.when(k % 8 != 0, F.concat(F.lit("CITY "), nation)),
        "state": segment, "served_municipality": segment, "served_state": text, "latitude": text, "longitude": text,
        "altitude": altitude, "status": text, spec.COL_INGESTED: F.current_timestamp(),
    }
    return cu.select(*[v.alias(name) for name, v in values.items()])
