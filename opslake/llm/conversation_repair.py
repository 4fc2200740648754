"""Conversation structure repair: run-length dynamic programming.

A conversation in order must have the roles ``(s?(ua)+)?`` (system, user,
assistant, by initials) and no blank or repeated rows. Every row is a symbol of
its role and fault; a symbol is a 4 x 4 min-plus matrix over the places in that
pattern: what it costs to keep, relabel or delete the row, after inserting rows
before it. Equal consecutive symbols are collapsed to runs; a run of r symbols
takes the cached binary powers of its matrix that add up to r. What is cheapest
from a place on then tells, front to back, the edits one by one, the
alphabetically least of equally cheap ones.

Scale: rows are dealt to stretches of the order (conversation, turn, role, text),
so a conversation that holds a third of all rows lies in many stretches. A
stretch of a conversation sums up to one matrix; per conversation only the
matrices of its stretches meet, streamed in order. Copies of a row are counted
before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opslake.llm._common import read_table, written

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
NEVER = 1 << 40
# Places in the pattern: 0 before all, 1 after system, 2 after user, 3 after assistant. The next place by role.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}  # the role that a new or relabelled row takes
END = (0, 2 * INSERT, INSERT, 0)         # cheapest end: nothing, user and assistant, assistant, nothing
GONE = "-"                               # symbol of a row that must go; others: initial, upper case if truncated

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, min(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def _row_edits(symbol: str, place: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next place) of the edits that use up a row, least letter first."""
    out = [("D", DELETE, place)]
    if symbol != GONE:
        late = TRUNCATED if symbol.isupper() else 0
        if (place, symbol.lower()) in STEP:
            out.append(("K", late, STEP[place, symbol.lower()]))
        out.append(("R", REROLE + late, STEP[place, NEXT[place]]))
    return out


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The matrix of 2 ** k equal symbols: insertions before each row included."""
    if k:
        return _times(power(symbol, k - 1), power(symbol, k - 1))
    rows = []
    for place in range(4):
        row, cost = [NEVER] * 4, 0
        for _ in range(4):  # after no insertion, one, two, ...
            for _, c, to in _row_edits(symbol, place):
                row[to] = min(row[to], cost + c)
            cost, place = cost + INSERT, STEP[place, NEXT[place]]
        rows.append(tuple(row))
    return tuple(rows)


@lru_cache(maxsize=1 << 15)
def _run(symbol: str, count: int) -> Matrix:
    done, k = None, 0
    while count:
        if count & 1:
            done = power(symbol, k) if done is None else _times(done, power(symbol, k))
        count, k = count >> 1, k + 1
    return done


@lru_cache(maxsize=1 << 15)
def _advance(matrix: Matrix, symbol: str, count: int) -> Matrix:
    return _times(matrix, _run(symbol, count))


def before(matrix: Matrix, after: Vector) -> Vector:
    """Cheapest cost from each place on, given that of the places after a matrix."""
    return tuple(min(matrix[i][j] + after[j] for j in range(4)) for i in range(4))


def runs(symbols: Iterable[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    for symbol, same in groupby(symbols, key=lambda s: s[0]):
        yield symbol, sum(c for _, c in same)


UNIT: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


def total(symbols: list[tuple[str, int]]) -> Matrix:
    """The matrix of a stretch of (symbol, count). A count over 1 is a row and
    copies of it, which must go."""
    each = (x for symbol, count in symbols for x in ((symbol, 1), (GONE, count - 1)) if x[1])
    out = UNIT
    for symbol, count in runs(each):
        out = _advance(out, symbol, count)
    return out


@lru_cache(maxsize=1 << 15)
def _before_one(symbol: str, after: Vector) -> Vector:
    """Cost from each place on before one symbol, less the smallest."""
    v = before(power(symbol, 0), after)
    return tuple(x - min(v) for x in v)


@lru_cache(maxsize=1 << 15)
def _choose(symbol: str, place: int, after: Vector) -> tuple[str, str, int]:
    """Edits up to and with one row: letters, roles of new and relabelled rows, next place."""
    here = before(power(symbol, 0), after)
    letters = roles = ""
    while True:
        rest = {letter: (cost + after[to], to) for letter, cost, to in _row_edits(symbol, place)}
        new = STEP[place, NEXT[place]]
        for letter in "DIKR":
            if letter == "I" and INSERT + here[new] == here[place]:
                letters, roles, place = letters + "I", roles + NEXT[place], new
                break
            if letter in rest and rest[letter][0] == here[place]:
                return letters + letter, roles + (NEXT[place] if letter == "R" else "-"), rest[letter][1]


def unroll(symbols: list[tuple[str, int]], after: Vector, place: int, last: bool) -> tuple[list[tuple[str, str]], int]:
    """(letters, roles) for each (symbol, count) of a stretch and the place after
    it, given the cheapest costs after the stretch and the place before it."""
    after = tuple(x - min(after) for x in after)
    afters = []
    for symbol, _ in reversed(symbols):
        afters.append(after)  # copies that go add the same to every place
        after = _before_one(symbol, after)
    out = []
    for (symbol, count), after in zip(symbols, reversed(afters)):
        letters, roles, place = _choose(symbol, place, after)
        out.append((letters + "D" * (count - 1), roles + "-" * (count - 1)))
    while last and out and place in (1, 2):
        letters, roles = out[-1]
        out[-1] = letters + "I", roles + NEXT[place]
        place = STEP[place, NEXT[place]]
    return out, place


def damage(rows: DataFrame) -> DataFrame:
    """The query's damage of (conv, turn, role, text, copies) rows."""
    key = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20).where("kind <> 0")
    return d.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.col("copies") * 2).otherwise(F.col("copies")).alias("copies"))


def plain_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, copies); a null role or text is one space."""
    def c(name: str):
        return F.col(f"`{name}`")
    return df.select(c(conv_col).alias("conv"), c(turn_col).cast("long").alias("turn"),
                     F.coalesce(c(role_col).cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(c(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("copies"))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Distinct (conv, turn, role, text) of ``plain_rows`` with ``copies``, the
    faults ``blank``, ``seen`` (role and text stand earlier) and ``open`` (neither,
    and no end of a sentence) and ``at``, a number that rises with conv, turn
    (nulls first), role and text. Its upper bits (from 33) name the stretch."""
    some = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    some = written(some.withColumn("same", F.sha2("text", 256)), "conversation-rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = some.groupBy("conv", "role", "same").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    again = again.select(*(F.col(c).alias(f"{c}_") for c in ("conv", "role", "same")), "first")
    on = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_")) & (F.col("same") == F.col("same_"))
    ended = F.rtrim("text", F.lit(BLANKS))
    seen = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(turn)
    some = some.join(again, on, "left").select(
        "conv", "turn", "role", "text", "copies", (ended == "").alias("blank"), (seen & (ended != "")).alias("seen"),
        (~seen & ~F.right(ended, F.lit(1)).isin("", ".", "!", "?")).alias("open"))
    some = some.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")
    return written(some.withColumn("at", F.monotonically_increasing_id()), "conversation-order")


def _in_arrow(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], ddl: str) -> DataFrame:
    """mapInArrow of a function from row tuples to row tuples."""
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            columns = zip(*out) if out else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        out: list[tuple] = []
        for row in rows(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
            out.append(row)
            if len(out) >= 4096:
                yield batch()
                out = []
        yield batch()

    return df.mapInArrow(run, ddl)


def _symbols(rows: list[tuple]) -> list[tuple[str, int]]:
    return [(symbol, copies) for _, symbol, copies, *_ in rows]


def _stretch_sums(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, part, matrix, illegal neighbours, first and last initial) of each stretch."""
    for (part, conv), some in groupby(rows, key=lambda r: r[:2]):
        some = [r[2:] for r in some]
        illegal = sum(copies - 1 for _, _, copies, _ in some) + sum(
            a[3] + b[3] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
        yield conv, part, [x for line in total(_symbols(some)) for x in line], illegal, some[0][3], some[-1][3]


def _costs_after(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From stretch sums by conv, last part first: (conv, part, costs after the
    stretch, stretches after it, cost and illegal neighbours from it on, whether it is the first)."""
    for conv, some in groupby(rows, key=lambda r: r[0]):
        after, bad, follower, held = END, 0, None, None
        for later, (_, part, matrix, illegal, first, last) in enumerate(some):
            if held:
                yield *held, False
            bad += illegal + (follower is not None and last + follower not in ("su", "ua", "au"))
            here = before(tuple(tuple(matrix[i:i + 4]) for i in range(0, 16, 4)), after)
            held = conv, part, list(after), later, here[0], bad
            after, follower = here, first
        yield *held, True


def _exits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Of stretches with a header: the place after them for each place before them."""
    for (part, conv), some in groupby(rows, key=lambda r: r[:2]):
        some = [r[2:] for r in some]
        if some[0][0] < 0:
            yield conv, part, [unroll(_symbols(some[1:]), tuple(some[0][4]), place, False)[1] for place in range(4)]


def _entries(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Headers with the place before each stretch, from (conv, part, after, later)
    and exits (conv, part, places) in order."""
    for conv, some in groupby(rows, key=lambda r: r[0]):
        place = 0
        for _, part, places, after, later in some:
            if places is None:
                yield part, conv, -1, None, None, None, after, place, later == 0
            else:
                place = places[place]


def _row_choices(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(at, letters, roles) of each row of stretches that begin with a header."""
    for _, some in groupby(rows, key=lambda r: r[:2]):
        header, *some = [r[2:] for r in some]
        out, _ = unroll(_symbols(some), tuple(header[4]), header[5], header[6])
        for (at, *_), (letters, roles) in zip(some, out):
            yield at, letters, roles


def edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``ordered_rows``: the edits of each row (at, letters, roles: of new and
    relabelled rows), and per conversation (conv, cost, illegal)."""
    conv = dict(rows.dtypes)["conv"]
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("blank") | F.col("seen"), GONE).when(F.col("open"), F.upper(plain)).otherwise(plain)
    sym = written(rows.select(F.shiftright("at", 33).alias("part"), "conv", "at", symbol.alias("symbol"), "copies",
                              initial.alias("initial")), "conversation-symbols")

    def stretches(df: DataFrame) -> DataFrame:
        return df.repartition("part", "conv").sortWithinPartitions("part", "conv", "at")

    def by_conv(df: DataFrame, *order) -> DataFrame:
        return df.repartition("conv").sortWithinPartitions("conv", *order)

    sums = _in_arrow(stretches(sym), _stretch_sums,
                     f"conv {conv}, part bigint, matrix array<bigint>, illegal bigint, first string, last string")
    back = written(_in_arrow(by_conv(sums, F.desc("part")), _costs_after,
                             f"conv {conv}, part bigint, after array<bigint>, later bigint, cost bigint, illegal bigint, head boolean"),
                   "conversation-costs")
    header = ["part", "conv", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("symbol"),
              F.lit(None).cast("long").alias("copies"), F.lit(None).cast("string").alias("initial"), "after"]
    steps = back.select("conv", "part", F.lit(None).cast("array<int>").alias("places"), "after", "later")
    if not (going_on := back.where("later > 0")).isEmpty():  # some conversation lies in several stretches
        places = stretches(going_on.select(*header).unionByName(sym.withColumn("after", F.lit(None).cast("array<long>"))))
        places = _in_arrow(places, _exits, f"conv {conv}, part bigint, places array<int>")
        steps = steps.unionByName(places.withColumns({"after": F.lit(None).cast("array<long>"), "later": F.lit(None).cast("long")}))
    entries = _in_arrow(by_conv(steps, "part", F.col("places").isNotNull()), _entries, (
        f"part bigint, conv {conv}, at bigint, symbol string, copies bigint, initial string, after array<bigint>, place int, last boolean"))
    rest = {"after": F.lit(None).cast("array<long>"), "place": F.lit(None).cast("int"), "last": F.lit(None).cast("boolean")}
    chosen = _in_arrow(stretches(entries.unionByName(sym.withColumns(rest))), _row_choices, "at bigint, letters string, roles string")
    return written(chosen, "conversation-edits"), back.where("head").select("conv", "cost", "illegal")


def repaired_lines(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv, at, step, edit, role, text) of every edit in order of at and step:
    kept (K), relabelled (R), new (I) and deleted (D) rows. Without the deleted
    ones these are the repaired conversations."""
    lines = rows.select("conv", "role", "text", "at").join(chosen, "at")
    lines = lines.withColumn("step", F.explode(F.sequence(F.lit(1), F.length("letters"))))
    lines = lines.withColumn("edit", F.substr("letters", F.col("step"), F.lit(1))).withColumn("to", F.substr("roles", F.col("step"), F.lit(1)))
    role = F.when(F.col("to") == "u", "user").when(F.col("to") == "a", "assistant").otherwise(F.col("role"))
    return lines.select("conv", "at", "step", "edit", role.alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def repair(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
           damaged: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of every conversation: ``repaired_lines`` and a report
    (conv, gaps, blank, duplicate, truncated, illegal, cost). ``damaged`` changes
    the (conv, turn, role, text, copies) rows first.

    Rows are taken by turn, nulls first, then role, then text. Edits: keep 0, give
    the role user or assistant 1, delete 2 (a must for blank rows and for those
    whose role and text stand earlier), insert an empty row 5; 5 more for a row
    that stays without end of sentence.

    Defined cases: a null conversation id is a conversation; a null role or text is
    one space (so such a text is blank); roles with other initials can't be kept;
    repeated rows are duplicates; an empty table gives empty results; other columns
    take no part, whatever their names."""
    rows = plain_rows(df, conv_col, turn_col, role_col, text_col)
    rows = ordered_rows(damaged(rows) if damaged else rows)
    chosen, costs = edits(rows)
    fresh = ~F.col("blank") & ~F.col("seen")
    by_turn = rows.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("seen"), F.col("copies")).when(fresh, F.col("copies") - 1).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("open"), 1).otherwise(0)).alias("truncated"))
    counts = by_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    costs = costs.withColumnRenamed("conv", "conv_")
    report = counts.join(costs, F.col("conv").eqNullSafe(F.col("conv_"))).select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return repaired_lines(rows, chosen), report


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, some in groupby(rows, key=lambda r: r[0]):
        audit, digest, joint = [], hashlib.sha256(), b""
        for _, edit, role, text in some:
            audit.append(edit)
            if edit != "D":
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
        yield conv, "".join(audit), digest.hexdigest()


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation after the contract's damage: faults, cost, audit and
    digest of the repaired text. One digest runs over a conversation in order, so
    that step streams each conversation through one task (nothing is held but its
    audit); all before it is spread."""
    source = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    lines, report = repair(source, "conv_id", "turn", "role", "text", damage)
    conv = dict(lines.dtypes)["conv"]
    streamed = lines.repartition("conv").sortWithinPartitions("conv", "at", "step").select("conv", "edit", "role", "text")
    digests = _in_arrow(streamed, _digests, f"conv {conv}, audit string, repaired_sha256 string").withColumnRenamed("conv", "conv_d")
    report = report.withColumnRenamed("conv", "conv_r")
    out = source.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("conv_r")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("conv_d")), "left")
    return out.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        *(F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
