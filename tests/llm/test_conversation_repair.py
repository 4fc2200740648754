"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest

from opslake.llm import conversation_repair as C

WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Cheapest edits and the least audit, front to back over (row, last initials)."""
    best = {}  # place: (cost, audit, lines)
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def offer(table, place, entry):
        if place not in table or entry[:2] < table[place][:2]:
            table[place] = entry

    def insert(table):
        for _ in range(4):
            for place, (cost, audit, lines) in list(table.items()):
                for r in ("user", "assistant"):
                    if (place, r[0]) in steps:
                        offer(table, steps[place, r[0]], (cost + 5, audit + "I", lines + (f"{r}:",)))

    best[0] = (0, "", ())
    insert(best)
    for (_, _, role, text), fault in zip(rows, faults):
        new = {}
        for place, (cost, audit, lines) in best.items():
            offer(new, place, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            late = 5 if fault else 0
            if (place, role[:1]) in steps:
                offer(new, steps[place, role[:1]], (cost + late, audit + "K", lines + (f"{role}:{text}",)))
            for r in ("user", "assistant"):
                if (place, r[0]) in steps:
                    offer(new, steps[place, r[0]], (cost + late + 1, audit + "R", lines + (f"{r}:{text}",)))
        insert(new)
        best = new
    return min(best[p] for p in (0, 3) if p in best)


def plain(source):
    out = {}
    damaged = plain_damage(source)
    for conv in {r[0] for r in source}:
        rows = sorted((r for r in damaged if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in rows if r[1] is not None]
        faults = plain_faults(rows)
        cost, audit, lines = plain_repair(rows, faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(rng, conv, n):
    roles = ["user", "assistant"] * n
    rows = [(conv, 0, "system", "Be brief.")] if rng.random() < 0.3 else []
    for i in range(n):
        role = rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.15 else roles[i]
        text = rng.choice(["", None, " \t\n", "no end", "Again.", "É \x0b", "What? ", "Yes!\n"]) if rng.random() < 0.3 else f"Row {i} of it."
        turn = None if rng.random() < 0.05 else i + rng.randrange(3) * (rng.random() < 0.1)
        rows += [(conv, turn, role, text)] * (1 + (rng.random() < 0.05) * rng.randrange(3))
    return rows


def conversations():
    rng = random.Random(4)
    rows = [r for conv in range(150) for r in rows_of(rng, conv, rng.randrange(0, 12))]
    rows += rows_of(rng, None, 8) + rows_of(rng, 500, 900)
    rows += [(501, None, "user", f"Turn {i}.") for i in range(40)] + [(502, 3, "user", "Copy.")] * 300
    rows += [(conv, t, "user", "Hello.") for conv in range(503, 520) for t in (0, 0, 1)]
    return rows


def run(spark, rows, path, parts):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    df.withColumns({"conv": C.F.lit("x"), "at": C.F.lit(1), "part": C.F.lit(2)}).write.parquet(f"{path}/conversations.parquet")
    got = C.op13_conversation_repair(spark, str(path)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_query_equals_plain_search(spark, tmp_path):
    rows = conversations()
    assert run(spark, rows, tmp_path, 3) == plain(rows)


def test_conversation_over_many_stretches(spark, tmp_path):
    """Range partitions cut the long conversation at several places."""
    rows = conversations()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        ordered = C.ordered_rows(C.damage(C.plain_rows(spark.createDataFrame(rows, "c long, t long, r string, x string"), "c", "t", "r", "x")))
        assert ordered.where("conv = 500").selectExpr("at >> 33").distinct().count() > 3
        assert run(spark, rows, tmp_path, 3) == plain(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(6))
def test_stretches_add_up(seed):
    """Cutting anywhere gives the edits of the whole."""
    rng = random.Random(seed)
    symbols = [(rng.choice("suaxSUAX-"), rng.choice([1, 1, 1, 2, 70])) for _ in range(60)]
    whole, _ = C.unroll(symbols, C.END, 0, True)
    cut = rng.randrange(61)
    middle = C.before(C.total(symbols[cut:]), C.END)
    first, place = C.unroll(symbols[:cut], middle, 0, cut == 60)
    second, _ = C.unroll(symbols[cut:], C.END, place, True)
    assert first + second == whole
    assert C.before(C.total(symbols), C.END)[0] == C.before(C._times(C.total(symbols[:cut]), C.total(symbols[cut:])), C.END)[0]


def test_empty_and_all_dropped(spark, tmp_path):
    assert run(spark, [], tmp_path / "a", 1) == {}
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hi.")], tmp_path / "b", 1) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_lines_are_repaired_conversations(spark):
    df = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 2, "user", "There?"), ("c", 3, "tool", "x"), ("d", 0, "assistant", "Yes.")],
                               "id string, n int, who string, what string")
    lines, report = C.repair(df, "id", "n", "who", "what")
    got = [(r.conv, r.edit, r.role, r.text) for r in lines.orderBy("conv", "at", "step").collect()]
    assert got == [("c", "K", "user", "Hi."), ("c", "R", "assistant", "There?"), ("c", "D", "tool", "x"), ("d", "D", "assistant", "Yes.")]
    assert {r.conv: r.cost for r in report.collect()} == {"c": 3, "d": 2}
