"""Repairs against trying every sequence of edits, and long conversations against a plain table of best prefixes."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from tablespan.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(initials, faults):
    """Every sequence of edits with at most two inserts in a row, by cost and then audit."""
    best = None
    gaps = [("", "u", "a", "ua", "au")] * (len(initials) + 1)
    choices = [[("D", "", 4)] + ([] if f in (1, 2) else [("R", "u", 3), ("R", "a", 3), *([("K", i, 0)] if i else [])]) for i, f in zip(initials, faults)]
    for edits in itertools.product(*choices):
        cost = sum(e[2] + (3 if f == 3 and e[0] != "D" else 0) for e, f in zip(edits, faults))
        if best is not None and cost > best[0]:
            continue
        for put in itertools.product(*gaps):
            roles = "".join(p + e for p, e in zip(put, [e[1] for e in edits] + [""]))
            whole = cost + 3 * sum(map(len, put))
            if PATTERN.fullmatch(roles):
                audit = "".join("I" * len(p) + e for p, e in zip(put, [e[0] for e in edits] + [""]))
                if best is None or (whole, audit) < best[:2]:
                    best = (whole, audit, roles)
    return best


def by_table(initials, faults):
    """The same for long rows: the best prefix of every state, row by row."""
    inserts = {0: {"": 0, "I": 2, "II": 3}, 1: {"": 1, "I": 2, "II": 3}, 2: {"": 2, "I": 3}, 3: {"": 3, "I": 2}}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "")}
    for initial, fault in zip(initials, faults):
        after = {}
        for q, (cost, audit) in best.items():
            for more, r in inserts[q].items():
                moves = [("D", r, 4)]
                if fault in (0, 3):
                    extra = 3 if fault else 0
                    moves.append(("R", step[r, "a" if r == 2 else "u"], 3 + extra))
                    if (r, initial) in step:
                        moves.append(("K", step[r, initial], extra))
                for edit, to, price in moves:
                    new = (cost + 3 * len(more) + price, audit + more + edit)
                    after[to] = min(after.get(to, new), new)
        best = after
    return min((c + 3 * k, a + "I" * k) for q, (c, a) in best.items() for k in [{0: 0, 1: 2, 2: 1, 3: 0}[q]])


def test_search_against_every_sequence():
    draw = random.Random(7)
    for n in [0, 1, 1, 2, 2, 3, 3, 3, 4, 4, 4] * 8:
        initials, faults = [draw.choice("suuaa ") for _ in range(n)], [draw.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert repair.search(initials, faults, repair.START, repair.ENDS) == cheapest(initials, faults)[:2] == by_table(initials, faults)


@pytest.mark.parametrize("roles", ["u", "ua", "suuaa", "s", "a ", "uuuuuuua"])
def test_long_searches_end(roles):
    draw = random.Random(8)
    for n in (20, repair.SEGMENT):
        for weights in ([9, 0, 0, 0], [6, 1, 1, 1], [1, 1, 1, 3]):
            initials, faults = [draw.choice(roles) for _ in range(n)], draw.choices([0, 1, 2, 3], weights, k=n)
            assert repair.search(initials, faults, repair.START, repair.ENDS) == by_table(initials, faults)


def expected(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv]
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            convs[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, initials = faults_of(rows), [r[1][:1] for r in rows]
        cost, audit = by_table(initials, faults)
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        n, place, at, lines = len(audit.replace("D", "")), 0, 0, []
        for e in audit:
            if e != "D":
                new = "user" if (place - n % 2) % 2 == 0 else "assistant"
                lines.append(f"{rows[at][1] if e == 'K' else new}:{'' if e == 'I' else rows[at][2]}")
                place += 1
            at += e != "I"
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines))
    return out


def awkward():
    draw = random.Random(9)
    table = []
    for conv in range(60):
        for turn in range(draw.randint(1, 9)):
            table.append((conv, turn * draw.choice([1, 1, 1, 3]), draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                          draw.choice(["Yes.", "no", " \t\n", "", "Why?  \n", None, "é!", "  end .", "x" * 50])))
    table += [(None, 1, "user", "hi."), (None, None, "assistant", "ho."), (None, None, "user", "ho."), (70, None, None, None), (70, 5, "user", "a."), (70, 5, "user", "a.")]
    table += [(80, k, ["user", "assistant"][draw.random() < 0.5], draw.choice(["ok.", "well", f"n{k}.", ""])) for k in range(700)]     # many segments
    table += [(81, 0, "user", "same.")] * 400
    return table


@pytest.mark.parametrize("segment", [3, 16, repair.SEGMENT])
def test_repairs(spark, segment):
    table = awkward()
    df = spark.createDataFrame(table, SCHEMA).selectExpr("*", "'x' as conv", "1 as pos", "2 as seg", "3 as fault", "4 as cost")
    found = repair.repaired(repair.damaged(df), df, segment)
    want = expected(table)
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted((w[:9] for w in want), key=str)
    lines = defaultdict(list)
    for r in sorted(repair.repaired_turns(repair.damaged(df), segment).collect(), key=lambda r: r.pos):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert dict(lines) == {w[0]: w[9] for w in want if w[9]}


def test_query_against_sql(spark, tmp_path):
    import duckdb

    table = [r for r in awkward() if r[0] is None or r[0] < 80]
    spark.createDataFrame(table, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = entry.queries()["op13_conversation_repair"](spark, str(tmp_path))
    cur = con.execute(entry.oracle_sql()["op13_conversation_repair"])
    assert [d[0] for d in cur.description] == found.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(empty).count() == 0 and repair.repaired_turns(empty).count() == 0
    # every row lost: an original conversation without rows
    got = repair.repaired(empty, spark.createDataFrame([(4, 0, "user", "a")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    long = "word. " * 3_500_000
    got = repair.repaired(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], SCHEMA)).collect()
    assert got[0].audit == "KK" and got[0].repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()
