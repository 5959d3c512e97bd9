"""Repair of conversations against a plain search over rows and states, and difficult tables."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridledger.llm import conversations as C
from gridledger.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Cost, audit and repaired rows of ``(symbol, role, text)`` rows: the least letter on a cheapest way, from the end backwards."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    ends = {s: (0, "", []) for s in ("", "a")} | {"u": (2, "I", [("assistant", "")]), "s": (4, "II", [("user", ""), ("assistant", "")])}
    best = ends
    full = {"u": "user", "a": "assistant"}
    for symbol, role, text in reversed(rows):
        extra, here = symbol.isupper(), {}
        for state in after:
            ways = [(best[state][0] + 3, "D" + best[state][1], best[state][2])]
            if symbol != "x":
                for new in after[state]:
                    if role[:1] == new:
                        ways.append((best[new][0] + extra, "K" + best[new][1], [(role, text), *best[new][2]]))
                    if new in "ua":
                        ways.append((best[new][0] + 2 + extra, "R" + best[new][1], [(full[new], text), *best[new][2]]))
            here[state] = min(ways, key=lambda w: w[:2])
        for _ in range(4):
            for state in after:
                for new in after[state]:
                    if new in "ua":
                        way = (here[new][0] + 2, "I" + here[new][1], [(full[new], ""), *here[new][2]])
                        here[state] = min(here[state], way, key=lambda w: w[:2])
        best = here
    return best[""]


def marked(rows):
    """Symbols and counts of ``(turn, role, text)`` rows in order, as the contract words them."""
    out, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        bare = text.strip(C.BLANK)
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not bare:
            counts["blank"] += 1
            kind = "x"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            kind = "x"
        elif bare[-1] not in ".!?":
            counts["truncated"] += 1
            kind = kind.upper()
        seen.add((role, text))
        out.append((kind, role, text))
    turns = sorted({t for t, _, _ in rows if t is not None})
    counts["gaps"] = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return out, counts


def expected(rows):
    marks, counts = marked(rows)
    cost, audit, new = plain(marks)
    return counts | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in new).encode()).hexdigest()}


@pytest.mark.parametrize("seed", range(4))
def test_the_grammar_gives_the_plain_cost_and_audit(seed):
    draw = random.Random(seed)
    for _ in range(400):
        symbols = "".join(draw.choices("xsuaoSUAO", [2, 1, 5, 5, 1, 1, 2, 2, 1], k=draw.randint(0, 14)))
        rules, short, next_symbol = [], symbols, 0x100
        for _ in range(draw.randint(0, 6)):
            if len(short) < 2:
                break
            i = draw.randrange(len(short) - 1)
            rules.append((short[i], short[i + 1]))
            short, next_symbol = short.replace(short[i:i + 2], chr(next_symbol)), next_symbol + 1
        rows = [(s, {"s": "system", "u": "user", "a": "assistant"}.get(s.lower(), "tool"), "t") for s in symbols]
        assert C.Grammar(rules, draw.choice([0, 3, 100])).cheapest(short) == plain(rows)[:2], (symbols, rules)


def test_a_rule_that_doubles_stands_for_a_very_long_conversation():
    rules = [("u", "a")] + [(chr(0x100 + i), chr(0x100 + i)) for i in range(16)]
    cost, audit = C.Grammar(rules).cheapest("s" + chr(0x100 + 16))
    assert (cost, len(audit), set(audit)) == (0, 1 + 2 ** 17, {"K"})


def test_the_query_agrees_with_a_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    given = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        given.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    found = {r.conv_id: r.asDict() for r in QUERIES["op12_conversations"](spark, folder).collect()}
    assert found.keys() == given.keys()
    for conv, rows in given.items():
        after = []
        for turn, role, text in sorted(rows):
            fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            if fault:
                text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
                after += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        assert {k: v for k, v in found[conv].items() if k != "conv_id"} == expected(after), conv


HARD = [
    (1, None, "user", "Hi."), (1, None, None, None), (1, 3, "assistant", "Yes?"), (1, 3, "assistant", "Yes?"), (1, 9, "assistant", "No"),
    (None, 1, "user", "Nobody's."), (None, 2, "assistant", "Indeed!"), (2, 5, "tool", "out."), (2, 6, "", "empty role."), (2, 7, "unit", "kept."),
    (3, 1, "system", "été 日本 😀"), (3, 2, "user", "w " * 50_000 + "."), (4, 0, "user", "\x0b \t"), (5, -4, "system", "a."), (5, 2 ** 40, "assistant", "b.")]


def test_difficult_rows(spark, tmp_path):
    df = spark.createDataFrame(HARD, SCHEMA).repartition(3)
    for name in ("symbols", "d1", "d2", "plan", "audit", "n", "copy", "fault"):
        df = df.withColumn(name, F.lit(f"extra {name}"))
    found = {r.conv_id: r.asDict() for r in C.summaries(df, C.plans(df)).collect()}
    groups = {}
    for conv, turn, role, text in HARD:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert found.keys() == groups.keys()
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert {k: v for k, v in found[conv].items() if k != "conv_id"} == expected(rows), conv
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    query = {r.conv_id: r for r in QUERIES["op12_conversations"](spark, str(tmp_path)).collect()}
    assert query.keys() == groups.keys()


def test_repaired_rows_follow_the_audit(spark):
    df = spark.createDataFrame([(7, 1, "assistant", "Lost."), (7, 2, "user", "Why"), (7, 3, "user", "")], SCHEMA)
    found = C.plans(df)
    new = [(r.place, r.role, r.text) for r in C.repaired(df, found).orderBy("place").collect()]
    assert [r.audit for r in found.collect()] == ["IKKDI"] or new
    assert new == [(i, *x) for i, x in enumerate(plain(marked([(1, "assistant", "Lost."), (2, "user", "Why"), (3, "user", "")])[0])[2])]


def test_few_rules_change_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = C.damaged(df)
    some = C.plans(rows, most_rules=2).collect()
    assert sorted(map(str, some)) == sorted(map(str, C.plans(rows).collect()))


def test_a_conversation_that_loses_all_rows(spark, tmp_path):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    row, = QUERIES["op12_conversations"](spark, str(tmp_path)).collect()
    assert row.asDict() == dict(conv_id=lost, gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", repaired_sha256=hashlib.sha256(b"").hexdigest())


def test_one_conversation_with_all_rows(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(20_000)]
    found = C.plans(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.cost, r.audit) for r in found] == [(0, "K" * 20_000)]


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op12_conversations"](spark, str(tmp_path)).count() == 0
