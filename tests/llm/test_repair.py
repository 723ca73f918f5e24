"""Conversation repair: every sequence of edits on short conversations, spilled steps, edge cases, the query's SQL."""

import hashlib
import re

import duckdb
import pytest

from gleanery.llm import queries, repair

DATA = "/root/testdata/sf0.01"


def _fault(role, text, seen):
    end = text.rstrip(" \t\n\x0b\f\r")[-1:]
    return "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""


def _cheapest(rows):
    """All ways: (cost, audit, lines) of the best; rows are (role, text) in order."""
    best = [(3 * len(rows) + 1, "", [])]

    def go(i, roles, cost, audit, lines, seen):
        if cost > best[0][0]:
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", roles):
                best[0] = min(best[0], (cost, audit, lines))
        else:
            role, text = rows[i]
            fault = _fault(role, text, seen)
            late = fault == "truncated"
            after = seen | {(role, text)}
            go(i + 1, roles, cost + 3, audit + "D", lines, after)
            if fault in ("", "truncated"):
                go(i + 1, roles + (role[:1] or "-"), cost + late, audit + "K", [*lines, f"{role}:{text}"], after)
                for r in ("user", "assistant"):
                    go(i + 1, roles + r[0], cost + 2 + late, audit + "R", [*lines, f"{r}:{text}"], after)
        for r in ("user", "assistant"):
            go(i, roles + r[0], cost + 2, audit + "I", [*lines, f"{r}:"], seen)

    go(0, "", 0, "", [], frozenset())
    return best[0]


SHORT = {
    1: [("user", "hi."), ("assistant", "yes.")],
    2: [("assistant", "a."), ("user", "b."), ("user", "c.")],
    3: [("system", "s."), ("assistant", "a."), ("system", "t.")],
    4: [("user", "x"), ("user", "x"), ("assistant", " \t")],
    5: [("tool", "t."), ("", "e."), ("user", "u")],
    6: [("system", "s!"), ("user", "q?"), ("user", "q?"), ("assistant", "cut")],
    7: [("user", "")],
    8: [("assistant", "n"), ("assistant", "m."), ("system", "o?"), ("user", "p")],
    9: [("system", "only.")],
    10: [("user", "z.")],
}


@pytest.mark.parametrize("spill", [2, 1 << 20])
def test_cheapest_and_least(spark, spill):
    rows = [(c, i, role, text) for c, turns in SHORT.items() for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in repair.repair(df, spill_rows=spill).collect()}
    assert got.keys() == SHORT.keys()
    for c, turns in SHORT.items():
        cost, audit, lines = _cheapest(turns)
        assert (got[c].cost, got[c].audit) == (cost, audit), c
        assert got[c].repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest(), c
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
        assert got[c].illegal == sum(p not in ("su", "ua", "au") for p in pairs)


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, fault string, present boolean, cost int"
    rows = [
        (1, None, None, None, "x", "y", True, 1), (1, 5, "user", "a.", "x", "y", True, 1), (1, 5, "user", "a.", "x", "y", True, 1), (1, 9, "assistant", "b", "x", "y", True, 1),
        (None, 1, "user", "q.", "x", "y", True, 1), (2, 1, "user", "gone.", "x", "y", False, 1), (3, None, "user", "only.", "x", "y", True, 1), (4, 1, "user", "kept?", "x", "y", None, 1),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in repair.repair(df, present="present").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got[2])[1:] == tuple(got[4])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert (got[1].gaps, got[1].blank, got[1].duplicate, got[1].truncated) == (3, 1, 1, 1)
    assert got[1].audit == "DKDK" and got[1].cost == 7
    assert got[None].audit == got[3].audit == "KI" and got[3].gaps == 0
    assert repair.repair(df.limit(0)).count() == 0
    assert repair.damage(df).columns == ["conv_id", "turn", "role", "text", "present"]


def test_a_giant_conversation_spills(spark):
    df = spark.range(30_000).selectExpr("id % 3 - id % 3 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn ', id, '.') AS text")
    kept, spilled = (repair.repair(df, spill_rows=n).first() for n in (1 << 20, 777))
    assert kept == spilled and kept.audit == "K" * 30_000 and kept.cost == 0
    text = "\n".join(f"{'assistant' if i % 2 else 'user'}:turn {i}." for i in range(30_000))
    assert kept.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_query_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    want = con.sql(repair.oracle_sql())
    got = queries.op13_streamed_repair(spark, DATA)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())
