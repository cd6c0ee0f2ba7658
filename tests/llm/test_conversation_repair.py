"""Repair of conversations against a brute-force search, at every length of run and on odd rows."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from gistmill.llm import conversation_repair as cr
from gistmill.llm import queries

SMALL = "/root/testdata/sf0.001"
sys.setrecursionlimit(50_000)
FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute(rows):
    """Least (cost, audit) of (initial, must go, truncated) rows, by the least rest from every place."""

    @lru_cache(None)
    def rest(i, last, inserted):
        found = []
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, ""))
        else:
            initial, must_go, late = rows[i]

            def then(cost, letter, last):
                more = rest(i + 1, last, 0)
                if more:
                    found.append((cost + more[0], letter + more[1]))

            then(3, "D", last)
            if not must_go:
                if initial and initial in FOLLOW[last]:
                    then(late, "K", initial)
                for role in "ua":
                    if role in FOLLOW[last]:
                        then(2 + late, "R", role)
        if inserted < 3:
            for role in "ua":
                if role in FOLLOW[last] and (more := rest(i, role, inserted + 1)):
                    found.append((2 + more[0], "I" + more[1]))
        return min(found, default=None)

    return rest(0, "", 0)


@pytest.mark.parametrize("run", [1, 3, 50])
def test_cheapest_audit_as_by_brute_force(run):
    rng = random.Random(run)
    for _ in range(400):
        rows = [(rng.choice("ssuuaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(12))]
        cut = [rows[i:i + run] for i in range(0, len(rows), run)]
        assert cr.cheapest([(cr.run_matrix(x), len(x)) for x in cut]) == brute(tuple(rows)), rows


def expected(source, damage=True):
    """Every conversation's report from plain rows (conv_id, turn, role, text)."""
    fill = lambda x: " " if x is None else str(x)
    out = {}
    for conv in {r[0] for r in source}:
        rows = []
        for c, turn, role, text in source:
            if c != conv:
                continue
            role, text = fill(role), fill(text)
            code = zlib.crc32(f"{fill(c)}:{fill(turn)}".encode()) % 20 if damage else 9
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            rows += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            shown = re.sub("[ \t-\r]", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                          else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        best = brute(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)))
        turns, i, repaired = {r[0] for r in rows if r[0] is not None}, 0, []
        for letter in best[1]:
            nxt = "assistant" if repaired and repaired[-1][0][:1] == "u" else "user"
            if letter == "I":
                repaired.append((nxt, ""))
            else:
                if letter != "D":
                    repaired.append((rows[i][1] if letter == "K" else nxt, rows[i][2]))
                i += 1
        assert i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[0][:1] for r in repaired))
        initials = [r[1][:1] for r in rows]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), *best,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def reported(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_query_as_by_brute_force(spark):
    source = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert reported(got) == expected(source)


def odd_rows():
    rng = random.Random(5)
    source = [(None, None, None, None), (None, 1, "user", "Yes."), (1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 4, "", ""),
              (1, 4, "assistant", " \t\x0b"), (2, 1, "system", "x" * 300_000), (2, 9, "tool", "Ok."), (3, 5, "user", None),
              (4, 1, "system", "Be kind."), (4, 1, "assistant", "été!"), (4, -3, "umpire", "Play. ")]
    # one conversation holds most rows, with many repeats and ties of turn
    source += [(7, rng.choice([None, *range(700)]), rng.choice(["user", "assistant", "system", "tool"]),
                rng.choice(["Yes.", "No", "", "What?", f"Row {i}."])) for i in range(1500)]
    return source


@pytest.mark.parametrize("damage", [True, False])
def test_odd_rows_and_a_hot_conversation(spark, damage):
    source = odd_rows()
    df = spark.createDataFrame([(*r, "x", None) for r in source],
                               "conv_id bigint, turn bigint, role string, text string, audit string, n bigint").repartition(5)
    got = reported(cr.repair_report(df, cr.damaged(df) if damage else None))
    want = expected(source, damage)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_repaired_turns_alternate(spark):
    df = spark.createDataFrame(odd_rows(), "conv_id bigint, turn bigint, role string, text string")
    rows = cr.repaired_turns(df).orderBy("conv_id", "position").collect()
    digests = reported(cr.repair_report(df))
    for conv in digests:
        own = [r for r in rows if r.conv_id == conv]
        assert [r.position for r in own] == list(range(len(own)))
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv][-1]
        assert "".join(r.edit for r in own) == digests[conv][-2].replace("D", "")


def test_empty_table_and_lost_conversation(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    none = spark.createDataFrame([], schema)
    assert cr.repair_report(none, cr.damaged(none)).collect() == [] and cr.repaired_turns(none).collect() == []
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    lost = spark.createDataFrame([(1, turn, "user", "Hi.")], schema)
    assert reported(cr.repair_report(lost, cr.damaged(lost))) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
