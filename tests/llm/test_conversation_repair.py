from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from orderflow.llm import conversation_repair as cr
from orderflow.llm.common import table

LEGAL = re.compile(r"(s?(ua)+)?")
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def cheapest(rows, costs=cr.Costs()):  # noqa: B008
    """Costs, letters and lines of the least cheapest edits, by shortest paths over all states.

    ``rows`` has (role, text, must go, truncated); a state is what may have been written.
    """
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def insert(states):
        for _ in range(3):
            for last, (cost, letters, out) in list(states.items()):
                for new in follow[last].replace("s", ""):
                    name = {"u": "user", "a": "assistant"}[new]
                    way = (cost + costs.insert, letters + "I", (*out, name + ":"))
                    if new not in states or way[:2] < states[new][:2]:
                        states[new] = way
        return states

    for role, text, gone, cut in rows:
        after = {}
        for last, (cost, letters, out) in insert(dict(best)).items():
            ways = [(last, cost + costs.delete, "D", out)]
            if not gone:
                extra = cost + costs.truncated * cut
                if role[:1] and role[:1] in follow[last]:
                    ways.append((role[:1], extra, "K", (*out, f"{role}:{text}")))
                for new in follow[last].replace("s", ""):
                    name = {"u": "user", "a": "assistant"}[new]
                    ways.append((new, extra + costs.rerole, "R", (*out, f"{name}:{text}")))
            for new, c, letter, lines in ways:
                way = (c, letters + letter, lines)
                if new not in after or way[:2] < after[new][:2]:
                    after[new] = way
        best = after
    best = insert(best)
    return min(best[last] for last in ("", "a") if last in best)


def brute(rows):
    """The expected row of one conversation from its (turn, role, text) in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    marked, seen, counts = [], set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = None
        if not end:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif end[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(marked)]
    turns = {t for t, _, _ in rows if t is not None}
    cost, letters, out = cheapest(marked)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **counts,
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": letters,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def found(spark, rows):
    frame = spark.createDataFrame(
        [(*row, "x", 7) for row in rows],
        "conv_id bigint, turn bigint, role string, text string, place string, n int",
    )
    faults, repaired = cr.repair(frame)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in cr.digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {
        r["conv_id"]: {k: r[k] for k in FIELDS} | {"repaired_sha256": digests.get(r["conv_id"], empty)}
        for r in faults.collect()
    }


@pytest.mark.parametrize("costs", [cr.Costs(), cr.Costs(rerole=4, delete=9, insert=1, truncated=3)])
def test_tables_give_the_least_cheapest_letters(costs):
    tables = cr.BlockTables(costs)
    chance = random.Random(5)
    for length in [0, 1, 2, 3, *[chance.randrange(4, 19) for _ in range(400)]]:
        rows = [(chance.choice("suax"), "t", False, chance.random() < 0.2) for _ in range(length)]
        symbols = [2 * (cr.ROLE_CLASSES + "x").index(r[0]) + r[3] for r in rows]
        letters, cost, q = tables.trace(symbols, tables.end[0], cr.START)
        tail, more = tables.tail(q)
        want = cheapest(rows, costs)
        assert (cost + more, "".join(letters) + tail) == want[:2]
        vector, total = tables.pull(tables.end[0], tables.blocks(symbols))
        assert tables.vectors[vector][cr.START] + total == want[0]


def test_a_piece_acts_as_its_matrix():
    tables, chance = cr.BlockTables(cr.Costs()), random.Random(3)
    for _ in range(50):
        symbols = [chance.randrange(8) for _ in range(chance.randrange(1, 30))]
        cut = chance.randrange(len(symbols) + 1)
        vector = tables.vectors[tables.end[0]]
        for part in (symbols[cut:], symbols[:cut]):
            m = tables.matrix(part)
            vector = [min(m[4 * q + k] + vector[k] for k in range(4)) for q in range(4)]
        number, total = tables.pull(tables.end[0], tables.blocks(symbols))
        assert [v + total for v in tables.vectors[number]] == list(vector)


def test_conversations_agree_with_brute_force(spark):
    chance, rows = random.Random(1), []
    for conv in [None, *range(40)]:
        turns = sorted(chance.sample(range(-5, 60), chance.randrange(1, 30)))
        for turn in turns:
            role = chance.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = chance.choice(["Yes.", "No!", "Why? ", "cut off", "", " \t\n", None, f"Text {turn}.", "é"])
            rows.append((conv, turn, role, text))
    wanted = {}
    for conv in [None, *range(40)]:
        wanted[conv] = brute([r[1:] for r in rows if r[0] == conv])
    chance.shuffle(rows)
    assert found(spark, rows) == wanted


def test_a_conversation_over_many_pieces(spark):
    """More rows than a batch has: pieces meet within the conversation."""
    chance = random.Random(2)
    rows = [
        (7, turn, chance.choice(["user", "assistant", "system"]), f"T{chance.randrange(3000)}" + chance.choice(["", ".", "."]))
        for turn in range(4500)
    ]
    assert found(spark, rows) == {7: brute([r[1:] for r in rows])}


def test_ties_repeats_and_null_turns(spark):
    rows = [(1, None, "user", "Hi."), (1, 3, "user", "Hi."), (1, 3, "assistant", "Yes."), (1, 3, "assistant", "Yes.")]
    rows += [(2, None, "user", "a" * 200_000 + ".")]
    rows += [(3, 2**63 - 1, "user", "x."), (3, -(2**63), "user", "y.")]
    got = found(spark, rows)
    # Rows of one turn: by role, then by hash.
    order = [rows[0], rows[2], rows[3], rows[1]]
    assert got[1] == brute([r[1:] for r in order])
    assert got[2]["gaps"] == 0 and got[2]["audit"] == "D"
    # A span beyond 64 bits has no number of gaps.
    assert got[3]["gaps"] is None and got[3]["audit"] == "KR"


def test_repaired_rows_are_legal(spark, sf_dir):
    faults, repaired = cr.repair(table(spark, sf_dir, "conversations"))
    rows = repaired.collect()
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert all(LEGAL.fullmatch("".join(roles)) for roles in by.values())
    assert faults.count() >= len(by) > 0


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_query_agrees_with_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").collect()
    after = {r["conv_id"]: [] for r in rows}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        fault = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role, text = r["role"], r["text"]
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        copies = 0 if fault == 0 else 2 if fault == 3 else 1
        after[r["conv_id"]] += [(r["turn"], "user" if fault == 4 else role, text)] * copies
    got = registry.queries()["op11_repair"](spark, sf_dir).collect()
    assert {r["conv_id"]: {k: r[k] for k in (*FIELDS, "repaired_sha256")} for r in got} == {
        conv: brute(rows) for conv, rows in after.items()
    }


def test_query_without_rows_after_damage(spark, tmp_path):
    lost = [k for k in range(400) if zlib.crc32(f"{k}:1".encode()) % 20 == 0]
    frame = spark.createDataFrame([(k, 1, "user", "Hi.") for k in lost], "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumn("hash", F.lit(1))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    for row in registry.queries()["op11_repair"](spark, str(tmp_path)).collect():
        assert tuple(row[k] for k in FIELDS) == (0, 0, 0, 0, 0, 0, "")
        assert row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
