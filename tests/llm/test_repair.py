"""Conversation repair against every sequence of edits (tiny) and a plain row-by-row search (any size)."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quern.llm import repair
from quern.llm.q_repair import damaged, op13_repair

GOOD = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        signs = WORD.findall(text)
        out.append("blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_edit(rows):
    """(cost, audit, repaired) by trying all edits, with up to two inserted rows at each place."""
    faulty, best = faults(rows), None
    inserts = [list(p) for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]
    edits = []
    for (_, role, text), fault in zip(rows, faulty):
        more = 5 if fault == "truncated" else 0
        can = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            can += [("K", more, (role, text)), ("R", 1 + more, ("user", text)), ("R", 1 + more, ("assistant", text))]
        edits.append(can)
    for chosen in itertools.product(*edits):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            out, audit, cost = [], "", 0
            for i in range(len(rows) + 1):
                out += [(r, "") for r in put[i]]
                audit, cost = audit + "I" * len(put[i]), cost + 5 * len(put[i])
                if i < len(rows):
                    letter, price, made = chosen[i]
                    audit, cost = audit + letter, cost + price
                    out += [made] if made else []
            if GOOD.fullmatch("".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


def search(rows):
    """The same by a search over rows and states."""
    move = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                to = move[state]
                made = (cost + 5, audit + "I", out + [(names[to], "")])
                if to not in best or made[:2] < best[to][:2]:
                    best[to] = made
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults(rows)):
        then = {}
        for state, (cost, audit, out) in inserted(best).items():
            more = 5 if fault == "truncated" else 0
            can = [(state, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                can.append((move[state], (cost + 1 + more, audit + "R", out + [(names[move[state]], text)])))
                initial = role[:1]
                if initial and (initial == move[state] or initial == "s" and state == ""):
                    can.append((initial, (cost + more, audit + "K", out + [(role, text)])))
            for to, made in can:
                if to not in then or made[:2] < then[to][:2]:
                    then[to] = made
        best = then
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def brute(rows):
    """What a conversation's (turn, role, text) rows should give."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    turns, kinds = [t for t, _, _ in rows if t is not None], faults(rows)
    cost, audit, out = search(rows)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def damage(rows):
    """{conv: rows after damage} of (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        here = out.setdefault(conv, [])
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        here += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def compare(found, conversations):
    assert sorted(str(r.conv_id) for r in found) == sorted(map(str, conversations))
    for r in found:
        want = brute(conversations[r.conv_id])
        assert {k: r[k] for k in want} == want, r.conv_id


def test_search_is_every_edit():
    rng = random.Random(4)
    texts = ["", "Hi", "Yes.", "No.", "Ok!"]
    for _ in range(60):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(texts)) for i in range(rng.randrange(4))]
        assert search(rows) == every_edit(rows)


def solve(rows):
    """The operator's own pieces, without Spark."""
    part = repair.Part("c", 0, 0)
    for (turn, role, text), fault in zip(rows, faults(rows)):
        part.add(turn, role, fault == "blank", bool(text) and text[-1] not in ".!?", 1, None if fault in ("blank", "duplicate") else text)
    return repair.solved(part.row(True) | {"entry": 0, "ends": repair.FINAL, "last": True})[0]


@pytest.mark.parametrize("kinds", [["user"], ["assistant", "user"], ["system", "user", "assistant", "tool"], ["tool", ""]])
def test_runs_against_search(kinds):
    rng = random.Random(len(kinds))
    for size in [1, 2, 3, 7, 8, 9, 31, 33, 70, 200]:
        for stay in (0.0, 0.7, 0.95):
            rows, role, cut = [], rng.choice(kinds), rng.random() < 0.5
            for i in range(size):
                if rng.random() > stay:
                    role, cut = rng.choice(kinds), rng.random() < 0.4
                rows.append((i, role, rng.choice(["", f"t{i}", "same."]) if rng.random() < 0.2 else f"t{i}" + ("" if cut else ".")))
            found, (cost, audit, out) = solve(rows), search(rows)
            assert (found["cost"], found["audit"], list(zip(found["roles"], found["texts"]))) == (cost, audit, out)


def test_long_runs():
    rows = [(i, "user", f"t{i}.") for i in range(3 * repair.BLOCK + 5)]
    found = solve(rows)
    assert len(found["audit"]) >= len(rows) and found["cost"] == sum({"K": 0, "R": 1, "D": 2, "I": 5}[x] for x in found["audit"])
    assert GOOD.fullmatch("".join(r[0] for r in found["roles"])) and found["cost"] == (len(rows) + 1) // 2 + 1
    assert repair.before(3, 10**15, repair.FINAL)[0] == 10**15 // 2


def test_whole_table(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    compare(op13_repair(spark, sf).collect(), damage(rows))


def test_conversations_of_many_parts(spark):
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice([f"Line {i}.", f"line {i}", "again.", " "])) for i in range(900)]
    rows += [(2, None, "user", "same.")] * 500 + [(c, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for c in range(3, 60) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = repair.parts(damaged(df), absent="absent", most_runs=20)
        assert cut.where("conv = 1").count() > 10 and cut.where("conv = 1").agg(F.count_distinct("part")).first()[0] > 1
        found = repair.summaries(repair.repaired(cut)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    compare(found, damage(rows))


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, 5, "", "x"), (1, 5, "user", "Ok."), (1, 5, "user", "No."), (1, 5, "user", "Ok."), (2, 0, "system", "s" * 3_000_000), (2, 1, "\U0001f600", "é.")]
    rows += [(3, -7, "user", " "), (3, 9, "User", "Hm. \t\n"), (4, 2, None, "t.")] + [(5, t, "user", "\x0b\x0c") for t in range(3)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, Conv string")
    compare(repair.summaries(repair.repaired(repair.parts(damaged(df), absent="absent"))).collect(), damage(rows))
    told = repair.repaired(repair.parts(df))
    assert repair.messages(told).where("conv = 1").count() == 2
    assert repair.repair(df.limit(0)).count() == 0
    gone = spark.createDataFrame([(7, 1, "user", "a.", True)], "conv_id long, turn long, role string, text string, absent boolean")
    r = repair.repair(gone, absent="absent").first()
    assert (r.gaps, r.cost, r.audit, r.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())
