"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(signs):
    """Least (cost, audit) over all edits, by a search in order of cost and letters."""
    heap, after = [(0, "", 0, "start")], {"start": "user", "s": "user", "u": "assistant", "a": "user"}
    while True:
        cost, audit, at, state = heapq.heappop(heap)
        if at == len(signs) and state in ("start", "a"):
            return cost, audit
        wanted = after[state]
        if cost < 40:
            heapq.heappush(heap, (cost + 2, audit + "I", at, wanted[0]))
        if at < len(signs):
            sign, must_go, cut = signs[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state))
            if not must_go:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", at + 1, wanted[0]))
                if sign == wanted[0] or (sign == "s" and state == "start"):
                    heapq.heappush(heap, (cost + cut, audit + "K", at + 1, sign))


def plain(rows, damaged):
    result = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        signs, seen, count = [], set(), dict.fromkeys("bdt", 0)
        for _, _, role, text in mine:
            body = text.rstrip(BLANKS)
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
            seen.add((role, text))
            signs.append((role[:1], fault in "bd", fault == "t"))
            if fault != "-":
                count[fault] += 1
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
        cost, audit = cheapest(signs)
        out, at, state = [], 0, None
        for letter in audit:
            wanted = "assistant" if state == "user" else "user"
            if letter == "I":
                out.append((wanted, ""))
            elif letter == "K":
                out.append(mine[at][2:])
            elif letter == "R":
                out.append((wanted, mine[at][3]))
            if letter != "D":
                state = {"u": "user", "a": "assistant", "s": "system"}[out[-1][0][0]]
            at += letter != "I"
        text = "\n".join(f"{r}:{t}" for r, t in out)
        result[conv] = (gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def as_dict(frame):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
            for r in frame.collect()}


def conversations(seed, n=60):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No", "What?", " \t", "", None, "Long text with an end. ", "é!\n", "no end: \x0b"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_a_plain_search(spark, seed):
    rows = conversations(seed) + [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (None, 1, "assistant", "B.")]
    frame = repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert as_dict(repair.repaired_digests(frame, copies="copies")) == plain(rows, damage(rows))


def test_repaired_rows_are_what_the_digest_says(spark):
    rows = conversations(3, 40)
    frame = spark.createDataFrame(rows, SCHEMA)
    digests, texts = as_dict(repair.repaired_digests(frame)), {}
    for r in sorted(repair.repaired_messages(frame).collect(), key=lambda r: (r["conv_id"], r["position"])):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, row in digests.items():
        assert row[-1] == hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest()
        roles = "".join(t[0] for t in texts.get(conv, []))
        assert roles.removeprefix("s").replace("ua", "") == "" and roles != "s"


def test_conversation_without_rows_empty_table_and_clashing_columns(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = repair.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))
    assert as_dict(repair.repaired_digests(frame, copies="copies")) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repaired_digests(none).count() == 0 and repair.repaired_messages(none).count() == 0
    clash = spark.createDataFrame(conversations(4, 10), SCHEMA)
    more = clash
    for name in ("copies", "digest", "audit", "part", "signature", "cost", "n", "seen", "position"):
        more = more.withColumn(name, F.lit("7"))
    assert as_dict(repair.repaired_digests(more)) == as_dict(repair.repaired_digests(clash))


def test_long_conversation_and_text(spark):
    rows = [(5, i, "user" if i % 2 else "assistant", "same." if i % 3 else f"{i}. " + "word " * 2000 + ".") for i in range(3000)]
    got = as_dict(repair.repaired_digests(spark.createDataFrame(rows, SCHEMA)))[5]
    seen, expect = set(), 0
    for r in rows:
        expect += r[2:] in seen
        seen.add(r[2:])
    assert got[2] == expect and len(got[6]) >= 3000


def test_automaton_shares_suffixes():
    automaton = repair.Automaton()
    a = automaton.node("uaua"[::-1])
    size = len(automaton.sign)
    b = automaton.node("xuaua"[::-1])
    assert len(automaton.sign) == size + 1 and automaton.next[b] == a
    assert automaton.audit(a) == "KKKK" and automaton.audit(b) == "DKKKK" and automaton.cost[b][0] == 3
