"""Conversation repair against a search over all edits, and against SQL on damaged tables."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest

from signalroot.llm import conversation_repair as C

LEGAL = re.compile(r"(s?(ua)+)?")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, list[str]]:
    """(cost, audit, repaired lines) by Dijkstra over (cost, audit): every edit of every row (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while True:
        cost, audit, k, initials, lines = heapq.heappop(heap)
        if k == len(rows) and LEGAL.fullmatch(initials):
            return cost, audit, list(lines)
        if (k, initials[-2:], audit[-4:].count("I")) in seen and len(audit) > 40:
            continue
        seen.add((k, initials[-2:], audit[-4:].count("I")))
        if not re.fullmatch(r"s?(ua)*u?", initials):
            continue
        if audit[-3:] != "III":
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, audit + "I", k, initials + role[0], (*lines, f"{role}:")))
        if k < len(rows):
            role, text, fault = rows[k]
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, initials, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + more, audit + "K", k + 1, initials + (role[:1] or "?"), (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", k + 1, initials + new[0], (*lines, f"{new}:{text}")))


def judged(rows: list[tuple]) -> dict:
    """The result of one conversation's rows (turn, role, text, copy) after damage, by plain loops."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode(), r[3]))
    faults, met = [], set()
    for _, role, text, _ in rows:
        solid = SOLID.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in met else "truncated" if solid[-1] not in ".!?" else "")
        met.add((role, text))
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit, lines = cheapest([(r[1], r[2], f) for r, f in zip(rows, faults)])
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def after_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        say = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [] if kind == 0 else [(turn, role, text, c) for c in range(1 + (kind == 3))]
    return found


def tables() -> list[tuple]:
    rng = random.Random(11)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "unit", None, ""]
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t", None, "Ça va ?  ", "x\x0b", "a\nb."]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 8)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None, 2 * turn]), rng.choice(roles), rng.choice(texts)))
    rows += [(None, t, r, "Hm.") for t, r in ((0, "user"), (1, "assistant"), (None, None))]
    rows += [(900, 0, "user", "Same.")] * 3 + [(901, None, "user", "A."), (901, None, "assistant", "B.")]
    dropped = [(c, 0, "user", "Gone.") for c in range(10_000, 10_400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return rows + dropped[:3]


COLUMNS = "conv_id long, turn long, role string, text string, nth int, audit string, kind string, copy int, symbol int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 1, 2) for r in rows], COLUMNS)


def test_every_signature_up_to_four_rows():
    """The trie's answers, in sorted order, against the search over all edits."""
    kinds = {"s": ("system", ""), "u": ("user", ""), "a": ("assistant", ""), "x": ("tool", ""), "U": ("user", "truncated"), "S": ("system", "truncated"), "-": ("user", "blank")}
    trie = C.Trie()
    signatures = sorted("".join(s) for n in range(5) for s in itertools.product(kinds, repeat=n))
    for signature in signatures:
        rows = [(kinds[s][0], "t", kinds[s][1]) for s in reversed(signature)]
        assert trie.solve(signature) == cheapest(rows)[:2], signature
    assert trie.made == len(signatures) - 1  # a layer for each node, once


def test_longer_signatures_in_any_order():
    rng = random.Random(4)
    trie = C.Trie()
    back = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for _ in range(60):
        signature = "".join(rng.choice("suaxSUA-") for _ in range(rng.randrange(5, 9)))
        rows = [(back.get(s.lower(), "user"), "t", "blank" if s == "-" else "truncated" if s.isupper() else "") for s in reversed(signature)]
        assert trie.solve(signature) == cheapest(rows)[:2], signature


def test_long_conversations_take_linear_time():
    cost, audit = C.Trie().solve("au" * 150_000)
    assert cost == 0 and audit == "K" * 300_000
    cost, audit = C.Trie().solve("u" * 100_000)
    assert cost == 2 * 50_000 and len(audit) == 100_000


@pytest.fixture(scope="module")
def got(spark):
    return {r.conv_id: r.asDict() for r in C.conversation_repair(frame(spark, tables())).collect()}


def test_awkward_conversations(got):
    want = {conv: {"conv_id": conv} | judged(rows) for conv, rows in after_damage(tables()).items()}
    assert got.keys() == want.keys()
    for conv, row in want.items():
        assert got[conv] == row, conv


def test_awkward_conversations_in_sql(got):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", tables())
    found = con.execute(C.ORACLE)
    names = [c[0] for c in found.description]
    assert {r[0]: dict(zip(names, r)) for r in found.fetchall()} == got


def test_a_conversation_with_most_rows_and_a_long_text(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Row {t}.") for t in range(30_000)] + [(2, 0, "user", "long " * 200_000 + "."), (2, 1, "assistant", "ok.")]
    whole = {r.conv_id: r for r in C.conversation_repair(frame(spark, rows)).collect()}
    after = after_damage(rows)
    assert whole[2].repaired_sha256 == judged(after[2])["repaired_sha256"]
    mine = after[1]
    assert whole[1].gaps == 30_000 - len({r[0] for r in mine}) - (29_999 - max(r[0] for r in mine)) - min(r[0] for r in mine)
    assert len(whole[1].audit.replace("I", "")) == len(mine)


def test_repaired_rows(spark):
    rows = [(1, 3, "assistant", "Hi."), (1, 1, "user", "Hello."), (1, 2, "user", "There?"), (2, 0, "tool", "x."), (3, 0, None, None), (None, 5, "user", "Q?"), (None, 6, "assistant", "A.")]
    found = sorted(map(tuple, C.repair(frame(spark, rows)).collect()), key=str)
    assert found == sorted([(1, 0, "user", "Hello."), (1, 1, "assistant", ""), (1, 2, "user", "There?"), (1, 3, "assistant", "Hi."), (None, 0, "user", "Q?"), (None, 1, "assistant", "A.")], key=str)


def test_empty_table(spark):
    assert C.conversation_repair(frame(spark, []).limit(0)).collect() == [] and C.repair(frame(spark, [])).collect() == []
