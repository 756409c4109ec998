"""Conversation structure repair: cheapest edits by a DP shared over a trie of signatures.

A row's symbol is its role's initial and its fault; a conversation's signature
is its symbols, last row first. Signatures come sorted, so each goes into the
trie along the path of the one before, and only that path is kept: a node's DP
layer (the cost from each state to a legal end, over the rows that its path
spells) is computed once for all conversations that share it. At the node where
a signature ends, the edits are read off the layers from the first row on, the
smallest letter that keeps the cost first; letters of unlike edits differ, so
that gives the least of the cheapest audits in time linear in the rows.

Rows are dealt by conversation and sorted, twice: once to judge them, once to
apply the edits and hash the result, which SHA-256 takes in order. Tasks read
them as streams; of a conversation they hold a byte a row, the size of its
audit. Signatures are dealt by signature and conversation, so one that very many
conversations share is split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import Scratch

#: Costs of the edits; a truncated row that stays adds one.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: The white space of a text, as a trim takes it.
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after a system, a user, an assistant row; the state that another user or assistant row leads to.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_OFF = 1 << 60
#: Costs where no row is left.
_END = (0, 2 * INSERT, INSERT, 0)
#: Rows for a task, and bytes of texts in a batch that goes out.
ROWS, BATCH_BYTES = 200_000, 1 << 20


def _kept(symbol: str, state: int) -> int | None:
    """The state after a row that keeps its role, None if that is illegal there."""
    if symbol == "s":
        return _SYSTEM if state == _START else None
    to = _NEXT[state]
    return to if symbol == ("u" if to == _USER else "a") else None


def _choices(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of what a row may undergo, by letter. `-` must go; capitals are truncated."""
    found = [("D", DELETE, state)]
    if symbol != "-":
        more = TRUNCATED * symbol.isupper()
        to = _kept(symbol.lower(), state)
        if to is not None:
            found.append(("K", more, to))
        found.append(("R", REROLE + more, _NEXT[state]))
    return found


_MOVES = {symbol: [_choices(symbol, state) for state in range(4)] for symbol in "suaxSUAX-"}


def layer(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from each state before a row, given those behind it; inserts in front count."""
    at = [min(cost + after[to] for _, cost, to in moves) for moves in _MOVES[symbol]]
    user, assistant = min(at[_USER], INSERT + at[_ASSISTANT]), min(at[_ASSISTANT], INSERT + at[_USER])
    return min(at[_START], INSERT + user), min(at[_SYSTEM], INSERT + user), user, assistant


class Trie:
    """The path of the last signature, with its layers, and what it came to."""

    def __init__(self):
        self.signature, self.layers, self.answer = None, [_END], (0, "")
        self.made = 0  # layers computed

    def solve(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of a signature that sorts behind the last one, or anywhere: order only saves work."""
        if signature == self.signature:
            return self.answer
        old, n = self.signature or "", 0
        for a, b in zip(old, signature):
            if a != b:
                break
            n += 1
        del self.layers[n + 1 :]
        for symbol in signature[n:]:
            self.layers.append(layer(symbol, self.layers[-1]))
        self.made += len(signature) - n
        self.signature, self.answer = signature, (self.layers[-1][_START], self._audit(signature))
        return self.answer

    def _audit(self, signature: str) -> str:
        letters, state = [], _START
        for k in range(len(signature), 0, -1):
            here, after = self.layers[k], self.layers[k - 1]
            while True:
                letter, to = next((x, s) for x, s in self._cheapest(signature[k - 1], state, here, after))
                letters.append(letter)
                state = to
                if letter != "I":
                    break
        while _END[state]:
            letters.append("I")
            state = _NEXT[state]
        return "".join(letters)

    @staticmethod
    def _cheapest(symbol: str, state: int, here: tuple[int, ...], after: tuple[int, ...]) -> Iterator[tuple[str, int]]:
        """Edits that keep to the cheapest cost, by letter."""
        delete, *stay = _MOVES[symbol][state]
        if DELETE + after[state] == here[state]:
            yield delete[0], state
        if INSERT + here[_NEXT[state]] == here[state]:
            yield "I", _NEXT[state]
        for letter, cost, to in stay:
            if cost + after[to] == here[state]:
                yield letter, to


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): a null role or text is one space."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *texts, F.lit(0).alias("copy"))


def damaged(conversations: DataFrame) -> DataFrame:
    """`rows_of` after damage by crc32(`conv_id:turn`) mod 20, a null there being one space.

    0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` from it, 3 repeats it, 4 makes it the user's.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows_of(conversations).withColumn("kind", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).filter("kind != 0")
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def examined(rows: DataFrame) -> DataFrame:
    """(conv_id, nth, turn, role, text, symbol, blank, duplicate, truncated, illegal, new_turn) of each row.

    A conversation's rows are counted by turn, nulls first; rows of one turn by
    role, then text. Of its faults a row has the first.
    """
    spread = rows.repartition(common.partitions(rows.sparkSession, rows.count(), ROWS), "conv_id")
    turn = F.col("turn").asc_nulls_first()
    order = Window.partitionBy("conv_id").orderBy(turn, "role", "text", "copy", "again")  # of equal rows the first is no repeat
    same = Window.partitionBy("conv_id", "role", "text").orderBy(turn, "copy")
    body = F.rtrim("text", F.lit(SPACE))
    rows = spread.withColumn("again", F.row_number().over(same) > 1)
    rows = rows.withColumns({"nth": F.row_number().over(order).cast("long"), "before": F.lag("role").over(order), "turn_before": F.lag("turn").over(order), "body": body})
    initial = lambda c: F.substring(c, 1, 1)
    blank, seen = F.col("body") == "", F.col("again")
    cut = ~blank & ~seen & ~F.right("body", F.lit(1)).isin(".", "!", "?")
    role = F.when(initial("role").isin("s", "u", "a"), initial("role")).otherwise("x")
    return rows.select(
        "conv_id", "nth", "turn", "role", "text", F.when(blank | seen, "-").when(cut, F.upper(role)).otherwise(role).alias("symbol"),
        blank.alias("blank"), (seen & ~blank).alias("duplicate"), cut.alias("truncated"),
        (F.col("before").isNotNull() & ~F.concat(initial("before"), initial("role")).isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"),
    )


_FLAGS = ("blank", "duplicate", "truncated", "illegal")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[object, int, int]]:
    """(conv_id, first row, row behind) of the runs of a sorted batch."""
    ids = batch.column("conv_id").to_pylist()
    at = 0
    for key, run in groupby(ids):
        n = sum(1 for _ in run)
        yield key, at, at + n
        at += n


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation out of its sorted rows: signature, gaps and faults."""
    names = ["conv_id", "signature", "gaps", *_FLAGS]
    key, held, parts = None, None, []

    def closed():
        gaps = held["high"] - held["low"] + 1 - held["turns"] if held["turns"] else 0
        return [key, "".join(parts)[::-1], gaps, *(held[f] for f in _FLAGS)]

    kind = None
    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        symbols, turns, new = (batch.column(c).to_pylist() for c in ("symbol", "turn", "new_turn"))
        flags = {f: batch.column(f).to_pylist() for f in _FLAGS}
        for one, lo, hi in _runs(batch):
            if held is None or one != key:
                if held is not None:
                    done.append(closed())
                key, parts, held = one, [], dict.fromkeys((*_FLAGS, "turns", "low", "high"), 0)
            for k in range(lo, hi):
                if new[k]:  # turns ascend
                    held["low"] = turns[k] if not held["turns"] else held["low"]
                    held["high"] = turns[k]
                    held["turns"] += 1
            parts.append("".join(s for s in symbols[lo:hi] if s))
            for f in _FLAGS:
                held[f] += sum(1 for x in flags[f][lo:hi] if x)
        if done:
            yield _batch(done, names, kind)
    if held is not None:
        yield _batch([closed()], names, kind)


def _batch(rows: list[list], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    types = {"conv_id": kind, "signature": pa.string(), "audit": pa.string(), "repaired_sha256": pa.string(), "role": pa.string(), "text": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(values, types.get(n, pa.int64())) for n, values in zip(names, zip(*rows))], names)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Trie()
    for batch in batches:
        answers = [trie.solve(s) for s in batch.column("signature").to_pylist()]
        cost, audit = pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers], pa.string())
        keep = [n for n in batch.schema.names if n != "signature"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), cost, audit], [*keep, "cost", "audit"])


def planned(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation; `rows` are `examined`."""
    spark, kind = rows.sparkSession, rows.schema["conv_id"].dataType.simpleString()
    narrow = rows.select("conv_id", "nth", "turn", "symbol", *_FLAGS, "new_turn")
    ids = conversations.select("conv_id").distinct()  # those that damage left no row of count too
    none = {f: F.lit(False) for f in (*_FLAGS, "new_turn")} | {"nth": F.lit(0).cast("long"), "turn": F.lit(None).cast("long"), "symbol": F.lit("")}
    n = common.partitions(spark, rows.count(), ROWS)
    dealt = narrow.unionByName(ids.withColumns(none)).repartition(n, "conv_id").sortWithinPartitions("conv_id", "nth")
    counts = ", ".join(f"{c} long" for c in ("gaps", *_FLAGS))
    signed = Scratch(spark).table(dealt.mapInArrow(_signed, f"conv_id {kind}, signature string, {counts}"), "signed")
    by_signature = signed.repartitionByRange(n, "signature", "conv_id").sortWithinPartitions("signature")
    return by_signature.mapInArrow(_solved, f"conv_id {kind}, {counts}, cost long, audit string")


class _Script:
    """Applies an audit to the rows of one conversation as they come."""

    def __init__(self, key, audit: str):
        self.key, self.audit, self.at, self.state = key, audit, 0, _START

    def _named(self) -> bytes:
        self.state = _NEXT[self.state]
        return _NAMES[self.state].encode()

    def inserts(self) -> Iterator[tuple[bytes, bytes]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._named(), b""

    def row(self, role: bytes, text: bytes) -> Iterator[tuple[bytes, bytes]]:
        """(role, text) of the rows that stand for the next one."""
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = {b"s": _SYSTEM, b"u": _USER, b"a": _ASSISTANT}[role[:1]]
            yield role, text
        elif letter == "R":
            yield self._named(), text


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[object, list, int]]]]:
    """Per batch an iterator of (conv_id, repaired rows, place of the plan or -1): a plan opens a conversation, its rows follow."""
    script = None
    for batch in batches:
        audits, roles, texts = (batch.column(c) for c in ("audit", "role", "text"))

        def pieces():
            nonlocal script
            for key, lo, hi in _runs(batch):
                for k in range(lo, hi):
                    audit = audits[k].as_py()
                    if audit is not None:
                        if script is not None:
                            yield script.key, list(script.inserts()), -1
                        script = _Script(key, audit)
                        yield key, [], k
                    else:
                        yield key, list(script.row(roles[k].as_py(), texts[k].as_py())), -1

        yield batch, pieces()
    if script is not None:
        yield None, iter([(script.key, list(script.inserts()), -1)])


def _dealt(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Plans and rows of each conversation behind one another, plan first, as a stream."""
    binary = {c: F.col(c).cast("binary") for c in ("role", "text")}
    mine = rows.select("conv_id", "nth", "role", "text").withColumns(binary).withColumns({c: F.lit(None).cast(t) for c, t in (("audit", "string"), *((n, "long") for n in ("gaps", *_FLAGS, "cost")))})
    first = plans.withColumns({"nth": F.lit(0).cast("long"), "role": F.lit(None).cast("binary"), "text": F.lit(None).cast("binary")})
    n = common.partitions(rows.sparkSession, rows.count(), ROWS)
    return mine.unionByName(first).repartition(n, "conv_id").sortWithinPartitions("conv_id", "nth")


_PLAN = ("gaps", *_FLAGS, "cost", "audit")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plans with the digest of the repaired conversation."""
    names, held, sha, some, kind = ["conv_id", *_PLAN, "repaired_sha256"], None, None, False, None
    for batch, pieces in _applied(batches):
        done = []
        for _, repaired, plan in pieces:
            if plan >= 0:
                if held is not None:
                    done.append([*held, sha.hexdigest()])
                kind = batch.schema.field("conv_id").type
                held, sha, some = [batch.column(c)[plan].as_py() for c in ("conv_id", *_PLAN)], hashlib.sha256(), False
            for role, text in repaired:
                sha.update(b"\n" * some + role + b":" + text)
                some = True
        if batch is None:
            done.append([*held, sha.hexdigest()])
        if done:
            yield _batch(done, names, kind)


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows, counted from 0 in each conversation."""
    kind, position, size, rows = None, 0, 0, []
    for batch, pieces in _applied(batches):
        kind = kind or batch.schema.field("conv_id").type
        for key, repaired, plan in pieces:
            position = 0 if plan >= 0 else position
            for role, text in repaired:
                rows.append([key, position, role.decode("utf-8", "replace"), text.decode("utf-8", "replace")])
                position, size = position + 1, size + len(text)
            if size > BATCH_BYTES or len(rows) > 10_000:
                yield _batch(rows, ["conv_id", "turn", "role", "text"], kind)
                rows, size = [], 0
    if rows:
        yield _batch(rows, ["conv_id", "turn", "role", "text"], kind)


def repair(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) of all conversations after the cheapest edits; turns count from 0.

    What a conversation may look like: nothing, or one system row at most, then
    user and assistant rows by turns. Blank and repeated rows go. A null role or
    text is one space, so such a row is blank or has a role to be given anew; a
    role counts by its initial, an empty role has none. Rows of a null conv_id
    are a conversation, null turns come first, rows of one turn in the order of
    role and text. Further columns aren't read; an empty table gives no row.
    """
    rows = Scratch(conversations.sparkSession).table(examined(rows_of(conversations)), "rows")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _dealt(rows, planned(conversations, rows)).mapInArrow(_mended, f"conv_id {kind}, turn long, role string, text string")


def conversation_repair(conversations: DataFrame) -> DataFrame:
    """The plan and the digest of the repaired `role:text` lines of every conversation after `damaged`.

    A conversation that damage leaves no row of has zeros, an empty audit and the
    digest of nothing. Nulls, ties and repeats as in `repair`; further columns
    aren't read; an empty table gives no row.
    """
    rows = Scratch(conversations.sparkSession).table(examined(damaged(conversations)), "rows")
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in ("gaps", *_FLAGS, "cost"))
    return _dealt(rows, planned(conversations, rows)).mapInArrow(_digested, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


#: The same in DuckDB's SQL: the best (cost, audit, text) of each state, row by row.
ORACLE = """
    WITH RECURSIVE
    table8 AS (SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ord(c)::BIGINT) AS bytes FROM conversations),
    kinds AS (SELECT * EXCLUDE (bytes, t), xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, table8),
    d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
    m AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
    o AS (SELECT *, row_number() OVER w AS nth, lag(role) OVER w AS before, rtrim(text, E' \\t\\n\\x0b\\x0c\\r') AS body
          FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy, again)),
    f AS (SELECT *, body = '' AS blank, body <> '' AND again AS duplicate, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, substr(role, 1, 1) AS i,
                 before IS NOT NULL AND substr(before, 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM o),
    ids AS (SELECT DISTINCT conv_id FROM conversations),
    sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
    dp AS (SELECT conv_id, 0::BIGINT AS nth, {'c': 0, 'a': '', 't': ''} AS e, {'c': 99999, 'a': '', 't': ''} AS s, {'c': 2, 'a': 'I', 't': 'user:'} AS u,
                  {'c': 4, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'} AS a FROM ids
      UNION ALL
      SELECT conv_id, nth, e, s, u2 AS u, list_min([a1, {'c': u2.c + 2, 'a': u2.a || 'I', 't': u2.t || chr(10) || 'assistant:'}]) AS a FROM (
        SELECT *, list_min([u1, {'c': e.c + 2, 'a': e.a || 'I', 't': e.t || CASE WHEN e.t = '' THEN '' ELSE chr(10) END || 'user:'}, {'c': s.c + 2, 'a': s.a || 'I', 't': s.t || chr(10) || 'user:'},
                                {'c': a1.c + 2, 'a': a1.a || 'I', 't': a1.t || chr(10) || 'user:'}]) AS u2 FROM (
          SELECT conv_id, nth, {'c': e.c + 3, 'a': e.a || 'D', 't': e.t} AS e,
            list_min([{'c': s.c + 3, 'a': s.a || 'D', 't': s.t}, {'c': e.c + k + CASE WHEN i = 's' THEN 0 ELSE 99999 END, 'a': e.a || 'K', 't': e.t || role || ':' || text}]) AS s,
            list_min([{'c': u.c + 3, 'a': u.a || 'D', 't': u.t}, {'c': p.c + k + CASE WHEN i = 'u' THEN 0 ELSE 99999 END, 'a': p.a || 'K', 't': p.t || nl || role || ':' || text},
                      {'c': p.c + k + 2, 'a': p.a || 'R', 't': p.t || nl || 'user:' || text}]) AS u1,
            list_min([{'c': a.c + 3, 'a': a.a || 'D', 't': a.t}, {'c': u.c + k + CASE WHEN i = 'a' THEN 0 ELSE 99999 END, 'a': u.a || 'K', 't': u.t || chr(10) || role || ':' || text},
                      {'c': u.c + k + 2, 'a': u.a || 'R', 't': u.t || chr(10) || 'assistant:' || text}]) AS a1
          FROM (SELECT dp.conv_id, f.nth, e, s, u, a, role, text, i, CASE WHEN blank OR duplicate THEN 99999 WHEN truncated THEN 1 ELSE 0 END AS k,
                       list_min([e, s, a]) AS p, CASE WHEN list_min([e, s, a]).t = '' THEN '' ELSE chr(10) END AS nl
                FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.nth = dp.nth + 1)))),
    best AS (SELECT dp.conv_id, list_min([e, a]) AS b FROM dp LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE dp.nth = coalesce(sums.n, 0))
    SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit, sha256(b.t) AS repaired_sha256
    FROM best LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM best.conv_id"""
