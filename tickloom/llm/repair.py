"""Repair of conversation structure by a suffix-shared automaton over role and fault signatures.

The rows of a conversation, in order of ``turn``, become a word over nine signs: must go (blank or duplicate), or
the role's initial (system, user, assistant, other), in upper case where the text is cut off.  The different words of all
conversations are sorted from their last sign and stored in an automaton whose nodes are registered from the end: a node is
one sign and the node behind it, so equal suffixes are one node whatever conversation they come from.  Each node gets, once
for each of the four states of the role grammar, the cost to go and the first edit of the best audit suffix; an audit
is read off by following those.  ``repaired_messages`` and ``repaired_digests`` apply the audits to the rows.

Edits: Keep (0), Rerole to the role the grammar wants (2), Delete (3), Insert an empty text (2); a cut-off row that is
not deleted adds 1.  Result roles: nothing, or an optional system row and then user, assistant pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import store

#: Nodes an automaton may hold before it starts anew.  Words come sorted from the end, so only one path is built twice.
NODES = 1 << 18
#: Repaired rows in one record batch.
ROWS = 4096
_BLANKS = " \t\n\x0b\x0c\r"
_GONE = "x"

# states of the grammar: nothing yet, after system, after user, after assistant
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state an inserted or re-roled row leads to, and that row's role.
_TO = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: The state a kept row leads to, by state and initial.
_KEPT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_KEEP, _REROLE, _DELETE, _INSERT = 0, 2, 3, 2


class Automaton:
    """Nodes of suffixes: ``cost[node][state]`` and ``edit[node][state]``, the least letter of the cheapest edits."""

    def __init__(self) -> None:
        self.sign, self.next = [""], [0]
        self.cost: list[list[int]] = [[0, 2 * _INSERT, _INSERT, 0]]
        self.edit: list[list[str]] = [["", "I", "I", ""]]
        self.register: dict[tuple[str, int], int] = {}

    def node(self, word: str) -> int:
        """The node of the whole ``word``, given from its last sign to its first."""
        at = 0
        for sign in word:
            key = (sign, at)
            got = self.register.get(key)
            if got is None:
                got = self.register[key] = self._add(sign, at)
            at = got
        return at

    def _add(self, sign: str, after: int) -> int:
        behind = self.cost[after]
        cut = sign.isupper()
        choices = []
        for state in range(4):
            ways = {"D": _DELETE + behind[state]}
            if sign != _GONE:
                kept = _KEPT[state].get(sign.lower())
                if kept is not None:
                    ways["K"] = _KEEP + cut + behind[kept]
                ways["R"] = _REROLE + cut + behind[_TO[state]]
            choices.append(ways)
        cost = [min(ways.values()) for ways in choices]
        for _ in range(3):  # an inserted row leads to another state of the same node; more than two never pay
            cost = [min(c, _INSERT + cost[_TO[s]]) for s, c in enumerate(cost)]
        for state, ways in enumerate(choices):
            ways["I"] = _INSERT + cost[_TO[state]]
        self.sign.append(sign)
        self.next.append(after)
        self.cost.append(cost)
        # the letters of one state differ, so the least first letter gives the least audit
        self.edit.append([min(k for k, v in ways.items() if v == cost[s]) for s, ways in enumerate(choices)])
        return len(self.sign) - 1

    def audit(self, node: int) -> str:
        out, state = [], _START
        while letter := self.edit[node][state]:
            out.append(letter)
            if letter == "K":
                state = _KEPT[state][self.sign[node].lower()]
            elif letter != "D":
                state = _TO[state]
            if letter != "I":
                node = self.next[node]
        return "".join(out)


def _rows(messages: DataFrame, copies: str | None) -> DataFrame:
    """The four columns without nulls in role and text; the column ``copies`` tells how often a row stands there (once if None)."""
    text = F.coalesce("text", F.lit(" "))
    role = F.coalesce("role", F.lit(" "))
    n = F.lit(1) if copies is None else F.col(copies)
    return messages.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), n.cast("long").alias("copies"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def signatures(messages: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conversation: ``gaps``, the counts of first faults, ``illegal`` and the ``signature`` of its rows.

    Only digests move.  Equal rows of a turn fold before the shuffle, and rows said earlier are found by (conversation, digest).  The
    rows of a conversation then stream through one task in order, which keeps one sign a row.
    """
    rows = _rows(messages, copies)
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = F.when(F.length(end) == 0, "b").when(F.right(end, F.lit(1)).isin(".", "!", "?"), "-").otherwise("t")
    cells = rows.select("conv_id", "turn", "role", "digest", "copies", F.concat(_initial(F.col("role")), fault).alias("kind")) \
        .groupBy("conv_id", "turn", "role", "digest", "kind").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0)) > 0)
    ordered = cells.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        of, now, id_type = None, None, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, turn, what, n, seen in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if now is None or conv != of:
                    if now is not None:
                        done.append((of, *now.row()))
                        if len(done) >= ROWS:
                            yield _batch(done, names, id_type)
                            done = []
                    of, now = conv, _Signature()
                now.add(turn, what, n, seen)
        if now is not None:
            done.append((of, *now.row()))
        if done:
            yield _batch(done, names, id_type)

    return ordered.select("conv_id", F.col("turn").cast("long"), "kind", "n", "seen").mapInArrow(
        run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string")


class _Signature:
    """What the rows of one conversation add up to, taken in order."""

    def __init__(self) -> None:
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = ""
        self.signs: list[str] = []

    def add(self, turn: int | None, kind: str, n: int, seen: bool) -> None:
        if not n:
            return
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial, fault = kind
        again = n - (not seen)
        self.illegal += n - 1 + (self.before != "" and self.before + initial not in ("su", "ua", "au"))
        self.before = initial
        if fault == "b":
            self.blank += n
            self.signs.append(_GONE * n)
            return
        self.duplicate += again
        if not seen:
            self.truncated += fault == "t"
            self.signs.append(initial.upper() if fault == "t" else initial)
        self.signs.append(_GONE * again)

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, "".join(self.signs)


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c) for c in columns[1:])], names)


def audits(signed: DataFrame) -> DataFrame:
    """(signature, cost, audit) of every different ``signature``: neighbours in order from the end share an automaton."""
    words = signed.select("signature").distinct().withColumn("back", F.reverse("signature"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            cost, best = [], []
            for back in batch.column(1).to_pylist():
                if len(automaton.sign) > NODES:
                    automaton = Automaton()
                node = automaton.node(back)
                cost.append(automaton.cost[node][_START])
                best.append(automaton.audit(node))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.int64()), pa.array(best, pa.string())], ["signature", "cost", "audit"])

    return words.repartitionByRange("back").sortWithinPartitions("back").mapInArrow(run, "signature string, cost long, audit string")


_HEAD = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _planned(messages: DataFrame, copies: str | None) -> DataFrame:
    """The rows of every conversation in order, behind a row with its counts and its audit."""
    signed = store(signatures(messages, copies), "signatures")
    plan = signed.join(store(audits(signed), "audits"), "signature")
    none = F.lit(None)
    head = plan.select("conv_id", F.lit(0).alias("part"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("digest"),
                       none.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), *_HEAD, "audit")
    rows = _rows(messages, copies).select("conv_id", F.lit(1).alias("part"), F.col("turn").cast("long").alias("turn"), "role", "digest", "text", "copies",
                                  *[none.cast("long").alias(c) for c in _HEAD], none.cast("string").alias("audit"))
    return head.union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "role", "digest") \
        .select("conv_id", "part", "role", "text", "copies", *_HEAD, "audit")


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, counts, audit, None) where a conversation begins, (conv_id, role, text, edit) for each row of its repaired form."""
    audit, at, state, of = "", 0, _START, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _TO[state]
            yield of, _ROLE[state], "", "I"

    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(i).to_pylist() for i in range(len(names))), strict=True):
            conv, part, role, text, copies = row[:5]
            if not part:
                yield from inserted()
                of, audit, at, state = conv, row[-1], 0, _START
                yield conv, row[5:-1], audit, None
                continue
            for _ in range(copies):
                yield from inserted()
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = _KEPT[state][role[:1]]
                    yield of, role, text, letter
                elif letter == "R":
                    state = _TO[state]
                    yield of, _ROLE[state], text, letter
    yield from inserted()


def repaired_messages(messages: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, position, role, text, edit): the rows of the repaired conversations, positions from 0.

    ``messages`` has conv_id, turn, role, text; ``copies`` may name a column that tells how often the row stands there (0: dropped, its
    conversation is still reported); other columns are ignored.  Null role and text count as one space, a null conv_id is a conversation of its own, null
    turns come first, and rows of one turn go by role, then by a digest of role and text; equal rows are duplicates
    of the first.  An empty table has no rows.  Rows stream in order through the task of their conversation, which holds its audit.
    """
    plan = _planned(messages, copies)
    names = ["conv_id", "position", "role", "text", "edit"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, position, id_type = [], 0, None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for conv, role, text, edit in _edited(typed()):
            if edit is None:
                position = 0
                continue
            out.append((conv, position, role, text, edit))
            position += 1
            if len(out) >= ROWS:
                yield _batch(out, names, id_type)
                out = []
        if out:
            yield _batch(out, names, id_type)

    return plan.mapInArrow(run, f"conv_id {plan.schema['conv_id'].dataType.simpleString()}, position long, role string, text string, edit string")


def repaired_digests(messages: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conversation: counts, cost, audit and ``repaired_sha256`` of its ``role:text`` rows joined by newlines.

    Input as in ``repaired_messages``.  A conversation without rows has zeros, an empty audit and the hash of the empty string.
    """
    plan = _planned(messages, copies)
    names = ["conv_id", *_HEAD, "audit", "repaired_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, sha, empty, id_type = [], None, hashlib.sha256(), True, None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field(0).type
                yield batch

        for conv, role, text, edit in _edited(typed()):
            if edit is None:
                if head is not None:
                    out.append((*head, sha.hexdigest()))
                    if len(out) >= ROWS:
                        yield _batch(out, names, id_type)
                        out = []
                head, sha, empty = (conv, *role, text), hashlib.sha256(), True
                continue
            sha.update((f"{role}:{text}" if empty else f"\n{role}:{text}").encode())
            empty = False
        if head is not None:
            out.append((*head, sha.hexdigest()))
        if out:
            yield _batch(out, names, id_type)

    kind = plan.schema["conv_id"].dataType.simpleString()
    return plan.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _HEAD) + ", audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults the query plants, by the crc32 of ``conv_id:turn`` modulo 20; nulls count as one space.

    0 drops the row (``copies`` 0), 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it
    (``copies`` 2), 4 sets the role to user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))
