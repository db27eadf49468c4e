"""Repair of conversation structure by survivor-coalescence Viterbi.

A conversation is a sequence of messages; its repair is the cheapest sequence of edits (keep, delete, change the
role, insert an empty message) after which the roles read system (optional), then user and assistant in turn. The
states of the search are what the repaired messages end with, so there are four survivors at a time. Their edits
form a tree of backpointers with reference counts: an edit that no survivor descends from is freed at once, and as
soon as all survivors share an ancestor, the edits up to it are final and are emitted. Memory thus holds only the
edits still open, however long the conversation. Of equally cheap repairs the one with the ASCII-least edits wins;
survivors in a tie are compared over all of their open edits (what is emitted they share).

Messages are dealt by conversation and sorted there by Spark, so that each task reads its conversations as a
stream, message by message; no conversation is ever held as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.textops import limit_batches, release

#: what white space is: a message of nothing else is blank
_WORD_CHAR = re.compile(r"[^\x20\x09-\x0D]")
_LAST_CHAR = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
ENDS = ".!?"
#: costs of the edits
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: states: what the repaired messages end with; the last one may only be followed by what ``_NEXT`` says
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: pairs of initials that may stand next to each other
LEGAL = ("su", "ua", "au")
#: characters of an emitted column that are sent on together
_PIECE = 1 << 20


class Message(NamedTuple):
    turn: int | None
    role: str
    text: str


class _Edit:
    """A node of the backpointer tree: one edit, its predecessor, and what rests on it, survivors (a count) and edits
    after it."""

    __slots__ = ("after", "before", "depth", "edit", "message", "survivors")

    def __init__(self, before: _Edit | None, edit: str, message: Message | None):
        self.before, self.edit, self.message = before, edit, message
        self.survivors, self.after = 0, []
        self.depth = before.depth + 1 if before is not None else 0
        if before is not None:
            before.after.append(self)

    @property
    def uses(self) -> int:
        return self.survivors + len(self.after)


def _free(node: _Edit | None) -> None:
    """Drop a node that nothing rests on, and its predecessors that only it rested on."""
    while node is not None and not node.uses:
        before, node.before, node.message = node.before, None, None
        if before is not None:
            before.after.remove(node)
        node = before


def _earlier(a: _Edit, b: _Edit) -> bool:
    """Whether the edits up to ``a`` come before those up to ``b``: all edits behind their common ancestor."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.before
        else:
            right.append(b.edit)
            b = b.before
    return left[::-1] < right[::-1]


class Repair:
    """The repair of one conversation, message by message. ``add`` and ``close`` return the edits that became final,
    as ``(edit, message after it)``, without a message for a deletion."""

    def __init__(self):
        self.root = _Edit(None, "", None)
        self.root.survivors = 1
        self.alive: dict[int, tuple[int, _Edit]] = {START: (0, self.root)}
        self._insert(self.alive)
        self.open_edits = 0

    @staticmethod
    def _offer(found: dict, state: int, cost: int, before: _Edit, edit: str, message: Message | None) -> None:
        """Take a path to a state if it is the best so far."""
        have = found.get(state)
        if have is not None and have[0] < cost:
            return
        node = _Edit(before, edit, message)
        if have is not None and have[0] == cost and not _earlier(node, have[1]):
            _free(node)
            return
        found[state] = cost, node
        node.survivors += 1
        if have is not None:
            Repair._release(have[1])

    def _insert(self, found: dict) -> None:
        """Messages inserted behind the last one: first from any state, then behind those. A third could only close
        a circle, which never pays."""
        for _ in range(2):
            for state in list(found):
                for to in _NEXT[state].values():
                    if to in _ROLE:
                        cost, node = found[state]  # the best by now: an offer frees what it replaces
                        self._offer(found, to, cost + INSERT, node, "I", Message(None, _ROLE[to], ""))

    @staticmethod
    def _release(node: _Edit) -> None:
        """A survivor no longer rests on the node."""
        node.survivors -= 1
        _free(node)

    def add(self, message: Message, fault: str | None) -> list[tuple[str, Message | None]]:
        found: dict[int, tuple[int, _Edit]] = {}
        must_go = fault in ("blank", "duplicate")
        extra = CUT_OFF if fault == "truncated" else 0
        for state, (cost, node) in self.alive.items():
            self._offer(found, state, cost + DELETE, node, "D", None)
            if must_go:
                continue
            kept = _NEXT[state].get(message.role[:1])
            if kept is not None:
                self._offer(found, kept, cost + extra, node, "K", message)
            for to in _NEXT[state].values():
                if to in _ROLE:
                    self._offer(found, to, cost + REROLE + extra, node, "R", message._replace(role=_ROLE[to]))
        self._insert(found)
        self._prune(found)
        for _, node in self.alive.values():
            self._release(node)
        self.alive = found
        return self._coalesced()

    def _prune(self, found: dict) -> None:
        """End survivors that cannot win any more: whatever follows them could follow the assistant's message as well,
        but for keeping a system message, which deletion replaces."""
        if ASSISTANT in found:
            for state, more in ((START, DELETE), (SYSTEM, 0)):
                if state in found and found[state][0] > found[ASSISTANT][0] + more:
                    self._release(found.pop(state)[1])

    def _coalesced(self) -> list[tuple[str, Message | None]]:
        """The edits that all survivors share: as long as one edit only rests on the root, it is final and the new root."""
        final = []
        while self.root.uses == 1 and self.root.after:
            (self.root,) = self.root.after
            final.append((self.root.edit, self.root.message))
            self.root.before, self.root.message = None, None
        self.open_edits = max(n.depth for _, n in self.alive.values()) - self.root.depth
        return final

    def close(self) -> tuple[int, list[tuple[str, Message | None]]]:
        """The cost of the best repair and its edits that were still open."""
        ends = [self.alive[s] for s in (START, ASSISTANT) if s in self.alive]
        cost, node = ends[0]
        for other in ends[1:]:
            if other[0] < cost or (other[0] == cost and _earlier(other[1], node)):
                cost, node = other
        final = []
        while node is not self.root:
            final.append((node.edit, node.message))
            node = node.before
        self.alive = {}
        return cost, final[::-1]


def fault_of(role: str, text: str, first: bool) -> str | None:
    """The first fault of a message; ``first``: no earlier message of the conversation has its role and text."""
    if not _WORD_CHAR.search(text):
        return "blank"
    if not first:
        return "duplicate"
    return None if _LAST_CHAR.search(text)[1] in ENDS else "truncated"


class _Stream:
    """Counts and repair of one conversation, fed in order."""

    def __init__(self):
        self.repair = Repair()
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.initial: str | None = None
        self.low = self.high = None

    def add(self, message: Message, first: bool):
        if message.turn is not None and message.turn != self.high:  # in order, so equal turns are neighbours
            self.low = message.turn if self.low is None else self.low
            self.high, self.turns = message.turn, self.turns + 1
        initial = message.role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        fault = fault_of(message.role, message.text, first)
        if fault:
            self.faults[fault] += 1
        return self.repair.add(message, fault)

    @property
    def gaps(self) -> int:
        return 0 if self.high is None else self.high - self.low + 1 - self.turns


def in_order(messages: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, turn, role, text, present, first`` dealt by conversation and sorted in it by turn (nulls first), role
    and text. One exchange: the rows that are first with their role and text are found in the same partitions."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = messages.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"),
        blank("text").alias("text"),
        F.coalesce(present if present is not None else F.lit(True), F.lit(False)).alias("present"),
    )
    dealt = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = dealt.withColumn("first", F.row_number().over(same) == 1)
    return marked.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", F.desc("first"))


def _conversations(batches: Iterator[pa.RecordBatch]):
    """``(conv_id, first of it, message, present, first)`` row by row, then ``None``."""
    nothing = object()
    last = nothing
    for batch in batches:
        for conv, turn, role, text, present, first in zip(*(c.to_pylist() for c in batch.columns)):
            yield conv, last is nothing or conv != last, Message(turn, role, text), present, first
            last = conv


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summaries(messages: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost`` (longs), ``audit``,
    the initials of the cheapest edits (Delete, Insert, Keep, Rerole), and ``repaired_sha256`` of the repaired
    messages as ``role:text`` lines.

    ``messages(conv_id, turn, role, text)``; messages of equal turn are taken by role and text; null role or text is
    one space, and an empty role fits nowhere; rows with a null ``conv_id`` are one conversation; a null turn comes first and is in no gap. Repeated
    rows are duplicates. Rows where ``present`` is not true only name their conversation: one without any other has
    zeros, an empty audit and the hash of an empty string. Other columns are ignored; very long texts pass as any; an
    empty table gives no rows. The digest of a conversation is one stream by nature, so a very long conversation takes
    one task long, but only its open edits and its audit are in memory.
    """
    limit_batches(messages.sparkSession)
    rows = in_order(messages, present)
    kind = rows.schema["conv_id"].dataType.simpleString()
    kind_pa = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stream = audit = digest = conv = None
        lines = 0

        def put(edits):
            nonlocal lines
            for edit, message in edits:
                audit.append(edit)
                if message is not None:
                    digest.update(f"{chr(10) if lines else ''}{message.role}:{message.text}".encode("utf-8", "surrogatepass"))
                    lines += 1
            if len(audit) > 4096:
                audit[:] = ["".join(audit)]

        def end():
            cost, edits = stream.repair.close()
            put(edits)
            out.append((conv, stream.gaps, *stream.faults.values(), stream.illegal, cost, "".join(audit), digest.hexdigest()))

        def batch_of():
            columns = list(zip(*out))
            out.clear()
            arrays = [pa.array(columns[0], kind_pa), *(pa.array(c, pa.int64()) for c in columns[1:7]), *(pa.array(c, pa.string()) for c in columns[7:])]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        held = 0
        for name, begins, message, there, first in _conversations(batches):
            if begins:
                if stream is not None:
                    end()
                    held += 100 + len(out[-1][7])
                    if held > _PIECE:
                        yield batch_of()
                        held = 0
                conv, stream, audit, digest, lines = name, _Stream(), [], hashlib.sha256(), 0
            if there:
                put(stream.add(message, first))
        if stream is not None:
            end()
            yield batch_of()
        release()

    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return rows.mapInArrow(run, schema)


def repaired(messages: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, place, edit, turn, role, text``, one row per edit in order from 0; a
    deletion has null role and text, an insertion a null turn. Nulls, ties and empty tables as in :func:`summaries`."""
    limit_batches(messages.sparkSession)
    rows = in_order(messages, present)
    kind = rows.schema["conv_id"].dataType.simpleString()
    kind_pa = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stream = conv = None
        place = held = 0

        def put(edits):
            nonlocal place, held
            for edit, message in edits:
                out.append((conv, place, edit, *(message or (None, None, None))))
                place, held = place + 1, held + 60 + (len(message.text) if message else 0)

        def batch_of():
            nonlocal held
            conv, place, edit, turn, role, text = zip(*out)
            out.clear()
            held = 0
            arrays = [pa.array(conv, kind_pa), pa.array(place, pa.int64()), pa.array(edit, pa.string())]
            arrays += [pa.array(turn, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "place", "edit", "turn", "role", "text"])

        for name, begins, message, there, first in _conversations(batches):
            if begins:
                if stream is not None:
                    put(stream.repair.close()[1])
                conv, stream, place = name, _Stream(), 0
            if there:
                put(stream.add(message, first))
            if held > _PIECE:
                yield batch_of()
        if stream is not None:
            put(stream.repair.close()[1])
        if out:
            yield batch_of()
        release()

    return rows.mapInArrow(run, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """A fixed damage for tests of a repair, by CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the message (``present``
    false), 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets role ``user``. Nulls count as a space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), draw.alias("_draw"))
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("_draw") != 0).alias("present"),
        F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")
