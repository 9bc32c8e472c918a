"""Conversation structure repair: the cheapest edits that give turns a legal order.

Messages (conv_id, turn, role, text) are dealt by conversation, sorted by turn and
streamed; a dynamic program over what the repaired conversation ends with (nothing,
a system, a user or an assistant message) goes from row to row. Legal is nothing, or
pairs of user and assistant behind at most one system message. Edits, with their
costs: Keep 0; Rerole to user or assistant 1; Delete 2, the only one for a blank or
duplicate row; Insert an empty user or assistant message 5; a truncated row
that isn't deleted costs 5 more. Of equally cheap edits the one whose initials are
the least in ASCII order is taken.

What a row does to the four states depends on their relative costs, the order of
their initials so far, and the kind of row: few cases, kept in a table.
Each state carries a running hash of its repaired conversation, so texts pass once
and are not held. Initials so far compare by one rank per state: each ends
with the edit of the same row, so none is a prefix of another.

Scale: the state goes on over Arrow batches. A row leaves one small number, the
backpointer of all four states. After ``CHUNK`` rows these are folded to the letters
between the states at both ends, which leave the task as rows (written by
Spark, so nothing lies on a worker's disk and a lost executor costs a re-run), and are put
together once the last state is known. So a giant conversation takes no more memory than
others; it is one stream, though, as the hash of its repaired text is sequential.
Whether a row's role and text came earlier is found by a window over (conversation, role,
text), not by a set that would grow with the conversation.

Defined results: a null role or text is one space (so a blank row, or a role that fits
nowhere); a null conv_id is a conversation; null turns come first; rows of one turn
are taken by role and text; repeated rows are duplicates; roles are told apart by
their first character, and an empty one fits nowhere; other columns are ignored; an
empty table gives an empty result; a span of turns too large for a long is the largest long.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# --- Fixed values of the contract: what is blank, how a message ends, legal neighbours.
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NEIGHBOURS = {"su", "ua", "au"}
# --- end of fixed values
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
CHUNK = 1 << 16
LONGEST = 2 ** 63 - 1
BLANK, DUPLICATE, CUT, SOUND = "blank", "duplicate", "truncated", "sound"

# State before -> states after 0, 1, 2 inserted messages.
INSERTED = {NOTHING: (NOTHING, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT),
            ASSISTANT: (ASSISTANT, USER)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
TO_END = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}   # messages to insert at the end


def edits(state: int, initial: str, fault: str) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, state after) of what can be done with a row."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT else 0
    following = ASSISTANT if state == USER else USER
    if initial == "s" and state == NOTHING:
        yield "K", more, SYSTEM
    elif initial == ("a" if following == ASSISTANT else "u"):
        yield "K", more, following
    yield "R", REROLE + more, following


@functools.lru_cache(maxsize=1 << 16)
def step(costs: tuple, ranks: tuple, initial: str, fault: str) -> tuple:
    """Costs (None: can't be reached) and ranks of the states after a row, what the least cost
    has grown by, and per state (state before, inserted messages, initial of the edit)."""
    best: list = [None] * 4
    for before, cost in enumerate(costs):
        if cost is None:
            continue
        for n, state in enumerate(INSERTED[before]):
            for letter, more, after in edits(state, initial, fault):
                found = (cost + INSERT * n + more, ranks[before], "I" * n + letter, before, n, letter)
                if best[after] is None or found < best[after]:
                    best[after] = found
    least = min(b[0] for b in best if b)
    order = sorted(b[1:3] for b in best if b)
    return (tuple(b and b[0] - least for b in best), tuple(b and order.index(b[1:3]) for b in best), least,
            tuple(b and b[3:] for b in best))


class Conversation:
    """The state of one conversation's stream."""

    def __init__(self, name: str | None):
        self.name, self.cost, self.costs, self.ranks = name, 0, (0, None, None, None), (0, None, None, None)
        self.hashes = [hashlib.sha256(), None, None, None]
        self.faults = dict.fromkeys((BLANK, DUPLICATE, CUT, SOUND), 0)
        self.illegal = 0
        self.initial = None
        self.low = self.high = None
        self.turns = 0
        self.back, self.moves, self.folded = array("I"), [], []
        self.numbers: dict[tuple, int] = {}

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        said = text.strip(SPACES)
        fault = BLANK if not said else DUPLICATE if not first else CUT if said[-1] not in ENDS else SOUND
        self.faults[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in NEIGHBOURS:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.costs, self.ranks, more, moves = step(self.costs, self.ranks, initial, fault)
        self.cost += more
        number = self.numbers.setdefault(moves, len(self.moves))
        if number == len(self.moves):
            self.moves.append(moves)
        self.back.append(number)
        self.hashes = [m and self.said(m, role, text) for m in moves]

    def said(self, move: tuple, role: str, text: str):
        """The hash of a state's repaired conversation after ``move``."""
        before, n, letter = move
        out = self.hashes[before]
        if n or letter != "D":
            out = out.copy()
        state = INSERTED[before][n]
        for at in INSERTED[before][1:n + 1]:
            out.update(line(ROLES[at], "", before == NOTHING and at == USER))
        if letter == "K":
            out.update(line(role, text, state == NOTHING))
        elif letter == "R":
            out.update(line(ROLES[ASSISTANT if state == USER else USER], text, state == NOTHING))
        return out

    def fold(self) -> list[tuple | None]:
        """(state at the start, letters) of the rows since the last fold, per state."""
        out: list = [None] * 4
        for end in range(4):
            if self.costs[end] is not None:
                state, letters = end, []
                for number in reversed(self.back):
                    state, n, letter = self.moves[number][state]
                    letters.append("I" * n + letter)
                out[end] = state, "".join(reversed(letters))
        self.back = array("I")
        return out

    def spilled(self) -> list[dict]:
        """Letters of the chunk that is full, per state; only the states at its ends are kept."""
        found = self.fold()
        self.folded.append([f and f[0] for f in found])
        return [{"conv": self.name, "chunk": len(self.folded) - 1, "state": k, "letters": f[1]}
                for k, f in enumerate(found) if f]

    def finished(self) -> dict:
        cost, _, state = min((c + INSERT * TO_END[k], self.ranks[k], k) for k, c in enumerate(self.costs) if c is not None)
        digest = self.hashes[state].copy()
        missing = INSERTED[state][1:TO_END[state] + 1]
        for at in missing:
            digest.update(line(ROLES[at], "", False))
        start, letters = self.fold()[state]
        chosen = []
        for chunk in reversed(self.folded):
            chosen.append(start)
            start = chunk[start]
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"conv": self.name, "chunk": -1, "letters": letters + "I" * len(missing), "gaps": min(gaps, LONGEST),
                "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT],
                "illegal": self.illegal, "cost": self.cost + cost, "repaired_sha256": digest.hexdigest(),
                "chosen": chosen[::-1]}


def line(role: str, text: str, first: bool) -> bytes:
    return ("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass")


FOUND = ("conv string, chunk int, state int, letters string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
         "illegal bigint, cost bigint, repaired_sha256 string, chosen array<int>")
COLUMNS = [c.split()[0] for c in FOUND.split(", ")]


def streamed(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row (chunk -1) per conversation, and rows of letters of those with over ``chunk`` messages."""
    def frame(found: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series([f.get(c) for f in found], dtype=object) for c in COLUMNS})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            out = []
            for name, turn, role, text, first in zip(*(batch[c].tolist() for c in ("conv", "turn", "role", "text", "first"))):
                if now is None or name != now.name:
                    if now is not None:
                        out.append(now.finished())
                    now = Conversation(name)
                elif len(now.back) == chunk:
                    out += now.spilled()
                now.add(None if turn is None else int(turn), role, text, first)
            if out:
                yield frame(out)
        if now is not None:
            yield frame([now.finished()])
    return in_order(rows).mapInPandas(walk, FOUND)


def space_for_null(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(" "))


def in_order(rows: DataFrame) -> DataFrame:
    """conv and turn (as text, as pandas would make nulls and long numbers floating), role, text, first
    (no earlier row has this role and text), by conversation and turn."""
    turn = F.col("turn").asc_nulls_first()
    rows = rows.select("conv_id", "turn", space_for_null("role").alias("role"), space_for_null("text").alias("text"))
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(turn)
    return (rows.withColumn("first", F.row_number().over(earlier) == 1)
            .repartition("conv_id").sortWithinPartitions("conv_id", turn, "role", "text", F.col("first").desc())
            .select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "text", "first"))


def repair(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of ``messages``: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit (the edits' initials), repaired_sha256."""
    found = C.written(streamed(messages, chunk), "turn-edits")
    whole = found.filter("chunk = -1")
    # one string per conversation, which is a column of the result
    spilled = found.filter("chunk >= 0").select(F.col("conv").alias("c"), "chunk", "state", "letters")
    long = whole.filter(F.size("chosen") > 0).select("conv", F.posexplode("chosen").alias("k", "at"))
    heads = (spilled.join(long, F.col("c").eqNullSafe(F.col("conv")) & (F.col("chunk") == F.col("k")) & (F.col("state") == F.col("at")))
             .groupBy("c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "letters"))),
                                                        lambda p: p["letters"]), "").alias("head")))
    kind = messages.schema["conv_id"].dataType
    return (whole.join(heads, F.col("conv").eqNullSafe(F.col("c")), "left")
            .select(F.col("conv").cast(kind).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                    F.concat(F.coalesce("head", F.lit("")), "letters").alias("audit"), "repaired_sha256"))


def repaired(messages: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired messages: conv_id, position (from 0), role, text. ``audits``: conv_id and audit, as
    ``repair`` gives them; a conversation's audit precedes its rows in the stream."""
    turn = F.col("turn").asc_nulls_first()
    rows = messages.select("conv_id", F.lit(1).alias("kind"), "turn", space_for_null("role").alias("role"),
                           space_for_null("text").alias("text"))
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(messages.schema["turn"].dataType).alias("turn"),
                          F.lit("").alias("role"), F.col("audit").alias("text"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, audit, at, state, position = None, "", 0, NOTHING, 0
        out: list[tuple] = []

        def say(role: str | None, text: str) -> None:
            nonlocal state, position
            state = SYSTEM if role is not None and state == NOTHING and role[:1] == "s" else ASSISTANT if state == USER else USER
            out.append((name, position, ROLES[state] if role is None else role, text))
            position += 1

        def insert() -> None:
            nonlocal at
            while audit[at:at + 1] == "I":
                say(None, "")
                at += 1

        for batch in batches:
            for conv, kind, role, text in zip(*(batch[c].tolist() for c in ("conv", "kind", "role", "text"))):
                if kind == 0:
                    insert()
                    name, audit, at, state, position = conv, text, 0, NOTHING, 0
                    continue
                insert()
                letter, at = audit[at], at + 1
                if letter != "D":
                    say(role if letter == "K" else None, text)
            yield pd.DataFrame(out, columns=["conv", "position", "role", "text"], dtype=object)
            out.clear()
        insert()
        yield pd.DataFrame(out, columns=["conv", "position", "role", "text"], dtype=object)
    return (rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", turn, "role", "text")
            .select(F.col("conv_id").cast("string").alias("conv"), "kind", "role", "text")
            .mapInPandas(walk, "conv string, position bigint, role string, text string")
            .select(F.col("conv").cast(messages.schema["conv_id"].dataType).alias("conv_id"), "position", "role", "text"))
