"""Conversation repair by generalised LR parsing of the role grammar, with weighted edits.

The grammar ``C -> | P | s P``, ``P -> u a | P u a`` (system, user, assistant) gets its LR automaton from its item sets. A
graph-structured stack holds every stack that some choice of edits leads to; each row offers delete, keep and rerole, and insertions may follow
it. Stacks of equal top are merged: the one of smaller (cost, audit) stays. At one place in a conversation the audit's letters fix its cost, so no audit
of equal cost begins another one, and the smaller stays smaller whatever follows. Tops with the same future (a pair is complete; a user turn waits for its
answer) are compared too, and a stack without any pair goes once a complete one is ahead by more than a rerole or delete could win back.

What all stacks of a place agree on is settled and leaves the stack, so a conversation is a stream: memory holds the rows since the
stacks last agreed, not the conversation. The few stack sets that occur, costs taken relative to the least, make a table that is filled as needed.

Spark sorts the rows by conversation and turn within a hash partition (an external sort) and the tasks read them as a stream. Which rows repeat an
earlier one is settled before, by a combined minimum per (conversation, role and text) and a join whose hot side can be split, so no task
remembers the turns it has seen. The digest of a conversation is one sequential hash, so its rows do pass through one task, one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Productions of the role grammar; C is the conversation, P a run of user-assistant pairs.
GRAMMAR = (("C", ()), ("C", ("P",)), ("C", ("s", "P")), ("P", ("u", "a")), ("P", ("P", "u", "a")))
START, PAIRS = "C", "P"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": b"user", "a": b"assistant"}
SPACE = b" \t\n\x0b\x0c\r"
FINE, CUT, BAD = "", "t", "x"  # a row as it is; truncated; blank or repeated, so it must go
TABLE = 1 << 16

Item = tuple[int, int]


@dataclass(frozen=True)
class Automaton:
    """LR(0) item sets of the grammar: shift and goto by (state, symbol), the production to reduce in a state, where it may end."""

    goto: dict[tuple[int, str], int]
    reduce: dict[int, int]
    ends: frozenset[int]
    waits: frozenset[int]  # a user turn waits for its answer
    whole: frozenset[int]  # at least one pair, and nothing waits


def build(grammar=GRAMMAR) -> Automaton:
    heads = {head for head, _ in grammar}

    def close(kernel: frozenset[Item]) -> frozenset[Item]:
        items, new = set(kernel), list(kernel)
        while new:
            rule, dot = new.pop()
            right = grammar[rule][1]
            if dot < len(right) and right[dot] in heads:
                found = {(n, 0) for n, (head, _) in enumerate(grammar) if head == right[dot]} - items
                items |= found
                new += found
        return frozenset(items)

    first = close(frozenset((n, 0) for n, (head, _) in enumerate(grammar) if head == START))
    states, goto, place = [first], {}, 0
    while place < len(states):
        steps: dict[str, set[Item]] = {}
        for rule, dot in states[place]:
            if dot < len(grammar[rule][1]):
                steps.setdefault(grammar[rule][1][dot], set()).add((rule, dot + 1))
        for symbol in sorted(steps):
            reached = close(frozenset(steps[symbol]))
            if reached not in states:
                states.append(reached)
            goto[place, symbol] = states.index(reached)
        place += 1
    done = {n: [rule for rule, dot in state if dot == len(grammar[rule][1])] for n, state in enumerate(states)}
    return Automaton(
        goto,
        {n: rule for n, rules in done.items() for rule in rules if grammar[rule][0] != START},
        frozenset(n for n, rules in done.items() if any(grammar[rule][0] == START for rule in rules)),
        frozenset(n for n in done if (n, "a") in goto),
        frozenset(n for (_, symbol), n in goto.items() if symbol == PAIRS),
    )


LR = build()

#: The tops of the graph-structured stack: (state, states below, cost, audit), in order of state.
Tops = tuple[tuple[int, tuple[int, ...], int, str], ...]


def shift(state: int, below: tuple[int, ...], symbol: str) -> tuple[int, tuple[int, ...]] | None:
    """The stack after ``symbol`` and all reductions due; None if the grammar has no such turn there."""
    if (state, symbol) not in LR.goto:
        return None
    stack = (*below, state, LR.goto[state, symbol])
    while stack[-1] in LR.reduce:
        head, right = GRAMMAR[LR.reduce[stack[-1]]]
        stack = stack[: len(stack) - len(right)]
        stack = (*stack, LR.goto[stack[-1], head])
    return stack[-1], stack[:-1]


def merge(tops: dict[int, tuple], state: int, below: tuple[int, ...], cost: int, audit: str) -> bool:
    """Put a stack among the tops unless one of equal top is as good."""
    held = tops.get(state)
    if held is not None and held[1:] <= (cost, audit):
        return False
    tops[state] = (below, cost, audit)
    return True


def insert(tops: dict[int, tuple]) -> None:
    """All stacks that insertions lead to."""
    open_ = list(tops)
    while open_:
        state = open_.pop()
        below, cost, audit = tops[state]
        for symbol in ROLES:
            reached = shift(state, below, symbol)
            if reached and merge(tops, *reached, cost + INSERT, audit + "I"):
                open_.append(reached[0])


def prune(tops: dict[int, tuple]) -> None:
    """Drop stacks that cannot win: of equal future all but the best, and those without a pair that are too far behind."""
    for same in (LR.waits, LR.whole):
        found = sorted((state for state in tops if state in same), key=lambda state: tops[state][1:])
        for state in found[1:]:
            del tops[state]
        if same is LR.whole and found:
            best = tops[found[0]][1:]
            for state in [state for state in tops if state not in LR.waits | LR.whole]:
                # The empty stack may still keep a first system turn, which the whole one would delete; a lone system turn has no such advantage.
                if tops[state][1] > best[0] + DELETE if state in LR.ends else tops[state][1:] > best:
                    del tops[state]


def settle_tops(tops: dict[int, tuple]) -> tuple[Tops, int, str]:
    """The tops with costs relative to the least and without the letters that all share; that cost and those letters."""
    prune(tops)
    least = min(cost for _, cost, _ in tops.values())
    audits = [audit for _, _, audit in tops.values()]
    low, high = min(audits), max(audits)
    same = next((n for n, letter in enumerate(low) if n >= len(high) or letter != high[n]), len(low))
    return tuple((state, below, cost - least, audit[same:]) for state, (below, cost, audit) in sorted(tops.items())), least, low[:same]


@lru_cache(1)
def opening() -> tuple[Tops, int, str]:
    tops = {0: ((), 0, "")}
    insert(tops)
    return settle_tops(tops)


@lru_cache(TABLE)
def step(tops: Tops, initial: str, fault: str) -> tuple[Tops, int, str]:
    """After one row: the tops, the cost added and the letters settled."""
    new: dict[int, tuple] = {}
    extra = TRUNCATED if fault == CUT else 0
    for state, below, cost, audit in tops:
        merge(new, state, below, cost + DELETE, audit + "D")
        if fault != BAD:
            for symbol, price, letter in ((initial, KEEP, "K"), *((role, REROLE, "R") for role in ROLES)):
                if reached := shift(state, below, symbol):
                    merge(new, *reached, cost + price + extra, audit + letter)
    insert(new)
    return settle_tops(new)


def finish(tops: Tops) -> tuple[int, str]:
    """Cost and remaining letters of the best stack that may end."""
    return min((cost, audit) for state, _, cost, audit in tops if state in LR.ends)


@dataclass
class Conversation:
    """The rows of one conversation, one after another."""

    emit: Callable[[str, bytes, bytes, object], None]  # letter, role, text, turn of each row that stays or comes
    faults: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0})
    illegal: int = 0
    low: int | None = None
    high: int | None = None
    turns: int = 0
    cost: int = 0
    rows: int = 0
    audit: list[str] = field(default_factory=list)
    waiting: list[tuple[bytes, bytes, object]] = field(default_factory=list)
    taken: int = 0
    next_role: str = "u"
    last: tuple | None = None

    def __post_init__(self):
        self.tops, self.cost, letters = opening()
        self.audit.append(letters)

    def add(self, turn, role: bytes, text: bytes, repeats: bool, first_turn) -> None:
        """``repeats``: some row of the conversation has the same role and text; ``first_turn``: the earliest turn of these."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = role.decode("utf-8", "replace")[:1]
        if self.rows:
            self.illegal += self.last[1] + initial not in ("su", "ua", "au")
        bare = text.strip(SPACE)
        same = repeats and (turn != first_turn or self.last is not None and self.last[0] == turn and self.last[2:] == (role, text))
        found = "blank" if not bare else "duplicate" if same else "truncated" if bare[-1:] not in b".!?" else ""
        if found:
            self.faults[found] += 1
        self.last = (turn, initial, role, text)
        self.rows += 1
        self.waiting.append((role, text, turn))
        symbol = initial if initial in ("s", "u", "a") else ""
        self.tops, cost, letters = step(self.tops, symbol, FINE if not found else CUT if found == "truncated" else BAD)
        self.cost += cost
        self.write(letters)

    def write(self, letters: str) -> None:
        """Rows and insertions that are settled."""
        if not letters:
            return
        self.audit.append(letters)
        for letter in letters:
            role, text, turn = (b"", b"", None) if letter == "I" else self.waiting[self.taken]
            self.taken += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = ROLES[self.next_role]
            if not role.startswith(b"s"):
                self.next_role = "a" if self.next_role == "u" else "u"
            self.emit(letter, role, text, turn)
        del self.waiting[: self.taken]
        self.taken = 0

    def close(self) -> tuple[int, str]:
        cost, letters = finish(self.tops)
        self.write(letters)
        return self.cost + cost, "".join(self.audit)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def prepared(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """(conv, turn, role, text, present, repeats, first_turn), sorted by conversation and turn within partitions."""
    gone = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
        gone.alias("present"),
    ).withColumn("mark", F.when(F.col("present"), F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))
    seen = (
        rows.where("present")
        .groupBy("conv", "mark")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn"))["turn"].alias("first_turn"))
        .where("n > 1")
        .select(F.col("conv").alias("seen_conv"), F.col("mark").alias("seen_mark"), "first_turn")
    )
    marked = rows.join(seen, rows["conv"].eqNullSafe(seen["seen_conv"]) & (rows["mark"] == seen["seen_mark"]), "left")
    return (
        marked.select("conv", "turn", F.col("role").cast("binary"), F.col("text").cast("binary"), "present", F.col("seen_mark").isNotNull().alias("repeats"), "first_turn")
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
    )


def conversations(batches: Iterator[pa.RecordBatch], begin: Callable[[object], Conversation], end: Callable[[object, Conversation], None]) -> Iterator[None]:
    """Feed sorted rows to one ``Conversation`` after another; a step after each batch, so that the caller can pass on what it has."""
    own, held = None, None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv", "turn", "role", "text", "present", "repeats", "first_turn")]
        for conv, turn, role, text, present, repeats, first_turn in zip(*columns, strict=True):
            if held is None or conv != own:
                if held is not None:
                    end(own, held)
                own, held = conv, begin(conv)
            if present:
                held.add(turn, role, text, repeats, first_turn)
        yield
    if held is not None:
        end(own, held)
    yield


def in_batches(names: list[str], kinds: list[pa.DataType | None], begin: Callable, end: Callable) -> Callable:
    """A function for ``mapInArrow``: what ``begin`` and ``end`` put into ``out``, in batches of these columns; type None is that of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        out: list[tuple] = []
        types = [first.schema.field("conv").type if kind is None else kind for kind in kinds]
        for _ in conversations(chain([first], batches), lambda conv: begin(conv, out), lambda conv, held: end(conv, held, out)):
            if out:
                columns = zip(zip(*out, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in columns], names)
                out.clear()

    return run


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None) -> DataFrame:
    """One row per conversation: its id, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows count in order of turn (missing first; equal turns by role and text). A missing role or text is one space. A row's first fault counts: blank
    text, role and text of an earlier row, no ``.``, ``!`` or ``?`` at the end. ``audit`` has the initials of the cheapest keeps, reroles, deletes and inserts
    that give ``(s?(ua)+)?`` (a role counts by its first letter; an empty or other role can only be reroled or deleted), of equal cost the least in ASCII.
    Rows for which ``present`` is not true count for nothing but keep their conversation in the result; one without other rows
    has zeros, an empty audit and the digest of an empty text. A missing id is a conversation like any other. Repeated rows are
    rows. An empty table gives no rows. Other columns are not read.
    """

    def begin(conv, out: list[tuple]) -> Conversation:
        digest, lines = hashlib.sha256(), 0

        def emit(letter: str, role: bytes, text: bytes, turn) -> None:
            nonlocal lines
            digest.update(b"\n" * (lines > 0) + role + b":" + text)
            lines += 1

        held = Conversation(emit)
        held.digest = digest
        return held

    def end(conv, held: Conversation, out: list[tuple]) -> None:
        cost, audit = held.close()
        out.append((conv, held.gaps, *held.faults.values(), held.illegal, cost, audit, held.digest.hexdigest()))

    names = [conv_col, *NUMBERS, "audit", "repaired_sha256"]
    kinds = [turns.schema[conv_col].dataType, *[T.LongType()] * len(NUMBERS), T.StringType(), T.StringType()]
    work = in_batches(names, [None, *[pa.int64()] * len(NUMBERS), pa.string(), pa.string()], begin, end)
    return prepared(turns, conv_col, turn_col, role_col, text_col, present).mapInArrow(work, T.StructType([*map(T.StructField, names, kinds)]))


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: id, ``place`` (from 1), role, text, ``edit`` (K, R or I) and the turn the row had (NULL if inserted).

    Rules as in ``repair``. A conversation of which nothing stays has no rows. The columns ``place`` and ``edit`` are the operator's own.
    """

    def begin(conv, out: list[tuple]) -> Conversation:
        place = count(1)
        return Conversation(lambda letter, role, text, turn: out.append((conv, next(place), role.decode(), text.decode(), letter, turn)))

    names = [conv_col, "place", role_col, text_col, "edit", turn_col]
    kinds = [turns.schema[conv_col].dataType, T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.LongType()]
    work = in_batches(names, [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()], begin, lambda conv, held, out: held.close())
    return prepared(turns, conv_col, turn_col, role_col, text_col, None).mapInArrow(work, T.StructType([*map(T.StructField, names, kinds)]))
