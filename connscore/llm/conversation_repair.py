"""Conversation repair by a weighted generalised LR parse over the role grammar.

A legal conversation is empty, or an optional ``s`` and one or more pairs
``u a`` (the first letters of the roles).  The parser reads a conversation's
rows in order.  Beside the plain shift of a row it may delete it, shift it as
``u`` or ``a`` (rerole), or shift a ``u`` or ``a`` that is not there (insert),
each at its cost.  All parses go on at once: their stacks share the cells
below, reductions follow the table's lookahead, and equal stacks are merged by
the least (cost, audit).

Spark deals the rows by conversation and sorts them; a task reads them as a
stream.  It holds at most ten stacks, each with a running SHA-256 of the text
repaired so far and its audit, so a conversation of any length takes constant
memory beside its audit.  A hash is one chain over a conversation's text, so
one conversation is read by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from connscore.llm import common as C

#: Rules of the role grammar, the start symbol first.
RULES = (("C", ()), ("C", ("T",)), ("C", ("s", "T")), ("T", ("T", "P")), ("T", ("P",)), ("P", ("u", "a")))

#: Costs of the actions, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: What may be inserted, and what a row may become.
ROLES = {"u": "user", "a": "assistant"}

#: Neighbouring role letters that are not counted as illegal.
LEGAL = frozenset({"su", "ua", "au"})

#: Rows after which the finished part of the repaired text goes into the running hashes.
FLUSH = 64

SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")


class Table:
    """LR states of a grammar, reductions by the terminals that may follow."""

    def __init__(self, rules: tuple = RULES):
        self.rules = rules
        self.heads = {head for head, _ in rules}
        self.follow = self._follow()
        start = self._closure({("", (rules[0][0],), 0)})
        self.states, self.goto, self._moves = [start], {}, {}
        for number, state in enumerate(self.states):   # grows while it is read
            for symbol in sorted({rhs[dot] for _, rhs, dot in state if dot < len(rhs)}):
                to = self._closure({(h, rhs, dot + 1) for h, rhs, dot in state if rhs[dot:dot + 1] == (symbol,)})
                if to not in self.states:
                    self.states.append(to)
                self.goto[number, symbol] = self.states.index(to)

    def _closure(self, items: set) -> frozenset:
        items = set(items)
        while True:
            wanted = {rhs[dot] for _, rhs, dot in items if dot < len(rhs)}
            more = {(h, rhs, 0) for h, rhs in self.rules if h in wanted} - items
            if not more:
                return frozenset(items)
            items |= more

    def _first(self, symbols: tuple, seen: frozenset = frozenset()) -> set:
        """Terminals that can begin ``symbols``; None among them if all can be empty."""
        if not symbols:
            return {None}
        head = symbols[0]
        if head not in self.heads:
            return {head}
        own: set = set()
        for h, rhs in self.rules:
            if h == head and (h, rhs) not in seen:
                own |= self._first(rhs, seen | {(h, rhs)})
        return own - {None} | (self._first(symbols[1:], seen) if None in own else set())

    def _follow(self) -> dict:
        follow: dict = {h: set() for h in self.heads}
        follow[self.rules[0][0]].add("$")
        while True:
            size = sum(map(len, follow.values()))
            for head, rhs in self.rules:
                for i, symbol in enumerate(rhs):
                    if symbol in self.heads:
                        after = self._first(rhs[i + 1:])
                        follow[symbol] |= after - {None} | (follow[head] if None in after else set())
            if size == sum(map(len, follow.values())):
                return follow

    def moves(self, stack: tuple, terminal: str) -> list[tuple]:
        """Stacks after all reductions that ``terminal`` allows and its shift; ``$``: the stack itself if it accepts."""
        known = self._moves.get((stack, terminal))
        if known is not None:
            return known
        out, work, seen = [], [stack], {stack}
        while work:
            top = work.pop()
            state = self.states[top[0]]
            if terminal == "$" and any(h == "" and dot == 1 for h, _, dot in state):
                out.append(top)
            to = self.goto.get((top[0], terminal))
            if to is not None:
                out.append((to, top))
            for head, rhs, dot in state:
                if head and dot == len(rhs) and terminal in self.follow[head]:
                    below = top
                    for _ in rhs:
                        below = below[1]
                    new = (self.goto[below[0], head], below)
                    if new not in seen:
                        seen.add(new)
                        work.append(new)
        self._moves[stack, terminal] = out
        return out


class Parse:
    """The parses of one conversation, a row at a time.

    A parse is (cost, rank, audit since the last flush, lines since then, hash
    and audit up to it).  Audits of live parses are never prefixes of each
    other right after a row, so the rank given at a flush decides later ties.
    """

    def __init__(self, table: Table):
        self.table = table
        self.tops = {(0, None): (0, 0, "", None, None, None)}
        self.rows = 0

    @staticmethod
    def _offer(tops: dict, stack: tuple, parse: tuple) -> bool:
        old = tops.get(stack)
        if old is None or parse[:3] < old[:3]:
            tops[stack] = parse
            return True
        return False

    def _with_inserts(self) -> dict:
        tops, fresh = dict(self.tops), list(self.tops)
        while fresh:
            changed = []
            for stack in fresh:
                cost, rank, audit, lines, done, before = tops[stack]
                for terminal, role in ROLES.items():
                    for to in self.table.moves(stack, terminal):
                        if self._offer(tops, to, (cost + INSERT, rank, audit + "I", (lines, role, ""), done, before)):
                            changed.append(to)
            fresh = changed
        return tops

    def read(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        tops: dict = {}
        stays = TRUNCATED if truncated else 0
        for stack, (cost, rank, audit, lines, done, before) in self._with_inserts().items():
            self._offer(tops, stack, (cost + DELETE, rank, audit + "D", lines, done, before))
            if must_go:
                continue
            if role:
                for to in self.table.moves(stack, role[0]):
                    self._offer(tops, to, (cost + stays, rank, audit + "K", (lines, role, text), done, before))
            for terminal, name in ROLES.items():
                for to in self.table.moves(stack, terminal):
                    self._offer(tops, to, (cost + stays + REROLE, rank, audit + "R", (lines, name, text), done, before))
        self.tops = tops
        self.rows += 1
        if self.rows % FLUSH == 0:
            order = sorted(tops, key=lambda s: tops[s][1:3])
            self.tops = {s: (tops[s][0], i, "", None, self._hashed(tops[s]), (tops[s][5], tops[s][2]))
                         for i, s in enumerate(order)}

    @staticmethod
    def _hashed(parse: tuple):
        lines, out = parse[3], []
        while lines is not None:
            lines, role, text = lines
            out.append(f"{role}:{text}")
        done = parse[4]
        if done is None and not out:
            return None
        if done is None:
            done, first = hashlib.sha256(), True
        else:
            done, first = done.copy(), False
        for line in reversed(out):
            done.update(line.encode() if first else b"\n" + line.encode())
            first = False
        return done

    def best(self) -> tuple[int, str, str]:
        """Cost, audit and SHA-256 of the cheapest parse, the ASCII-least audit among equals."""
        tops: dict = {}
        for stack, parse in self._with_inserts().items():
            for to in self.table.moves(stack, "$"):
                self._offer(tops, to, parse)
        parse = min(tops.values(), key=lambda p: p[:3])
        pieces, before = [parse[2]], parse[5]
        while before is not None:
            before, piece = before
            pieces.append(piece)
        done = self._hashed(parse) or hashlib.sha256()
        return parse[0], "".join(reversed(pieces)), done.hexdigest()


class _Conversation:
    """What is reported of one conversation."""

    def __init__(self, table: Table, conv_id: int | None):
        self.conv_id, self.parse = conv_id, Parse(table)
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.letter: str | None = None

    def read(self, turn: int | None, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if turn is not None and turn != self.last_turn:   # rows come by turn
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        letter = role[:1]
        self.illegal += self.letter is not None and self.letter + letter not in LEGAL
        self.letter = letter
        self.parse.read(role, text, blank or duplicate, truncated)

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.parse.best())


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn, to one row per conversation."""
    schema = pa.schema([(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                       + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    table, now, out = Table(), None, []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for batch in batches:
        for conv_id, gone, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.report())
                now = _Conversation(table, conv_id)
            if not gone:
                now.read(*row)
        if len(out) >= 1000:
            yield packed()
            out = []
    if now is not None:
        out.append(now.report())
    if out:
        yield packed()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with their planted damage: conv_id, turn, role, text, gone (nulls of role and text as one space).

    crc32 of ``conv_id:turn`` (a null as one space) modulo 20 decides: 0 the row
    is gone, 1 its text is empty, 2 its ``.``, ``!`` and ``?`` go, 3 it comes
    twice, 4 its role is user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"),
        (F.crc32(key) % 20).alias("damage"))
    damage = F.col("damage")
    return rows.select(
        "conv_id", "turn", F.when(damage == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(damage.isin(0, 1), F.lit("")).when(damage == 2, F.regexp_replace("text", "[.!?]", ""))
         .otherwise(F.col("text")).alias("text"),
        (damage == 0).alias("gone"),
        F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair(rows: DataFrame, gone_column: str | None = None) -> DataFrame:
    """Per conversation: its faults, the cheapest repair and the hash of the repaired text.

    ``rows`` has conv_id, turn, role and text; ``gone_column`` names a boolean
    column that is true for rows that only say that their conversation exists.
    Other columns are not read.  Null role or
    text counts as one space, a null conv_id is a conversation of its own.
    Rows go by turn (nulls first), equal turns by role and text in byte order;
    of equal rows the first is no duplicate.  A row with an empty role cannot be
    kept as it is.  Without rows: zeros, an empty audit, the hash of nothing.
    An empty table gives an empty table.
    """
    space = F.lit(" ")
    gone = F.col(gone_column) if gone_column else F.lit(False)
    rows = rows.select("conv_id", gone.alias("gone"), "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text")).repartition("conv_id")
    # the window's keys hold conv_id, so it needs no second shuffle
    equal = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    again = ~blank & (F.col("seen") > 1)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    flagged = rows.withColumn("seen", F.row_number().over(equal)).select(
        "conv_id", "gone", "turn", "role", "text", blank.alias("blank"), again.alias("duplicate"),
        (~blank & ~again & cut).alias("truncated"), "seen")
    in_order = flagged.sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen").drop("seen")
    with C.settings(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        return C.written(in_order.mapInArrow(_repaired, SCHEMA), "repaired")
