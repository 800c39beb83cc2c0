"""Repair of conversations as the lightest derivation of a legal turn sequence.

Legal sequences of role initials are ``(s?(ua)+)?``. An item is the rest of a conversation from a row on
together with the state of that pattern before it; its axioms are the empty rests in an accepting state.
A deduction combines a finished item with an edit of the row before it, or with an inserted turn:

* Keep a row whose initial fits (0), Rerole it to user or assistant (2), Delete it (3), Insert an empty
  turn (2); a truncated row that stays costs 1 more; blank and repeated rows can only be deleted.

Values are ``(cost, rows edited, audit)``, the audit being the edits' initials. Every deduction raises cost
or rows and puts one letter in front of the audit, so values never fall and their order is kept: the
functions are superior and monotone, and items popped from the agenda are final (Knuth). The first time
the goal, all rows in the beginning state, is popped, it holds the least cost and of equal ones the
ASCII-least audit.

Rows are dealt by ranges of (conversation, turn, role, text digest) and read in that order, so a conversation
of any length spreads over tasks. A conversation within a task is repaired there. One that ranges over
several, or is longer than ``piece_rows`` or ``PIECE_BYTES``, is cut into pieces, each solved for all pairs of
states at its ends; equally cheap audits of the same rows are never prefixes of one another, so the
lightest path through the pieces (read backwards; audits are linked, not copied) is that of the whole. A task
then holds the audits of one conversation, a byte or so for a row, and never its texts.

Rows are collapsed before they are dealt: repeats of a role and text in a conversation are counted, and only
the first carries its text. Rows of the same turn are taken by role, then by the SHA-256 of the text, so
repeats are neighbours.

Null roles and texts count as one space (a blank text, a role that fits nowhere); null turns come first
and do not count for gaps; null ``conv_id`` are one conversation. Empty texts are blank. An empty table
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivetables.llm.common import exact, written
from archivetables.session import partitions_for

PIECE_ROWS = 1024
PIECE_BYTES = 4 << 20

# states of the pattern: beginning, after s, after u, after a; what each initial leads to
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
INTO = [[(b, i) for b, step in enumerate(STEPS) for i, e in step.items() if e == end] for end in range(4)]
ACCEPTING = (0, 3)
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of every row, damaged by the checksum of its place: 0 copies of
    a dropped row, 2 of a repeated one."""
    rows = exact(conversations, "conv_id", "turn", "role", "text")
    space = F.lit(" ")
    key = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def lightest(
    rows: list[tuple[str | None, int]], ends: tuple[int, ...], goal: tuple[int, int] | None = None
) -> dict[tuple[int, int], tuple[int, str]]:
    """``(cost, audit)`` of each item ``(rows edited, state before them)`` derived from axioms in the states
    ``ends``, up to the goal if there is one. A row is its initial, none if it has to go, and the cost of
    leaving it as it is."""
    final: dict[tuple[int, int], tuple[int, str]] = {}
    agenda = [(0, 0, "", end) for end in ends]
    heapify(agenda)
    while agenda:
        cost, edited, audit, state = heappop(agenda)
        item = (edited, state)
        if item in final:
            continue
        final[item] = cost, audit
        if item == goal:
            break
        row = rows[-1 - edited] if edited < len(rows) else None
        for before, initial in INTO[state]:
            if initial != "s":
                heappush(agenda, (cost + 2, edited, "I" + audit, before))
            if row and row[0] is not None:
                if row[0] == initial:
                    heappush(agenda, (cost + row[1], edited + 1, "K" + audit, before))
                elif initial != "s":
                    heappush(agenda, (cost + 2 + row[1], edited + 1, "R" + audit, before))
        if row:
            heappush(agenda, (cost + 3, edited + 1, "D" + audit, state))
    return final


def edited(turns: list[tuple[str, str | None]], audit: str, state: int = 0) -> list[tuple[str, str]]:
    """The role and text of the turns that the edits leave."""
    given, kept = iter(turns), []
    for letter in audit:
        if letter == "D":
            next(given)
            continue
        initial = next(i for i in STEPS[state] if i != "s")
        if letter == "K":
            role, text = next(given)
            initial = role[:1]
        elif letter == "R":
            role, text = NAMES[initial], next(given)[1]
        else:
            role, text = NAMES[initial], ""
        kept.append((role, text))
        state = STEPS[state][initial]
    return kept


TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
PATHS = pa.list_(
    pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
)
COUNTS = ("blank", "duplicate", "truncated", "illegal")
PLACES = ("first_turn", "last_turn", "turns_seen")  # of the turns that are not null
EDGES = ("first_initial", "last_initial")
PIECE_DDL = (
    "piece bigint, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_turn bigint, last_turn bigint, turns_seen bigint, first_initial string, last_initial string, "
    "paths array<struct<begin int, end int, cost bigint, audit string>>, turns array<struct<role string, text string>>"
)
PIECE_ARROW = [
    pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), PATHS, TURNS,
]


class _Piece:
    """Consecutive rows of a conversation, and what is counted in them."""

    def __init__(self) -> None:
        self.rows: list[tuple[str | None, int]] = []
        self.turns: list[tuple[str, str | None]] = []
        self.n_bytes = self.blank = self.duplicate = self.truncated = self.illegal = self.turns_seen = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str | None, fault: str) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.turns and self.turns[-1][0][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.turns_seen += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        gone = fault in ("blank", "duplicate")
        self.rows.append((None if gone else role[:1], int(fault == "truncated")))
        self.turns.append((role, None if gone else text))
        self.n_bytes += len(text or "")

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.n_bytes >= PIECE_BYTES

    def values(self, key: object, number: int, whole: bool) -> tuple:
        n = len(self.rows)
        if whole:
            cost, audit = lightest(self.rows, ACCEPTING, (n, 0))[n, 0]
            paths, turns = [(0, -1, cost, audit)], edited(self.turns, audit)
        else:
            turns, paths = self.turns, []
            for end in range(len(STEPS)):
                final = lightest(self.rows, (end,))
                paths += [(b, end, *final[n, b]) for b in range(len(STEPS)) if (n, b) in final]
        edges = (self.turns[0][0][:1], self.turns[-1][0][:1]) if n else (None, None)
        return (
            key, number, whole, *(getattr(self, c) for c in (*COUNTS, *PLACES)), *edges,
            [dict(zip(("begin", "end", "cost", "audit"), p, strict=True)) for p in paths],
            [{"role": r, "text": t} for r, t in turns],
        )


def collapsed(damaged: DataFrame) -> DataFrame:
    """The damaged rows in the order the pieces need, dealt by ranges of it: for each role and text of a
    conversation a row with the text at its first turn, and for each place the number of rows there."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("digest")
    here, none = F.col("copies") > 0, F.lit(None).cast("string")
    firsts = damaged.where(here & ~blank).groupBy("conv_id", "role", "text").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unplaced")
    )
    turn = F.when(~F.col("unplaced"), F.col("least")).alias("turn")
    firsts = firsts.select("conv_id", turn, "role", digest, "text", F.lit(0).cast("long").alias("n"), *[F.lit(False).alias(c) for c in ("is_blank", "is_cut")])
    places = damaged.select(
        "conv_id",
        *(F.when(here, c).alias(n) for n, c in (("turn", F.col("turn")), ("role", F.col("role")), ("digest", digest))),
        blank.alias("is_blank"), (~last).alias("is_cut"), "copies",
    )
    places = places.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("n"), F.max("is_blank").alias("is_blank"), F.max("is_cut").alias("is_cut")
    )
    places = places.select("conv_id", "turn", "role", "digest", none.alias("text"), "n", "is_blank", "is_cut")
    tasks = partitions_for(damaged.sparkSession)
    order = ["conv_id", "turn", "role", "digest"]
    return firsts.unionAll(places).repartitionByRange(tasks, *order).sortWithinPartitions(*order, "n")


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    """The conversations of ``collapsed`` rows as pieces, each repaired or solved for its ends."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(PIECE_DDL).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        begun, at_first, pieces = False, True, 0  # of the conversation at hand
        key, piece, held, n_bytes, text = None, _Piece(), [], 0, None

        def put(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal piece, number, n_bytes
            held.append(piece.values(key, number, whole))
            n_bytes += piece.n_bytes
            piece, number = _Piece(), number + 1
            if n_bytes >= PIECE_BYTES or len(held) == PIECE_ROWS:
                yield batch_of()

        def batch_of() -> pa.RecordBatch:
            nonlocal n_bytes
            kinds = [key_type, *PIECE_ARROW]
            arrays = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)]
            held.clear()
            n_bytes = 0
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            columns = ("conv_id", "turn", "role", "text", "n", "is_blank", "is_cut")
            for conv, turn, role, first, n, is_blank, is_cut in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True
            ):
                if begun and conv != key:
                    # it may have begun in the task before if it is this one's first
                    yield from put(not at_first and not pieces)
                    pieces, at_first = 0, False
                key, begun = conv, True
                if first is not None:
                    text = first
                    continue
                for _ in range(n):
                    if piece.full(piece_rows):
                        yield from put(False)
                        pieces += 1
                    fault = "truncated" if is_cut else ""
                    if is_blank or text is None:
                        fault = "blank" if is_blank else "duplicate"
                    piece.add(turn, role, text, fault)
                    text = None
        if begun:  # it may go on in the next task
            yield from put(False)
        if held:
            yield batch_of()

    return rows.mapInArrow(cut, schema)


class _Linked:
    """An audit as linked pieces of text; tails are shared."""

    __slots__ = ("text", "next", "choice")

    def __init__(self, text: str, next_: _Linked | None, choice: tuple) -> None:
        self.text, self.next, self.choice = text, next_, choice

    def before(self, other: _Linked) -> bool:
        """Whether it is ASCII-less than another; what both end with is not read."""
        mine, theirs, a, b = self, other, self.text, other.text
        while mine is not theirs or a != b:
            same = min(len(a), len(b))
            if a[:same] != b[:same]:
                return a < b
            a, b = a[same:], b[same:]
            while not a and mine is not None:
                mine = mine.next
                a = mine.text if mine is not None else ""
            while not b and theirs is not None:
                theirs = theirs.next
                b = theirs.text if theirs is not None else ""
            if mine is None or theirs is None:
                return mine is None and theirs is not None
        return False


TOTALS = ("gaps", *COUNTS, "cost")
CHOICE = pa.schema(
    [("piece", pa.int64()), ("begin", pa.int32()), ("audit", pa.string()), ("number", pa.int64()), *((t, pa.int64()) for t in TOTALS)]
)
CHOICE_DDL = "piece bigint, begin int, audit string, number bigint, " + ", ".join(f"{t} bigint" for t in TOTALS)


def gaps(first: int | None, last: int | None, seen: int) -> int:
    return 0 if first is None else last - first + 1 - seen


def _choices(pieces: DataFrame) -> DataFrame:
    """For each piece of a cut conversation its state and audit on the lightest path, its number, and the
    conversation's totals at its first piece."""
    light = pieces.drop("turns", "whole").repartition(
        partitions_for(pieces.sparkSession), "conv_id"
    ).sortWithinPartitions(F.col("conv_id"), F.desc("piece"))

    def solved(last: dict, best: dict, totals: dict) -> Iterator[pa.RecordBatch]:
        cost, path = best[0]
        number, rows = 0, []
        while path is not None:
            if path.choice:
                piece, begin = path.choice
                sums = [totals[t] if t != "cost" else cost for t in TOTALS] if not number else [None] * len(TOTALS)
                rows.append((piece, begin, path.text, number, *sums))
                number += 1
                if len(rows) == 1000:
                    yield _choice_batch(rows)
                    rows = []
            path = path.next
        if rows:
            yield _choice_batch(rows)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        behind, best, totals = None, {}, {}
        for batch in batches:
            for row in batch.to_pylist():
                if behind is None or row["conv_id"] != behind["conv_id"]:
                    if behind is not None:
                        yield from solved(behind, best, totals)
                    best = {end: (0, _Linked("", None, ())) for end in ACCEPTING}
                    totals = dict.fromkeys((*COUNTS, "turns_seen"), 0) | {"first_turn": None, "last_turn": None}
                    behind = None
                new: dict[int, tuple[int, _Linked]] = {}
                for path in row["paths"]:
                    if path["end"] in best:
                        cost, rest = best[path["end"]]
                        here = (cost + path["cost"], _Linked(path["audit"], rest, (row["piece"], path["begin"])))
                        old = new.get(path["begin"])
                        if old is None or here[0] < old[0] or (here[0] == old[0] and here[1].before(old[1])):
                            new[path["begin"]] = here
                best = new
                for count in COUNTS:
                    totals[count] += row[count]
                if behind is not None and behind["first_initial"] is not None and row["last_initial"] is not None:
                    totals["illegal"] += row["last_initial"] + behind["first_initial"] not in LEGAL
                if row["turns_seen"]:
                    shared = totals["first_turn"] is not None and totals["first_turn"] == row["last_turn"]
                    totals["turns_seen"] += row["turns_seen"] - shared
                    totals["first_turn"] = row["first_turn"]
                    if totals["last_turn"] is None:
                        totals["last_turn"] = row["last_turn"]
                totals["gaps"] = gaps(totals["first_turn"], totals["last_turn"], totals["turns_seen"])
                if row["first_initial"] is None and behind is not None:
                    row["first_initial"] = behind["first_initial"]
                behind = row
        if behind is not None:
            yield from solved(behind, best, totals)

    return light.mapInArrow(walk, CHOICE_DDL)


def _choice_batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CHOICE, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=CHOICE)


def repair(damaged: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``conv_id, number, audit, turns`` and, at number 0, the totals ``gaps, blank, duplicate, truncated,
    illegal, cost`` of every conversation of ``damaged`` (as ``damage`` gives it).

    ``turns`` are the repaired ones, ``audit`` the edits; a long conversation's are spread over rows by
    ``number``.
    """
    found = written(_pieces(collapsed(damaged), piece_rows), "conversation-pieces")
    lone = F.col("paths")[0]
    whole = found.where("whole").select(
        "conv_id", F.lit(0).cast("long").alias("number"), lone["audit"].alias("audit"), "turns",
        F.when(F.col("first_turn").isNull(), 0)
        .otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns_seen")).cast("long").alias("gaps"),
        *COUNTS, lone["cost"].alias("cost"), F.lit(True).alias("whole"),
    )
    cut = found.where("NOT whole")
    picked = cut.select("conv_id", "piece", "turns").join(_choices(cut), "piece")
    names = ["conv_id", "number", "audit", "turns", *TOTALS, "whole"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(*(batch.column(n).to_pylist() for n in ("turns", "audit", "begin")), strict=True)
            turns = [
                [{"role": r, "text": t} for r, t in edited([(x["role"], x["text"]) for x in rows], audit, begin)]
                for rows, audit, begin in given
            ]
            columns = [batch.column(n) for n in ("conv_id", "number", "audit")]
            totals = [batch.column(t) for t in TOTALS]
            no = pa.array([False] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(turns, TURNS), *totals, no], names)

    return whole.unionByName(picked.mapInArrow(apply, whole.select(*names).schema))


def repaired_text(turns: Column) -> Column:
    """Turns as ``role:text``, a line break between them."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def summary(repaired: DataFrame) -> DataFrame:
    """A row per conversation: its totals, its audit and the digest of its repaired text.

    A conversation in several rows is hashed as they come, in order; a digest cannot be computed in parts.
    """
    columns = ["conv_id", *TOTALS, "audit", "repaired_sha256"]
    whole = repaired.where("whole").withColumn(
        "repaired_sha256", F.sha2(repaired_text(F.col("turns")).cast("binary"), 256)
    )
    whole = whole.select(*columns)
    rows = repaired.where("NOT whole").select(
        "conv_id", "number", "audit", (F.size("turns") > 0).alias("some"),
        repaired_text(F.col("turns")).cast("binary").alias("text"), *TOTALS,
    )
    rows = rows.repartition(partitions_for(repaired.sparkSession), "conv_id").sortWithinPartitions("conv_id", "number")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, audit, totals, any_, key = None, [], {}, False, None

        def row() -> pa.RecordBatch:
            values = [key, *(totals[t] for t in TOTALS), "".join(audit), hasher.hexdigest()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, [key_type, *[pa.int64()] * len(TOTALS), pa.string(), pa.string()], strict=True)],
                columns,
            )

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            for given in batch.to_pylist():
                if given["number"] == 0:
                    if hasher is not None:
                        yield row()
                    hasher, audit, totals, any_, key = hashlib.sha256(), [], given, False, given["conv_id"]
                audit.append(given["audit"])
                if given["some"]:
                    if any_:
                        hasher.update(b"\n")
                    hasher.update(given["text"])
                    any_ = True
        if hasher is not None:
            yield row()

    return whole.unionByName(rows.mapInArrow(digest, whole.schema))


def _sql_step(value: str) -> str:
    """The checksum's shift register after a byte."""
    return (
        f"list_reduce([{value}, 1, 2, 3, 4, 5, 6, 7, 8], "
        "lambda v, i: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))"
    )


def _sql_least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _sql_edit(letter: str, cost: str, rest: str) -> str:
    """A deduction: null where there is no rest, or no such edit (a null cost)."""
    return f"CASE WHEN {rest} IS NOT NULL AND ({cost}) IS NOT NULL THEN {{'cost': {rest}.cost + {cost}, 'audit': '{letter}' || {rest}.audit}} END"


def _sql_inserted(values: tuple[str, ...]) -> tuple[str, ...]:
    """The four states' values after one more chance to insert a turn."""
    after = (2, 2, 3, 2)
    return tuple(_sql_least(v, _sql_edit("I", "2", values[a])) for v, a in zip(values, after, strict=True))


_DELETE = tuple(_sql_edit("D", "3", f"q{i}") for i in range(4))


def _sql_row(state: int) -> str:
    options = [_DELETE[state]]
    for initial, end in STEPS[state].items():
        options.append(_sql_edit("K", f"CASE WHEN NOT gone AND initial = '{initial}' THEN late END", f"q{end}"))
        if initial != "s":
            options.append(_sql_edit("R", "CASE WHEN NOT gone THEN 2 + late END", f"q{end}"))
    return _sql_least(*options)


# The same by dynamic programming over suffixes, a row for each recursion; states of the pattern as q0 to q3.
# The repaired text follows from the audit, turn by turn.
REPAIR_SQL = rf"""WITH RECURSIVE
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(
             string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda c: ord(c)::UBIGINT)),
           lambda crc, byte: {_sql_step('xor(crc, byte)')}), 4294967295::UBIGINT) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM given WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place
  FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS seen,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed),
turns AS (
  SELECT conv_id, place, role, text, initial, blank OR seen AS gone,
         CASE WHEN cut THEN 1 ELSE 0 END AS late FROM judged),
counts AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
         count(*) FILTER (cut AND NOT seen AND NOT blank) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ends AS (
  SELECT conv_id, n AS place, {{'cost': 0, 'audit': ''}} AS q0, {{'cost': 4, 'audit': 'II'}} AS q1,
         {{'cost': 2, 'audit': 'I'}} AS q2, {{'cost': 0, 'audit': ''}} AS q3 FROM counts),
solved AS (
  SELECT * FROM ends
  UNION ALL
  SELECT conv_id, place - 1, {', '.join(f'{v} AS q{i}' for i, v in enumerate(_sql_inserted(('i0', 'i1', 'i2', 'i3'))))}
  FROM (
    SELECT conv_id, place, {', '.join(f'{v} AS i{i}' for i, v in enumerate(_sql_inserted(('r0', 'r1', 'r2', 'r3'))))}
    FROM (
      SELECT s.conv_id, s.place, {', '.join(f'{_sql_row(i)} AS r{i}' for i in range(4))}
      FROM solved s JOIN turns t ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND s.place = t.place) AS edits)
    AS once),
best AS (SELECT conv_id, q0.cost AS cost, q0.audit AS audit FROM solved WHERE place = 0),
letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS pos
  FROM best WHERE audit <> ''),
numbered AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS place,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY pos) AS kept
  FROM letters),
filled AS (
  SELECT n.conv_id, pos, letter, kept, t.role, t.text,
         max(CASE WHEN letter = 'K' AND kept = 1 AND initial = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY n.conv_id) AS headed
  FROM numbered n LEFT JOIN turns t
    ON letter <> 'I' AND n.conv_id IS NOT DISTINCT FROM t.conv_id AND n.place = t.place),
repaired AS (
  SELECT conv_id, string_agg(
    CASE WHEN letter = 'K' THEN role
         WHEN (kept - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS text
  FROM filled WHERE letter <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id"""
