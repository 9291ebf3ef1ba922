"""Repair of damaged conversations by weighted interval parsing.

A repaired conversation is a sentence of a small grammar: an optional system turn,
then user and assistant in turn. Rows may be kept, given another role or deleted,
and turns may be inserted, each at a cost. Spans of rows are parsed bottom-up by
their length (CYK over rules of two parts): a span's cell holds, for each kind of
turn sequence it can become, the cheapest edits and among those the least ones in
ASCII. Equal shapes of spans are parsed once a task.

Any two neighbouring spans combine by the same rules. So a conversation of any
length is parsed in pieces, on as many tasks as its rows fill, and the cells of
the pieces meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import partitions, read

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
# Rows that one chart spans, all splits of all spans; longer conversations are
# combined from such pieces.
PIECE = 16
# Charts of pieces that a task remembers.
CHARTS = 50_000

# What a span can become. D: nothing; xy: turns from x to y, u for user and a for
# assistant; s: the system turn alone, sx: it and turns up to x.
KINDS = ("D", "uu", "ua", "au", "aa", "s", "su", "sa")
# The grammar in Chomsky normal form: kind of the left part and of the right part ->
# kind of both. Deleted rows vanish into either side; roles must alternate.
RULES = {("D", k): k for k in KINDS} | {(k, "D"): k for k in KINDS} | {
    (a + b, c + d): a + d for a in "uas" for b in "ua" for c in "ua" for d in "ua"
    if b != c and a + b in KINDS} | {("s", "u" + d): "s" + d for d in "ua"}
# A whole conversation must become one of these.
GOALS = ("D", "ua", "sa")
NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}
ROLES = {"u": "user", "a": "assistant"}

Cell = dict[str, tuple[int, str]]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for a, (cost, edits) in left.items():
        for b, (more, others) in right.items():
            kind = RULES.get((a, b))
            if kind is not None:
                found = (cost + more, edits + others)
                if kind not in out or found < out[kind]:
                    out[kind] = found
    return out


def _better(*cells: Cell) -> Cell:
    return {k: min(c[k] for c in cells if k in c) for k in KINDS if any(k in c for c in cells)}


_ONE: Cell = {k: (INSERT, "I") for k in ("uu", "aa")}
# What insertion alone gives: one turn or two. Three or more are never the cheapest.
INSERTED = _better(_ONE, combine(_ONE, _ONE))


def closed(cell: Cell) -> Cell:
    """The cell with turns inserted before and behind."""
    before = _better(cell, combine(INSERTED, cell))
    return _better(before, combine(before, INSERTED))


def leaf(symbol: str, count: int) -> Cell:
    """The cell of one row, or of ``count`` rows that must go (symbol ``x``).

    Symbols are the initial of the role (``o``: any other), in upper case for a
    truncated row.
    """
    if symbol == "x":
        return closed({"D": (DELETE * count, "D" * count)})
    role, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    cell = {"D": (DELETE, "D")} | {k: (REROLE + extra, "R") for k in ("uu", "aa")}
    kept = {"u": "uu", "a": "aa", "s": "s"}.get(role)
    if kept:
        cell[kept] = (KEEP + extra, "K")
    return closed(cell)


def chart(shape: tuple[tuple[str, int], ...]) -> Cell:
    """The cell of a piece: every span from every split of it, shorter spans first."""
    n = len(shape)
    spans = {(i, i + 1): leaf(*shape[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            spans[i, i + length] = _better(*(
                combine(spans[i, k], spans[k, i + length]) for k in range(i + 1, i + length)))
    return spans[0, n]


class Parse:
    """Rows one by one into the cell of their whole span; holds a few short strings
    of edits for each span that waits for its neighbour of equal length."""

    def __init__(self, charts: dict[tuple, Cell] | None = None) -> None:
        self.charts = {} if charts is None else charts
        self.shape: list[tuple[str, int]] = []
        self.spans: list[tuple[int, Cell]] = []

    def add(self, symbol: str, count: int = 1) -> None:
        if symbol == "x" and self.shape and self.shape[-1][0] == "x":
            count += self.shape.pop()[1]
        elif len(self.shape) == PIECE:
            self._flush()
        self.shape.append((symbol, count))

    def _flush(self) -> None:
        if self.shape:
            shape, self.shape = tuple(self.shape), []
            cell = self.charts.get(shape)
            if cell is None:
                cell = chart(shape)
                if len(self.charts) < CHARTS:
                    self.charts[shape] = cell
            self.join(cell)

    def join(self, cell: Cell) -> None:
        size = 1
        while self.spans and self.spans[-1][0] <= size:
            before, left = self.spans.pop()
            size, cell = size + before, combine(left, cell)
        self.spans.append((size, cell))

    def cell(self) -> Cell:
        self._flush()
        cell: Cell = {"D": (0, "")}
        for _, left in reversed(self.spans):
            cell = combine(left, cell)
        return cell


def best(cell: Cell) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    return min(cell[k] for k in GOALS if k in cell)


# --- rows ---------------------------------------------------------------------

def _text(column: str) -> Column:
    """As text, a null as one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with seeded damage: ``conv_id``, ``turn``, ``role``, ``text`` and how
    often the row is there now, ``copies``. A dropped row stays, with none."""
    kind = F.crc32(F.encode(F.concat(_text("conv_id"), F.lit(":"), _text("turn")), "UTF-8")) % 20
    text = _text("text")
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(_text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Equal rows of a conversation as one with a count, written. ``line`` is the
    digest of conversation, role and text; texts are not kept of blank rows."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    there = F.col("copies") > 0
    line = F.unhex(F.sha2(F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"),
        F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    marked = rows.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, F.col("role")).alias("role"),
        F.when(there, line).alias("line"), F.when(there & ~blank, F.col("text")).alias("text"),
        (there & blank).alias("blank"),
        (there & ~blank & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"), "copies")
    return materialize(
        marked.groupBy("conv_id", "turn", "role", "line").agg(
            F.sum("copies").alias("copies"), F.first("text").alias("text"),
            F.first("blank").alias("blank"), F.first("truncated").alias("truncated")),
        "repair-rows")


def _faults(rows: DataFrame) -> DataFrame:
    """The ordered rows without texts, and whether an earlier turn says the same.
    Only lines of several turns are joined back, from a written table."""
    own = rows.select("conv_id", "turn", "role", "line", "copies", "blank", "truncated")
    again = materialize(
        own.where("copies > 0 and not blank").groupBy(F.col("line").alias("l_line")).agg(
            F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1").select("l_line", F.col("first.turn").alias("first_turn")), "repair-lines")
    later = F.col("l_line").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return own.join(again, own["line"] == again["l_line"], "left").select(
        *own.columns, later.alias("later"))


COUNTS = ("blank", "duplicate", "truncated", "illegal")
PIECE_SCHEMA = ("conv_id bigint, part int, open boolean, n bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
                + ", first string, last string, low bigint, high bigint, turns bigint, "
                "cells array<struct<kind:string,cost:bigint,edits:string>>")
_CELLS = pa.list_(pa.struct([("kind", pa.string()), ("cost", pa.int64()), ("edits", pa.string())]))
PARSED_SCHEMA = ("conv_id bigint, gaps bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
                 + ", cost bigint, audit string")
_LEGAL = {"su", "ua", "au"}


class Run:
    """What is known of neighbouring rows of one conversation."""

    def __init__(self, conv_id: int | None, charts: dict | None = None) -> None:
        self.conv_id, self.parse, self.n = conv_id, Parse(charts), 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None
        self.low = self.high = None
        self.turns = 0

    def _turns(self, low: int | None, high: int | None, turns: int) -> None:
        """Turns come in order, so one turn is counted twice only where runs meet."""
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def add(self, turn, role, copies, blank, truncated, later) -> None:
        if not copies:
            return
        initial = role[:1]
        # Copies of a row stand next to each other: never a legal pair.
        self.counts["illegal"] += copies - 1 + (self.n > 0 and self.last + initial not in _LEGAL)
        self.first = initial if self.first is None else self.first
        self.last, self.n = initial, self.n + copies
        self._turns(turn, turn, turn is not None)
        if blank or later:
            self.counts["blank" if blank else "duplicate"] += copies
            self.parse.add("x", copies)
            return
        self.counts["duplicate"] += copies - 1
        self.counts["truncated"] += truncated
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.parse.add(symbol.upper() if truncated else symbol)
        if copies > 1:
            self.parse.add("x", copies - 1)

    def join(self, piece: dict) -> None:
        """The same from a piece behind this one."""
        if piece["n"]:
            self.counts["illegal"] += self.n > 0 and self.last + piece["first"] not in _LEGAL
            self.first = piece["first"] if self.first is None else self.first
            self.last, self.n = piece["last"], self.n + piece["n"]
        for c in COUNTS:
            self.counts[c] += piece[c]
        self._turns(piece["low"], piece["high"], piece["turns"])
        self.parse.join({c["kind"]: (c["cost"], c["edits"]) for c in piece["cells"]})

    def piece(self, part: int, is_open: bool) -> dict:
        cell = self.parse.cell()
        if not is_open:
            cell = {"D": best(cell)}
        return {"conv_id": self.conv_id, "part": part, "open": is_open, "n": self.n, **self.counts,
                "first": self.first, "last": self.last, "low": self.low, "high": self.high,
                "turns": self.turns,
                "cells": [{"kind": k, "cost": c, "edits": e} for k, (c, e) in cell.items()]}

    def parsed(self) -> dict:
        cost, audit = best(self.parse.cell())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": cost, "audit": audit}


def _table(rows: Sequence[dict], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(list(rows), schema=like)


_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("open", pa.bool_()), ("n", pa.int64()),
                     *[(c, pa.int64()) for c in COUNTS], ("first", pa.string()), ("last", pa.string()),
                     ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("cells", _CELLS)])
_PARSED = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in COUNTS],
                     ("cost", pa.int64()), ("audit", pa.string())])


def parse_conversations(rows: DataFrame) -> DataFrame:
    """Counts, cost and edits of each conversation of ``_ordered`` rows.

    Rows are sorted over all tasks by conversation and turn. A conversation inside
    one task is done there. One that crosses to the next task, so at most the first
    and the last of a task, leaves a piece on each, and the pieces are joined.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, done, first = TaskContext.get().partitionId(), None, [], True
        charts: dict[tuple, Cell] = {}
        for batch in batches:
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or conv_id != own.conv_id:
                    if own is not None:
                        done.append(own.piece(part, first))
                        first = False
                    own = Run(conv_id, charts)
                own.add(*row)
            yield _table(done, _PIECES)
            done = []
        if own is not None:
            yield _table([own.piece(part, True)], _PIECES)

    def join(pieces: pa.Table) -> pa.Table:
        rows = pieces.sort_by("part").to_pylist()
        own = Run(rows[0]["conv_id"])
        for piece in rows:
            own.join(piece)
        return pa.Table.from_batches([_table([own.parsed()], _PARSED)])

    order = ("conv_id", "turn", "role", "line")
    ranged = _faults(rows).repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    pieces = materialize(
        ranged.select("conv_id", "turn", "role", "copies", "blank", "truncated", "later")
        .mapInArrow(run, PIECE_SCHEMA), "repair-pieces")
    whole = pieces.where("not open").select(
        "conv_id",
        F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
        .cast("bigint").alias("gaps"), *COUNTS,
        F.get("cells", F.lit(0))["cost"].alias("cost"), F.get("cells", F.lit(0))["edits"].alias("audit"))
    crossing = pieces.where("open").groupBy("conv_id").applyInArrow(join, PARSED_SCHEMA)
    return whole.unionByName(crossing)


def _digests(parsed: DataFrame, rows: DataFrame) -> DataFrame:
    """``parsed`` with the digest of each repaired conversation.

    A digest is sequential: the rows of a conversation pass through one task, in
    order and one by one; only its edits and a batch of rows are held.
    """
    names = parsed.columns
    nothing = [F.lit(None).cast(t).alias(f"r_{c}") for c, t in
               (("turn", "bigint"), ("role", "string"), ("line", "binary"), ("text", "string"), ("copies", "bigint"))]
    heads = parsed.select(*names, F.lit(False).alias("is_row"), *nothing)
    lines = rows.where("copies > 0").select(
        "conv_id", *[F.lit(None).cast(parsed.schema[c].dataType).alias(c) for c in names[1:]],
        F.lit(True).alias("is_row"), *[F.col(c).alias(f"r_{c}") for c in ("turn", "role", "line", "text", "copies")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None

        def begin(row: dict) -> None:
            nonlocal head, digest, edits, said, last
            head, digest, edits, said, last = row, hashlib.sha256(), iter(row["audit"]), 0, ""

        def say(role: str, text: str) -> None:
            nonlocal said, last
            digest.update(("\n" * (said > 0) + role + ":" + text).encode())
            said, last = said + 1, role[:1]

        def step(role: str | None, text: str | None) -> bool:
            """Edits up to that of the next row; with no row left, those behind."""
            for edit in edits:
                if edit == "I":
                    say(ROLES[NEXT[last]], "")
                    continue
                if edit != "D":
                    say(role if edit == "K" else ROLES[NEXT[last]], text or "")
                return True
            return False

        def end() -> dict:
            step(None, None)
            return {**{c: head[c] for c in names}, "repaired_sha256": digest.hexdigest()}

        digest = edits = said = last = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if not row["is_row"]:
                    if head is not None:
                        done.append(end())
                    begin(row)
                    continue
                for _ in range(row["r_copies"]):
                    step(row["r_role"], row["r_text"])
            yield _table(done, out)
        if head is not None:
            yield _table([end()], out)

    out = _PARSED.append(pa.field("repaired_sha256", pa.string()))
    both = heads.unionByName(lines)
    return (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", "is_row", "r_turn", "r_role", "r_line")
        .mapInArrow(run, PARSED_SCHEMA + ", repaired_sha256 string")
    )


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation of ``rows``, which have
    ``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` (see ``damaged``).

    Returns per ``conv_id``, null among them, the contract's counts, ``cost``,
    ``audit`` and ``repaired_sha256``. Rows stand by turn, nulls first; rows of one
    turn by role and then by the digest of their text, so repeated rows stand
    together. Empty texts and those of white space are blank. A conversation with
    no row left has zeros and empty edits; an empty table gives no rows. Texts of
    any length pass as they are; other columns are ignored.
    """
    ordered = _ordered(rows)
    return _digests(parse_conversations(ordered), ordered)


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair_conversations(damaged(read(spark, sf_dir, "conversations")))


# The same by a path from state to state, row after row.
OP12_SQL = r"""
with recursive keyed as (
    select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as mark
    from conversations),
hashed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as body,
           xor(list_reduce(list_prepend(4294967295::ubigint,
               list_transform(range(1, length(mark) + 1), lambda i: ascii(mark[i])::ubigint)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)::ubigint[]),
                   lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end)),
               4294967295::ubigint) % 20 as kind
    from keyed),
left_over as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
           case when kind = 1 then '' when kind = 2 then regexp_replace(body, '[.!?]', '', 'g')
                else body end as body
    from hashed, range(1, 3) r(copy) where kind <> 0 and (copy = 1 or kind = 3)),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, body) as i
    from left_over),
numbered as (
    select *, row_number() over (partition by conv_id, role, body order by i) as nth from placed),
judged as (
    select *, left(role, 1) as initial, not regexp_matches(body, '[^\x20\x09-\x0D]') as is_blank,
           regexp_matches(body, '[^\x20\x09-\x0D]') and nth > 1 as is_duplicate,
           regexp_matches(body, '[^\x20\x09-\x0D]') and nth = 1
               and not regexp_matches(body, '[.!?][\x20\x09-\x0D]*$') as is_truncated,
           lag(left(role, 1)) over (partition by conv_id order by i) as earlier
    from numbered),
counted as (
    select conv_id, max(i) as n,
           coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
           count(*) filter (is_blank) as blank, count(*) filter (is_duplicate) as duplicate,
           count(*) filter (is_truncated) as truncated,
           count(*) filter (earlier is not null and earlier || initial not in ('su', 'ua', 'au')) as illegal
    from judged group by conv_id),
inserts(state, after, added, edits) as (
    values ('', '', 0, ''), ('', 'u', 3, 'I'), ('', 'a', 6, 'II'), ('s', 's', 0, ''), ('s', 'u', 3, 'I'),
           ('s', 'a', 6, 'II'), ('u', 'u', 0, ''), ('u', 'a', 3, 'I'), ('u', 'u', 6, 'II'),
           ('a', 'a', 0, ''), ('a', 'u', 3, 'I'), ('a', 'a', 6, 'II')),
names(state, list) as (
    values ('I' || 'u', ['user:']), ('I' || 'a', ['assistant:']), ('IIu', ['assistant:', 'user:']),
           ('IIa', ['user:', 'assistant:']), ('s', []::varchar[]), ('u', []), ('a', []), ('', [])),
fillers as (
    select i.*, n.list from inserts i join names n on n.state = i.edits || i.after or (i.edits = '' and n.state = i.after)),
follows(state, initial) as (values ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
walk(conv_id, i, state, best) as (
    select conv_id, 0::bigint, '', {'cost': 0, 'audit': '', 'lines': []::varchar[]} from counted
    union all
    select conv_id, i, state, min(best) from (
        select w.conv_id, r.i, case when o.edit = 'D' then f.after else o.role end as state,
               {'cost': (w.best.cost + f.added + case o.edit when 'D' then 4 when 'R' then 3 else 0 end
                    + case when o.edit <> 'D' and r.is_truncated then 3 else 0 end)::integer,
                'audit': w.best.audit || f.edits || o.edit,
                'lines': w.best.lines || f.list || case o.edit when 'D' then []::varchar[] when 'K' then [r.role || ':' || r.body]
                    else [case o.role when 'u' then 'user:' else 'assistant:' end || r.body] end} as best
        from walk w join judged r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1
        join fillers f on f.state = w.state
        join (values ('D', ''), ('K', 's'), ('K', 'u'), ('K', 'a'), ('R', 'u'), ('R', 'a')) o(edit, role)
          on o.edit = 'D' or (not r.is_blank and not r.is_duplicate and (o.edit = 'R' or o.role = r.initial)
             and exists (select 1 from follows n where n.state = f.after and n.initial = o.role))) steps
    group by conv_id, i, state),
ended as (
    select w.conv_id, min({'cost': (w.best.cost + f.added)::integer, 'audit': w.best.audit || f.edits,
                           'lines': w.best.lines || f.list}) as best
    from walk w join counted c on c.conv_id is not distinct from w.conv_id and w.i = c.n
    join fillers f on f.state = w.state where f.after in ('', 'a') group by w.conv_id)
select k.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       coalesce(best.cost, 0)::bigint as cost, coalesce(best.audit, '') as audit,
       sha256(coalesce(array_to_string(best.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) k
left join counted c on c.conv_id is not distinct from k.conv_id
left join ended e on e.conv_id is not distinct from k.conv_id
"""
