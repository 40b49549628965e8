"""Conversation structure repair by a run-length dynamic programme.

A conversation is repaired when the initials of its roles are
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn. The
edits, with costs, are Keep 0, Rerole (to user or assistant) 3, Delete 4 and
Insert (an empty user or assistant turn) 3. Every turn has a symbol: its role's
initial and its first fault. Blank turns and duplicates (a role and text seen
earlier) must be deleted; a truncated turn costs 3 more unless it is deleted.

States are what the repaired turns end in so far: nothing, s, u, a. A symbol is
a min-plus transition between them (with the inserts that may stand before the
turn). Equal consecutive symbols are a run, and a run of any length is advanced
through binary powers of its transition, which a task computes once per symbol.
The cost still to go after each turn then tells, turn by turn, which choices are
cheapest; the ASCII-least of these are the audit.

Turns are counted first: one row per (conversation, turn, role, text digest),
so that copies are one run and no text takes part in the dynamic programme.
These rows are range-partitioned; a block is one partition. A conversation that
spans blocks is one transition matrix per block, and the cost to go at the end
of each block comes from the matrices behind it, so a conversation of any size is
spread over tasks. Only the last step reads a conversation in one task, as
its SHA-256 and its audit are sequences: it streams the sorted turns and
holds one turn and the audit. Texts are shuffled once.

Defined results: a null conversation, turn, role or text counts as one space
where text is built; null conversations are one conversation; turns are sorted
with nulls first, turns of one number by role, then by text (its first 32
characters, then its MD5); an empty role has no initial and cannot be kept as it
is; a role keeps its name if its initial fits (``usher`` counts as u); repeated rows
are repeated turns; further columns of any name are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

INF = 1 << 40
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a.
BEGIN, S, U, A = range(4)
STATES = range(4)
#: Role initial -> (state before, state after).
STEPS = {"s": {BEGIN: S}, "u": {BEGIN: U, S: U, A: U}, "a": {U: A}}
ROLES = {"u": "user", "a": "assistant"}
#: Turns that are inserted when the turns end in a state.
LAST = ("", "ua", "a", "")
OK, CUT, BLANK = range(3)
#: The symbol of turns that must be deleted; others are initial + fault.
GONE = "-"

Matrix = tuple[tuple[int, ...], ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in STATES), INF) for j in STATES) for i in STATES)


def apply(m: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(min(m[i][k] + v[k] for k in STATES), INF) for i in STATES)


ONE: Matrix = tuple(tuple(0 if i == j else INF for j in STATES) for i in STATES)


def _inserts() -> Matrix:
    one = [list(r) for r in ONE]
    for to in ROLES:
        for a, b in STEPS[to].items():
            one[a][b] = min(one[a][b], INSERT)
    m: Matrix = tuple(tuple(r) for r in one)
    return times(m, m)


BEFORE = _inserts()
#: Cost to go after the last turn.
END = apply(BEFORE, (0, INF, INF, 0))


@cache
def choices(symbol: str) -> tuple[tuple[str, int, tuple[tuple[int, int], ...], str], ...]:
    """(edit, cost, (state before, after) pairs, new role) of a turn, in ASCII order."""
    out = [("D", DELETE, tuple((q, q) for q in STATES), "")]
    if symbol != GONE:
        more = TRUNCATED if symbol[1:] == str(CUT) else 0
        if symbol[0] in STEPS:
            out.append(("K", more, tuple(STEPS[symbol[0]].items()), ""))
        out += [("R", REROLE + more, tuple(STEPS[to].items()), name) for to, name in ROLES.items()]
    return tuple(out)


@cache
def power(symbol: str, k: int) -> Matrix:
    """The transition of 2**k turns of one symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    m = [[INF] * 4 for _ in STATES]
    for _, cost, pairs, _ in choices(symbol):
        for a, b in pairs:
            m[a][b] = min(m[a][b], cost)
    return times(BEFORE, tuple(tuple(r) for r in m))


def advance(symbol: str, n: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go before a run of ``n`` turns, given that after it."""
    k = 0
    while n >> k:
        if n >> k & 1:
            v = apply(power(symbol, k), v)
        k += 1
    return v


def matrix(runs: list[tuple[str, int]]) -> Matrix:
    m = ONE
    for symbol, n in runs:
        k = 0
        while n >> k:
            if n >> k & 1:
                m = times(m, power(symbol, k))
            k += 1
    return m


def level(v: tuple[int, ...]) -> tuple[int, ...]:
    """``v`` without what all states have in common; few different ones exist."""
    low = min(v)
    return tuple(x - low for x in v)


@cache
def before(symbol: str, v: tuple[int, ...]) -> tuple[int, ...]:
    return level(apply(power(symbol, 0), v))


@cache
def move(symbol: str, v: tuple[int, ...], q: int) -> tuple[str, str, str | None, int]:
    """The cheapest, ASCII-least edits of one turn from state ``q``, given the
    cost to go after it: (edits, initials of the turns inserted before it,
    its new role ("" as it was, None deleted), state after)."""
    w = apply(power(symbol, 0), v)
    put = ""
    while True:
        for edit, cost, pairs, role in choices(symbol):
            if edit > "I":
                break
            if cost + v[q] == w[q]:
                return "I" * len(put) + edit, put, None, q
        for to in ROLES:
            if q in STEPS[to] and INSERT + w[STEPS[to][q]] == w[q]:
                put, q = put + to, STEPS[to][q]
                break
        else:
            for edit, cost, pairs, role in choices(symbol):
                if edit > "I" and q in dict(pairs) and cost + v[dict(pairs)[q]] == w[q]:
                    return "I" * len(put) + edit, put, role, dict(pairs)[q]
            raise AssertionError("no choice has the cheapest cost")


def pack(v: tuple[int, ...]) -> int:
    return sum(x << 8 * i for i, x in enumerate(v))


@cache
def unpack(n: int) -> tuple[int, ...]:
    return tuple(n >> 8 * i & 255 for i in STATES)


def symbol_of(initial: str, fault: int, first: bool) -> str:
    if fault == BLANK or not first:
        return GONE
    return (initial if initial in STEPS else "x") + str(fault)


def runs_of(symbols: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Equal neighbours as one run."""
    out: list[tuple[str, int]] = []
    for s, n in symbols:
        if n and out and out[-1][0] == s:
            out[-1] = (s, out[-1][1] + n)
        elif n:
            out.append((s, n))
    return out


def _turn_runs(initial: str, fault: int, first: bool, n: int) -> list[tuple[str, int]]:
    """A counted turn: its first copy, then duplicates."""
    s = symbol_of(initial, fault, first)
    return [(s, n)] if s == GONE else [(s, 1), (GONE, n - 1)]


def _segments(pdf: pd.DataFrame) -> list[tuple[int, int]]:
    """[start, end) of the conversations of a sorted block (null is one)."""
    code = pd.factorize(pdf["conv"], use_na_sentinel=False)[0]
    cut = np.flatnonzero(np.diff(code, prepend=-1, append=-1))
    return list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if len(code) else []


def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column | None = None) -> DataFrame:
    """(conv, turn, role, text, head, digest, fault, copies)."""
    src = turns.select(F.col(conv).cast("string").alias("conv"), F.col(turn).alias("turn"), _spaced(role).alias("role"),
                       _spaced(text).alias("text"), (F.lit(1) if copies is None else copies).cast("bigint").alias("copies"))
    words, ended = F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(~words, BLANK).when(ended, OK).otherwise(CUT)
    return src.select("conv", "turn", "role", "text", F.substring("text", 1, 32).alias("head"), F.md5(F.col("text").cast("binary")).alias("digest"),
                      fault.alias("fault"), "copies")


KEY = ["conv", "turn", "role", "head", "digest"]


def counted_turns(rows: DataFrame) -> DataFrame:
    """(KEY..., fault, n, first, block, pos): one row per different turn,
    sorted; ``first`` tells whether no earlier turn has its role and text."""
    n = rows.filter("copies > 0").groupBy(*KEY).agg(F.max("fault").alias("fault"), F.sum("copies").alias("n"))
    n = written(n, "turns")
    early = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    firsts = n.groupBy("conv", "role", "head", "digest").agg(early.alias("e")) \
        .select(*(F.col(c).alias(f"__{c}") for c in ("conv", "role", "head", "digest")), F.col("e.turn").alias("__turn"))
    # one row per key on both sides: no key is frequent here
    same = [n[c].eqNullSafe(firsts[f"__{c}"]) if c in ("conv", "turn") else n[c] == firsts[f"__{c}"] for c in KEY]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), *KEY[2:]]
    rows = n.join(firsts, cond, "left").select(*KEY, "fault", "n", F.col("__role").isNotNull().alias("first"))
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("*", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("pos")), "sorted-turns")


def _rows_of(pdf: pd.DataFrame) -> list[list[tuple[str, int]]]:
    return [_turn_runs(r[:1], f, e, n) for r, f, e, n in
            zip(pdf["role"].tolist(), pdf["fault"].tolist(), pdf["first"].tolist(), pdf["n"].tolist(), strict=True)]


def costs_to_go(turns: DataFrame) -> DataFrame:
    """(KEY..., fault, n, first, ahead): ``ahead`` is the packed cost to go
    after the turn's copies."""
    small = turns.select("conv", "role", "fault", "n", "first", "block", "pos")

    def matrices(pdf: pd.DataFrame) -> pd.DataFrame:
        """The transitions of a block's first and last conversation."""
        pdf = pdf.sort_values("pos")
        parts, rows = _segments(pdf), _rows_of(pdf)
        out = []
        for j in sorted({0, len(parts) - 1}):
            a, b = parts[j]
            m = matrix(runs_of([x for r in rows[a:b] for x in r]))
            out.append((pdf["conv"].iloc[a], int(pdf["block"].iloc[0]), j == len(parts) - 1, [x for r in m for x in r]))
        return pd.DataFrame(out, columns=["conv", "block", "last", "m"])

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        """Cost to go at the ends of the blocks of one conversation."""
        pdf = pdf.sort_values("block", ascending=False)
        v, out = END, []
        for block, last, flat in zip(pdf["block"], pdf["last"], pdf["m"], strict=True):
            if last:
                out.append((block, pack(level(v))))
            v = apply(tuple(tuple(int(x) for x in flat[4 * i: 4 * i + 4]) for i in STATES), v)
        return pd.DataFrame(out, columns=["block", "end"])

    def fill(pdf: pd.DataFrame, end: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        parts, rows = _segments(pdf), _rows_of(pdf)
        ahead = np.zeros(len(pdf), dtype=np.int64)
        for j, (a, b) in enumerate(parts):
            v = unpack(int(end["end"].iloc[0])) if j == len(parts) - 1 else END
            for i in range(b - 1, a - 1, -1):
                ahead[i] = pack(v)
                for symbol, n in reversed(rows[i]):
                    v = before(symbol, v) if n == 1 else level(advance(symbol, n, v))
        return pd.DataFrame({"pos": pdf["pos"], "ahead": ahead})

    of_block = small.groupBy("block").applyInPandas(matrices, "conv string, block int, last boolean, m array<bigint>")
    borders = of_block.groupBy("conv").applyInPandas(ends, "block int, end bigint")
    found = written(small.groupBy("block").cogroup(borders.groupBy("block")).applyInPandas(fill, "pos bigint, ahead bigint"), "cost-to-go")
    return turns.join(found, "pos").select(*KEY, "fault", "n", "first", "ahead")


def _stream(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """Counted turns (kind 1), each followed by its texts (kind 2), and one
    row for every conversation of ``rows`` before them (kind 0), sorted."""
    none = F.lit(None)
    head = rows.select("conv").distinct().select("conv", none.cast(rows.schema["turn"].dataType).alias("turn"),
                                                 *(F.lit("").alias(c) for c in KEY[2:]), F.lit(0).alias("kind"))
    texts = rows.filter(f"copies > 0 AND fault != {BLANK}").select(*KEY, F.lit(2).alias("kind"), "text")
    all_ = head.unionByName(turns.withColumn("kind", F.lit(1)), allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    order = [F.col("conv").asc_nulls_first(), (F.col("kind") > 0).asc(), F.col("turn").asc_nulls_first(), *KEY[2:], "kind"]
    return (all_.repartition("conv").sortWithinPartitions(*order)
            .select("conv", "turn", "role", "kind", "fault", "n", "first", "ahead", "text"))


class Repair:
    """One conversation, turn by turn."""

    def __init__(self):
        self.state, self.last = BEGIN, None
        self.audit: list[str] = []
        self.low = self.high = self.turn = None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.distinct = 0

    def counted(self, turn, role: str, fault: int, n: int, first: bool, ahead: int) -> tuple[str, str | None]:
        """(initials of turns to insert before, the kept turn's role or None)."""
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.turn:
                self.distinct += 1
            self.high = self.turn = turn
        initial = role[:1]
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in ("su", "ua", "au"))
        self.last = initial
        symbol = symbol_of(initial, fault, first)
        if symbol == GONE:
            self.blank += n if fault == BLANK else 0
            self.duplicate += 0 if fault == BLANK else n
            self.audit.append("D" * n)
            self.cost += DELETE * n
            return "", None
        self.duplicate += n - 1
        self.truncated += fault == CUT
        v = unpack(ahead)
        edits, put, new, self.state = move(symbol, v, self.state)
        self.audit.append(edits + "D" * (n - 1))
        self.cost += DELETE * (n - 1) + INSERT * len(put) + {"D": DELETE, "K": 0, "R": REROLE}[edits[-1]]
        if new is None:
            return put, None
        self.cost += TRUNCATED if fault == CUT else 0
        return put, new or role

    def end(self) -> str:
        """Initials of the turns to insert at the end."""
        put = LAST[self.state]
        self.audit.append("I" * len(put))
        self.cost += INSERT * len(put)
        return put

    def gaps(self) -> int:
        return 0 if self.low is None else int(self.high - self.low + 1 - self.distinct)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("conv", conv, Repair), ("turn", role, text, edits since the last one) and ("end",) events of the stream."""
    r: Repair | None = None
    kept: str | None = None
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            p = b.slice(lo, 1024)
            for conv, turn, role, kind, fault, n, first, ahead, text in zip(*(c.to_pylist() for c in p.columns), strict=True):
                if kind == 0:
                    if r is not None:
                        for x in r.end():
                            yield "turn", ROLES[x], ""
                        yield ("end",)
                    r, kept = Repair(), None
                    yield "conv", conv, r
                elif kind == 1:
                    put, kept = r.counted(turn, role, fault, n, first, ahead)
                    for x in put:
                        yield "turn", ROLES[x], ""
                elif kept is not None:
                    yield "turn", kept, text
                    kept = None
    if r is not None:
        for x in r.end():
            yield "turn", ROLES[x], ""
        yield ("end",)


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
                                      if rows else [pa.array([], f.type) for f in schema], schema=schema)


def _solved(turns: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column | None) -> DataFrame:
    rows = prepared(turns, conv, turn, role, text, copies)
    return _stream(costs_to_go(counted_turns(rows)), rows)


def repaired_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   copies: Column | None = None) -> DataFrame:
    """(conv, place, role, text): the turns of the repaired conversations,
    numbered from 1; a conversation without turns has none."""
    kind = turns.schema[conv].dataType
    schema = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, name, place = 0, None, 0
        for e in _walk(batches):
            if e[0] == "conv":
                name, place = e[1], 0
            elif e[0] == "turn":
                place += 1
                rows.append((name, place, e[1], e[2]))
                size += len(e[2])
                if len(rows) >= 4096 or size > 1 << 20:
                    yield _emit(rows, schema)
                    rows, size = [], 0
        yield _emit(rows, schema)

    out = _solved(turns, conv, turn, role, text, copies).mapInArrow(run, "conv string, place bigint, role string, text string")
    return out.select(F.col("conv").cast(kind).alias(conv), "place", F.col("role").alias(role), F.col("text").alias(text))


def repair_report(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  copies: Column | None = None) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256 (of the repaired ``role:text`` lines).
    ``copies`` tells how often a row counts; a conversation whose rows all count
    0 times has no turns."""
    kind = turns.schema[conv].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv", pa.string()), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        name = r = sha = None
        new = True
        for e in _walk(batches):
            if e[0] == "conv":
                name, r, sha, new = e[1], e[2], hashlib.sha256(), True
            elif e[0] == "turn":
                sha.update(f"{'' if new else chr(10)}{e[1]}:{e[2]}".encode())
                new = False
            else:
                rows.append((name, r.gaps(), r.blank, r.duplicate, r.truncated, r.illegal, r.cost, "".join(r.audit), sha.hexdigest()))
                if len(rows) >= 4096:
                    yield _emit(rows, schema)
                    rows = []
        yield _emit(rows, schema)

    out = _solved(turns, conv, turn, role, text, copies).mapInArrow(
        run, f"conv string, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string")
    return out.select(F.col("conv").cast(kind).alias(conv), *counts, "audit", "repaired_sha256")


def damaged(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): the rows with faults by the CRC-32 of
    ``conv:turn`` modulo 20: 0 counts no longer, 1 loses its text, 2 its
    ``[.!?]``, 3 counts twice, 4 is the user's."""
    code = F.crc32(F.concat(_spaced(conv), F.lit(":"), _spaced(turn)).cast("binary")) % 20
    src = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), _spaced(role).alias("role"), _spaced(text).alias("text"),
                       code.alias("code"))
    return src.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias(role),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias(text),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


def structure_report(turns: DataFrame) -> DataFrame:
    """The report of the damaged conversations."""
    return repair_report(damaged(turns), copies=F.col("copies"))


#: One step of the backward recursion: {c: cost, a: edits, t: lines} from each
#: state, before a turn is looked at (x) and with inserts before it (w).
def _sql_choice(state: str) -> str:
    delete = f"{{'c': {state}.c + {DELETE}, 'a': 'D' || {state}.a, 't': {state}.t}}"
    more = f"CASE WHEN fault = {CUT} THEN {TRUNCATED} ELSE 0 END"
    keeps = {"b": "CASE init WHEN 's' THEN s WHEN 'u' THEN u END", "s": "CASE init WHEN 'u' THEN u END",
             "u": "CASE init WHEN 'a' THEN a END", "a": "CASE init WHEN 'u' THEN u END"}[state]
    name, to = ("assistant", "a") if state == "u" else ("user", "u")
    return (f"list_sort(list_filter([{delete}, "
            f"CASE WHEN fault < {BLANK} AND ({keeps}) IS NOT NULL THEN {{'c': ({keeps}).c + {more}, 'a': 'K' || ({keeps}).a, "
            f"'t': list_prepend(role || ':' || txt, ({keeps}).t)}} END, "
            f"CASE WHEN fault < {BLANK} THEN {{'c': {to}.c + {REROLE} + {more}, 'a': 'R' || {to}.a, "
            f"'t': list_prepend('{name}:' || txt, {to}.t)}} END], lambda o: o IS NOT NULL))[1]")


def _sql_insert(name: str, to: str) -> str:
    return f"{{'c': {to}.c + {INSERT}, 'a': 'I' || {to}.a, 't': list_prepend('{name}:', {to}.t)}}"


def _sql_crc(text: str) -> str:
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen({text}) + 1), lambda i: {byte})), "
            "lambda c, b: xor(c // 256, crc_table[xor(c, b) % 256 + 1])), CAST(4294967295 AS BIGINT))")


_ROW = f"{{'c': CAST(%s AS BIGINT), 'a': '%s', 't': CAST(%s AS VARCHAR[])}}"
_WORD = "[^\\x20\\x09-\\x0D]"

SQL = f"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(c ORDER BY n) AS crc_table FROM (
    SELECT n, list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
                          lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END) AS c
    FROM range(256) AS r(n))),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS MATERIALIZED (SELECT * EXCLUDE (k), {_sql_crc('k')} % 20 AS code FROM raw, tab),
hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt,
         unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST, copy) AS seen FROM hurt),
turns AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS init, count(*) OVER (PARTITION BY conv_id) AS n,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before_it,
         CASE WHEN NOT regexp_matches(txt, '{_WORD}') THEN {BLANK} WHEN seen > 1 THEN {BLANK + 1}
              WHEN regexp_matches(txt, '[.!?][\\x20\\x09-\\x0D]*$') THEN {OK} ELSE {CUT} END AS fault FROM placed),
walk AS (
  SELECT conv_id, n + 1 AS i, {_ROW % (0, '', '[]')} AS b, {_ROW % (6, 'II', "['user:', 'assistant:']")} AS s,
         {_ROW % (3, 'I', "['assistant:']")} AS u, {_ROW % (0, '', '[]')} AS a
  FROM turns WHERE i = 1
  UNION ALL
  SELECT conv_id, i, list_sort([b, {_sql_insert('user', 'u')}, {_sql_insert('user', 'ua')}])[1] AS b,
         list_sort([s, {_sql_insert('user', 'u')}, {_sql_insert('user', 'ua')}])[1] AS s,
         list_sort([u, ua])[1] AS u, list_sort([a, {_sql_insert('user', 'u')}])[1] AS a
  FROM (SELECT *, {_sql_insert('assistant', 'a')} AS ua FROM (
    SELECT w.conv_id, t.i, {_sql_choice('b')} AS b, {_sql_choice('s')} AS s, {_sql_choice('u')} AS u, {_sql_choice('a')} AS a
    FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i - 1))),
best AS (SELECT conv_id, b FROM walk WHERE i = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank,
         count(*) FILTER (fault = {BLANK + 1}) AS duplicate, count(*) FILTER (fault = {CUT}) AS truncated,
         count(*) FILTER (before_it IS NOT NULL AND before_it || init NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""
