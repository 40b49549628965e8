"""DuckDB oracle SQL for the query catalog.

Only the base parquet tables are registered on the DuckDB side, so every
oracle string carries the fixture views and intermediate steps it needs as
CTEs. ``sql(body, *names)`` prepends the named CTEs and their dependencies
in definition order.

Conventions shared with ``plans.catalog`` so that results hash alike:
timestamps are rendered as ``yyyy-MM-dd HH:mm:ss`` text, integer results are
BIGINT, arrays are rendered as text or exploded to rows, and arithmetic is
written in the same order with DOUBLE operands.
"""

from __future__ import annotations

from ..constants import (DEFAULT_STOP_WORDS, DIGIT_WORD, LONE_CHAR, MIN_WORDS, MS_DAY, MS_HOUR,
                         MS_YEAR, SPECIAL_CHARS_CLASS, WHITESPACE_CHAR)
from ..functions.hashing import duck_unit_hash

SENT = "TIMESTAMP '9000-01-01 00:00:00'"
D = "CAST({} AS DOUBLE)".format


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(q(w) for w in DEFAULT_STOP_WORDS) + "]"


def clean_sql(c: str, lone_chars: bool = True) -> str:
    out = f"regexp_replace({c}, {q(SPECIAL_CHARS_CLASS)}, ' ', 'g')"
    out = f"regexp_replace({out}, {q(DIGIT_WORD)}, ' ', 'g')"
    if lone_chars:
        out = f"regexp_replace({out}, {q(LONE_CHAR)}, ' ', 'g')"
        out = f"regexp_replace({out}, {q(LONE_CHAR)}, ' ', 'g')"
    return out


def tokens_sql(c: str, stop: bool = True) -> str:
    split = f"string_split_regex(lower({clean_sql(c, lone_chars=False)}), {q(WHITESPACE_CHAR)})"
    cond = "length(t) > 3 AND regexp_full_match(t, '\\p{L}+')"
    if stop:
        cond += f" AND NOT list_contains({STOP_LIST}, t)"
    return f"list_filter({split}, lambda t: {cond})"


# name -> (dependencies, body). Order matters: dependencies come first.
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------- fixtures
cte("subject", """SELECT c_custkey AS pid,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'm' ELSE 'F' END AS gender,
  CASE WHEN c_custkey % 50 = 1 THEN TIMESTAMP '1690-01-01'
       ELSE TIMESTAMP '1920-01-01' + to_days(CAST((c_custkey * 977) % 29000 AS INT)) END AS dob,
  CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS expire_flag,
  CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2001-01-01' + to_days(CAST((c_custkey * 37) % 700 AS INT)) END AS dod
FROM customer""")
cte("episode", """SELECT o_custkey AS pid, o_orderkey AS hadm, o_orderkey AS stay, o_orderdate AS in_ts,
  CASE WHEN o_orderkey % 300 = 7 THEN NULL ELSE o_orderdate + to_days(CAST(200 + o_orderkey % 400 AS INT)) END AS out_ts
FROM orders""")
cte("note_raw", """SELECT o_custkey AS pid, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS hadm,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate + to_hours(9) END AS charttime,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_shipdate + to_hours(12) END AS storetime,
  l_shipdate AS chartdate,
  CASE WHEN l_returnflag = 'R' THEN 'Discharge summary' ELSE 'Nursing' END AS category,
  l_orderkey * 8 + l_linenumber AS note_id,
  (l_orderkey * 7 + l_linenumber) % (SELECT count(*) FROM documents) AS doc_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
cte("score", """SELECT o_custkey AS pid, o_orderkey AS hadm, o_orderkey AS stay,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey * 31 % 164 AS DOUBLE) END AS score FROM orders""")
cte("flags", """SELECT o_custkey AS pid, o_orderkey AS hadm, i.i AS flag_no,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN (o_orderkey * (i.i + 3) + i.i) % 7 = 0 THEN 1 ELSE 0 END AS flag
FROM orders, range(30) i(i)""")

# ---------------------------------------------------------------- loaded tables
cte("subj", f"""SELECT pid, CASE WHEN lower(gender) = 'm' THEN 1 ELSE 0 END AS is_male, dob,
  expire_flag AS is_dead,
  CASE WHEN expire_flag = 1 AND dod IS NOT NULL THEN dod ELSE {SENT} END AS dod
FROM subject""", "subject")
cte("ep", f"""SELECT pid, hadm, stay, coalesce(in_ts, {SENT}) AS in_ts, coalesce(out_ts, {SENT}) AS out_ts
FROM episode""", "episode")
cte("notes", """SELECT pid, hadm, coalesce(charttime, storetime, chartdate) AS ts, category, note_id, doc_id
FROM note_raw WHERE NOT contains(lower(category), 'discharge') AND hadm IS NOT NULL""", "note_raw")
cte("scr", "SELECT pid, hadm, stay, coalesce(score, 0.0) AS score FROM score", "score")
cte("flg", """SELECT pid, hadm, string_agg(CAST(coalesce(flag, 0) AS VARCHAR), '' ORDER BY flag_no) AS flag_str,
  list(CAST(coalesce(flag, 0) AS DOUBLE) ORDER BY flag_no) AS flags
FROM flags GROUP BY pid, hadm""", "flags")

# ---------------------------------------------------------------- cohort steps
cte("latest", """SELECT pid, hadm, stay, in_ts, out_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY out_ts DESC, stay DESC) AS rn FROM ep) WHERE rn = 1""",
    "ep")
cte("cohort_all", f"""SELECT l.pid, l.hadm, l.stay, l.in_ts, l.out_ts, s.is_male, s.dob, s.is_dead, s.dod,
  {D('epoch_ms(l.in_ts) - epoch_ms(s.dob)')} / {D(MS_YEAR)} AS raw_age
FROM latest l JOIN subj s ON l.pid = s.pid""", "latest", "subj")
cte("cohort", """SELECT pid, hadm, stay, in_ts, out_ts, is_male, dob, is_dead, dod,
  CASE WHEN raw_age >= 300 THEN 89.0 ELSE raw_age END AS age
FROM cohort_all WHERE (CASE WHEN raw_age >= 300 THEN 89.0 ELSE raw_age END) >= 18""", "cohort_all")
cte("inep", """SELECT n.* FROM notes n JOIN cohort c ON n.pid = c.pid AND n.hadm = c.hadm
  AND c.in_ts <= n.ts AND n.ts < c.out_ts AND n.ts < c.dod""", "notes", "cohort")
cte("inep_text", """SELECT i.*, d.text FROM inep i JOIN documents d ON i.doc_id = d.doc_id""", "inep")
cte("tok", f"SELECT pid, hadm, ts, note_id, {tokens_sql('text')} AS tokens FROM inep_text", "inep_text")
cte("words", "SELECT pid, CAST(sum(len(tokens)) AS BIGINT) AS n_words FROM tok GROUP BY pid", "tok")
cte("kept_words", f"SELECT pid, n_words FROM words WHERE n_words >= {MIN_WORDS}", "words")
cte("kept_notes", "SELECT * FROM inep WHERE pid IN (SELECT pid FROM kept_words)", "inep", "kept_words")
cte("first", "SELECT pid, min(ts) AS first_ts FROM kept_notes GROUP BY pid", "kept_notes")
cte("labels", f"""SELECT pid,
  CASE WHEN epoch_ms(dod) >= epoch_ms(in_ts) AND epoch_ms(dod) <= epoch_ms(out_ts) THEN 1 ELSE 0 END AS label_in_episode,
  CASE WHEN epoch_ms(dod) > epoch_ms(out_ts) AND (epoch_ms(dod) - epoch_ms(out_ts)) // {MS_DAY} <= 30 THEN 1 ELSE 0 END AS label_30d,
  CASE WHEN epoch_ms(dod) > epoch_ms(out_ts) AND (epoch_ms(dod) - epoch_ms(out_ts)) // {MS_DAY} <= 365 THEN 1 ELSE 0 END AS label_1y
FROM cohort""", "cohort")


def present_cte(hours: int, name: str) -> None:
    """Cohort rows present ``hours`` after the first note."""
    if hours <= 0:
        cte(name, "SELECT * FROM cohort", "cohort")
        return
    b = f"epoch_ms(f.first_ts) + {int(hours) * MS_HOUR}"
    cte(name, f"""SELECT c.* FROM cohort c JOIN first f ON c.pid = f.pid
  WHERE epoch_ms(c.out_ts) > {b} AND epoch_ms(c.dod) > {b}""", "cohort", "first")


def unit_hash_sql(key: str, seed: int) -> str:
    return duck_unit_hash(key, seed)


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    order = list(CTES)
    return sorted(seen, key=order.index)


def sql(body: str, *names: str, extra: list[tuple[str, str]] | None = None, recursive: bool = False) -> str:
    """``WITH <needed ctes>, <extra ctes> <body>``. With ``recursive`` the
    extra CTEs but the last, which is the recursion, are computed once."""
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in _closure(names)]
    extra = extra or []
    for i, (n, b) in enumerate(extra):
        parts.append(f"{n} AS {'MATERIALIZED ' if recursive and i < len(extra) - 1 else ''}(\n{b}\n)")
    return ("WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(parts) + "\n" + body) if parts else body


def descent(width: int, iterations: int) -> str:
    """Full-batch subgradient descent as a recursion: (t, model, w) from
    ``pts`` (x with a constant last, y in -1/1, fold) and ``models`` (model,
    bias, reg, held_out, n)."""
    g = ", ".join(f"sum(CASE WHEN p.y * list_dot_product(p.x, v.w) < 1 THEN -p.y * p.x[{j}] ELSE 0.0::DOUBLE END)"
                  + (" * any_value(m.bias)" if j == width + 1 else "") for j in range(1, width + 2))
    zero = ", ".join(["0.0"] * (width + 1))
    return f"""SELECT 0 AS t, model, CAST([{zero}] AS DOUBLE[]) AS w FROM models
  UNION ALL
  SELECT t + 1, model, list_transform(list_zip(w, g), lambda z:
    z[1] * (1.0::DOUBLE - 1.0::DOUBLE / sqrt(t + 1) * reg) - 1.0::DOUBLE / sqrt(t + 1) * z[2] / n)
  FROM (SELECT v.t, v.model, any_value(v.w) AS w, any_value(m.reg) AS reg, any_value(m.n) AS n, [{g}] AS g
        FROM walk v JOIN models m ON v.model = m.model JOIN pts p ON p.fold <> m.held_out
        WHERE v.t < {iterations} GROUP BY v.t, v.model)"""
