"""Near-duplicate lines by a deletion-neighbourhood join.

A line is the words between two newlines; its order is (document id, line
number). A line is dropped if an earlier line equals it, or is within one word
edit (a word replaced, inserted or removed) and both have ``min_words`` words
or more; the earliest stays. Shorter lines are dropped for equality only, as
one word is too much of them. Lines without words always stay.

Method. All texts with one word deleted, and the text itself, are the
neighbourhood of a line. Lines within one edit share a variant: a replaced
word gives the same deletion at the same place of lines of the same length, an
inserted word gives a deletion of one that is the whole of the other. Each
variant is a 64-bit key; keys are aggregated to the earliest line of each role
(same place, whole, deletion), so a variant that a third of all lines share
costs one row per map task and key, and no pairs are formed inside a group:
all lines of one key and role are within one edit of the same line. The pairs
found (a line and the earliest of a key) are verified on their words.

Most lines have no near line, and emitting all their variants would cost a row
per word of the corpus. An edit leaves one half of a line unchanged, so a line
is only a candidate if another line has the same first or last half; four half
keys per line decide that, and candidates alone emit variants. This loses no
pair.

Defined results: null ids come after all others; rows with one id tie (neither
is earlier), so a repeated row keeps its lines; null and empty texts have no
lines; an empty table gives an empty result; other columns pass through and
may have any name not starting with ``__ld_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import small_side, written

MIN_WORDS = 8
_TABLE = K.ascii_table("nonspace", lower=False)
_Q = int(K._Q)
_QINV = K.U(pow(_Q, -1, 1 << 64))


class Lines:
    """Lines of a slice: word range, row, line number, and their hashes."""

    def __init__(self, w: K.Words, raw_slice: np.ndarray):
        n = len(w.start)
        newline = np.zeros(len(raw_slice) + 1, dtype=np.int64)
        np.cumsum(raw_slice == 10, out=newline[1:])
        number = newline[w.start] - newline[w.offsets[w.row]] if n else np.zeros(0, dtype=np.int64)
        change = np.ones(n, dtype=bool)
        change[1:] = (w.row[1:] != w.row[:-1]) | (number[1:] != number[:-1])
        self.first = np.flatnonzero(change)
        self.size = np.diff(np.append(self.first, n))
        self.row, self.number = w.row[self.first], number[self.first]
        self.words = n
        self.line = np.repeat(np.arange(len(self.first)), self.size)
        self.place = np.arange(n) - np.repeat(self.first, self.size)
        top = int(self.size.max()) + 2 if n else 2
        self.inverse = K.powers(_QINV, top)
        self.before = np.zeros(n + 1, dtype=np.uint64)  # sums of hash * Q^place over the words before
        np.cumsum(w.hash * K.powers(K.U(_Q), top)[self.place], out=self.before[1:])
        self.whole = self.before[self.first + self.size] - self.before[self.first]
        self.hash = K.mix(self.whole + self.size.astype(np.uint64))

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return self.before[self.first + n] - self.before[self.first]

    def suffix(self, n: np.ndarray) -> np.ndarray:
        skip = self.size - n
        return (self.whole - self.prefix(skip)) * self.inverse[skip]

    def half_keys(self) -> np.ndarray:
        """Four keys per line: for a pair whose longer line has m words, the
        first m // 2 words and the last m - m // 2, with m the line's own
        length or one more."""
        out = []
        for m in (self.size, self.size + 1):
            h = m // 2
            out += [K.mix(self.prefix(h) + K.mix((2 * m).astype(np.uint64))),
                    K.mix(self.suffix(np.minimum(m - h, self.size)) + K.mix((2 * m + 1).astype(np.uint64)))]
        return np.stack(out, axis=1) if len(self.size) else np.zeros((0, 4), dtype=np.uint64)

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """For every word: (key of the line without it, the same with its
        place and the line's length)."""
        i = np.arange(self.words)
        start = self.first[self.line]
        left = self.before[i] - self.before[start]
        right = (self.whole[self.line] - (self.before[i + 1] - self.before[start])) * _QINV
        n = self.size[self.line]
        key = K.mix(left + right + (n - 1).astype(np.uint64))
        return key, K.mix(key + K.mix((n * (1 << 24) + self.place + 1).astype(np.uint64)))


def text_key(text: str | Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def _line_rows(src: DataFrame, min_words: int) -> DataFrame:
    """(id, tkey, line, lh, halves) for every line with words of (id, tkey, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(2))
            for lo, hi in K.slices(off):
                s = Lines(K.Words(raw, off[lo: hi + 1], _TABLE), raw[off[lo]: off[hi]])
                rows = pa.array(lo + s.row)
                near = np.flatnonzero(s.size >= min_words)
                ends = np.cumsum(np.where(s.size >= min_words, 4, 0))
                halves = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                                  pa.array(K.signed(s.half_keys()[near].ravel())))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(s.number.astype(np.int32)),
                     pa.array(K.signed(s.hash)), halves], names=["id", "tkey", "line", "lh", "halves"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, tkey bigint, line int, lh bigint, halves array<bigint>")


def _order(*more: str) -> Column:
    return F.struct(F.col("id").isNull().alias("last"), "id", "line", *more)


def _variants(lines: DataFrame) -> DataFrame:
    """(lh, ord, k, role) of each candidate line: S deletion at its place, D
    deletion, F the whole line."""
    kind = lines.schema["ord"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(2))
            for lo, hi in K.slices(off, K.SLICE_BYTES // 4):
                s = Lines(K.Words(raw, off[lo: hi + 1], _TABLE), raw[off[lo]: off[hi]])
                key, placed = s.deletions()
                of = lo + s.row[s.line]
                rows = pa.array(np.concatenate([of, of, lo + s.row]))
                keys = np.concatenate([placed, key, s.hash])
                role = np.repeat(np.array(["S", "D", "F"]), [len(key), len(key), len(s.hash)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(K.signed(keys)), pa.array(role)],
                    names=["lh", "ord", "k", "role"])

    return lines.select("lh", "ord", "words").mapInArrow(run, f"lh bigint, ord {kind}, k bigint, role string")


def within_one_edit(a: list, b: list) -> bool:
    """Whether two word lists are at most one replaced, inserted or removed word apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _verified(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [within_one_edit(x.encode().split(), y.encode().split())
                  for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)]
            yield b.filter(pa.array(ok, pa.bool_())).select(["lh", "ord"])

    return pairs.select("lh", "ord", "a", "b").mapInArrow(run, pairs.select("lh", "ord").schema)


def dropped_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """(id, tkey, dropped): for each (key, text key) with dropped lines, their
    numbers (from 0) in order. Runs jobs: the line table, the candidate lines
    and their texts are written to the shared checkpoint folder."""
    src = docs.select(F.col(key).alias("id"), text_key(text).alias("tkey"), F.col(text).alias("text"))
    lines = written(_line_rows(src, min_words), "lines")
    first = lines.groupBy("lh").agg(F.min(_order("tkey")).alias("first"), F.count("*").alias("n"))

    halves = lines.select("lh", F.explode("halves").alias("half"))
    shared = written(halves.groupBy("half").agg(F.min("lh").alias("a"), F.max("lh").alias("b"))
                     .filter("a != b").select("half"), "halves")
    candidates = halves.join(small_side(shared), "half", "left_semi").select("lh").distinct()
    where = written(first.join(candidates, "lh", "left_semi")
                    .groupBy("first.id", "first.tkey")
                    .agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "lh")).alias("at")), "candidates")
    w = small_side(where).select(F.col("id").alias("wid"), F.col("tkey").alias("wkey"), "at")
    got = (src.join(w, src.id.eqNullSafe(F.col("wid")) & (src.tkey == F.col("wkey")))
           .select("id", F.split("text", "\n", -1).alias("all"), F.explode("at").alias("x"))
           .select("id", F.col("x.line").alias("line"), F.col("x.lh").alias("lh"), F.col("all")[F.col("x.line")].alias("words")))
    texts = written(got.select("lh", _order("lh").alias("ord"), "words").dropDuplicates(["lh"]), "line-texts")

    v = _variants(texts)
    groups = (v.groupBy("k").agg(*(F.min(F.when(F.col("role") == r, F.col("ord"))).alias(r) for r in "SDF"),
                                 F.min("lh").alias("a"), F.max("lh").alias("b"))
              .filter("a != b").select("k", "S", "D", "F"))
    earlier = (v.join(groups, "k")
               .withColumn("near", F.expr("CASE role WHEN 'S' THEN S WHEN 'D' THEN F ELSE D END"))
               .filter("near < ord").groupBy("lh").agg(F.collect_set("near").alias("near"))
               .select("lh", F.explode("near").alias("near")))
    t = texts.select(F.col("lh").alias("lh2"), F.col("words").alias("b"))
    pairs = (earlier.join(texts.select("lh", F.col("words").alias("a")), "lh")
             .join(t, F.col("near.lh") == F.col("lh2"))
             .select("lh", F.col("near").alias("ord"), "a", "b"))
    near = _verified(pairs).groupBy("lh").agg(F.min("ord").alias("near"))

    plain = F.struct("first.last", "first.id", "first.line")
    near_plain = F.struct("near.last", "near.id", "near.line")
    best = (first.join(near, "lh", "left").filter("n > 1 OR near IS NOT NULL")
            .select("lh", F.when(F.col("near").isNull() | (plain < near_plain), plain).otherwise(near_plain).alias("best")))
    best = written(best, "best")  # a table of its own, so that the join can split a frequent line
    return (lines.drop("halves").join(best, "lh").filter(_order() > F.col("best"))
            .groupBy("id", "tkey").agg(F.sort_array(F.collect_set("line")).alias("dropped")))


def line_dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text``, and the columns
    __ld_dropped (their numbers, null for none). All columns pass through."""
    d = written(dropped_lines(docs, key=key, text=text, min_words=min_words), "dropped")
    d = small_side(d).select(F.col("id").alias("__ld_id"), F.col("tkey").alias("__ld_key"), F.col("dropped").alias("__ld_dropped"))
    joined = docs.join(d, docs[key].eqNullSafe(F.col("__ld_id")) & (text_key(docs[text]) == F.col("__ld_key")), "left")
    kept = F.array_join(F.filter(F.split(docs[text], "\n", -1),
                                 lambda _, i: ~F.array_contains(F.col("__ld_dropped"), i)), "\n")
    cut = F.when(F.col("__ld_dropped").isNull(), docs[text]).otherwise(kept)
    return joined.select(*(cut.alias(c) if c == text else docs[c] for c in docs.columns), "__ld_dropped")


def line_dedup_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: key, n_dropped, dropped (line numbers,
    comma-joined). The texts themselves are not shuffled."""
    d = written(dropped_lines(docs, key=key, text=text, min_words=min_words), "dropped")
    d = small_side(d)
    rows = docs.select(F.col(key).alias("__ld_out"), text_key(text).alias("__ld_key"))
    return (rows.join(d, rows["__ld_out"].eqNullSafe(d["id"]) & (rows["__ld_key"] == d["tkey"]), "left")
            .select(F.col("__ld_out").alias(key), F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
                    F.coalesce(F.array_join(F.col("dropped").cast("array<string>"), ","), F.lit("")).alias("dropped")))


#: DuckDB SQL for ``line_dedup_report`` over ``documents``.
SQL = rf"""
WITH line AS MATERIALIZED (
  SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS line,
         list_filter(string_split_regex(u.x, '[\x20\x09\x0B-\x0D]+'), lambda w: w != '') AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM documents) d,
       LATERAL (SELECT unnest(all_lines) AS x, generate_subscripts(all_lines, 1) AS i) u),
uniq AS MATERIALIZED (
  SELECT words, min({{'doc_id': doc_id, 'line': line}}) AS first FROM line WHERE len(words) > 0 GROUP BY words),
cand AS (SELECT words, first, len(words) AS n FROM uniq WHERE len(words) >= {MIN_WORDS}),
del AS MATERIALIZED (
  SELECT md5(array_to_string(list_concat(words[1:p - 1], words[p + 1:]), ' ')) AS k, p, n, first, words
  FROM cand, LATERAL (SELECT unnest(range(1, n + 1)) AS p) x),
whole AS MATERIALIZED (SELECT md5(array_to_string(words, ' ')) AS k, first, words FROM cand),
same AS (SELECT k, p, n, min(first) AS m FROM del GROUP BY k, p, n HAVING count(*) > 1),
near AS (
  SELECT d.words, s.m FROM del d JOIN same s ON d.k = s.k AND d.p = s.p AND d.n = s.n
  UNION ALL SELECT d.words, w.first FROM del d JOIN whole w ON d.k = w.k
  UNION ALL SELECT w.words, d.first FROM del d JOIN whole w ON d.k = w.k),
best AS (SELECT words, min(m) AS m FROM (SELECT words, m FROM near UNION ALL SELECT words, first FROM uniq) GROUP BY words),
gone AS (
  SELECT l.doc_id, l.line FROM line l JOIN best b ON l.words = b.words
  WHERE {{'doc_id': l.doc_id, 'line': l.line}} > b.m)
SELECT d.doc_id, count(g.line) AS n_dropped,
       coalesce(string_agg(CAST(g.line AS VARCHAR), ',' ORDER BY g.line), '') AS dropped
FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id GROUP BY d.doc_id
"""
