"""Benchmark decontamination by a prefix-filtered set join.

Item windows (``window`` consecutive words; all words of a shorter item) are
sets of shingles (``shingle`` consecutive words; all words of a shorter
window). A document holds a window only if it holds all its shingles, so for
exact containment a prefix of one shingle is enough: the rarest, by the number
of its occurrences in all documents. Documents meet windows on that shingle
alone. The shingle's offset in the window gives the one place where the window
can start (positional bound); a start before the document's first word or an
end past its last is no candidate (length bound). The rest is verified word by
word over the item-sized window.

Two passes over the documents, no shuffle of texts: one counts the windows'
shingles, one joins. The windows reach the executors as broadcast blocks of
at most ``block_shingles`` shingles; a larger benchmark takes several blocks
and the second pass adds the hits of one block after the other.

Defined results: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the
text with A-Z lower-cased; a null text has none and is not contaminated; an
item without words occurs nowhere; a null item id counts as the empty string;
item rows with one id are one item; repeated documents repeat; an empty table
on either side is allowed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K

WINDOW = 13
SHINGLE = 5
BLOCK_SHINGLES = 1 << 20
#: contaminated: n_hit > 0 and MIN_SHARE_INVERSE * n_hit >= n_words
MIN_SHARE_INVERSE = 20
_TABLE = K.ascii_table("alnum", lower=True)


def item_windows(items: DataFrame, item: str, text: str, window: int, shingle: int) -> DataFrame:
    """Distinct windows: words (space-joined bytes), n, shingles (hashes by
    offset), items (ids as strings)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(1))
            ids = [x or "" for x in b.column(0).to_pylist()]
            for lo, hi in K.slices(off):
                w = K.Words(raw, off[lo: hi + 1], _TABLE)
                rows: list[tuple] = []
                for r in range(hi - lo):
                    i, j = int(w.first[r]), int(w.first[r + 1])
                    n = min(window, j - i)
                    for a in range(i, j - n + 1) if n else ():
                        words = b" ".join(w.word(x) for x in range(a, a + n))
                        h = K.signed(K.windows(w.hash[a: a + n], min(shingle, n)))
                        rows.append((ids[lo + r], words, n, h.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.binary()),
                     pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.list_(pa.int64()))],
                    names=["item", "words", "n", "shingles"])

    return (items.select(F.col(item).cast("string"), text)
            .mapInArrow(run, "item string, words binary, n int, shingles array<bigint>")
            .groupBy("words").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"),
                                  F.collect_set("item").alias("items")))


def _shingles(w: K.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of the shingles that lie within one row."""
    h = K.windows(w.hash, size)
    at = np.flatnonzero(w.row[: len(h)] == w.row[size - 1: size - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
    return h[at], at


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index in the sorted ``table`` of each value, or -1."""
    if not len(table):
        return np.full(len(values), -1)
    i = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[i] == values, i, -1)


def shingle_counts(docs: DataFrame, text: str, known, sizes: list[int]) -> DataFrame:
    """Occurrences in all documents of the broadcast ``known`` shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        total = np.zeros(len(table), dtype=np.int64)
        for b in batches:
            raw, off = K.utf8_buffers(b.column(0))
            for lo, hi in K.slices(off):
                w = K.Words(raw, off[lo: hi + 1], _TABLE)
                for s in sizes:
                    m = _member(_shingles(w, s)[0], table)
                    total += np.bincount(m[m >= 0], minlength=len(table))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(K.signed(table[some])), pa.array(total[some])], names=["shingle", "n"])

    return (docs.select(text).mapInArrow(run, "shingle bigint, n bigint")
            .groupBy("shingle").agg(F.sum("n").alias("n")))


class WindowIndex:
    """The windows of one block under their rarest shingle."""

    def __init__(self, rows: list, counts: dict[int, int], shingle: int):
        keys, self.offset, self.n, self.words, self.items = [], [], [], [], []
        for r in rows:
            freq = [(counts.get(h, 0), h, i) for i, h in enumerate(r["shingles"])]
            c, h, i = min(freq)
            if c:  # a window with a shingle that no document holds occurs nowhere
                keys.append(h)
                self.offset.append(i)
                self.n.append(r["n"])
                self.words.append(bytes(r["words"]))
                self.items.append(sorted(r["items"]))
        order = np.argsort(K.unsigned(np.array(keys, dtype=np.int64)), kind="stable")
        self.key = K.unsigned(np.array(keys, dtype=np.int64))[order]
        self.offset = np.array(self.offset, dtype=np.int64)[order]
        self.n = np.array(self.n, dtype=np.int64)[order]
        self.words = [self.words[i] for i in order]
        self.items = [self.items[i] for i in order]
        self.sizes = sorted({min(shingle, int(n)) for n in self.n})

    def occurrences(self, w: K.Words) -> list[tuple[int, int, int]]:
        """(word index of the start, words, window number), verified."""
        out = []
        for s in self.sizes:
            h, at = _shingles(w, s)
            lo, hi = np.searchsorted(self.key, h), np.searchsorted(self.key, h, side="right")
            hit = np.flatnonzero(hi > lo)
            for a, x, y in zip(at[hit].tolist(), lo[hit].tolist(), hi[hit].tolist(), strict=True):
                row = w.row[a]
                for k in range(x, y):
                    n, start = int(self.n[k]), a - int(self.offset[k])
                    if min(n, s) != s or start < w.first[row] or start + n > w.first[row + 1]:
                        continue
                    if b" ".join(w.word(i) for i in range(start, start + n)) == self.words[k]:
                        out.append((start, n, k))
        return out


def decontaminate(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", keep: list[str] | None = None,
                  window: int = WINDOW, shingle: int = SHINGLE, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``keep`` (the key alone by default), n_words, n_hit, n_items,
    items_sha256, contaminated; one row per row of ``docs``."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    keep = keep or [key]
    wins = item_windows(items, item, item_text, window, shingle)
    total = wins.select(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_shingles))
    indexes = []
    for k in range(blocks):
        rows = wins.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).collect()
        known = np.unique(K.unsigned(np.array([h for r in rows for h in r["shingles"]], dtype=np.int64)))
        sizes = sorted({min(shingle, r["n"]) for r in rows})
        counts = {r[0]: r[1] for r in shingle_counts(docs, text, sc.broadcast(known), sizes).collect()} if rows else {}
        indexes.append(sc.broadcast(WindowIndex(rows, counts, shingle)))
    cols = [F.col(c) for c in keep]
    src = docs.select(*cols, F.col(text).alias("__text"))
    base = list(src.schema[:-1])
    between = T.StructType([*src.schema, T.StructField("__spans", T.ArrayType(T.LongType())),
                            T.StructField("__items", T.ArrayType(T.StringType()))])
    final = T.StructType([*base, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                          T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
                          T.StructField("contaminated", T.BooleanType())])
    out = src
    for k, index in enumerate(indexes):
        out = out.mapInArrow(_join(index, len(keep), k == len(indexes) - 1), final if k == len(indexes) - 1 else between)
    assert spark is out.sparkSession
    return out


def _join(index, n_keep: int, last: bool):
    """The pass that adds the hits of one block; the last one counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in batches:
            raw, off = K.utf8_buffers(b.column(n_keep))
            before = n_keep + 1 < b.num_columns
            spans = b.column(n_keep + 1).to_pylist() if before else [[] for _ in range(b.num_rows)]
            found = b.column(n_keep + 2).to_pylist() if before else [[] for _ in range(b.num_rows)]
            n_words = np.zeros(b.num_rows, dtype=np.int64)
            for lo, hi in K.slices(off):
                w = K.Words(raw, off[lo: hi + 1], _TABLE)
                n_words[lo:hi] = w.count()
                for start, n, k in ix.occurrences(w):
                    r = int(w.row[start])
                    at = start - int(w.first[r])
                    if spans[lo + r] and spans[lo + r][-2] <= at <= spans[lo + r][-1]:
                        spans[lo + r][-1] = max(spans[lo + r][-1], at + n)
                    else:
                        spans[lo + r] += [at, at + n]
                    if ix.items[k]:
                        found[lo + r] += ix.items[k]
            found = [sorted(set(f)) if f else f for f in found]
            if not last:
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[: n_keep + 1], pa.array(spans, pa.list_(pa.int64())),
                     pa.array(found, pa.list_(pa.string()))],
                    names=[*b.schema.names[: n_keep + 1], "__spans", "__items"])
                continue
            n_hit = np.array([covered(s) for s in spans], dtype=np.int64)
            digest = [hashlib.sha256(",".join(f).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keep], pa.array(n_words), pa.array(n_hit),
                 pa.array([len(f) for f in found], pa.int64()), pa.array(digest, pa.string()),
                 pa.array((n_hit > 0) & (MIN_SHARE_INVERSE * n_hit >= n_words))],
                names=[*b.schema.names[:n_keep], "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return run


def covered(spans: list[int]) -> int:
    """Words in the union of [start, end) pairs."""
    total, reach = 0, -1
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


_SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
#: DuckDB SQL for ``decontaminate`` over ``documents`` and ``benchmark``.
SQL = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT item, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS p
        FROM item WHERE len(w) > 0)),
held AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT h.doc_id, h.p, h.n, w.item FROM held h JOIN win w ON h.n = w.n AND h.s = w.s),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {MIN_SHARE_INVERSE} * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
