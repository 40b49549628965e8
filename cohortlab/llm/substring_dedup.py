"""Substring dedup: content-defined chunks from a gear rolling hash.

A document is the sequence of its words. A gear hash rolls over the words'
hashes in a register of ``GEAR`` words (shift, add, the oldest word leaves). A
word ends a chunk if its value is above those of the ``REACH`` words before
and not below those of the ``REACH`` words after. So a cut depends on a few
words around it and on nothing else: a passage has the same cuts wherever it
stands, an insertion moves only the cuts beside it, and chunks have at least
``REACH + 1`` words. Stretches without a cut end a chunk after ``MAX_WORDS``.

Chunks are compared by a 64-bit digest of their words. The occurrence with the
smallest (document id, position) is the first; every other one is a duplicate
if the digest is found in another document. A run of neighbouring duplicates
is a passage if it follows the chunks of one other document for ``min_words``
words. The common text can go on into the next chunk on either side (and a few
words on, where cuts depend on what stands outside it); any other run that
could reach ``min_words`` that way is verified: one whole window of that many
words must also stand in an earlier document. All documents are asked that
hold enough neighbouring chunks of such runs, whether these are first
occurrences, proven or not. Other runs (a licence line, a common sentence) are left alone.

Shuffles hold digests and positions, never texts. Digests are counted once per
map slice before they are shuffled, so that a frequent passage costs one row
per slice there. What is joined with them by digest or window is a written table,
so that Spark can split a frequent one.

Defined results: null and empty texts have no words and no passages; null ids
come last; rows that share id and text are one document, so that repeated rows
report the same passages once; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .line_dedup import text_key
from .scratch import small_side, written

GEAR = 3
REACH = 2
MAX_WORDS = 64
MIN_WORDS = 51
_TABLE = K.ascii_table("nonspace", lower=False)


def gear_hash(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Rolling value at each word, over the last GEAR words of its row."""
    out = h.copy()
    for j in range(1, GEAR):
        same = row[j:] == row[:-j]
        out[j:] += np.where(same, h[:-j] << K.U(j), K.U(0))
    return K.mix(out)


class Chunks:
    """Chunks of a slice: first word, words, row, number in the row, digest."""

    def __init__(self, w: K.Words):
        n = len(w.hash)
        g, row = gear_hash(w.hash, w.row), w.row
        cut = np.ones(n, dtype=bool)
        for j in range(1, REACH + 1):
            same = row[j:] == row[:-j]
            cut[j:] &= ~same | (g[j:] > g[:-j])
            cut[:-j] &= ~same | (g[:-j] >= g[j:])
        last = np.ones(n, dtype=bool)
        last[:-1] = row[1:] != row[:-1]
        first = np.ones(n, dtype=bool)
        first[1:] = cut[:-1] | last[:-1]
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, n))
        if n and size.max() > MAX_WORDS:
            parts = -(-size // MAX_WORDS)
            of = np.repeat(np.arange(len(start)), parts)
            k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = start[of] + k * MAX_WORDS
            size = np.diff(np.append(start, n))
        self.start, self.size = start, size
        self.row = row[start]
        edge = np.ones(len(start), dtype=bool)
        edge[1:] = self.row[1:] != self.row[:-1]
        begin = np.flatnonzero(edge)
        self.number = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
        if n:
            place = np.arange(n) - np.repeat(start, size)
            self.digest = K.mix(np.add.reduceat(w.hash * K.powers(K._Q, MAX_WORDS + 1)[place], start)
                                + size.astype(np.uint64))
        else:
            self.digest = np.zeros(0, dtype=np.uint64)
        # words that the common text can have beside a run: a cut inside it is
        # only missing from the other document where the gear register or the
        # reach leaves the common text
        spare = np.zeros(len(start), dtype=np.int64)
        self.before, self.after = spare.copy(), spare.copy()
        self.before[1:] = np.where(edge[1:], 0, size[:-1] + REACH + GEAR - 1)
        self.after[:-1] = np.where(edge[1:], 0, size[1:] + REACH)


def _repeated_digests(src: DataFrame) -> DataFrame:
    """Digests that occur twice or more, counted once per slice before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(0))
            for lo, hi in K.slices(off, 4 * K.SLICE_BYTES):
                d, n = np.unique(Chunks(K.Words(raw, off[lo: hi + 1], _TABLE)).digest, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(d)), pa.array(n > 1)], names=["digest", "again"])

    found = src.select("text").mapInArrow(run, "digest bigint, again boolean")
    return (found.groupBy("digest").agg(F.count("*").alias("n"), F.max("again").alias("again"))
            .filter("n > 1 OR again").select("digest"))


def _chunk_rows(src: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(2))
            for lo, hi in K.slices(off):
                w = K.Words(raw, off[lo: hi + 1], _TABLE)
                c = Chunks(w)
                rows = pa.array(lo + c.row)
                base = w.offsets[c.row]
                i32 = [c.number, w.start[c.start] - base, w.end[c.start + c.size - 1] - base, c.size, c.before, c.after]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(c.digest)), b.column(0).take(rows), b.column(1).take(rows),
                     *(pa.array(x.astype(np.int32)) for x in i32)],
                    names=["digest", "id", "tkey", "chunk", "start", "end", "n", "before", "after"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"digest bigint, id {kind}, tkey bigint, chunk int, start int, end int, n int, "
                               "before int, after int")


def stretches(chunks: list[dict], min_words: int) -> Iterator[tuple[list[dict], int]]:
    """The stretches of neighbouring ones among a document's chunks that can
    hold ``min_words`` words with what the common text may have on either
    side, each with its own words."""
    ordered = sorted({c["chunk"]: c for c in chunks}.values(), key=lambda c: c["chunk"])
    cuts = [k for k in range(1, len(ordered)) if ordered[k]["chunk"] != ordered[k - 1]["chunk"] + 1]
    for a, b in zip([0, *cuts], [*cuts, len(ordered)], strict=True):
        run = ordered[a:b]
        n = sum(c["n"] for c in run)
        if run and n + run[0]["before"] + run[-1]["after"] >= min_words:
            yield run, n


def passages_of(own: tuple, chunks: list[dict], min_words: int) -> list[dict]:
    """The runs of one document's duplicate chunks that can hold
    ``min_words`` words: bytes, words, how many more words the common text may
    have on either side, the document of the first chunk's first occurrence,
    and the digests of a run that is not proven. A run is proven if it follows
    one other document for ``min_words`` words."""
    out = []
    for run, n in stretches(chunks, min_words):
        was, stretch, longest = None, 0, 0
        for c in run:
            f = c["f"]
            if was is None or (f["id"], f["tkey"], f["chunk"]) != (was["id"], was["tkey"], was["chunk"] + 1):
                stretch = 0
            was, stretch = f, stretch + c["n"]
            if (f["id"], f["tkey"]) != own:
                longest = max(longest, stretch)
        proven = longest >= min_words
        out.append({"start": run[0]["start"], "end": run[-1]["end"], "n": n, "before": run[0]["before"],
                    "after": run[-1]["after"], "proven": proven, "first_id": run[0]["f"]["id"],
                    "digests": [] if proven else sorted({c["digest"] for c in run})})
    return out


def _runs(again: DataFrame, min_words: int) -> DataFrame:
    """(id, tkey, start, end, n, before, after, proven, first_id, digests)."""
    kind = again.schema["id"].dataType.simpleString()
    rows = again.select("id", "tkey", F.struct("digest", "chunk", "start", "end", "n", "before", "after", "f").alias("c"))
    docs = rows.groupBy("id", "tkey").agg(F.collect_list("c").alias("chunks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                p = b.slice(lo, 256)
                found = [passages_of((i, t), c, min_words) for i, t, c in zip(*(x.to_pylist() for x in p.columns), strict=True)]
                rows = pa.array(np.repeat(np.arange(p.num_rows), [len(f) for f in found]))
                flat = [x for f in found for x in f]
                ints = ("start", "end", "n", "before", "after")
                yield pa.RecordBatch.from_arrays(
                    [p.column(0).take(rows), p.column(1).take(rows), *(pa.array([x[k] for x in flat], pa.int64()) for k in ints),
                     pa.array([x["proven"] for x in flat], pa.bool_()), pa.array([x["first_id"] for x in flat], p.schema.field(0).type),
                     pa.array([x["digests"] for x in flat], pa.list_(pa.int64()))],
                    names=["id", "tkey", *ints, "proven", "first_id", "digests"])

    return docs.mapInArrow(run, f"id {kind}, tkey bigint, start bigint, end bigint, n bigint, before bigint, after bigint, "
                                f"proven boolean, first_id {kind}, digests array<bigint>")


def _holders(chunks: DataFrame, min_words: int) -> DataFrame:
    """(id, tkey, place, back, ahead): where documents hold neighbouring ones
    of ``chunks`` that can hold ``min_words`` words."""
    kind = chunks.schema["id"].dataType.simpleString()
    rows = chunks.select("id", "tkey", F.struct("chunk", "n", "before", "after").alias("c"))
    docs = rows.groupBy("id", "tkey").agg(F.collect_list("c").alias("chunks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                p = b.slice(lo, 256)
                found = [[(run[0]["chunk"], run[0]["before"], n + run[-1]["after"]) for run, n in stretches(c, min_words)]
                         for c in p.column(2).to_pylist()]
                rows = pa.array(np.repeat(np.arange(p.num_rows), [len(f) for f in found]))
                flat = [x for f in found for x in f]
                yield pa.RecordBatch.from_arrays(
                    [p.column(0).take(rows), p.column(1).take(rows), *(pa.array([x[k] for x in flat], pa.int64()) for k in range(3))],
                    names=["id", "tkey", "place", "back", "ahead"])

    return docs.mapInArrow(run, f"id {kind}, tkey bigint, place bigint, back bigint, ahead bigint")


def _window_rows(texts: DataFrame, min_words: int) -> DataFrame:
    """(id, tkey, run, window) of (id, tkey, text, asks): the hashes of all
    windows of ``min_words`` words in each asked range. An ask gives a run of
    the text (or null), a byte or a chunk where the range has its place, and
    how many words the range has before and from there. What a run of the text
    gives is not given again without a run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(2))
            for r in range(b.num_rows):
                w = K.Words(raw, off[r: r + 2], _TABLE)
                c, h = Chunks(w), K.windows(w.hash, min_words)
                runs, win = [], [np.zeros(0, dtype=np.uint64)]
                given = np.zeros(len(h), dtype=bool)
                for a in sorted(b.column(3)[r].as_py(), key=lambda a: a["run"] is None):
                    at = int(np.searchsorted(w.start, a["place"])) if a["run"] is not None else int(c.start[a["place"]])
                    part = slice(max(0, at - a["back"]), max(0, at + a["ahead"] - min_words + 1))
                    got = h[part] if a["run"] is not None else h[part][~given[part]]
                    given[part] = True
                    runs += [a["run"]] * len(got)
                    win.append(got)
                rows = pa.array(np.full(len(runs), r))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(runs, pa.int64()),
                     pa.array(K.signed(np.concatenate(win)))], names=["id", "tkey", "run", "window"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, tkey bigint, run bigint, window bigint")


def repeated_passages(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """(id, tkey, start, end, n_words, first_id): one row per passage that
    repeats an earlier document; start and end are UTF-8 byte positions of its
    whole chunks, first_id is the document that keeps the first of them."""
    src = docs.select(F.col(key).alias("id"), text_key(text).alias("tkey"), F.col(text).alias("text"))
    # the sides that are aggregates of the join key are written first: a join of two scans can split a frequent key
    repeated = written(_repeated_digests(src), "repeated-digests")
    shared = written(_chunk_rows(src).join(repeated, "digest", "left_semi"), "shared-chunks")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "tkey", "chunk")
    firsts = (shared.groupBy("digest").agg(F.min(order).alias("f"), F.max(F.struct(F.col("id").isNull(), "id", "tkey")).alias("m"))
              .filter(~F.col("m.id").eqNullSafe(F.col("f.id")) | (F.col("m.tkey") != F.col("f.tkey")))
              .select("digest", "f"))
    firsts = written(firsts, "first-chunks")
    again = shared.join(firsts, "digest").filter(order > F.col("f"))
    runs = written(_runs(again, min_words).withColumn(
        "run", F.xxhash64("id", F.col("id").isNull(), "tkey", "start")), "runs")

    # runs that are not proven: is a whole window of them, with what stands beside them, in an earlier document?
    # A document with such a window holds all whole chunks in it, as its first or not, in a run that is proven or not.
    open_ = runs.filter("NOT proven")
    sought = small_side(written(open_.select(F.explode("digests").alias("digest")).distinct(), "sought-digests"))
    own = open_.select("id", "tkey", F.struct("run", F.col("start").alias("place"), F.col("before").alias("back"),
                                              (F.col("n") + F.col("after")).alias("ahead")).alias("ask"))
    other = (_holders(shared.join(sought, "digest", "left_semi"), min_words)
             .select("id", "tkey", F.struct(F.lit(None).cast("bigint").alias("run"), "place", "back", "ahead").alias("ask")))
    asks = written(own.unionByName(other).groupBy("id", "tkey").agg(F.collect_set("ask").alias("asks")), "asks")
    a = small_side(asks).select(F.col("id").alias("aid"), F.col("tkey").alias("akey"), "asks")
    texts = src.join(a, src.id.eqNullSafe(F.col("aid")) & (src.tkey == F.col("akey"))).select("id", "tkey", "text", "asks")
    windows = written(_window_rows(texts, min_words), "windows")
    document = F.struct(F.col("id").isNull().alias("last"), "id", "tkey")
    earliest = written(windows.groupBy("window").agg(F.min(document).alias("e"), F.max(document).alias("m")).filter("e != m")
                       .select("window", "e"), "earliest-windows")
    whole = (windows.filter("run IS NOT NULL").join(earliest, "window").filter(document > F.col("e"))
             .select("run").distinct())
    kept = runs.filter("proven").unionByName(open_.join(whole, "run", "left_semi").select(*runs.columns))
    return kept.select("id", "tkey", "start", "end", F.col("n").alias("n_words"), "first_id")


def passage_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """key, first_<key>, start, end, n_words."""
    return (repeated_passages(docs, key=key, text=text, min_words=min_words)
            .select(F.col("id").alias(key), F.col("first_id").alias(f"first_{key}"), "start", "end", "n_words"))


def without_passages(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; all columns
    pass through."""
    p = written(repeated_passages(docs, key=key, text=text, min_words=min_words)
                .groupBy("id", "tkey").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")), "passages")
    p = small_side(p).select(F.col("id").alias("__sd_id"), F.col("tkey").alias("__sd_key"), F.col("cuts").alias("__sd_cuts"))
    joined = docs.join(p, docs[key].eqNullSafe(F.col("__sd_id")) & (text_key(docs[text]) == F.col("__sd_key")), "left")
    at = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, cuts in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if cuts:
                    data, keep, pos = t.encode(), [], 0
                    for c in cuts:
                        keep.append(data[pos: c["start"]])
                        pos = c["end"]
                    t = b"".join([*keep, data[pos:]]).decode()
                out.append(t)
            cols = list(b.columns[:-1])
            cols[at] = pa.array(out, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return joined.select(*(docs[c] for c in docs.columns), "__sd_cuts").mapInArrow(cut, docs.schema)
