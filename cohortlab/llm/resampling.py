"""Importance resampling towards a target distribution.

Words come from a pre-tokeniser of the ``tokenizers`` library that is not
trained: a Regex Split over the text with A-Z lower-cased gives every word with
its offsets. A window of n neighbouring offset pairs is a feature: its words
joined by one space. A feature's bucket is the CRC-32 of its UTF-8 bytes modulo
``buckets``. Bucket histograms of the documents and of the target give each
bucket a gain, the scaled logarithm of how much likelier the bucket is in the
target; a document's weight is the mean gain of its features. Scores add Gumbel
noise (from a hash of the id), so that the highest scores are a sample without
replacement in proportion to the weights.

Texts are pre-tokenised once. Each document's buckets go to a written table (two
bytes a feature), from which the histograms and the weights are read. The
driver sees one number per bucket, a parameter. Tasks sum their histogram
before the shuffle. Ranks come from a range-partitioned sort of small rows, not
from one window. A long text is split into pieces between words, so that
memory does not follow the number of words.

Defined results: null and empty texts have no words, weight 0 and are never
drawn; a null id counts as the empty string in the noise and comes after the
other ids in ties; repeated rows repeat, each with a rank of its own, and rows
of one id and score are ranked by n_features; further columns of any name are
not read; empty tables on either side are allowed (an empty target has
T = t = 0).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from ..operators.text import dense_index
from .scratch import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10
#: Characters that are pre-tokenised at a time.
PIECE = 1 << 18
#: Words whose checksum a task remembers.
REMEMBERED = 1 << 18


def _is_word(c: str) -> bool:
    return c >= "\x80" or c.isalnum()


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters that end between words
    (a longer word is not cut)."""
    a, n = 0, len(text)
    while n - a > size:
        b = a + size
        while b < n and _is_word(text[b - 1]) and _is_word(text[b]):
            b += 1
        yield text[a:b]
        a = b
    yield text[a:]


class Features:
    """Buckets of a text's windows."""

    def __init__(self, low: int, high: int, buckets: int):
        self.split = Split(Regex(WORD), behavior="removed", invert=True)
        self.low, self.high, self.buckets = low, high, buckets
        self.kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
        self.seen: dict[str, int] = {}

    def _word(self, w: str) -> int:
        n = self.seen.get(w)
        if n is None:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            n = self.seen[w] = zlib.crc32(w.encode()) % self.buckets
        return n

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """(words, buckets of all windows) of a lower-cased text."""
        words, out = 0, []
        tail: list[str] = []
        for p in pieces(text):
            spans = self.split.pre_tokenize_str(p)
            words += len(spans)
            if self.high == 1:
                out.append(np.fromiter((self._word(w) for w, _ in spans), self.kind, len(spans)))
                continue
            # windows that end in this piece: the pairs (first word's offsets, last word's offsets), with what the
            # pieces before left over
            near = tail + [p[a:b] for _, (a, b) in spans]
            found = []
            for j in range(len(tail), len(near)):
                for n in range(self.low, min(self.high, j + 1) + 1):
                    found.append(zlib.crc32(" ".join(near[j - n + 1: j + 1]).encode()) % self.buckets)
            out.append(np.array(found, dtype=self.kind))
            tail = near[max(0, len(near) - self.high + 1):]
        return words, np.concatenate(out)


def feature_buckets(docs: DataFrame, key: str | Column, text: str, *, low: int, high: int, buckets: int) -> DataFrame:
    """(id, n_words, n_features, features): one row per row of ``docs``;
    ``features`` holds the buckets as little-endian numbers."""
    src = docs.select((F.col(key) if isinstance(key, str) else key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features(low, high, buckets)
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                part = b.slice(lo, 128)
                lowered = pc.ascii_lower(part.column(1))
                found = [f.of(t.as_py() or "") for t in lowered]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([w for w, _ in found], pa.int64()),
                     pa.array([len(x) for _, x in found], pa.int64()),
                     pa.array([x.tobytes() for _, x in found], pa.binary())],
                    names=["id", "n_words", "n_features", "features"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, features binary")


def _flat(col: pa.Array, kind: np.dtype) -> np.ndarray:
    """The numbers of a binary column, one after the other."""
    _, off, data = col.buffers()
    at = np.frombuffer(off, dtype=np.int32)[col.offset: col.offset + len(col) + 1]
    if data is None or at[0] == at[-1]:
        return np.zeros(0, dtype=kind)
    return np.frombuffer(data, dtype=np.uint8)[at[0]: at[-1]].view(kind)


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket; each task sends its own sums."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            n += np.bincount(_flat(b.column(0), kind), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in features.select("features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of B buckets, in doubles."""
    b, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000.0 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(source.astype(float), target.astype(float), strict=True)], dtype=np.int64)


def weights(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain, 0 without features."""
    held = features.sparkSession.sparkContext.broadcast(gain)
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy()
            total = np.zeros(len(n), dtype=np.int64)
            some = np.flatnonzero(n)
            if len(some):
                at = np.cumsum(n) - n
                total[some] = np.add.reduceat(held.value[_flat(b.column(3), kind)], at[some]) // n[some]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(total)],
                                             names=["id", "n_words", "n_features", "weight"])

    kind_id = features.schema["id"].dataType.simpleString()
    return features.mapInArrow(run, f"id {kind_id}, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of sha256(``seed:key``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000.0 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def importance_resample(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text",
                        target_text: str = "text", low: int = 1, high: int = 1, buckets: int = BUCKETS,
                        seed: str = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """key, n_features, weight, score, rank of every row of ``docs``; ``rank``
    is null where the row is not drawn. Drawn are the ``percent`` per cent
    (floored) with the highest scores among the rows of ``min_words`` words;
    features are runs of ``low`` to ``high`` words."""
    size = {"low": low, "high": high, "buckets": buckets}
    mine = written(feature_buckets(docs, key, text, **size), "features")
    wanted = feature_buckets(target, F.lit(0).cast("bigint"), target_text, **size)
    gain = gains(histogram(mine, buckets), histogram(wanted, buckets))
    scored = written(weights(mine, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    # the position in the table splits a score that very many equal rows have
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("n_features").asc(), F.col("__at").asc()]
    ranked = dense_index(able.withColumn("__at", F.monotonically_increasing_id()), order, out="rank").withColumn("rank", F.col("rank") + 1)
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank")
    columns = [F.col("id").alias(key), "n_features", "weight", "score"]
    rest = scored.filter(F.col("n_words") < min_words)
    return ranked.select(*columns, rank).unionByName(rest.select(*columns, F.lit(None).cast("bigint").alias("rank")))


def _sql_words(table: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


#: DuckDB has no CRC-32: its table and the sum over the bytes are written out.
SQL = f"""
WITH tab AS MATERIALIZED (
  SELECT list(c ORDER BY n) AS crc_table FROM (
    SELECT n, list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
                          lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END) AS c
    FROM range(256) AS r(n))),
docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row_no, {_sql_words('documents')} AS w FROM documents),
item AS MATERIALIZED (SELECT {_sql_words('benchmark')} AS w FROM benchmark),
doc_word AS MATERIALIZED (SELECT row_no, unnest(w) AS word FROM docs),
item_word AS MATERIALIZED (SELECT unnest(w) AS word FROM item),
word AS MATERIALIZED (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_word UNION SELECT word FROM item_word)),
bucket AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                   list_transform(range(1, length(h) // 2 + 1), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))),
                   lambda c, b: xor(c // 256, crc_table[xor(c, b) % 256 + 1])), CAST(4294967295 AS BIGINT)) % {BUCKETS} AS b
  FROM word, tab),
s AS (SELECT b, count(*) AS n FROM doc_word JOIN bucket USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM item_word JOIN bucket USING (word) GROUP BY b),
gain AS MATERIALIZED (
  SELECT b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM doc_word) + {BUCKETS}.0::DOUBLE)
           / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM item_word) + {BUCKETS}.0::DOUBLE)))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (b)),
weighed AS (
  SELECT row_no, CAST(count(*) AS BIGINT) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
  FROM doc_word JOIN bucket USING (word) JOIN gain USING (b) GROUP BY row_no),
scored AS (
  SELECT doc_id, row_no, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
           CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
           + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weighed USING (row_no)),
able AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, row_no) AS r,
         count(*) OVER () AS n FROM scored WHERE n_words >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= {PERCENT} * n // 100 THEN r END AS rank
FROM scored LEFT JOIN able USING (row_no)
"""
