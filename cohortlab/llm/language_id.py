"""Language identification with bit-sliced Bloom filters over n-grams.

Fit: from a bounded sample of labelled rows (``sample_per_lang`` documents of
each language in expectation, drawn by a hash of the key) the character
n-grams of each language are counted on Spark. A language holds an n-gram if
its share there is at least ``min_share`` and at least ``min_ratio`` of the
share in the language where it is most frequent (so that a few foreign
passages or wrong labels put nothing into a filter). Shares sum to 1, so a
language holds at most ``1 / min_share`` n-grams and the model has a size
that does not follow the corpus.

Model: one array of bit masks (bit l of a slot: some n-gram of language l
hashes there). The AND of an n-gram's slots is the set of languages that hold
it. Predict: per language the number of the text's n-grams whose mask has its
bit, corrected for the filter's false positives: with fill rate f and k
hashes a foreign n-gram hits with probability p = f^k, so of n n-grams with x
hits, (x - p n) / (1 - p) are expected to be true.

n-grams: of the lower-cased letters of each word with one mark before and
after it; other characters separate words. Every text with a letter has one.

Defined results: a text that is null or without letters gives ``und`` with
score 0; ties go to the language with more training rows, then the smaller
name; without any labelled rows every text gives ``und``. Neither language,
source nor key is an input of a prediction. Repeated rows repeat; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K

SAMPLE_PER_LANG = 4000
SIZES = (3, 4)
MIN_SHARE = 2e-5
MIN_RATIO = 0.05
HASHES = 3
SLOTS_PER_GRAM = 8
UNDETERMINED = "und"
SLICE_CHARS = 1 << 19

_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter (built once per process)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def grams(texts: list[str | None], sizes=SIZES) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every n-gram of the texts, in text order for
    each size."""
    marked = [" " + t.lower() + " " if t else " " for t in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in marked])
    letter = letter_table()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    # of each run of separators the one before and the one after a word stay
    codes = np.where(letter, codes, 0)[keep].astype(np.uint64)
    owner, letter = owner[keep], letter[keep]
    hashes, owners = [], []
    for k in sizes:
        n = len(codes) - k + 1
        if n <= 0:
            continue
        h, ok = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
        for j in range(k):
            h = h * K.U(0x1000003D) + codes[j: j + n]
            if 0 < j < k - 1:
                ok &= letter[j: j + n]
        if k > 3:
            # a mark at both ends: a word of k - 2 letters; marks alone are none
            ok &= letter[: n] | letter[k - 1: k - 1 + n]
        hashes.append(K.mix(h[ok] + K.U(k)))
        owners.append(owner[1: 1 + n][ok])
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
    return np.concatenate(hashes), np.concatenate(owners)


@dataclass
class LanguageModel:
    """Languages in tie order, bit masks (slots x mask words), false-positive
    rate per language."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    sizes: tuple[int, ...] = SIZES
    hashes: int = HASHES

    @classmethod
    def build(cls, members: dict[str, np.ndarray], order: list[str], sizes=SIZES, hashes: int = HASHES,
              slots_per_gram: int = SLOTS_PER_GRAM) -> LanguageModel:
        most = max([1, *(len(g) for g in members.values())])
        m = 1 << max(10, int(np.ceil(np.log2(most * slots_per_gram))))
        slots = np.zeros((m, (len(order) + 63) // 64 or 1), dtype=np.uint64)
        fill = np.zeros(len(order))
        for i, lang in enumerate(order):
            at = np.unique(np.concatenate([cls._slot(members[lang], j, m) for j in range(hashes)]))
            slots[at, i // 64] |= K.U(1) << K.U(i % 64)
            fill[i] = len(at) / m
        return cls(order, slots, fill ** hashes, tuple(sizes), hashes)

    @staticmethod
    def _slot(h: np.ndarray, j: int, m: int) -> np.ndarray:
        bits = int(m).bit_length() - 1
        return ((h >> K.U(21 * j)) & K.U((1 << min(bits, 21)) - 1) if bits <= 21
                else K.mix(h + K.U(j)) & K.U(m - 1)).astype(np.int64)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        h, owner = grams(texts, self.sizes)
        total = np.bincount(owner, minlength=n).astype(float)
        if not self.languages or not len(h):
            return [UNDETERMINED] * n, np.zeros(n)
        corrected = np.zeros((n, len(self.languages)))
        at = [self._slot(h, j, len(self.slots)) for j in range(self.hashes)]
        for w in range(self.slots.shape[1]):
            mask = self.slots[at[0], w]
            for a in at[1:]:
                mask &= self.slots[a, w]
            for i in range(64 * w, min(len(self.languages), 64 * w + 64)):
                hit = ((mask >> K.U(i % 64)) & K.U(1)).astype(bool)
                x, p = np.bincount(owner[hit], minlength=n), self.false_rate[i]
                corrected[:, i] = (x - p * total) / max(1 - p, 1e-9)
        best = corrected.argmax(axis=1)
        score = np.clip(corrected[np.arange(n), best] / np.maximum(total, 1), 0.0, 1.0)
        names = [self.languages[i] if t else UNDETERMINED for i, t in zip(best, total, strict=True)]
        return names, np.where(total > 0, score, 0.0)


def text_slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most SLICE_CHARS characters, or one text."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > a and size + n > SLICE_CHARS:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def fit_language_model(docs: DataFrame, training: Column, *, key: str = "doc_id", text: str = "text",
                       lang: str = "lang", sample_per_lang: int = SAMPLE_PER_LANG, min_share: float = MIN_SHARE,
                       min_ratio: float = MIN_RATIO, sizes=SIZES) -> LanguageModel:
    """Fit on the rows where ``training`` holds and a label is given.

    Two jobs: a count per language (no text is read), then the n-gram counts
    of the sample. The driver gets one row per language and at most
    ``1 / min_share`` n-grams of each.
    """
    rows = docs.filter(training & F.col(lang).isNotNull() & (F.col(lang) != UNDETERMINED))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    order = sorted(counts, key=lambda x: (-counts[x], x))
    if not order:
        return LanguageModel.build({}, [], sizes)
    limits = F.create_map(*(F.lit(x) for name in order for x in
                            (name, int(min(1.0, sample_per_lang / counts[name]) * (1 << 40)))))
    draw = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    sample = rows.filter(draw < limits[F.col(lang)]).select(lang, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = np.array(b.column(0).to_pylist(), dtype=object)
            texts = b.column(1).to_pylist()
            for name in sorted(set(names)):
                own = [texts[i] for i in np.flatnonzero(names == name)]
                for lo, hi in text_slices(own):
                    g, n = np.unique(grams(own[lo:hi], sizes)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(g), pa.string()), pa.array(K.signed(g)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"])

    held = (sample.mapInArrow(count, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = held.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = held.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    # the best share of each n-gram, next to the language's own
    members = (shares.groupBy("gram").agg(F.collect_list(F.struct("lang", "share")).alias("all"),
                                          F.max("share").alias("best"))
               .select("gram", F.explode("all").alias("x"), "best")
               .filter((F.col("x.share") >= min_share) & (F.col("x.share") >= min_ratio * F.col("best")))
               .select(F.col("x.lang").alias("lang"), "gram").collect())
    own: dict[str, list[int]] = {name: [] for name in order}
    for r in members:
        own[r["lang"]].append(r["gram"])
    return LanguageModel.build({k: K.unsigned(np.array(v, dtype=np.int64)) for k, v in own.items()}, order, sizes)


def identify_language(docs: DataFrame, model: LanguageModel, *, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred and score; one pass, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            names: list[str] = []
            scores: list[np.ndarray] = [np.zeros(0)]
            for lo, hi in text_slices(texts):
                got, s = held.value.predict(texts[lo:hi])
                names += got
                scores.append(s)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                names=[*b.schema.names[:-1], "lang_pred", "score"])

    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*src.schema[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return src.mapInArrow(run, schema)


def remainder(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 5 (the held-out rows have 0)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def language_id(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
                **fit) -> DataFrame:
    """key, held_out, lang_pred, score: learned on the rows that are not held
    out (a row without key is neither trained on nor held out)."""
    model = fit_language_model(docs, F.coalesce(remainder(key) != 0, F.lit(False)), key=key, text=text, lang=lang, **fit)
    src = docs.select(F.col(key), F.coalesce(remainder(key) == 0, F.lit(False)).alias("held_out"), F.col(text).alias("__t"))
    return identify_language(src, model, keep=[key, "held_out"], text="__t")
