"""Text operators: tokenization, word counts, vocabulary, term counts,
dense document index and the note cohort.

Tokenization is one JVM expression tree per document over the whole text
(regex passes, lower case, split, higher-order token filter) followed by
Spark ML's ``StopWordsRemover`` (a hash-set lookup in the JVM), also for stop
words given as a DataFrame, if they or those in use are at most
``LOOKUP_WORDS``; more are joined with the rows' distinct terms. Counting
explodes tokens and aggregates with map-side combine, so a very frequent
term or a very long document never becomes a single hot reduce task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEFAULT_STOP_WORDS, MIN_WORDS
from ..functions.textcols import word_tokens
from .cohort import notes_in_episode

#: Stop words that a task looks up in a hash set (a word each, a few dozen MB).
LOOKUP_WORDS = 1_000_000
#: Column of the cohort row that in-episode notes carry.
COHORT = "_cohort"


def _words_in_use(words: DataFrame, df: DataFrame, raw: str) -> list[str] | None:
    """The stop words to look up, or None if they are more than
    ``LOOKUP_WORDS``: the whole list if it is short enough, otherwise those of its
    words that occur at all (a join of distinct terms, not of tokens)."""
    stop = words.select(F.col(words.columns[0]).alias("term")).filter("term IS NOT NULL").distinct()
    for found in (lambda: stop, lambda: explode_tokens(df, [], raw).distinct().join(stop, "term", "left_semi")):
        rows = found().limit(LOOKUP_WORDS + 1).collect()
        if len(rows) <= LOOKUP_WORDS:
            return [r["term"] for r in rows]
    return None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _rest(tokens: pd.Series, lost: pd.Series) -> pd.Series:
    """Tokens that are not among the lost ones; Spark's array functions
    compare each token with each of them."""
    def rest(row, gone):
        if row is None or gone is None:
            return row
        gone = set(gone)
        return [t for t in row if t not in gone]
    return pd.Series([rest(r, g) for r, g in zip(tokens, lost)], dtype=object)


def _without_words(df: DataFrame, raw: str, out: str, words: DataFrame) -> DataFrame:
    """``raw`` without the tokens in the first column of ``words``, whatever
    their number: each row's distinct terms are joined with the list, and what a
    row loses comes back as one array. The row's other columns do not move with
    its terms. A long row loses many terms, so they are looked up in a set."""
    from ..session import materialize
    stop = words.select(F.col(words.columns[0]).alias("_term")).filter("_term IS NOT NULL").distinct()
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    terms = rows.select("_row", F.explode(F.array_distinct(raw)).alias("_term"))
    lost = terms.join(stop, "_term", "left_semi").groupBy("_row").agg(F.collect_list("_term").alias("_lost"))
    return rows.join(lost, "_row", "left").withColumn(out, _rest(raw, "_lost")).drop("_row", "_lost", raw)


def tokenize(df: DataFrame, col: str = "text", stopwords: Iterable[str] | DataFrame | None = None,
             *, out: str = "tokens", drop_text: bool = True) -> DataFrame:
    """Add ``out``: cleaned, lower-cased tokens longer than three characters,
    all letters, not stop words (exact match; order and repeats kept). A null
    text has no tokens."""
    tmp = f"_{out}_raw"
    with_raw = df.withColumn(tmp, F.coalesce(word_tokens(col), F.array().cast("array<string>")))
    if drop_text:
        with_raw = with_raw.drop(col)
    if isinstance(stopwords, DataFrame):
        found = _words_in_use(stopwords, with_raw, tmp)
        if found is None:
            return _without_words(with_raw, tmp, out, stopwords)
        stopwords = found
    words = sorted(set(DEFAULT_STOP_WORDS if stopwords is None else stopwords))
    if not words:
        return with_raw.withColumnRenamed(tmp, out)
    remover = StopWordsRemover(inputCol=tmp, outputCol=out, stopWords=words, caseSensitive=True)
    return remover.transform(with_raw).drop(tmp)


def words_per_subject(tok: DataFrame, *, pid: str = "pid", tokens: str = "tokens",
                      out: str = "n_words") -> DataFrame:
    return tok.groupBy(pid).agg(F.sum(F.size(tokens)).cast("bigint").alias(out))


def min_word_subjects(tok: DataFrame, min_words: int = MIN_WORDS, *, pid: str = "pid",
                      tokens: str = "tokens", out: str = "n_words") -> DataFrame:
    """Subjects with at least ``min_words`` kept words (HAVING)."""
    return words_per_subject(tok, pid=pid, tokens=tokens, out=out).filter(F.col(out) >= min_words)


def explode_tokens(tok: DataFrame, keys: Sequence[str], tokens: str = "tokens",
                   term: str = "term") -> DataFrame:
    """One row per token occurrence.

    ``explode_outer`` + a NULL filter instead of ``explode``: for an inner
    explode the optimizer infers ``size(tokens) > 0`` and pushes it below
    projections and exchanges, which evaluates the whole tokenization
    expression a second time. Tokens are never NULL, so the rows are the same.
    """
    return (tok.select(*keys, F.explode_outer(tokens).alias(term))
            .filter(F.col(term).isNotNull()))


def vocabulary(tok: DataFrame, *, tokens: str = "tokens", term: str = "term",
               out: str = "n") -> DataFrame:
    """Distinct terms with their total counts."""
    return (explode_tokens(tok, [], tokens, term).groupBy(term)
            .agg(F.count(F.lit(1)).alias(out)))


def term_counts(tok: DataFrame, *, doc: str | Sequence[str] = "doc_id", tokens: str = "tokens",
                term: str = "term", out: str = "n") -> DataFrame:
    """(doc, term, count) for every term of every document."""
    keys = [doc] if isinstance(doc, str) else list(doc)
    return (explode_tokens(tok, keys, tokens, term).groupBy(*keys, term)
            .agg(F.count(F.lit(1)).alias(out)))


def dense_index(df: DataFrame, order: Sequence[str], *, out: str = "idx",
                checkpoint: bool = True) -> DataFrame:
    """0-based consecutive index in ``order`` (which must be a total order).

    No single-task global window: rows are range-partitioned and sorted,
    each partition counts its rows, the per-partition offsets (one row per
    partition, a size known in advance) are summed and broadcast back, and
    the index is offset + position inside the partition. The sorted rows are
    checkpointed first so both passes see the same partitions even after an
    executor loss.
    """
    s = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        from ..session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        s = s.checkpoint(eager=True)
    s = (s.withColumn("_part", F.shiftright("_mid", 33))
          .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    res = s.join(F.broadcast(offsets.select("_part", "_off")), "_part", "inner")
    return res.withColumn(out, F.col("_off") + F.col("_pos")).drop("_mid", "_part", "_pos", "_off")


def note_cohort(cohort: DataFrame, notes: DataFrame | None = None,
                stopwords: Iterable[str] | DataFrame | None = None, min_words: int = MIN_WORDS, *,
                notes_in_ep: DataFrame | None = None, tokens: DataFrame | None = None, pid: str = "pid",
                text: str = "text", ts: str = "ts") -> dict[str, DataFrame]:
    """Notes inside the episode -> tokens -> subjects with >= ``min_words``
    kept words -> first note time. Returns the sets of the study:

      subjects  cohort rows of the kept subjects, with ``first_ts``
      notes     in-episode notes of the kept subjects
      first     (pid, first_ts)
      tokens    tokenized in-episode notes of *all* cohort subjects
      words     (pid, n_words) of the kept subjects
      stats     (pid, n_words, first_ts, n_notes) of the kept subjects
      wide      ``subjects`` with n_words and n_notes

    The in-episode notes carry their cohort row, so word count, first note
    time, note count and the cohort columns come from one aggregate over the
    tokenized notes (partial aggregation, one shuffle by subject) and the
    cohort is computed once. Pass ``notes_in_ep`` (made with
    ``carry=COHORT``) when the in-episode notes were already computed, and
    ``tokens`` when they were already tokenized (e.g. written once).
    """
    inep = notes_in_ep
    if inep is None and notes is not None:
        inep = notes_in_episode(cohort, notes, ts=ts, carry=COHORT)
    tok = tokens if tokens is not None else tokenize(inep, text, stopwords)
    # the cohort row is the same for all notes of a subject: as a grouping key
    # it needs no aggregate of its own (one over structs would sort the tokens)
    agg = (tok.select(pid, COHORT, ts, F.size("tokens").alias("_n")).groupBy(pid, COHORT)
           .agg(F.sum("_n").cast("bigint").alias("n_words"), F.min(ts).alias("first_ts"),
                F.count(F.lit(1)).alias("n_notes"))
           .filter(F.col("n_words") >= min_words))
    wide = agg.select(f"{COHORT}.*", "first_ts", "n_words", "n_notes")
    kept = (tok if inep is None else inep).join(agg.select(pid), pid, "left_semi").drop(COHORT)
    return {"subjects": wide.drop("n_words", "n_notes"), "notes": kept, "first": agg.select(pid, "first_ts"),
            "tokens": tok.drop(COHORT), "words": agg.select(pid, "n_words"),
            "stats": agg.select(pid, "n_words", "first_ts", "n_notes"), "wide": wide}
