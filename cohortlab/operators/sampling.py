"""Reproducible splits, folds, rebalancing and bag subtraction.

Every draw is a function of ``unit_hash(key, "seed|purpose")`` (see
``functions.hashing``), so a split is a filter: it repeats exactly, needs no
driver-side sample, and can be recomputed after an executor loss. Splits,
rebalancing and folds have purposes of their own, so draws with one seed are
independent: a negative's chance to stay in a rebalanced training set does not
depend on how it came into that set.

Exact splits take the ``m`` rows with the smallest (hash, key). The cut-off
is found with bounded histograms of the hash (at most ``HIST_BUCKETS`` rows
reach the driver per round) instead of a global sort or a single-task
window; the split itself is then the filter (hash, key) <= cut-off. They are
the default at every size; the approximate forms are used when asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TARGET_POSITIVE_SHARE, TRAIN_PROPORTION
from ..functions.hashing import HASH_BITS, hash_threshold, unit_hash

HIST_BITS = 16
HIST_BUCKETS = 1 << HIST_BITS
# The histogram is refined until its bucket holds at most this many rows. A
# bucket of one hash value holds one row, as keys are unique; a larger one
# means that they are not.
CANDIDATE_ROWS = 1024

SPLIT, REBALANCE, FOLD = "split", "rebalance", "fold"


def draw(key: str, seed: int, purpose: str) -> Column:
    """The key's hash for one purpose."""
    return unit_hash(key, f"{seed}|{purpose}")


def split_hash(df: DataFrame, p: float = TRAIN_PROPORTION, seed: int = 0, *,
               key: str = "pid") -> tuple[DataFrame, DataFrame]:
    """Approximate split: each row goes to the first part with probability p."""
    t = hash_threshold(p)
    h = draw(key, seed, SPLIT)
    return df.filter(h < F.lit(t)), df.filter(h >= F.lit(t))


def _histogram(keys: DataFrame, lo: int, width_bits: int, h: str = "_h"):
    """Counts of ``h`` in [lo, lo + 2^width_bits) by its top HIST_BITS bits:
    at most HIST_BUCKETS rows reach the driver."""
    shift = max(width_bits - HIST_BITS, 0)
    band = keys.filter((F.col(h) >= F.lit(lo)) & (F.col(h) < F.lit(lo + (1 << width_bits))))
    rows = (band.groupBy(F.shiftright(F.col(h) - F.lit(lo), shift).alias("b"))
            .agg(F.count(F.lit(1)).alias("n")).collect())
    return shift, sorted((r["b"], r["n"]) for r in rows)


def _kth_smallest(keys: DataFrame, key: str, m: int, hist, h: str = "_h"):
    """(hash, key) of the m-th smallest row (1-based) by (hash, key), given
    the first-round histogram over the whole hash range."""
    lo, need = 0, m
    shift, buckets = hist
    while True:
        acc = 0
        for b, n_b in buckets:
            if acc + n_b >= need:
                break
            acc += n_b
        need -= acc
        lo += b << shift
        width_bits = shift
        if n_b <= CANDIDATE_ROWS or shift == 0:
            if n_b > CANDIDATE_ROWS:
                raise ValueError(f"{key!r} is not unique: {n_b} rows share one hash value")
            cand = keys.filter((F.col(h) >= F.lit(lo)) & (F.col(h) < F.lit(lo + (1 << width_bits))))
            row = sorted((r[h], r[key]) for r in cand.select(h, key).collect())[need - 1]
            return row
        shift, buckets = _histogram(keys, lo, width_bits, h)


def smallest(df: DataFrame, m: int | None = None, seed: int = 0, *, key: str = "pid",
             p: float | None = None, purpose: str = SPLIT) -> Column:
    """Condition that holds for the m rows with the smallest (hash, key);
    with ``p`` instead of ``m``, m = int(count * p). ``key`` must be unique.

    Runs jobs: the search works on a persisted (key, hash) projection, one
    histogram over the whole hash range (which also gives the row count),
    then usually one bucket; the projection is released before returning.
    """
    h = draw(key, seed, purpose)
    keys = df.select(key).withColumn("_h", h).persist()
    try:
        hist = _histogram(keys, 0, HASH_BITS)
        n = sum(c for _, c in hist[1])
        if m is None:
            m = int(n * p)
        m = max(0, min(int(m), n))
        if m in (0, n):
            return F.lit(m > 0)
        hk, kk = _kth_smallest(keys, key, m, hist)
    finally:
        keys.unpersist()
    return (h < F.lit(hk)) | ((h == F.lit(hk)) & (F.col(key) <= F.lit(kk)))


def take_smallest(df: DataFrame, m: int | None = None, seed: int = 0, *, key: str = "pid",
                  p: float | None = None, purpose: str = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(the m rows with the smallest (hash, key), the rest): two filters on
    ``df`` (see ``smallest``)."""
    inside = smallest(df, m, seed, key=key, p=p, purpose=purpose)
    return df.filter(inside), df.filter(~inside)


def split_exact(df: DataFrame, p: float = TRAIN_PROPORTION, seed: int = 0, *,
                key: str = "pid") -> tuple[DataFrame, DataFrame]:
    """Exact split: int(count * p) rows for the first part, the rest for the
    second. (The proportion is honoured; the study hard-coded 0.7 here.)"""
    return take_smallest(df, None, seed, key=key, p=p)


def split_subjects(df: DataFrame, p: float = TRAIN_PROPORTION, seed: int = 0, *,
                   key: str = "pid", exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Exact split, or the hash split if ``exact`` is False."""
    return split_exact(df, p, seed, key=key) if exact else split_hash(df, p, seed, key=key)


def label_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """(n, positives) as one row."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.coalesce(F.sum(F.col(label)), F.lit(0)).cast("bigint").alias("positives"))


def rebalance_negatives(df: DataFrame, label: str = "label", *, key: str = "pid",
                        target: float = TARGET_POSITIVE_SHARE, exact: bool = True,
                        seed: int = 0) -> DataFrame:
    """Subsample negatives so positives make up ``target`` of the rows.

    Unchanged when positives already make up at least ``target``. Exact:
    int(pos / target * (1 - target)) negatives; approximate: each negative
    kept with probability (pos / target * (1 - target)) / negatives. Either
    way the result is one filter over ``df``; the counts run first.
    """
    row = label_balance(df, label).first()
    n, pos = row["n"], row["positives"]
    if n == 0 or pos / n >= target:
        return df
    wanted = pos / target * (1 - target)
    negative = F.col(label) == 0
    if exact:
        kept = smallest(df.filter(negative), int(wanted), seed, key=key, purpose=REBALANCE)
    else:
        kept = draw(key, seed, REBALANCE) < F.lit(hash_threshold(wanted / (n - pos)))
    return df.filter((F.col(label) == 1) | (negative & kept))


def fold_assignment(df: DataFrame, k: int = 5, seed: int = 0, *, key: str = "pid",
                    out: str = "fold") -> DataFrame:
    """Fold number in [0, k) per row, equal-probability folds."""
    return df.withColumn(out, F.pmod(draw(key, seed, FOLD), F.lit(int(k))).cast("int"))


def subtract_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` (with their multiplicity) whose value does not occur
    in ``right``; NULLs compare equal. Unlike EXCEPT it keeps duplicates,
    unlike EXCEPT ALL it removes every copy of a matched value."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in left.columns]).distinct()
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in left.columns]
    return left.join(r, cond, "left_anti")
