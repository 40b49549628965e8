"""Temporal cohort operators.

Inputs use the loader schemas (see ``sources.loaders``). The cohort is one
wide DataFrame, one row per subject: the subject's columns plus its latest
episode (pid, hadm, stay, in_ts, out_ts, is_male, dob, is_dead, dod,
index_date, age). The study's separate patient and stay sets are
projections of it (``cohort_subjects`` / ``cohort_episodes``).

Scale notes
- ``latest_episode`` is a max over a struct per subject: partial
  aggregation runs before the shuffle, so a subject with a huge number of
  episodes costs one row per map task, not one hot reduce task.
- Interval conditions live in the join condition next to the equi-keys,
  so they are evaluated inside the join, never as a cross product.
- ``hours <= 0`` returns the inputs unchanged (no first-note join at all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (AGE_MASK_AT, AGE_MASK_TO, DAYS_1Y, DAYS_30, MIN_AGE, MS_DAY, MS_HOUR,
                         MS_YEAR, SENTINEL_MS)
from ..functions.timecols import millis
from ..session import materialize

SUBJECT_COLS = ["pid", "is_male", "dob", "is_dead", "dod", "index_date", "age"]
EPISODE_COLS = ["pid", "hadm", "stay", "in_ts", "out_ts"]


def latest_episode(episodes: DataFrame, *, pid: str = "pid", out_ts: str = "out_ts",
                   stay: str = "stay") -> DataFrame:
    """Each subject's episode with the latest out time; equal out times are
    broken by the larger stay id, so the result does not depend on order."""
    rest = [c for c in episodes.columns if c not in (pid, out_ts, stay)]
    best = episodes.groupBy(pid).agg(
        F.max(F.struct(F.col(out_ts), F.col(stay), *[F.col(c) for c in rest])).alias("_best"))
    return best.select(*[F.col(pid) if c == pid else F.col(f"_best.{c}").alias(c)
                         for c in episodes.columns])


def age_years(in_ts: str | Column = "in_ts", dob: str | Column = "dob") -> Column:
    """(in - dob) in millis / 365-day years, as a double."""
    return (millis(in_ts) - millis(dob)).cast("double") / F.lit(float(MS_YEAR))


def build_cohort(subjects: DataFrame, episodes: DataFrame, *, min_age: float = MIN_AGE,
                 cap_at: float = AGE_MASK_AT, cap_to: float = AGE_MASK_TO,
                 pid: str = "pid") -> DataFrame:
    """Adult cohort: latest episode per subject, joined to the subject, age at
    admission (masked ages >= ``cap_at`` become ``cap_to``), age >= ``min_age``."""
    latest = latest_episode(episodes, pid=pid)
    subj = subjects.drop("age")
    joined = latest.join(subj, pid, "inner")
    age = age_years()
    joined = joined.withColumn("age", F.when(age >= cap_at, F.lit(float(cap_to))).otherwise(age))
    return joined.filter(F.col("age") >= min_age)


def cohort_subjects(cohort: DataFrame) -> DataFrame:
    return cohort.select(*[c for c in SUBJECT_COLS if c in cohort.columns])


def cohort_episodes(cohort: DataFrame) -> DataFrame:
    return cohort.select(*[c for c in EPISODE_COLS if c in cohort.columns])


def join_subject_episode(subjects: DataFrame, episodes: DataFrame, *, pid: str = "pid") -> DataFrame:
    """Every episode with its subject (inner equi-join on the subject id)."""
    return episodes.join(subjects, pid, "inner")


def notes_in_episode(cohort: DataFrame, notes: DataFrame, *, keys: Sequence[str] = ("pid", "hadm"),
                     ts: str = "ts", carry: str | None = None) -> DataFrame:
    """Notes of the cohort admission written inside the episode:
    in <= t < out and t < death. Returns the note columns; with ``carry``
    also the cohort row as a struct of that name, so that what follows does
    not need to join the cohort again."""
    c = cohort.select(*[F.col(k).alias(f"_c_{k}") for k in keys],
                      F.col("in_ts").alias("_c_in"), F.col("out_ts").alias("_c_out"),
                      F.col("dod").alias("_c_dod"),
                      *([F.struct(*cohort.columns).alias(carry)] if carry else []))
    cond = [notes[k] == c[f"_c_{k}"] for k in keys]
    t = notes[ts]
    cond += [c["_c_in"] <= t, t < c["_c_out"], t < c["_c_dod"]]
    return notes.join(c, cond, "inner").select(*[notes[x] for x in notes.columns], *([c[carry]] if carry else []))


def notes_in_episode_binned(cohort: DataFrame, notes: DataFrame, *, keys: Sequence[str] = ("pid", "hadm"), ts: str = "ts",
                            bin_hours: int = 24, hot_rows: int = 1_000_000, carry: str | None = None) -> DataFrame:
    """``notes_in_episode`` where an admission may have a third of all notes.

    The notes of an admission with more than ``hot_rows`` of them are dealt by
    time bins; its episode is entered in each bin that it covers and that lies
    among the notes' times. All other notes and episodes are in one bin. The exact
    bounds stay in the join condition, so the rows are the same."""
    width = int(bin_hours) * MS_HOUR
    counts = notes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(millis(ts)).alias("_from"), F.max(millis(ts)).alias("_to"))
    # at most rows / hot_rows keys
    hot = materialize(counts.filter(F.col("_n") > hot_rows).select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_from", "_to"))

    def is_hot(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), [df[k] == hot[f"_h_{k}"] for k in keys], "left")

    def place(ms: Column) -> Column:
        return F.floor(ms / F.lit(width))

    n = is_hot(notes).withColumn("_bin", F.when(F.col("_from").isNotNull(), place(millis(ts))).otherwise(F.lit(0)))
    n = n.select(*[notes[x] for x in notes.columns], "_bin")
    c = is_hot(cohort)
    first, last = F.greatest(millis("in_ts"), F.col("_from")), F.least(millis("out_ts"), millis("dod"), F.col("_to"))
    bins = F.when(F.col("_from").isNull(), F.array(F.lit(0).cast("bigint"))) \
        .when(first <= last, F.sequence(place(first), place(last))).otherwise(F.array().cast("array<bigint>"))
    c = c.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("in_ts").alias("_c_in"), F.col("out_ts").alias("_c_out"),
                 F.col("dod").alias("_c_dod"), F.explode(bins).alias("_c_bin"),
                 *([F.struct(*[cohort[x] for x in cohort.columns]).alias(carry)] if carry else []))
    t = F.col(ts)
    cond = [n[k] == c[f"_c_{k}"] for k in keys] + [n["_bin"] == c["_c_bin"], c["_c_in"] <= t, t < c["_c_out"], t < c["_c_dod"]]
    return n.join(c, cond, "inner").select(*[n[x] for x in notes.columns], *([c[carry]] if carry else []))


def restrict_to_subjects(df: DataFrame, subjects: DataFrame, *, pid: str = "pid") -> DataFrame:
    """Rows of ``df`` whose subject is in ``subjects`` (left semi-join: the
    right side's columns are not carried and duplicated subject rows on the
    right cannot multiply ``df``)."""
    return df.join(subjects.select(pid), pid, "left_semi")


def first_event(events: DataFrame, *, pid: str = "pid", ts: str = "ts",
                out: str = "first_ts") -> DataFrame:
    """Earliest event time per subject (partial min before the shuffle)."""
    return events.groupBy(pid).agg(F.min(ts).alias(out))


def with_first_event(cohort: DataFrame, first: DataFrame, *, pid: str = "pid") -> DataFrame:
    """Cohort rows of subjects that have a first event, with ``first_ts``."""
    return cohort.join(first, pid, "inner")


def _bound_ms(first_ts: str, hours: int) -> Column:
    return millis(first_ts) + F.lit(int(hours) * MS_HOUR)


def present_after_hours(cohort: DataFrame, first: DataFrame, hours: int, *,
                        pid: str = "pid", first_ts: str = "first_ts") -> DataFrame:
    """Subjects still in their episode and alive ``hours`` after their first
    note: out > first + h and death > first + h (both strict). Subjects
    without a first note drop out for h > 0; h <= 0 returns ``cohort``."""
    if hours <= 0:
        return cohort
    f = first.select(pid, first_ts)
    b = _bound_ms(first_ts, hours)
    kept = cohort.join(f, pid, "inner").filter((millis("out_ts") > b) & (millis("dod") > b))
    return kept.select(*cohort.columns)


def events_within_hours(events: DataFrame, first: DataFrame, hours: int, *,
                        survivors: DataFrame | None = None, pid: str = "pid",
                        ts: str = "ts", first_ts: str = "first_ts") -> DataFrame:
    """Events before first + h of subjects with a first note; with
    ``survivors`` only those subjects' events. h <= 0 returns ``events``."""
    if hours <= 0:
        return events
    f = first.select(pid, first_ts)
    if survivors is not None:
        f = f.join(survivors.select(pid), pid, "left_semi")
    kept = events.join(f, pid, "inner").filter(millis(ts) < _bound_ms(first_ts, hours))
    return kept.select(*events.columns)


LABEL_KINDS = ("in_episode", "30d", "1y")


def label_expr(kind: str, *, sentinel_is_missing: bool = False) -> Column:
    """Mortality label from in/out/death millis.

    in_episode: in <= death <= out. 30d / 1y: death after out and the whole
    days (truncated) of death - out at most 30 / 365. With the default, a
    missing out time and a living subject share the sentinel, which counts
    as an in-episode death, as in the study; ``sentinel_is_missing`` treats
    the sentinel death date as no death instead.
    """
    d, o, i = millis("dod"), millis("out_ts"), millis("in_ts")
    if kind == "in_episode":
        cond = (d >= i) & (d <= o)
    elif kind in ("30d", "1y"):
        days = DAYS_30 if kind == "30d" else DAYS_1Y
        cond = (d > o) & (F.floor((d - o) / F.lit(MS_DAY)) <= days)
    else:
        raise ValueError(f"kind must be one of {LABEL_KINDS}, got {kind!r}")
    if sentinel_is_missing:
        cond = cond & (d != F.lit(SENTINEL_MS))
    return F.when(cond, 1).otherwise(0)


def label_events(cohort: DataFrame, kind: str = "in_episode", *, pid: str = "pid",
                 out: str = "label", sentinel_is_missing: bool = False) -> DataFrame:
    """(pid, label) for every cohort row."""
    return cohort.select(pid, label_expr(kind, sentinel_is_missing=sentinel_is_missing).alias(out))


def label_all(cohort: DataFrame, *, pid: str = "pid", sentinel_is_missing: bool = False) -> DataFrame:
    """The three labels as three columns in one pass."""
    return cohort.select(pid, *[
        label_expr(k, sentinel_is_missing=sentinel_is_missing).alias(f"label_{k}")
        for k in LABEL_KINDS])
