"""Typed loaders: raw (CSV-like, all text) tables -> the library's schemas.

Each loader is one ``select`` over its input, so Catalyst prunes the columns
it does not need and pushes the note filters into the scan. Column names of
the input are parameters; outputs use the library's standard names:

  subjects  pid, is_male, dob, is_dead, dod, index_date, age
  episodes  pid, hadm, stay, in_ts, out_ts
  notes     pid, hadm, ts, category, description, text (+ ``keep`` columns)
  scores    pid, hadm, stay, score, <other score fields>
  flags     pid, hadm, flags (array<double>)

Missing values follow the study: an empty or NULL date becomes the
9000-01-01 sentinel, an empty score 0.0, an empty flag 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import EXCLUDED_CATEGORY, FLAG_NAMES, INDEX_TS, SCORE_FIELDS, TS_FORMAT
from ..functions.timecols import as_ts, blank_to_null, sentinel

_TEXT_TYPES = (T.StringType, T.VarcharType, T.CharType)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _TEXT_TYPES)


def _present(df: DataFrame, name: str) -> Column:
    """NULL-or-empty test that works for text and typed columns."""
    if _is_text(df, name):
        return blank_to_null(name).isNotNull()
    return F.col(name).isNotNull()


def _number(df: DataFrame, name: str, typ: str, default) -> Column:
    c = blank_to_null(name) if _is_text(df, name) else F.col(name)
    return F.coalesce(c.cast(typ), F.lit(default).cast(typ))


def load_subjects(df: DataFrame, *, pid: str = "SUBJECT_ID", gender: str = "GENDER",
                  dob: str = "DOB", dod: str = "DOD",
                  expire_flag: str = "EXPIRE_FLAG") -> DataFrame:
    """Gender ``m`` (any case) -> 1; the death date only counts when the
    expire flag is 1 and the date is present, otherwise the sentinel."""
    is_dead = (blank_to_null(expire_flag) if _is_text(df, expire_flag)
               else F.col(expire_flag)).cast("int")
    return df.select(
        F.col(pid).alias("pid"),
        F.when(F.lower(F.col(gender)) == "m", 1).otherwise(0).alias("is_male"),
        as_ts(df, dob).alias("dob"),
        is_dead.alias("is_dead"),
        F.when((is_dead == 1) & _present(df, dod), as_ts(df, dod))
         .otherwise(sentinel()).alias("dod"),
        F.to_timestamp(F.lit(INDEX_TS), TS_FORMAT).alias("index_date"),
        F.lit(0.0).alias("age"),
    )


def load_notes(df: DataFrame, *, pid: str = "SUBJECT_ID", hadm: str = "HADM_ID",
               chartdate: str = "CHARTDATE", charttime: str = "CHARTTIME",
               storetime: str = "STORETIME", category: str = "CATEGORY",
               description: str | None = "DESCRIPTION", text: str | None = "TEXT",
               exclude: str | None = EXCLUDED_CATEGORY,
               keep: Sequence[str] = ()) -> DataFrame:
    """Drop excluded categories and notes without an admission; the note time
    is the chart time, else the store time, else the chart date (a bare
    10-character date gets midnight)."""
    out = df
    if exclude:
        out = out.filter(~F.lower(F.coalesce(F.col(category), F.lit(""))).contains(exclude.lower()))
    out = out.filter(_present(df, hadm))
    ts = F.coalesce(as_ts(df, charttime, pad_dates=True), as_ts(df, storetime, pad_dates=True),
                    as_ts(df, chartdate, pad_dates=True))
    cols = [F.col(pid).alias("pid"), F.col(hadm).alias("hadm"), ts.alias("ts"),
            F.col(category).alias("category")]
    if description:
        cols.append(F.col(description).alias("description"))
    if text:
        cols.append(F.col(text).alias("text"))
    cols += [F.col(k) for k in keep]
    return out.select(*cols)


def load_flags(df: DataFrame, *, pid: str = "subject_id", hadm: str = "hadm_id",
               flag_cols: Sequence[str] = tuple(FLAG_NAMES)) -> DataFrame:
    """Pack the flag columns, in order, into one array<double>; empty -> 0.
    (An array keeps a multi-character flag from shifting the others.)"""
    flags = F.array(*[_number(df, c, "double", 0.0) for c in flag_cols])
    return df.select(F.col(pid).alias("pid"), F.col(hadm).alias("hadm"), flags.alias("flags"))


def flags_from_long(df: DataFrame, *, pid: str = "pid", hadm: str = "hadm",
                    flag_no: str = "flag_no", flag: str = "flag", n_flags: int = 30) -> DataFrame:
    """Long (one row per flag) -> wide flag columns ``f0..f{n-1}``.

    One aggregate with a column a flag: a pivot would group by (admission,
    flag number) first and send a row for every flag through a shuffle. Here
    partial aggregation makes one row an admission before the only shuffle.
    """
    value = [F.first(F.when(F.col(flag_no) == i, F.col(flag)), ignorenulls=True).alias(f"f{i}") for i in range(n_flags)]
    return df.groupBy(pid, hadm).agg(*value)


def load_episodes(df: DataFrame, *, pid: str = "SUBJECT_ID", hadm: str = "HADM_ID",
                  stay: str = "ICUSTAY_ID", intime: str = "INTIME",
                  outtime: str = "OUTTIME") -> DataFrame:
    return df.select(
        F.col(pid).alias("pid"), F.col(hadm).alias("hadm"), F.col(stay).alias("stay"),
        F.coalesce(as_ts(df, intime), sentinel()).alias("in_ts"),
        F.coalesce(as_ts(df, outtime), sentinel()).alias("out_ts"),
    )


def load_scores(df: DataFrame, *, pid: str = "subject_id", hadm: str = "hadm_id",
                stay: str = "icustay_id",
                score_cols: Sequence[str] = tuple(SCORE_FIELDS)) -> DataFrame:
    """All score fields as doubles, empty -> 0.0. The first field is the
    severity score and is also exposed as ``score``."""
    vals = [_number(df, c, "double", 0.0) for c in score_cols]
    cols = [F.col(pid).alias("pid"), F.col(hadm).alias("hadm"), F.col(stay).alias("stay"),
            vals[0].alias("score")]
    cols += [v.alias(c) for c, v in zip(score_cols[1:], vals[1:])]
    return df.select(*cols)


def table_counts(tables: Mapping[str, DataFrame], *, name_col: str = "table",
                 count_col: str = "n") -> DataFrame:
    """One row per table with its row count, as one DataFrame (one job)."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
               .select(F.lit(name).alias(name_col), F.col(count_col))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
