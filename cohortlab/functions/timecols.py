"""Timestamp column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SENTINEL_TS, TS_FORMAT


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel() -> Column:
    return F.to_timestamp(F.lit(SENTINEL_TS), TS_FORMAT)


def blank_to_null(c: str | Column) -> Column:
    """Treat NULL and empty/blank text alike (CSV reads an empty field as NULL)."""
    c = col_of(c)
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def parse_ts(c: str | Column, pad_dates: bool = False) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` parse; optionally a bare 10-character
    date gets `` 00:00:00`` appended first. ANSI mode makes bad text raise."""
    s = F.trim(col_of(c).cast("string"))
    if pad_dates:
        s = F.when(F.length(s) == 10, F.concat(s, F.lit(" 00:00:00"))).otherwise(s)
    return F.to_timestamp(s, TS_FORMAT)


def as_ts(df: DataFrame, name: str, pad_dates: bool = False) -> Column:
    """Timestamp view of column ``name``: parsed if text, cast if already a
    date/timestamp (parquet ``timestamp_ntz`` is read as UTC wall clock)."""
    dt = df.schema[name].dataType
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return parse_ts(blank_to_null(name), pad_dates)
    return F.col(name).cast("timestamp")


def millis(c: str | Column) -> Column:
    return F.unix_millis(col_of(c))


def ts_text(c: str | Column) -> Column:
    """Canonical text form used in query outputs (both engines agree on it)."""
    return F.date_format(col_of(c), TS_FORMAT)
