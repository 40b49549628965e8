"""Written intermediate tables and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows of a side that may be broadcast; the callers' rows have a few dozen
#: bytes, so this is a few dozen MB at most.
BROADCAST_ROWS = 200_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: computed
    once, read by several branches, and not lost with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most
    ``rows`` rows; otherwise unchanged, and the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
