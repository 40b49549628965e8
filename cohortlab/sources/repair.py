"""Repair of raw note exports, line by line and in parallel.

The study ran its exports through two line filters before loading them. Their
effect on a file of lines:

notes:
  1. a doubled quote ``""`` becomes a space;
  2. each pair of spaces becomes one space (one left-to-right pass);
  3. blank lines are dropped;
  4. a line with an odd number of quotes opens a record that goes on to the
     next such line; its lines are joined by one space, each but the last
     without a carriage return at its end; a record that the file does not
     close is dropped;
  5. commas inside quotes become ``;``.
lab results: steps 1 and 5.

Whether a line is inside a record depends on the quotes of all lines before
it, so a reader of records needs the whole file in one task. Here the file is
read as lines in as many splits as it has. Each split numbers its records twice
as it is read, for a start outside and for a start inside of a record (a running
count over the parity of the quotes alone: the text stays in the JVM and nothing
is shuffled). One row per split then tells which of the two holds and how many
records lie before it. A record of one line is complete; only the lines of
longer records meet by its number. What comes out is one record per row without
line breaks, which Spark's CSV functions parse.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_BLANK = r"^[ \t\n\x0B\f\r]*\z"


def _unquote(c: Column) -> Column:
    return F.replace(c, F.lit('""'), F.lit(" "))


def commas_in_quotes(c: Column) -> Column:
    """Step 5: ``;`` for the commas in every second part between quotes."""
    return F.array_join(F.transform(F.split(c, '"', -1), lambda x, i: F.when(i % 2 == 1, F.translate(x, ",", ";")).otherwise(x)), '"')


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line): lines end at a newline only; (block, at) is
    their order in the file. A file of any size is split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("before", "outside", "inside")]))
def _numbered(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Of each line in the order of its split: the parity of the quotes
    before it in the split, and how many records have begun with it, should the
    split begin outside or inside of one."""
    split, parity, counts = None, 0, [0, 0]
    for file, block, odd in batches:
        n = len(odd)
        out = np.zeros((n, 3), dtype=np.int64)
        new = np.flatnonzero((file.ne(file.shift()) | block.ne(block.shift())).to_numpy())
        for a, z in zip(new, [*new[1:], n], strict=True):
            if (file.iloc[a], block.iloc[a]) != split:
                split, parity, counts = (file.iloc[a], block.iloc[a]), 0, [0, 0]
            o = odd.iloc[a:z].to_numpy()
            before = (parity + np.cumsum(o) - o) % 2
            out[a:z, 0] = before
            for k in (0, 1):
                out[a:z, k + 1] = counts[k] + np.cumsum(before == k)
                counts[k] = int(out[z - 1, k + 1])
            parity = (parity + int(o.sum())) % 2
        yield pd.DataFrame(out, columns=["before", "outside", "inside"])


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line, odd, before, record) of the non-blank lines:
    ``before`` tells whether the line begins inside of a record. Writes the
    lines to the shared checkpoint folder, as they are read twice."""
    line = F.replace(_unquote(F.col("line")), F.lit("  "), F.lit(" "))
    odd = (F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))) % 2
    lines = read_lines(spark, path).withColumn("line", line).filter(~F.col("line").rlike(_BLANK)).withColumn("odd", odd)
    lines = materialize(lines.withColumn("n", _numbered("file", "block", "odd")).select("file", "block", "at", "line", "odd", "n.*"))
    # one row per split
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.max("outside").alias("outside"), F.max("inside").alias("inside"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("carry", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    own = F.when(F.col("carry") == 0, F.col("outside")).otherwise(F.col("inside"))
    blocks = blocks.withColumn("begun", own).withColumn("first", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
    number = F.col("first") + F.when(F.col("carry") == 0, F.col("outside")).otherwise(F.col("inside"))
    return (lines.join(F.broadcast(blocks.select("file", "block", "carry", "first")), ["file", "block"])
            .select("file", "block", "at", "line", "odd", ((F.col("before") + F.col("carry")) % 2).alias("before"), number.alias("record")))


def _records(lines: DataFrame) -> DataFrame:
    alone = (F.col("before") == 0) & (F.col("odd") == 0)
    # the value names its condition: what a caller computes of it must not be pushed down to lines that are no records
    single = lines.filter(alone).select("file", "record", F.when(alone, commas_in_quotes(F.col("line"))).alias("value"))
    parts = lines.filter(~alone).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("parts"), F.sum("odd").alias("odd"))
    texts = F.transform("parts", lambda x: x["line"])
    head = F.transform(F.slice(texts, F.lit(1), F.size(texts) - 1), lambda x: F.regexp_replace(x, "\r$", ""))
    joined = F.array_join(F.concat(head, F.slice(texts, -1, 1)), " ")
    return single.unionByName(parts.filter(F.col("odd") % 2 == 0).select("file", "record", commas_in_quotes(joined).alias("value")))


def repaired_notes(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, value): the records of a raw note export, repaired,
    numbered from 1 in each file. Only lines of records that span lines are shuffled."""
    return _records(_numbered_lines(spark, path))


def repaired_lab_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value): the lines of a raw lab-result export."""
    return read_lines(spark, path).select("file", "block", "at", commas_in_quotes(_unquote(F.col("line"))).alias("value"))


def read_repaired_notes(spark: SparkSession, path: str) -> DataFrame:
    """A raw note export as a table of text columns; the first record of each
    file is its header."""
    lines = _numbered_lines(spark, path)
    records, header = _records(lines), _records(lines.filter("record = 1")).select("value").first()
    if header is None:
        return spark.createDataFrame([], "value string").drop("value")
    names = [c.strip().strip('"') for c in header["value"].split(",")]
    schema = ", ".join(f"`{c}` STRING" for c in names)
    options = {"mode": "FAILFAST", "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return records.filter("record > 1").select(F.from_csv("value", schema, options).alias("r")).select("r.*")
