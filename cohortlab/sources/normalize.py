"""Column normalisers for quoted free text.

``sources.repair`` repairs a raw export. These expressions have the same
steps for a text column that was read some other way (from a table, or by the
CSV reader, after which the quotes around a field are gone and a doubled
quote is a single one):

full (note text):
  1. a doubled quote ``""`` becomes a space;
  2. each pair of spaces becomes one space (a single left-to-right pass, so
     four spaces become two);
  3. blank lines (only whitespace) are dropped;
  4. the remaining lines are joined with one space; a carriage return that
     ends a joined line is dropped (the last line keeps its own);
  5. commas become ``;``.
light (lab results): steps 1 and 5 only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import col_of

_BLANK_LINE = r"^[ \t\r\f\x0B]*\z"


def normalized_text(c: str | Column, join_lines: bool = True, light: bool = False) -> Column:
    out = F.replace(col_of(c), F.lit('""'), F.lit(" "))
    if not light:
        out = F.replace(out, F.lit("  "), F.lit(" "))
        lines = F.filter(F.split(out, "\n"), lambda l: ~l.rlike(_BLANK_LINE))
        if join_lines:
            out = F.regexp_replace(F.array_join(lines, "\n"), "\r?\n", " ")
        else:
            out = F.array_join(lines, "\n")
    return F.translate(out, ",", ";")


def normalize_quoted_text(df: DataFrame, col: str, *, join_lines: bool = True,
                          out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, normalized_text(col, join_lines=join_lines))


def normalize_quoted_text_light(df: DataFrame, col: str, *, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, normalized_text(col, light=True))
