"""Text column expressions for note cleaning and tokenization.

One expression tree per document, no Python UDF: regex passes run in the JVM
over whole texts, and token filters are higher-order functions on the array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (DIGIT_WORD, LONE_CHAR, MIN_TOKEN_CHARS_EXCLUSIVE,
                         SPECIAL_CHARS_CLASS, WHITESPACE_CHAR)
from .timecols import col_of

# A token is kept when every UTF-16 unit is a letter. Letters outside the
# Basic Multilingual Plane are stored as surrogate pairs, which are not
# letters unit by unit, so the class excludes them explicitly. \z, not $,
# so a trailing line separator cannot slip through.
LETTERS_ONLY = r"^[\p{L}&&[^\x{10000}-\x{10FFFF}]]+\z"


def clean_text(c: str | Column, lone_chars: bool = True) -> Column:
    """The four regex passes of the note cleaner, in order.

    Passes 3-4 (lone letters between blanks) cannot change the token list,
    because one-letter tokens fail the length test anyway; ``tokens`` skips
    them, ``clean_text`` keeps them for the cleaned text itself.
    """
    out = F.regexp_replace(col_of(c), SPECIAL_CHARS_CLASS, " ")
    out = F.regexp_replace(out, DIGIT_WORD, " ")
    if lone_chars:
        out = F.regexp_replace(out, LONE_CHAR, " ")
        out = F.regexp_replace(out, LONE_CHAR, " ")
    return out


def raw_tokens(c: str | Column) -> Column:
    """clean -> lower -> split on single whitespace characters."""
    return F.split(F.lower(clean_text(c, lone_chars=False)), WHITESPACE_CHAR)


def keep_token(t: Column) -> Column:
    return (F.length(t) > MIN_TOKEN_CHARS_EXCLUSIVE) & t.rlike(LETTERS_ONLY)


# A word with a digit, as after the special characters (the underscore is one): the
# lookbehind and the possessive runs look at no character twice.
DIGIT_RUN = r"(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]*+"
SEPARATOR = f"[{SPECIAL_CHARS_CLASS[1:-1]}{WHITESPACE_CHAR[1:-1]}]"


def word_tokens(c: str | Column) -> Column:
    """Tokens longer than 3 characters made of letters only (stop words not
    yet removed; see ``operators.text.tokenize``): ``raw_tokens`` filtered by
    ``keep_token``, with fewer passes over the text.

    Special characters become separators of the split. Only a capital sigma has
    a small form that depends on the characters around it, so they are replaced before
    it is lowered. What is beside a word with a digit is a token only if it has
    letters beyond ASCII, so texts of ASCII alone keep such words until ``keep_token``."""
    x = col_of(c)
    spaced = F.when(F.contains(x, F.lit("Σ")), F.regexp_replace(x, SPECIAL_CHARS_CLASS, " ")).otherwise(x)
    ascii_only = F.octet_length(x) == F.char_length(x)
    low = F.lower(F.when(ascii_only, x).otherwise(F.regexp_replace(spaced, DIGIT_RUN, " ")))
    return F.filter(F.split(low, SEPARATOR), keep_token)
