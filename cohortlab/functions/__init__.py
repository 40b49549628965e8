"""Column-level building blocks (pure expressions, no actions)."""

from .hashing import hash_threshold, unit_hash
from .textcols import clean_text, raw_tokens, word_tokens
from .timecols import as_ts, blank_to_null, millis, parse_ts, sentinel, ts_text

__all__ = ["as_ts", "blank_to_null", "clean_text", "hash_threshold", "millis", "parse_ts",
           "raw_tokens", "sentinel", "ts_text", "unit_hash", "word_tokens"]
