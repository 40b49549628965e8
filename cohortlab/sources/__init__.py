"""Readers, typed loaders, text normalisers and sinks."""

from .csv_io import read_csv_table, read_word_list, table_name_from_path, write_csv_table, write_text
from .loaders import (flags_from_long, load_episodes, load_flags, load_notes, load_scores,
                      load_subjects, table_counts)
from .normalize import normalize_quoted_text, normalize_quoted_text_light, normalized_text
from .raw import export_raw_csv, load_raw_tables, raw_counts

__all__ = ["export_raw_csv", "flags_from_long", "load_episodes", "load_flags", "load_notes",
           "load_raw_tables", "load_scores", "load_subjects", "normalize_quoted_text",
           "normalize_quoted_text_light", "normalized_text", "raw_counts", "read_csv_table",
           "read_word_list", "table_counts", "table_name_from_path", "write_csv_table",
           "write_text"]
