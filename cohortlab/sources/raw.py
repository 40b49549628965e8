"""The study's five raw CSV exports, loaded together.

A data folder holds the tables under their export names. Each is read as
text with a header (notes after the repair of their quoted multi-line fields)
and typed by its loader; ``raw_counts`` gives the row counts the study reported after loading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import ts_text
from . import fixtures as fx
from .csv_io import read_csv_table, write_csv_table
from .loaders import (load_episodes, load_flags, load_notes, load_scores, load_subjects,
                      table_counts)
from .repair import read_repaired_notes

# Export file names of the five tables (fixed values).
RAW_FILES = {"subjects": "PATIENTS.csv", "notes": "NOTEEVENTS.csv", "flags": "EHCOMORBIDITIES.csv",
             "episodes": "ICUSTAYS.csv", "scores": "SAPSII.csv"}
# Rows of a file of an exported table: a few dozen to a few hundred MB of notes for a task that reads it.
ROWS_PER_FILE = 50_000


def load_raw_tables(spark: SparkSession, data_dir: str, *, repair_notes: bool = True) -> dict[str, DataFrame]:
    """subjects, notes, flags, episodes, scores as typed DataFrames.

    Notes go through the repair of raw exports (see ``sources.repair``), which
    reads a file in parallel. ``repair_notes=False`` reads them with the
    multi-line CSV reader instead: texts as they are, one task per file."""
    d = data_dir.rstrip("/")

    def read(key: str, multi_line: bool = False) -> DataFrame:
        return read_csv_table(spark, f"{d}/{RAW_FILES[key]}", multi_line=multi_line)

    notes = (read_repaired_notes(spark, f"{d}/{RAW_FILES['notes']}") if repair_notes
             else read("notes", multi_line=True))
    return {"subjects": load_subjects(read("subjects")),
            "notes": load_notes(notes),
            "flags": load_flags(read("flags")),
            "episodes": load_episodes(read("episodes")),
            "scores": load_scores(read("scores"))}


def raw_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of subjects, episodes and scores (what the study printed)."""
    return table_counts({k: tables[k] for k in ("subjects", "episodes", "scores")})


def export_raw_csv(spark: SparkSession, sf_dir: str, out_dir: str,
                   only: tuple[str, ...] | None = None, compression: str = "none") -> dict[str, str]:
    """Write the fixture tables of ``sf_dir`` in the raw export layout (text
    columns, empty for missing values) under ``out_dir``; returns the paths.
    ``only`` limits the export to some of the five tables. Used to run the
    whole study from CSV files in tests and demos. With a ``compression`` the
    files are what an archive of the export holds (``.csv.gz``): every note has
    its whole text, which takes many times the tables' own room as plain text."""
    from ..constants import FLAG_NAMES, SCORE_FIELDS
    o = out_dir.rstrip("/")
    txt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tts = lambda c: F.coalesce(ts_text(c), F.lit(""))
    s = fx.subject(spark, sf_dir)
    tables = {
        "subjects": s.select(txt("pid").alias("SUBJECT_ID"), F.col("gender").alias("GENDER"),
                             tts("dob").alias("DOB"), tts("dod").alias("DOD"),
                             txt("expire_flag").alias("EXPIRE_FLAG")),
        "episodes": fx.episode(spark, sf_dir).select(
            txt("pid").alias("SUBJECT_ID"), txt("hadm").alias("HADM_ID"), txt("stay").alias("ICUSTAY_ID"),
            tts("in_ts").alias("INTIME"), tts("out_ts").alias("OUTTIME")),
        "notes": fx.note(spark, sf_dir, with_text=True).select(
            txt("pid").alias("SUBJECT_ID"), txt("hadm").alias("HADM_ID"),
            F.date_format("chartdate", "yyyy-MM-dd").alias("CHARTDATE"), tts("charttime").alias("CHARTTIME"),
            F.col("category").alias("CATEGORY"), F.lit("").alias("DESCRIPTION"), F.col("text").alias("TEXT"),
            tts("storetime").alias("STORETIME")),
        "scores": fx.score(spark, sf_dir).select(
            txt("pid").alias("subject_id"), txt("hadm").alias("hadm_id"), txt("stay").alias("icustay_id"),
            txt("score").alias(SCORE_FIELDS[0]), *[F.lit("").alias(c) for c in SCORE_FIELDS[1:]]),
        "flags": fx.flags_wide(spark, sf_dir).select(
            txt("pid").alias("subject_id"), txt("hadm").alias("hadm_id"),
            *[txt(f"f{i}").alias(n) for i, n in enumerate(FLAG_NAMES)]),
    }
    paths = {}
    for key, df in tables.items():
        if only is not None and key not in only:
            continue
        paths[key] = f"{o}/{RAW_FILES[key]}"
        write_csv_table(df, paths[key], compression=compression, rows_per_file=ROWS_PER_FILE)
    return paths
