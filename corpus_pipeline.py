"""The training-data pipeline: five stages over ``documents``.

1. language ID: documents whose language cannot be told go;
2. line dedup: lines that an earlier line equals or nearly equals are cut;
   a document of which nothing is left goes;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. benchmark decontamination: contaminated documents go;
5. best-fit packing of what is left into bins.

Each stage works on all rows its predecessor kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.decontaminate import decontaminate
from cohortlab.llm.jaccard_join import without_near_copies
from cohortlab.llm.language_id import UNDETERMINED, fit_language_model, identify_language, remainder
from cohortlab.llm.line_dedup import line_dedup
from cohortlab.llm.packing import best_fit_pack, text_cluster
from cohortlab.llm.scratch import written

#: Share of a document's n-grams that must be of its language. A clean
#: document has 0.6 or more even if a third of it is foreign or code.
MIN_LANGUAGE_SCORE = 0.25


def _whole(docs: DataFrame) -> DataFrame:
    """The rows as one struct next to the texts that a stage reads, so that
    what it adds can have any name."""
    return docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("__row"), F.col("text").alias("__t"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that have a language (learned on the rows that the
    operator's contract allows)."""
    model = fit_language_model(docs, F.coalesce(remainder("doc_id") != 0, F.lit(False)))
    found = identify_language(_whole(docs), model, keep=["__row"], text="__t")
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select("__row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines; n_chars follows the text. A document that lost a
    line and has no word left goes, others stay."""
    cut = line_dedup(docs)
    empty = F.col("__ld_dropped").isNotNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    n = F.when(F.col("__ld_dropped").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("bigint")
    return cut.filter(~empty).withColumn("n_chars", n).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one of the smallest id (null
    last), also where several rows have that id or no row has one."""
    return without_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    flagged = decontaminate(_whole(docs), items, keep=["__row"], text="__t")
    return flagged.filter(~F.col("contaminated")).select("__row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, bin_id, start, n (bytes)."""
    return best_fit_pack(docs, size=F.octet_length("text"), source=F.col("source"), cluster=text_cluster())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("best_fit_packing", packing_stage),
]

#: The language model, the packing and the near-copy components are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result but the last is
    written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
