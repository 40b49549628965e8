"""The queries ``opN_<name>`` and ``pipeline``: each operator with production
parameters on its whole table, and the DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import SQL as DECONTAMINATE_SQL
from .decontaminate import decontaminate
from .embedding_dedup import SQL as EMBEDDING_SQL
from .embedding_dedup import embedding_dedup
from .jaccard_join import SQL as JACCARD_SQL
from .jaccard_join import jaccard_report
from .language_id import language_id
from .line_dedup import SQL as LINE_DEDUP_SQL
from .line_dedup import line_dedup_report
from .packing import best_fit_pack, text_cluster
from .resampling import SQL as RESAMPLING_SQL
from .resampling import importance_resample
from .secrets import secret_scan
from .structure_repair import SQL as STRUCTURE_SQL
from .structure_repair import structure_report
from .substring_dedup import passage_report
from .suffix_dedup import SQL as SUFFIX_SQL
from .suffix_dedup import removed_report
from .token_counts import token_counts
from .transcripts import format_conversations


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_report(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), limit=512)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles are learned on four fifths of the conversations (by a hash of
    the id) and recovered for all."""
    return format_conversations(table(spark, sf_dir, "conversations"),
                                training=F.coalesce(F.crc32(F.col("conv").cast("binary")) % 5 != 0, F.lit(False)))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes in UTF-8 bytes; copies of one text are a duplicate cluster."""
    return best_fit_pack(table(spark, sf_dir, "documents"), size=F.octet_length("text"), source=F.col("source"),
                         cluster=text_cluster())


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_report(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_report(table(spark, sf_dir, "documents"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of the damaged conversations."""
    return structure_report(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_decontaminate": op6_decontaminate,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_structure_repair": op13_structure_repair,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op6_decontaminate": DECONTAMINATE_SQL,
    "op8_embedding_near_dedup": EMBEDDING_SQL,
    "op10_ngram_jaccard_join": JACCARD_SQL,
    "op11_importance_resampling": RESAMPLING_SQL,
    "op12_suffix_dedup": SUFFIX_SQL,
    "op13_structure_repair": STRUCTURE_SQL,
}
