"""Bindings of the study's input tables to the driver's parquet tables.

The test tables carry no clinical data, so subjects, episodes, notes,
scores and flags are derived from ``customer``, ``orders``, ``lineitem`` and
``documents`` by fixed rules (the same rules the DuckDB oracle strings use,
see ``plans.oracle``). Every view reads its whole source table.

Notes are built key-first: ``note(..., with_text=False)`` carries ``doc_id``
instead of the text, and ``attach_text`` fetches texts later, after the
cohort joins have cut the notes down, so long texts are shuffled only for
notes that survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SCORE_FIELDS
from ..session import use_utc

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting that turns ``spread_scan`` on.
SPREAD_SCANS = "spark.cohortlab.spreadScans"


def spread_scan(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the session has
    cores, before CPU-heavy per-row work. For tests on one small file: off
    unless the session sets ``spark.cohortlab.spreadScans`` to true, as it
    shuffles the whole table."""
    spark = df.sparkSession
    if spark.conf.get(SPREAD_SCANS, "false") != "true":
        return df
    n = min_partitions or spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def _days(n) -> F.Column:
    return F.make_dt_interval(n.cast("int"))


def _ts(c: str) -> F.Column:
    return F.col(c).cast("timestamp")


def subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("pid"),
        F.when(F.col("c_mktsegment") == "BUILDING", "m").otherwise("F").alias("gender"),
        F.when(k % 50 == 1, F.to_timestamp(F.lit("1690-01-01 00:00:00")))
         .otherwise(F.to_timestamp(F.lit("1920-01-01 00:00:00")) + _days((k * 977) % 29000))
         .alias("dob"),
        F.when(k % 3 == 0, 1).otherwise(0).alias("expire_flag"),
        F.when(k % 3 == 0, F.to_timestamp(F.lit("2001-01-01 00:00:00")) + _days((k * 37) % 700))
         .alias("dod"),
    )


def episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("pid"), k.alias("hadm"), k.alias("stay"),
        _ts("o_orderdate").alias("in_ts"),
        F.when(k % 300 == 7, F.lit(None).cast("timestamp"))
         .otherwise(_ts("o_orderdate") + _days(200 + k % 400)).alias("out_ts"),
    )


def note(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """Raw notes: pid, hadm, charttime, storetime, chartdate, category,
    note_id, doc_id (+ text). ``note_id`` = orderkey * 8 + line number is
    unique per note."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    docs = table(spark, sf_dir, "documents")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    ln = F.col("l_linenumber")
    ship = _ts("l_shipdate")
    hour = lambda h: F.make_dt_interval(F.lit(0), F.lit(h))
    notes = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").alias("pid"),
        F.when(ln == 7, F.lit(None).cast("bigint")).otherwise(F.col("l_orderkey")).alias("hadm"),
        F.when(ln % 3 == 0, F.lit(None).cast("timestamp")).otherwise(ship + hour(9)).alias("charttime"),
        F.when(ln % 2 == 0, F.lit(None).cast("timestamp")).otherwise(ship + hour(12)).alias("storetime"),
        ship.alias("chartdate"),
        F.when(F.col("l_returnflag") == "R", "Discharge summary").otherwise("Nursing").alias("category"),
        (F.col("l_orderkey") * 8 + ln).alias("note_id"),
        ((F.col("l_orderkey") * 7 + ln) % n_docs).alias("doc_id"),
    )
    return attach_text(spark, sf_dir, notes) if with_text else notes


def attach_text(spark: SparkSession, sf_dir: str, notes: DataFrame,
                key: str = "doc_id", out: str = "text") -> DataFrame:
    docs = spread_scan(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias(key),
                                                                 F.col("text").alias(out))
    return notes.join(docs, key, "inner")


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("pid"), k.alias("hadm"), k.alias("stay"),
        F.when(k % 13 == 0, F.lit(None).cast("double"))
         .otherwise(((k * 31) % 164).cast("double")).alias("score"),
    )


def score_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All score fields of the export, with missing values in each."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rest = [F.when(k % (11 + i) == 0, F.lit(None).cast("double"))
             .otherwise(((k * (7 + i)) % (20 + i)).cast("double")).alias(c) for i, c in enumerate(SCORE_FIELDS[1:])]
    return score(spark, sf_dir).select("pid", "hadm", "stay", F.col("score").alias(SCORE_FIELDS[0])).join(
        o.select(k.alias("stay"), *rest), "stay")


def _flag_rule(h: F.Column, i: F.Column) -> F.Column:
    return (F.when(h % 11 == 0, F.lit(None).cast("int"))
             .when((h * (i + 3) + i) % 7 == 0, 1).otherwise(0))


def flags_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flags as ``flags`` in the export's wide layout (pid, hadm,
    f0..f29), computed row by row from orders: no explode, no pivot."""
    o = table(spark, sf_dir, "orders")
    h = F.col("o_orderkey")
    return o.select(F.col("o_custkey").alias("pid"), h.alias("hadm"),
                    *[_flag_rule(h, F.lit(i)).alias(f"f{i}") for i in range(30)])


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form: pid, hadm, flag_no 0..29, flag (NULL for some admissions).
    Thirty rows per order come from exploding a fixed sequence."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    long = o.select(F.col("o_custkey").alias("pid"), k.alias("hadm"),
                    F.explode(F.sequence(F.lit(0), F.lit(29))).alias("flag_no"))
    return long.withColumn("flag", _flag_rule(F.col("hadm"), F.col("flag_no")))
