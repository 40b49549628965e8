"""Study tables stored by subject.

Subjects, episodes, notes, scores and flags are written once, in buckets by
subject and sorted within them. Joins and aggregates by subject then read
matching buckets and shuffle nothing. Spark takes the buckets of a table for a
join by (subject, admission) only if the other keys are no join keys of their own,
so ``same`` states them as a condition beside the subject.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def save_bucketed(tables: Mapping[str, DataFrame], *, key: str = "pid", buckets: int | None = None,
                  prefix: str | None = None, path: str | None = None) -> dict[str, str]:
    """{name: catalog table}: the tables written in ``buckets`` by ``key``,
    below ``path`` (a fresh folder of the shared checkpoint folder by default)."""
    names = {}
    for name, df in tables.items():
        spark = df.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        names[name] = f"{prefix or 'study'}_{name}_{uuid.uuid4().hex[:8]}"
        folder = f"{path.rstrip('/')}/{name}" if path else scratch_path(spark, names[name])
        # one file a bucket, so that the sort order within it is known
        (df.repartition(n, key).write.format("parquet").option("path", folder).bucketBy(n, key).sortBy(key).saveAsTable(names[name]))
    return names


def load_bucketed(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    return {k: spark.table(v) for k, v in names.items()}


def same(left: Column, right: Column) -> Column:
    """Equality as a condition that is not taken for a join key."""
    return F.array_contains(F.array(right), left)


def baseline_features_bucketed(subjects: DataFrame, episodes: DataFrame, scores: DataFrame, *, pid: str = "pid") -> DataFrame:
    """``baseline_features_wide`` of bucketed tables: no row is shuffled."""
    from ..constants import MAX_AGE, MAX_SCORE
    from ..operators.cohort import build_cohort
    c = build_cohort(subjects, episodes, pid=pid)
    s = scores.select(F.col(pid).alias("_pid"), F.col("hadm").alias("_hadm"), F.col("stay").alias("_stay"), "score")
    j = c.join(s, (c[pid] == s["_pid"]) & same(c["hadm"], s["_hadm"]) & same(c["stay"], s["_stay"]))
    return j.select(pid, F.array(F.col("age") / F.lit(MAX_AGE), F.col("is_male").cast("double"), F.col("score") / F.lit(MAX_SCORE))
                    .alias("features"))


def notes_in_episode_bucketed(subjects: DataFrame, episodes: DataFrame, notes: DataFrame, *, pid: str = "pid", ts: str = "ts") -> DataFrame:
    """``notes_in_episode`` of bucketed tables: no row is shuffled."""
    from ..operators.cohort import build_cohort
    c = build_cohort(subjects, episodes, pid=pid).select(F.col(pid).alias("_pid"), F.col("hadm").alias("_hadm"), "in_ts", "out_ts", "dod")
    t = notes[ts]
    return notes.join(c, (notes[pid] == c["_pid"]) & same(notes["hadm"], c["_hadm"]) & (c["in_ts"] <= t) & (t < c["out_ts"])
                      & (t < c["dod"])).select(*[notes[x] for x in notes.columns])
