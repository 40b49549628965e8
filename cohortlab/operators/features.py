"""Feature construction.

Long form: (pid, feature, value). Wide form: (pid, features array<double>).
Labelled points: (pid, label double, features vector) for Spark ML.

Baseline features are age / 89, sex and severity score / 163 of the cohort
episode; derived features append the 30 comorbidity flags of the cohort
admission. The long form is built in one pass (no union of three scans), and
the sparse path groups a patient's own (index, value) pairs only, so a point
costs its number of features, not the size of the dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MAX_AGE, MAX_SCORE
from ..session import materialize, scratch_path
from .cohort import present_after_hours

BASELINE_NAMES = ("patient_age", "patient_sex", "saps_score")
# Entries of a dictionary that may be broadcast (a name and a number each).
BROADCAST_NAMES = 1_000_000


def _baseline_values(cohort: DataFrame, scores: DataFrame, first: DataFrame | None,
                     hours: int, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    c = present_after_hours(cohort, first, hours) if (first is not None and hours > 0) else cohort
    s = scores.select(*keys, F.col("score"))
    j = c.select(*keys, "age", "is_male", *keep).join(s, list(keys), "inner")
    return j.select(
        "pid", *keep,
        (F.col("age") / F.lit(MAX_AGE)).alias("_age"),
        F.col("is_male").cast("double").alias("_sex"),
        (F.col("score") / F.lit(MAX_SCORE)).alias("_score"),
    )


def baseline_features_long(cohort: DataFrame, scores: DataFrame, first: DataFrame | None = None,
                           hours: int = 0, *, keys: Sequence[str] = ("pid", "hadm", "stay"),
                           feature: str = "feature", value: str = "value") -> DataFrame:
    """(pid, feature, value) for age, sex and score; with ``first`` and
    ``hours`` > 0 only subjects still present ``hours`` after the first note."""
    v = _baseline_values(cohort, scores, first, hours, keys)
    return v.select("pid", F.inline(F.array(*[
        F.struct(F.lit(n).alias(feature), F.col(c).alias(value))
        for n, c in zip(BASELINE_NAMES, ("_age", "_sex", "_score"))])))


def baseline_features_wide(cohort: DataFrame, scores: DataFrame, first: DataFrame | None = None,
                           hours: int = 0, *, keys: Sequence[str] = ("pid", "hadm", "stay"),
                           out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """(pid, array of age, sex and score); ``keep`` names cohort columns to
    carry along."""
    v = _baseline_values(cohort, scores, first, hours, keys, keep)
    return v.select("pid", F.array("_age", "_sex", "_score").alias(out), *keep)


def flag_vector(flags: DataFrame, cohort: DataFrame, *, keys: Sequence[str] = ("pid", "hadm"),
                flags_col: str = "flags", out: str = "features") -> DataFrame:
    """Comorbidity flags of the cohort admission (semi-join: the cohort has
    one row per subject, so no row can be multiplied)."""
    return (flags.join(cohort.select(*keys), list(keys), "left_semi")
            .select("pid", F.col(flags_col).alias(out)))


def concat_features(a: DataFrame, b: DataFrame, *, pid: str = "pid", col: str = "features",
                    out: str = "features") -> DataFrame:
    """Inner join by subject, arrays concatenated (a's first)."""
    j = a.select(pid, F.col(col).alias("_a")).join(b.select(pid, F.col(col).alias("_b")), pid, "inner")
    return j.select(pid, F.concat("_a", "_b").alias(out))


def derived_features(cohort: DataFrame, scores: DataFrame, flags: DataFrame, **kw) -> DataFrame:
    """3 baseline + 30 flag values per subject."""
    return concat_features(baseline_features_wide(cohort, scores), flag_vector(flags, cohort), **kw)


def feature_dictionary(long: DataFrame, *, feature: str = "feature", name: str = "name",
                       index: str = "index") -> DataFrame:
    """Distinct lower-cased feature names with a 0-based index in name order
    (one dictionary, fitted once and reused for train and test)."""
    from .text import dense_index
    names = long.select(F.lower(F.col(feature)).alias(name)).distinct()
    return dense_index(names, [name], out=index).select(name, F.col(index).cast("int").alias(index))


def labeled_points_dense(features: DataFrame, labels: DataFrame, *, pid: str = "pid",
                         features_col: str = "features", label: str = "label", carry: Sequence[str] = ()) -> DataFrame:
    """(pid, label double, features vector), inner join of labels and features;
    ``carry``: further columns of the features."""
    j = labels.select(pid, F.col(label).cast("double").alias("label")).join(
        features.select(pid, *carry, features_col), pid, "inner")
    return j.select(pid, *carry, "label", array_to_vector(F.col(features_col)).alias("features"))


def with_sparse_vectors(df: DataFrame, size: Column | int, indices: Column, values: Column, out: str = "features", *,
                        path: str | None = None) -> DataFrame:
    """``df`` with ``out``, the sparse vector of ``indices`` (ascending) and
    ``values``, as a written table (at ``path``, for callers that delete it).

    Spark has no expression that makes a sparse vector of two arrays, but a
    vector column is stored as a struct of them: the struct is written and read
    with a schema that calls it a vector. No row passes through Python."""
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), (F.lit(size) if isinstance(size, int) else size).cast("int").alias("size"),
                     indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))
    path = path or scratch_path(df.sparkSession, "vectors")
    table = df.withColumn(out, parts)
    table.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == out else f.dataType) for f in table.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def labeled_points_sparse(long: DataFrame, labels: DataFrame, dictionary: DataFrame | None = None,
                          *, pid: str = "pid", feature: str = "feature", value: str = "value",
                          label: str = "label") -> DataFrame:
    """Sparse labelled points from long-form features.

    Output: pid, label, size, indices, values (sorted by index) and
    ``features`` (an ML ``SparseVector``). The dictionary has one row per
    name; it is written once, its size is checked, and it is broadcast up to
    ``BROADCAST_NAMES`` names (the join shuffles beyond). Names the dictionary
    does not have are left out; a subject with none that it has keeps an empty
    vector. The points are a written table.
    """
    if dictionary is None:
        long = materialize(long)
        dictionary = feature_dictionary(long, feature=feature)
    d = materialize(dictionary.select("name", "index"))
    size = d.count()
    side = F.broadcast(d) if size <= BROADCAST_NAMES else d
    pairs = long.select(pid, F.lower(F.col(feature)).alias("name"), F.col(value).alias("_v")).join(side, "name", "left")
    # collect_list leaves nulls out: names without an index
    known = F.when(F.col("index").isNotNull(), F.struct("index", "_v"))
    per = pairs.groupBy(pid).agg(F.sort_array(F.collect_list(known)).alias("_p"))
    per = per.select(pid, F.col("_p.index").alias("indices"), F.col("_p._v").alias("values"))
    j = per.join(labels.select(pid, F.col(label).cast("double").alias("label")), pid, "inner")
    j = j.select(pid, "label", F.lit(size).alias("size"), "indices", "values")
    return with_sparse_vectors(j, F.col("size"), F.col("indices"), F.col("values"))


def mean_vector_by_key(df: DataFrame, key: str | Sequence[str], vec: str, *,
                       out: str = "mean") -> DataFrame:
    """Element-wise mean of an array or vector column per key.

    ``Summarizer`` aggregates vectors with partial aggregation (no explode,
    no row per element in the shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    v = F.col(vec) if isinstance(df.schema[vec].dataType, VectorUDT) else array_to_vector(F.col(vec))
    agg = df.select(*keys, v.alias("_v")).groupBy(*keys).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return agg.select(*keys, vector_to_array("_m").alias(out))


def array_to_long(df: DataFrame, keys: Sequence[str], arr: str, *, idx: str = "idx",
                  value: str = "value") -> DataFrame:
    """(keys..., idx, value) rows of an array column (0-based idx)."""
    return df.select(*keys, F.posexplode(arr).alias(idx, value))
