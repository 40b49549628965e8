from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlab import operators as op


def test_sparse_points_and_dictionary(spark):
    long = spark.createDataFrame([(1, "B", 2.0), (1, "a", 1.0), (2, "c", 3.0), (2, "A", 0.0)],
                                 "pid long, feature string, value double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "pid long, label int")
    d = {r["name"]: r["index"] for r in op.feature_dictionary(long).collect()}
    assert d == {"a": 0, "b": 1, "c": 2}
    pts = {r["pid"]: r for r in op.labeled_points_sparse(long, labels)
           .withColumn("dense", vector_to_array("features")).collect()}
    assert set(pts) == {1, 2}
    assert pts[1]["indices"] == [0, 1] and pts[1]["values"] == [1.0, 2.0] and pts[1]["size"] == 3
    assert pts[1]["dense"] == [1.0, 2.0, 0.0] and pts[2]["dense"] == [0.0, 0.0, 3.0]
    assert pts[1]["label"] == 1.0


def test_mean_vector_by_key(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 5.0])], "k int, v array<double>")
    got = {r["k"]: r["mean"] for r in op.mean_vector_by_key(df, "k", "v").collect()}
    assert got == {1: [2.0, 3.0], 2: [5.0, 5.0]}


def test_concat_and_dense_points(spark):
    a = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "pid long, features array<double>")
    b = spark.createDataFrame([(1, [9.0, 8.0])], "pid long, features array<double>")
    c = op.concat_features(a, b).collect()
    assert [(r["pid"], r["features"]) for r in c] == [(1, [1.0, 9.0, 8.0])]
    labels = spark.createDataFrame([(1, 0)], "pid long, label int")
    p = op.labeled_points_dense(op.concat_features(a, b), labels).first()
    assert p["label"] == 0.0 and list(p["features"]) == [1.0, 9.0, 8.0]


def test_linear_score(spark):
    from cohortlab.plans.models import linear_score
    df = spark.createDataFrame([(1, [1.0, 2.0])], "pid long, features array<double>")
    assert linear_score(df, [0.5, 2.0], 1.0).first()["score"] == 5.5


def test_sparse_points_stay_sparse(spark):
    from pyspark.ml.linalg import SparseVector
    n = 100_000
    names = spark.range(n).select(F.concat(F.lit("f"), "id").alias("name"), F.col("id").cast("int").alias("index"))
    long = spark.createDataFrame([(1, "F7", 2.0), (1, "f99999", 3.0), (2, "unknown", 1.0), (3, "F0", 5.0)],
                                 "pid long, feature string, value double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "pid long, label int")
    pts = op.labeled_points_sparse(long, labels, names)
    got = {r["pid"]: r["features"] for r in pts.collect()}
    assert got == {1: SparseVector(n, {7: 2.0, 99999: 3.0}), 2: SparseVector(n, {}), 3: SparseVector(n, {0: 5.0})}
    assert all(isinstance(v, SparseVector) for v in got.values())
    plan = pts._jdf.queryExecution().toString()
    assert not any("SortMergeJoin" in line and "name" in line for line in plan.splitlines())
