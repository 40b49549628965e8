import random

from pyspark.ml.linalg import Vectors
from cohortlab import operators as op
from cohortlab.plans import models as M


def _points(spark, n=120, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = i % 2
        rows.append((i, float(y), Vectors.dense([y * 2.0 - 1.0 + rnd.gauss(0, 0.3), rnd.gauss(0, 1)])))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    schema = StructType([StructField("pid", LongType()), StructField("label", DoubleType()),
                         StructField("features", VectorUDT())])
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_svm_separates_toy_data(spark):
    pts = _points(spark)
    m = M.fit_svm(pts, 20, 0.01, True)
    assert op.auc_by_rank(m.score(pts)).first()["auc"] > 0.95 and len(m.weights) == 2
    by_model = {r["pid"]: r["score"] for r in m.score(pts).collect()}
    by_hand = {r["pid"]: r["score"] for r in M.linear_score(pts, m.weights, m.intercept).collect()}
    assert all(abs(by_model[p] - by_hand[p]) < 1e-9 for p in by_hand)


def test_topic_mixtures_sum_to_one(spark):
    rows = [(p, ["heart", "lung", "renal", "heart"] if p % 2 else ["sepsis", "fever", "renal"])
            for p in range(20) for _ in range(2)]
    tok = spark.createDataFrame(rows, "pid long, tokens array<string>").union(
        spark.createDataFrame([(99, [])], "pid long, tokens array<string>"))
    feats, model = M.topic_features(tok, k=3, iterations=5, seed=1)
    got = {r["pid"]: r["features"] for r in feats.collect()}
    assert 99 not in got and len(got) == 20
    assert all(abs(sum(v) - 1.0) < 1e-6 and len(v) == 3 for v in got.values())
    terms = M.topic_top_terms(model, 2).collect()
    assert len(terms) == 6 and {r["term"] for r in terms} <= {"heart", "lung", "renal", "sepsis", "fever"}


def test_topic_features_count_their_notes_once(spark, monkeypatch):
    """Fit and mixtures use one table of vectors, made with one shuffle of whole token lists."""
    tok = spark.createDataFrame([(p, ["heart", "lung", "renal", "heart"] if p % 2 else ["sepsis", "renal"]) for p in range(20)],
                                "pid long, tokens array<string>").repartition(3)
    made, real = [], M.with_sparse_vectors

    def vectors(df, *a, **kw):
        made.append(df._jdf.queryExecution().sparkPlan().toString())
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *a, **kw)

    plans = []
    monkeypatch.setattr(M, "with_sparse_vectors", vectors)
    feats, model = M.topic_features(tok, k=2, iterations=2, seed=1)
    assert feats.count() == 20 and len(made) == 1
    assert plans[0].count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_doc" in plans[0]
    M.topic_features(tok, model=model)
    assert len(made) == 2


def test_cv_grid_rows_and_best(spark):
    pts = _points(spark, 80)
    out, best = M.cv_grid(pts, {"intercept": [True], "iterations": [3, 5], "reg": [0.01]}, 2, seed=1)
    rows = out.orderBy("grid_point").collect()
    assert len(rows) == 2 and sum(r["best"] for r in rows) == 1
    top = max(r["mean_auc"] for r in rows)
    first_top = next(r for r in rows if r["mean_auc"] == top)
    assert first_top["best"] and best["iterations"] == first_top["iterations"]


def test_em_topic_optimizer(spark):
    rows = [(p, ["heart", "lung", "renal"] if p % 2 else ["sepsis", "fever", "renal"]) for p in range(12)]
    tok = spark.createDataFrame(rows, "pid long, tokens array<string>")
    feats, model = M.topic_features(tok, k=2, iterations=5, seed=2, optimizer="em", vocab_size=4)
    assert model.size == model.vocabulary.count() == 4
    assert all(abs(sum(r["features"]) - 1.0) < 1e-6 for r in feats.collect())


def test_topic_vectors_count_known_terms(spark):
    tok = spark.createDataFrame([(1, ["b", "a", "b"]), (1, ["c"]), (2, []), (3, ["z"])], "pid long, tokens array<string>")
    model = M.fit_topics(tok.filter("pid < 3"), k=2, iterations=2)
    index = {r["term"]: r["term_index"] for r in model.vocabulary.collect()}
    assert index == {"b": 0, "a": 1, "c": 2}     # by count, then by term
    got = sorted((r["pid"], tuple(r["_tf"].indices.tolist()), tuple(r["_tf"].values.tolist()), r["_tf"].size)
                 for r in model.vectors(tok).collect())
    assert got == [(1, (0, 1), (2.0, 1.0), 3), (1, (2,), (1.0,), 3)]


def test_cv_grid_equals_the_cross_validator(spark):
    """Fits that are shared between iterations against Spark ML's CrossValidator, which makes each."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    pts = _points(spark, 90)
    grid = {"intercept": [False, True], "iterations": [2, 30, 40], "reg": [0.1]}
    got = [r["mean_auc"] for r in M.cv_grid(pts, grid, 2, seed=1, parallelism=2)[0].orderBy("grid_point").collect()]
    svc = LinearSVC(standardization=False)
    maps = (ParamGridBuilder().addGrid(svc.fitIntercept, grid["intercept"]).addGrid(svc.maxIter, grid["iterations"])
            .addGrid(svc.regParam, grid["reg"]).build())
    cv = CrossValidator(estimator=svc, estimatorParamMaps=maps, evaluator=BinaryClassificationEvaluator(numBins=0), foldCol="fold", numFolds=2)
    want = cv.fit(M.fold_assignment(pts, 2, 1, key="pid")).avgMetrics
    assert len(got) == 6 and all(abs(a - b) < 1e-12 for a, b in zip(got, want))


def test_cv_grid_query_searches_the_whole_grid(spark, monkeypatch):
    import __spark_entry__ as E
    from cohortlab.constants import DERIVED_GRID
    seen, real = [], M.cv_grid

    def grid(points, grid, *a, **kw):
        seen.append(grid)
        return real(points, {"intercept": [True], "iterations": [2], "reg": [0.1]}, *a, **kw)

    monkeypatch.setattr(M, "cv_grid", grid)
    E.queries()["cv_grid"](spark, "/root/testdata/sf0.01").count()
    assert seen == [DERIVED_GRID]


def test_topic_features_query_fits_the_study_s_topics(spark, monkeypatch):
    import __spark_entry__ as E
    seen, real = [], M.topic_features

    def features(tok, k, iterations, **kw):
        seen.append((k, iterations))
        return real(tok, 2, 2, **kw)

    monkeypatch.setattr(M, "topic_features", features)
    E.queries()["topic_features"](spark, "/root/testdata/sf0.01").count()
    assert seen == [(50, 50)]
