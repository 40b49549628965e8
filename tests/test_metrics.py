import random

from pyspark.sql import functions as F

from cohortlab import operators as op


def _scored(spark, n=400, ties=True, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.3 else 0
        s = rnd.randint(0, 20) / 10.0 if ties else rnd.random()
        rows.append((i, s + 0.3 * y, y))
    return spark.createDataFrame(rows, "pid long, score double, label int")


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_auc_matches_brute_force_with_ties(spark):
    df = _scored(spark)
    rows = [(r["score"], r["label"]) for r in df.collect()]
    auc = op.auc_by_rank(df).first()["auc"]
    assert abs(auc - _brute_auc(rows)) < 1e-12


def test_auc_reversed_is_complement(spark):
    df = _scored(spark, ties=False)
    a = op.auc_by_rank(df).first()["auc"]
    b = op.auc_by_rank(df.withColumn("score", -F.col("score"))).first()["auc"]
    assert abs(a + b - 1.0) < 1e-12


def test_auc_equals_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = _scored(spark)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    ref = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert abs(op.auc_by_rank(df).first()["auc"] - ref) < 1e-9


def test_auc_by_group_and_degenerate(spark):
    df = _scored(spark).withColumn("g", F.col("pid") % 3)
    by = {r["g"]: r["auc"] for r in op.auc_by_rank(df, by="g").collect()}
    for g in range(3):
        rows = [(r["score"], r["label"]) for r in df.filter(F.col("g") == g).collect()]
        assert abs(by[g] - _brute_auc(rows)) < 1e-12
    only_neg = df.withColumn("label", F.lit(0))
    assert op.auc_by_rank(only_neg).first()["auc"] is None


def test_confusion_and_metrics(spark):
    df = spark.createDataFrame([(0.5, 1), (-0.2, 1), (0.1, 0), (-1.0, 0), (-0.5, 0)], "score double, label int")
    cm = op.confusion_counts(df).first()
    assert (cm["tp"], cm["fp"], cm["tn"], cm["fn"]) == (1, 1, 2, 1)
    m = op.binary_metrics(df).first()
    assert m["total"] == 5 and m["positives"] == 2
    assert abs(m["accuracy"] - 0.6) < 1e-12 and abs(m["sensitivity"] - 0.5) < 1e-12
    raw = op.confusion_counts(df, threshold=None).first()   # study's raw-margin equality
    assert raw["tp"] == 0


def _uncoalesced(spark, parts):
    keys = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    return old


def test_auc_over_many_range_partitions(spark):
    old = _uncoalesced(spark, 23)
    try:
        df = _scored(spark, n=300, ties=False).withColumn("g", F.col("pid") % 2)
        rows = [(r["score"], r["label"], r["g"]) for r in df.collect()]
        assert abs(op.auc_by_rank(df).first()["auc"] - _brute_auc([(s, y) for s, y, _ in rows])) < 1e-12
        by = {r["g"]: r["auc"] for r in op.auc_by_rank(df, by="g").collect()}
        null = op.auc_by_rank(df.withColumn("g", F.lit(None).cast("int")), by="g").first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for g in (0, 1):
        assert abs(by[g] - _brute_auc([(s, y) for s, y, k in rows if k == g])) < 1e-12
    assert null["g"] is None and abs(null["auc"] - _brute_auc([(s, y) for s, y, _ in rows])) < 1e-12


def test_auc_of_infinite_nan_and_equal_scores(spark):
    inf = float("inf")
    rows = [(inf, 1), (-inf, 0), (1.0, 0), (2.0, 1), (inf, 0), (-inf, 1)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert abs(op.auc_by_rank(df).first()["auc"] - _brute_auc(rows)) < 1e-12
    assert abs(op.binary_metrics(df).first()["auc"] - _brute_auc(rows)) < 1e-12
    nan = spark.createDataFrame([(float("nan"), 1), (inf, 0), (None, 0)], "score double, label int")
    assert op.auc_by_rank(nan).first()["auc"] == 1.0     # NaN is above all, a null score is no row
    equal = spark.createDataFrame([(3.0, 1), (3.0, 0), (3.0, 0)], "score double, label int")
    assert op.auc_by_rank(equal).first()["auc"] == 0.5
