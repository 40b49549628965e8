from pyspark.sql import functions as F

from cohortlab import operators as op


def _ids(spark, n=1000):
    return spark.range(0, n).withColumnRenamed("id", "pid")


def test_split_exact_counts_disjoint_complete(spark):
    df = _ids(spark)
    tr, te = op.split_exact(df, 0.7, seed=3)
    a = {r["pid"] for r in tr.collect()}
    b = {r["pid"] for r in te.collect()}
    assert len(a) == 700 and not (a & b) and len(a | b) == 1000
    tr2, _ = op.split_exact(df, 0.7, seed=3)
    assert {r["pid"] for r in tr2.collect()} == a
    tr3, _ = op.split_exact(df, 0.7, seed=4)
    assert {r["pid"] for r in tr3.collect()} != a


def test_split_exact_multi_round(spark, monkeypatch):
    from cohortlab.operators import sampling
    monkeypatch.setattr(sampling, "CANDIDATE_ROWS", 1)
    monkeypatch.setattr(sampling, "HIST_BITS", 4)
    df = _ids(spark, 400)
    tr, te = sampling.split_exact(df, 0.25, seed=1)
    assert tr.count() == 100 and te.count() == 300


def test_split_of_a_key_that_is_not_unique_is_refused(spark):
    import pytest
    with pytest.raises(ValueError, match="not unique"):
        op.split_exact(spark.range(0, 4000).select(F.lit(7).alias("pid")), 0.5)


def test_draws_are_independent_after_a_split(spark):
    """50,000 subjects, 10 % positive: the positive share of the rebalanced
    training set is the target, whatever the split kept."""
    df = _ids(spark, 50_000).withColumn("label", F.when(F.col("pid") % 10 == 0, 1).otherwise(0))
    for exact in (True, False):
        train, _ = op.split_subjects(df, 0.7, seed=42, exact=exact)
        r = op.label_balance(op.rebalance_negatives(train, exact=exact, seed=42)).first()
        assert 0.29 <= r["positives"] / r["n"] <= 0.31
        folds = op.fold_assignment(train, 5, seed=42).groupBy("fold").count().collect()
        assert all(abs(f["count"] - 7000) < 350 for f in folds)


def test_exact_split_by_default_at_every_size(spark):
    train, test = op.split_subjects(_ids(spark, 5003), 0.7, seed=1)
    assert (train.count(), test.count()) == (3502, 1501)


def test_split_hash_reproducible(spark):
    df = _ids(spark)
    tr, te = op.split_hash(df, 0.7, seed=1)
    n = tr.count()
    assert 600 < n < 800 and n + te.count() == 1000
    assert op.split_hash(df, 0.7, seed=1)[0].count() == n


def test_rebalance_negatives(spark):
    df = _ids(spark).withColumn("label", F.when(F.col("pid") < 100, 1).otherwise(0))
    ex = op.rebalance_negatives(df, "label", exact=True, seed=0)
    b = ex.groupBy("label").count().collect()
    counts = {r["label"]: r["count"] for r in b}
    assert counts[1] == 100 and counts[0] == int(100 / 0.3 * 0.7)
    # already balanced -> unchanged
    bal = _ids(spark, 10).withColumn("label", F.when(F.col("pid") < 3, 1).otherwise(0))
    assert op.rebalance_negatives(bal, "label").count() == 10
    # no positives -> nothing sampled
    none = _ids(spark, 10).withColumn("label", F.lit(0))
    assert op.rebalance_negatives(none, "label", exact=True).count() == 0


def test_fold_assignment_range(spark):
    f = op.fold_assignment(_ids(spark), 5, seed=2)
    folds = {r["fold"] for r in f.collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_subtract_rows_keeps_multiplicity_and_matches_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    got = sorted(tuple(r) for r in op.subtract_rows(left, right).collect())
    assert got == [(1, "a"), (1, "a")]


def test_unit_hash_matches_duckdb(spark):
    import duckdb
    from cohortlab.functions.hashing import duck_unit_hash, unit_hash
    s = spark.range(0, 5).select(unit_hash("id", 42).alias("h")).orderBy("id" if False else "h").collect()
    d = duckdb.sql(f"SELECT {duck_unit_hash('i', 42)} AS h FROM range(5) t(i) ORDER BY h").fetchall()
    assert [r["h"] for r in s] == [r[0] for r in d]
