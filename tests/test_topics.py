import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql.types import LongType, StructField, StructType

from cohortlab.plans import models as M
from cohortlab.plans import topics as tp


def _docs(spark, n=240, terms=60, seed=1):
    """Documents of three subjects matter, and one without a term."""
    rng = np.random.default_rng(seed)
    rows = [(n, SparseVector(terms, {}))]
    for i in range(n):
        t = np.where(rng.random(25) < 0.9, rng.integers(0, terms // 3, 25) + terms // 3 * (i % 3), rng.integers(0, terms, 25))
        at, c = np.unique(t, return_counts=True)
        rows.append((i, SparseVector(terms, at.tolist(), c.astype(float).tolist())))
    schema = StructType([StructField("pid", LongType()), StructField("_tf", VectorUDT())])
    return spark.createDataFrame(rows, schema).repartition(3).localCheckpoint()


def _mixtures(model, docs):
    return {r["pid"]: np.array(r["topic_mix"]) for r in model.transform(docs).collect()}


def test_mixtures_are_the_fixed_point_of_plain_steps():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 60, 50)
    rows, counts = rng.integers(0, 300, sizes.sum()), rng.integers(1, 4, sizes.sum()).astype(float)
    beta, alpha, start, o = rng.gamma(0.5, 1.0, (300, 4)), np.full(4, 0.25), tp.first_mixture(4, 0, 1), 0
    sums = np.zeros((301, 4))
    got, want_sums = tp.mixtures(sizes, rows, counts, beta, alpha, start, sums, np.full(50, 2)), np.zeros((301, 4))
    for s, g in zip(sizes, got):
        b, c, x = beta[rows[o:o + s]], counts[o:o + s], start
        for _ in range(5000):
            theta = np.exp(tp.digamma(x))
            x, last = theta * ((c / (b @ theta)) @ b) + alpha, x
            if np.abs(x - last).mean() < 1e-9:
                break
        assert np.abs(g - x).max() < 0.05 and abs(g.sum() - c.sum() - 1.0) < 1e-3
        np.add.at(want_sums, rows[o:o + s], 2 * np.outer(c / (b @ theta), theta))
        o += s
    assert np.abs(sums - want_sums).max() < 0.05 * want_sums.max()


def test_spread_fit_equals_the_fit_in_one_task(spark, monkeypatch):
    docs = _docs(spark)
    one, spread = tp.fit_online(docs, 3, 6, seed=4), tp.fit_online(docs, 3, 6, seed=4, local_values=0)
    assert np.allclose(one.weights.total, spread.weights.total) and np.allclose(one.weights.alpha, spread.weights.alpha)
    # what the iterations keep is the whole of the topics: first weights and what documents added
    rows = {int(t): v for r in spread.added.collect() for t, v in zip(np.frombuffer(r["terms"], "<i4"), np.frombuffer(r["vals"], "<f4").reshape(-1, 3))}
    whole = spread.weights.base(np.arange(60))
    for t, v in rows.items():
        whole[t] += v
    assert spread.terms == len(rows) and np.allclose(whole.sum(axis=0), spread.weights.total)
    a = _mixtures(one, docs)
    monkeypatch.setattr(tp, "BROADCAST_VALUES", 0)
    b = _mixtures(spread, docs)
    assert a.keys() == b.keys() == set(range(241)) and not a[240].any()
    assert all(np.abs(a[p] - b[p]).max() < 1e-3 and abs(b[p].sum() - 1) < 1e-9 for p in range(240))
    top = {r["topic"]: r for r in spread.describeTopics(4).collect()}
    for j in range(3):
        order = np.lexsort((np.arange(60), -whole[:, j]))[:4]
        assert list(top[j]["termIndices"]) == order.tolist()
        assert np.allclose(top[j]["termWeights"], whole[order, j] / whole[:, j].sum())


def test_topics_are_found(spark):
    docs = _docs(spark, 2500)
    got = _mixtures(tp.fit_online(docs, 3, 50, seed=4), docs)
    kinds = [np.argmax(np.mean([got[p] for p in range(2500) if p % 3 == z], axis=0)) for z in range(3)]
    assert sorted(kinds) == [0, 1, 2]
    assert np.mean([np.argmax(got[p]) == kinds[p % 3] for p in range(2500)]) > 0.9


def test_online_fit_keeps_no_topic_matrix_on_the_driver(spark, monkeypatch):
    """Spark ML's fit holds k x V matrices on the driver: it is not called, and what comes
    to the driver is a row a block, whatever the vocabulary."""
    monkeypatch.setattr(M, "LDA", lambda **kw: pytest.fail("Spark ML's LDA"))
    schema = StructType([StructField("pid", LongType()), StructField("_tf", VectorUDT())])
    wide = spark.createDataFrame([(i, SparseVector(2_000_000_000, [i, 10**9 + i], [2.0, 1.0])) for i in range(40)], schema)
    monkeypatch.setattr(tp, "_first_total", lambda spark, size, k, seed: np.full(k, float(size)))
    model = M.fit_lda(wide.localCheckpoint(), 2, 4, seed=3)
    assert model.weights.size == 2_000_000_000 and 0 < model.terms <= 80
    assert len(_mixtures(model, wide)) == 40


def test_numbers_beyond_the_vocabulary_are_not_known(spark):
    df = spark.createDataFrame([(1, (3, [0, 2, 5], [1.0, 1.0, 9.0])), (2, (3, [0, 2], [1.0, 1.0]))],
                               "pid long, _tf struct<size:int,indices:array<int>,values:array<double>>").localCheckpoint()
    model = tp.fit_online(df, 2, 3, seed=1)
    a, b = (_mixtures(model, df)[p] for p in (1, 2))
    assert model.weights.size == 3 and np.allclose(a, b)


def test_no_documents(spark):
    model = tp.fit_online(_docs(spark).filter("pid < 0").localCheckpoint(), 2, 3)
    assert model.terms == 0 and model.transform(_docs(spark).filter("pid < 0")).count() == 0
