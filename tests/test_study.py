import datetime as dt
import random

import pytest

import __spark_entry__ as E
from cohortlab.plans.study import hourly_auc


def test_hourly_auc_matches_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2000, 1, 1)
    subj, first, scored = [], [], []
    for p in range(60):
        out = base + dt.timedelta(hours=rnd.randint(10, 200))
        dod = dt.datetime(9000, 1, 1) if p % 3 else base + dt.timedelta(hours=rnd.randint(5, 300))
        subj.append((p, out, dod))
        if p % 5:
            first.append((p, base + dt.timedelta(hours=rnd.randint(0, 40))))
        scored.append((p, float(rnd.randint(0, 5)), int(rnd.random() < 0.4)))
    cohort = spark.createDataFrame(subj, "pid long, out_ts timestamp, dod timestamp")
    fdf = spark.createDataFrame(first, "pid long, first_ts timestamp")
    sdf = spark.createDataFrame(scored, "pid long, score double, label int")
    hours = list(range(0, 241, 24))
    got = {r["hour"]: (r["total"], r["positives"], r["auc"])
           for r in hourly_auc(sdf, cohort, fdf, hours).collect()}
    fmap = dict(first)
    for h in hours:
        present = []
        for (p, out, dod), (_, s, y) in zip(subj, scored):
            if h <= 0:
                present.append((s, y))
            elif p in fmap:
                b = fmap[p] + dt.timedelta(hours=h)
                if out > b and dod > b:
                    present.append((s, y))
        if not present:
            assert h not in got
            continue
        pos = [s for s, y in present if y]
        neg = [s for s, y in present if not y]
        auc = (sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))
               if pos and neg else None)
        tot, npos, a = got[h]
        assert (tot, npos) == (len(present), len(pos)), h
        assert (a is None and auc is None) or abs(a - auc) < 1e-12, h


def _inputs(spark, sf_dir, **kw):
    from cohortlab.plans.catalog import Tables
    from cohortlab.plans.study import build_inputs
    from cohortlab.sources import fixtures as fx
    t = Tables(spark, sf_dir)
    notes = fx.attach_text(spark, sf_dir, t.notes(with_text=False))
    return build_inputs(spark, t.subjects(), t.episodes(), notes, t.scores(), t.flags(), seed=3, **kw)


@pytest.fixture
def fits(monkeypatch):
    """Settings of every SVM and LDA fit; grid searches only note the grid."""
    from cohortlab.plans import study
    seen = {"svm": [], "lda": [], "grid": []}
    real_svm, real_topics, real_lda = study.fit_svm, study.topic_features, study.fit_lda

    def svm(points, iterations, reg, intercept):
        seen["svm"].append((iterations, reg, intercept))
        return real_svm(points, 2, reg, intercept)

    def topics(tok, k, iterations, **kw):
        if kw.get("model") is None:
            seen["lda"].append((k, iterations, kw["optimizer"]))
        return real_topics(tok, 2, 2, **kw)

    def lda(vectors, k, iterations, **kw):
        seen["lda"].append((k, iterations, kw["optimizer"]))
        return real_lda(vectors, 2, 2, **kw)

    def grid(points, grid, folds, seed, parallelism):
        assert points.count() and "pid" in points.columns
        seen["grid"].append((grid, folds))
        return None, {"iterations": 7, "reg": 0.5, "intercept": False}

    monkeypatch.setattr(study, "fit_svm", svm)
    monkeypatch.setattr(study, "topic_features", topics)
    monkeypatch.setattr(study, "fit_lda", lda)
    monkeypatch.setattr(study, "cv_grid", grid)
    return seen


def test_build_inputs(spark, sf_dir):
    sub, full = _inputs(spark, sf_dir)
    subjects = {r["pid"] for r in full.cohort.collect()}
    train, test = ({r["pid"] for r in x.collect()} for x in (full.train, full.test))
    assert train | test == subjects and not train & test and len(train) == int(len(subjects) * 0.7)
    labels = {r["pid"]: r["label"] for r in full.labels.collect()}
    assert set(labels) == subjects == {r["pid"] for r in full.first.collect()}
    balanced = {r["pid"] for r in sub.train.collect()}
    pos = {p for p in train if labels[p]}
    assert pos <= balanced <= train
    if len(pos) / len(train) < 0.3:
        assert len(balanced) == len(pos) + int(len(pos) / 0.3 * 0.7)
    plan = full.tokens._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan          # read from the one written token table
    hashed = _inputs(spark, sf_dir, exact=False, rebalance=False)
    assert hashed[0] is hashed[1]


def test_each_experiment_uses_its_settings(spark, sf_dir, fits):
    from cohortlab.constants import BASELINE_GRID, DERIVED_GRID
    from cohortlab.plans.study import StudyConfig, run_study, study_summary
    cfg = StudyConfig(topic_hours=range(240, 481, 240), hours=range(0, 481, 240))
    out = run_study(_inputs(spark, sf_dir), cfg)
    assert fits["svm"] == [(300, 100.0, True), (300, 0.1, True), (300, 100.0, True), (300, 100.0, True), (300, 100.0, True)]
    assert fits["lda"] == [(50, 50, "online")] * 3 and not fits["grid"]
    rows = study_summary(out).collect()
    assert {(r["experiment"], r["split"], r["hour"]) for r in rows} == {
        ("baseline", "train", None), ("baseline", "test", 0), ("baseline", "test", 240), ("baseline", "test", 480),
        ("retrospective_topics", "train", None), ("retrospective_topics", "test", None), ("derived", "train", None),
        ("derived", "test", None), *(("hourly_topics", s, h) for s in ("train", "test") for h in (240, 480))}
    fits["svm"].clear()
    run_study(_inputs(spark, sf_dir), cfg, topic_sweep=False, baseline_grid=BASELINE_GRID, derived_grid=DERIVED_GRID)
    assert fits["grid"] == [(BASELINE_GRID, 5), (DERIVED_GRID, 5)]
    assert fits["svm"] == [(7, 0.5, False), (300, 0.1, True), (7, 0.5, False)]


def test_topic_cube_equals_counts_at_every_mark(spark):
    """The vectors of each mark against a new count of the notes it sees."""
    from collections import Counter

    from cohortlab.plans.models import TopicCube
    rnd = random.Random(4)
    words = [f"word{i}" for i in range(12)]
    notes = [(p, "train" if p % 3 else "test", m, [rnd.choice(words[: 3 + 2 * m + p % 2]) for _ in range(rnd.randrange(0, 6))])
             for p in range(12) for m in range(5)]
    df = spark.createDataFrame(notes, "pid long, part string, mark int, tokens array<string>").repartition(3)
    cube = TopicCube(df, 5)
    index = {r["term"]: r["term_index"] for r in cube.vocabulary.collect()}
    assert sorted(index.values()) == list(range(len(index)))
    for m in range(5):
        vocabulary = {t for _, s, k, ts in notes if s == "train" and k <= m for t in ts}
        assert {t for t, i in index.items() if i < cube.sizes[m]} == vocabulary
        for part in ("train", "test"):
            want = sorted((p, tuple(sorted((index[t], float(n)) for t, n in Counter(ts).items() if t in vocabulary)))
                          for p, s, k, ts in notes if s == part and k <= m and set(ts) & vocabulary)
            got = sorted((r["pid"], tuple(zip(r["_tf"].indices.tolist(), r["_tf"].values.tolist())))
                         for r in cube.vectors(m, part).collect())
            assert got == want
        assert {r["_tf"].size for r in cube.vectors(m, "train").collect()} == {cube.sizes[m]}


def test_marks_equal_the_hour_filter(spark):
    from cohortlab import operators as op
    from cohortlab.plans.study import _marked
    rnd = random.Random(5)
    base = dt.datetime(2000, 1, 1)
    notes = spark.createDataFrame([(p, base + dt.timedelta(hours=rnd.choice([0, 1, 12, 24, 36, 37, 400])), i)
                                   for i, p in enumerate(rnd.choices(range(8), k=80))], "pid long, ts timestamp, i long")
    first = spark.createDataFrame([(p, base + dt.timedelta(hours=p % 3)) for p in range(6)], "pid long, first_ts timestamp")
    hours = [12, 24, 36]
    marked = {r["i"]: r["mark"] for r in _marked(notes, first, hours).collect()}
    for m, h in enumerate(hours):
        assert {i for i, k in marked.items() if k <= m} == {r["i"] for r in op.events_within_hours(notes, first, h).collect()}


def test_default_hours():
    from cohortlab.plans.study import StudyConfig
    cfg = StudyConfig()
    assert list(cfg.hours) == list(range(0, 241, 12)) and list(cfg.topic_hours) == list(range(12, 241, 12))


def test_fitted_experiments_run(spark, sf_dir):
    q = E.queries()
    hourly = q["hourly_auc_fitted"](spark, sf_dir).collect()
    assert len(hourly) == 22 and sum(r["split"] == "train" for r in hourly) == 1
    derived = q["derived_model"](spark, sf_dir).collect()
    assert sorted(r["split"] for r in derived) == ["test", "train"]


def test_texts_are_attached_to_in_episode_notes_only(spark, sf_dir):
    from cohortlab.plans.catalog import Tables
    from cohortlab.plans.study import build_inputs
    from cohortlab.sources import fixtures as fx
    t = Tables(spark, sf_dir)
    seen = []

    def attach(notes):
        seen.append(notes.count())
        return fx.attach_text(spark, sf_dir, notes)

    late = build_inputs(spark, t.subjects(), t.episodes(), t.notes(with_text=False), t.scores(), t.flags(), seed=3, attach=attach)[0]
    early = _inputs(spark, sf_dir)[0]
    assert 0 < seen[0] < t.notes(with_text=False).count()
    for name in ("tokens", "cohort", "labels", "train", "test"):
        a, b = getattr(late, name), getattr(early, name)
        b = b.select(*a.columns)
        assert a.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_few_large_topic_models_at_once(spark, sf_dir, monkeypatch):
    """Fits of large vocabularies run one by one, and no vectors or counts are left on disk."""
    import os
    import threading
    import time
    from cohortlab import session
    from cohortlab.plans import study
    assert study.fits_at_once(5, 1000, 4) == 4 and study.fits_at_once(5, 600_000, 4) == 2 and study.fits_at_once(50, 10**7, 4) == 1
    monkeypatch.setattr(study, "FIT_VALUES", 1)
    lock, now, most, real = threading.Lock(), [0], [0], study.fit_lda

    def lda(vectors, k, iterations, **kw):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.5)
        try:
            return real(vectors, 2, 2, **kw)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(study, "fit_lda", lda)
    before = set(session._SCRATCH)
    cfg = study.StudyConfig(svm_iterations=2, topic_hours=range(2400, 4801, 1200), parallelism=3)
    assert study.hourly_topic_model(_inputs(spark, sf_dir)[0], cfg).count() == 6
    assert most[0] == 1
    assert not [p for p in set(session._SCRATCH) - before if os.path.exists(p)]
