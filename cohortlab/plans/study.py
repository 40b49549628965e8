"""The study's experiments as Spark jobs.

EXP-1 ``baseline_model``     age/sex/score SVM, tested every 12 h after the first note
EXP-2 ``hourly_topic_model`` LDA + SVM refit at every hour mark
EXP-3 ``retrospective_topic_model`` LDA on all in-episode notes, SVM on train
EXP-4 ``derived_model``      33 derived features
EXP-5 ``run_study``          everything above on one set of inputs

The hour sweep of EXP-1 is one job: every test subject counts once, at the
last hour mark at which it is present (each subject has one cut-off,
min(out, death) - first note); sums over the marks give the counts of every hour.

The hour sweep of EXP-2 counts the notes' tokens once. A note is seen from one
mark on, so the notes of a mark are those of the mark before and the ones new at
it; terms are numbered by the mark that sees them first, so the vocabulary of a
mark is a prefix of one numbering and a note has one vector for all marks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add
from threading import BoundedSemaphore

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..constants import (BASELINE_GRID, DERIVED_GRID, HOURS_START, HOURS_STEP, HOURS_STOP, LDA_ITERATIONS,
                         LDA_K, MS_HOUR, N_FOLDS, RETROSPECTIVE_TOPIC_REG, SVM_ITERATIONS, SVM_REG,
                         TOPIC_HOURS_START, TRAIN_PROPORTION)
from ..functions.timecols import millis
from ..session import clear_scratch, drop_scratch, materialize, scratch_path
from .models import LinearModel, TopicCube, cv_grid, fit_lda, fit_svm, fit_topics, linear_score, topic_features
from .subgradient import cv_grid_subgradient, fit_svm_subgradient
from .topics import BROADCAST_VALUES


def hourly_auc(scored: DataFrame, cohort: DataFrame | None, first: DataFrame, hours: Iterable[int], *,
               pid: str = "pid", score: str = "score", label: str = "label",
               threshold: float | None = 0.0) -> DataFrame:
    """Binary metrics per hour mark over the subjects present at that hour.

    At h <= 0 every scored subject counts (also those without a first note);
    at h > 0 a subject counts when it has a first note and both its out time
    and its death are strictly later than first + h. Pass ``cohort=None`` when
    ``scored`` already has ``out_ts`` and ``dod``.
    """
    hrs = sorted({int(h) for h in hours})
    f = first.select(pid, millis("first_ts").alias("_f"))
    x = scored if cohort is None else scored.select(pid, score, label).join(
        cohort.select(pid, "out_ts", "dod"), pid, "inner")
    x = x.select(pid, score, label, millis("out_ts").alias("_o"), millis("dod").alias("_d")).join(f, pid, "left")

    # a subject is present at the marks up to its last one; marks up to 0 hold for all
    stay = F.least("_o", "_d") - F.col("_f")
    known = F.col("_f").isNotNull() & F.col("_o").isNotNull() & F.col("_d").isNotNull()
    later = [F.when(stay > h * MS_HOUR, 1).otherwise(0) for h in hrs if h > 0]
    until = F.lit(len(hrs) - len(later)) + (F.when(known, reduce(add, later)).otherwise(0) if later else F.lit(0))
    return op.binary_metrics_over_marks(x.select(score, label, until.alias("_marks")), hrs, "_marks", score, label, out="hour",
                                        threshold=threshold)


def _sweep(start=HOURS_START, stop=HOURS_STOP, step=HOURS_STEP) -> range:
    return range(start, stop + 1, step)


@dataclass
class StudyInputs:
    cohort: DataFrame                  # build_cohort output
    first: DataFrame                   # (pid, first_ts) of the note cohort
    tokens: DataFrame                  # tokenized in-episode notes (pid, ts, tokens)
    scores: DataFrame                  # load_scores output
    flags: DataFrame                   # load_flags output
    labels: DataFrame                  # (pid, label)
    train: DataFrame                   # (pid) training subjects
    test: DataFrame                    # (pid) test subjects


@dataclass
class StudyConfig:
    svm_iterations: int = SVM_ITERATIONS
    baseline_reg: float = SVM_REG
    hourly_topic_reg: float = SVM_REG                          # EXP-2
    retrospective_topic_reg: float = RETROSPECTIVE_TOPIC_REG   # EXP-3
    derived_reg: float = SVM_REG
    intercept: bool = True
    lda_k: int = LDA_K
    lda_iterations: int = LDA_ITERATIONS
    seed: int = 0
    hours: range = field(default_factory=_sweep)
    topic_hours: range = field(default_factory=lambda: _sweep(TOPIC_HOURS_START))
    refit_test_topics: bool = False
    threshold: float | None = 0.0
    lda_optimizer: str = "online"
    folds: int = N_FOLDS
    solver: str = "linear_svc"      # or "subgradient", the study's
    parallelism: int = 4      # fits that run at once (EXP-2's hour marks, grid points)


def _restrict(df: DataFrame, subjects: DataFrame, pid: str = "pid") -> DataFrame:
    return op.restrict_to_subjects(df, subjects, pid=pid)


def fit_ready(points: DataFrame) -> DataFrame:
    """Checkpoint labelled points once: solvers iterate over them, and the
    checkpoint also replaces the long lineage, which Spark ML would otherwise
    re-analyse at every step. Small inputs come out in few partitions, as
    adaptive execution merges them by bytes."""
    return materialize(points)


def _points_with_ids(features: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return fit_ready(op.labeled_points_dense(features, labels, carry=carry))


def _fit(train: DataFrame, iterations: int, reg: float, intercept: bool, cfg: StudyConfig,
         grid: Mapping | None) -> LinearModel:
    """SVM with the given settings, or with the best of ``grid`` by k-fold
    mean AUC on the training points."""
    own = cfg.solver == "subgradient"
    if grid:
        _, best = cv_grid_subgradient(train, grid, cfg.folds, seed=cfg.seed) if own else \
            cv_grid(train, grid, cfg.folds, seed=cfg.seed, parallelism=cfg.parallelism)
        iterations, reg, intercept = best["iterations"], best["reg"], best["intercept"]
    return (fit_svm_subgradient if own else fit_svm)(train, iterations, reg, intercept)


def baseline_model(inp: StudyInputs, cfg: StudyConfig = StudyConfig(), *,
                   grid: Mapping | None = None) -> tuple[DataFrame, LinearModel]:
    """EXP-1: (split, hour, total, positives, auc, accuracy, sensitivity,
    specificity); the train row has hour NULL. With ``grid`` the SVM settings
    are chosen by k-fold mean AUC on the train subjects first."""
    train_c = _restrict(inp.cohort, inp.train)
    long_train = op.baseline_features_long(train_c, inp.scores)
    dictionary = materialize(op.feature_dictionary(long_train))
    pts = fit_ready(op.labeled_points_sparse(long_train, inp.labels, dictionary))
    model = _fit(pts, cfg.svm_iterations, cfg.baseline_reg, cfg.intercept, cfg, grid)
    train_m = op.binary_metrics(model.score(pts), threshold=cfg.threshold)
    test_c = _restrict(inp.cohort, inp.test)
    long_test = op.baseline_features_long(test_c, inp.scores)
    test_pts = op.labeled_points_sparse(long_test, inp.labels, dictionary)
    hourly = hourly_auc(model.score(test_pts), inp.cohort, inp.first, cfg.hours, threshold=cfg.threshold)
    out = (train_m.select(F.lit("train").alias("split"), F.lit(None).cast("int").alias("hour"), "*")
           .unionByName(hourly.select(F.lit("test").alias("split"), "*")))
    return out, model


def _topic_points(tok: DataFrame, labels: DataFrame, cfg: StudyConfig, model=None):
    feats, model = topic_features(tok, cfg.lda_k, cfg.lda_iterations, seed=cfg.seed,
                                  optimizer=cfg.lda_optimizer, model=model)
    return _points_with_ids(feats, labels), model


def retrospective_topic_model(inp: StudyInputs, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """EXP-3: LDA on all in-episode notes, SVM on train subjects, metrics on
    train and test."""
    pts, _ = _topic_points(inp.tokens, inp.labels, cfg)
    train, test = _restrict(pts, inp.train), _restrict(pts, inp.test)
    model = _fit(train, cfg.svm_iterations, cfg.retrospective_topic_reg, cfg.intercept, cfg, None)
    return _split_metrics(_scored(model, train, test), cfg)


def _scored(model: LinearModel, train: DataFrame, test: DataFrame, hour: int | None = None) -> DataFrame:
    """(split[, hour], score, label) of both parts."""
    extra = [] if hour is None else [F.lit(int(hour)).alias("hour")]
    parts = [model.score(p).select(F.lit(name).alias("split"), *extra, "score", "label")
             for name, p in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


def _split_metrics(scored: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Binary metrics of each split (and hour): one grouped pass."""
    by = ["split", "hour"] if "hour" in scored.columns else ["split"]
    return op.binary_metrics(scored, by=by, threshold=cfg.threshold)


def _marked(notes: DataFrame, first: DataFrame, hours: list[int], pid: str = "pid", ts: str = "ts") -> DataFrame:
    """Notes with ``mark``, the place in ``hours`` (ascending) of the first
    mark that sees them; at marks up to 0 all notes count, as in
    ``events_within_hours``. Notes no mark sees are left out."""
    f = first.select(pid, millis("first_ts").alias("_f"))
    since = millis(ts) - F.col("_f")
    mark = reduce(add, [F.when(since >= h * MS_HOUR, 1).otherwise(0) for h in hours])
    return notes.join(f, pid, "inner").withColumn("mark", mark).filter(F.col("mark") < len(hours)).drop("_f")


#: Values of the topic matrices (k x V each) of the LDA fits that run at once. The
#: driver holds about a dozen matrices of a fit (topics, broadcasts, sums of tasks).
FIT_VALUES = 6_000_000


def fits_at_once(k: int, terms: int, parallelism: int) -> int:
    """How many LDA fits of ``terms`` terms the driver may hold at a time."""
    return max(1, min(int(parallelism), FIT_VALUES // max(1, int(k) * int(terms))))


def held_terms(k: int, terms: int) -> int:
    """Terms of a Spark ML fit that holds as much on the driver as an online fit
    does, of which there are three copies of a broadcast of four-byte numbers."""
    return min(int(terms), BROADCAST_VALUES // (8 * int(k)))


def hourly_topic_model(inp: StudyInputs, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """EXP-2: at every hour mark keep notes before first + h, fit LDA on the
    train subjects' notes, SVM on their topic mixtures, evaluate on the test
    subjects (their notes transformed by the train topics unless
    ``refit_test_topics``). Tokens are counted once for all marks; one
    fit per hour mark, one metrics pass over all marks. Marks run at the
    same time; their LDA fits only as far as ``fits_at_once`` allows, and a
    mark's topics and vectors are deleted when its points are written."""
    spark = inp.tokens.sparkSession
    hours = sorted({int(h) for h in cfg.topic_hours})
    later = [h for h in hours if h > 0]
    parts = [_restrict(inp.tokens, s).withColumn("part", F.lit(name)) for name, s in (("train", inp.train), ("test", inp.test))]
    tok = parts[0].unionByName(parts[1])
    marked = _marked(tok, inp.first, later) if later else None

    def cubes(notes: DataFrame, marks: int) -> tuple[TopicCube, TopicCube]:
        notes = materialize(notes.select("pid", "part", "mark", "tokens"))
        own = TopicCube(notes, marks)
        return own, TopicCube(notes, marks, vocabulary_of="test") if cfg.refit_test_topics else own

    jobs = []
    if later:
        pair = cubes(marked, len(later))
        jobs += [(h, m, pair) for m, h in enumerate(later)]
    if len(later) < len(hours):            # marks up to 0 see all notes
        pair = cubes(tok.withColumn("mark", F.lit(0)), 1)
        jobs += [(h, 0, pair) for h in hours if h <= 0]

    def points(vectors: DataFrame, lda) -> DataFrame:
        mixed = op.mean_vector_by_key(lda.transform(vectors), [c for c in ("pid", "part") if c in vectors.columns], "topic_mix", out="features")
        return _points_with_ids(mixed, inp.labels, tuple(c for c in ("part",) if c in vectors.columns))

    online = cfg.lda_optimizer == "online"
    largest = max((c.sizes[-1] for _, _, pair in jobs for c in pair), default=0)
    room = BoundedSemaphore(fits_at_once(cfg.lda_k, held_terms(cfg.lda_k, largest) if online else largest, cfg.parallelism))
    fit = {"seed": cfg.seed, "optimizer": cfg.lda_optimizer}

    def written_vectors(m: int, train: TopicCube, test: TopicCube) -> tuple[DataFrame, DataFrame]:
        """Spark ML's models need vectors, which are written; they go with the call."""
        paths = scratch_path(spark, "vectors"), scratch_path(spark, "vectors")
        mine, theirs = train.vectors(m, "train", paths[0]), test.vectors(m, "test", paths[1])
        with room:
            lda = fit_lda(mine, cfg.lda_k, cfg.lda_iterations, **fit)
            tr_pts = points(mine, lda)
            if cfg.refit_test_topics:
                lda = fit_lda(theirs, cfg.lda_k, cfg.lda_iterations, **fit)
            te_pts = points(theirs, lda)
        drop_scratch(spark, *paths)
        return tr_pts, te_pts

    def both_points(m: int, train: TopicCube, test: TopicCube) -> tuple[DataFrame, DataFrame]:
        """Written points of a mark; its models go with the call."""
        if not online:
            return written_vectors(m, train, test)
        with room:
            lda = fit_lda(train.terms(m, "train"), cfg.lda_k, cfg.lda_iterations, **fit)
            if not cfg.refit_test_topics:                   # the mixtures of both parts in one pass
                both = points(train.terms(m, "train", "test"), lda)
                lda.drop()
                return tuple(both.filter(F.col("part") == name).drop("part") for name in ("train", "test"))
            tr_pts = points(train.terms(m, "train"), lda)
            lda.drop()
            lda = fit_lda(test.terms(m, "test"), cfg.lda_k, cfg.lda_iterations, **fit)
            te_pts = points(test.terms(m, "test"), lda)
            lda.drop()
        return tr_pts.drop("part"), te_pts.drop("part")

    def at(job: tuple) -> DataFrame:
        h, m, (train, test) = job
        tr_pts, te_pts = both_points(m, train, test)
        model = _fit(tr_pts, cfg.svm_iterations, cfg.hourly_topic_reg, cfg.intercept, cfg, None)
        return _scored(model, tr_pts, te_pts, h)

    # a fit is a chain of small jobs: several marks at once keep the cluster busy
    with ThreadPool(max(1, cfg.parallelism)) as pool:
        scored = reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(at), jobs))
    for cube in {id(c): c for _, _, pair in jobs for c in pair}.values():
        cube.drop()
    return _split_metrics(scored, cfg)


def derived_model(inp: StudyInputs, cfg: StudyConfig = StudyConfig(), *,
                  grid: Mapping | None = None) -> DataFrame:
    """EXP-4: 3 baseline + 30 flag features; with ``grid`` the SVM settings
    are chosen by k-fold mean AUC on the train subjects first."""
    feats = op.derived_features(inp.cohort, inp.scores, inp.flags)
    pts = _points_with_ids(feats, inp.labels)
    train, test = _restrict(pts, inp.train), _restrict(pts, inp.test)
    model = _fit(train, cfg.svm_iterations, cfg.derived_reg, cfg.intercept, cfg, grid)
    return _split_metrics(_scored(model, train, test), cfg)


def build_inputs(spark: SparkSession, subjects: DataFrame, episodes: DataFrame, notes: DataFrame,
                 scores: DataFrame, flags: DataFrame, *, stopwords=None, label_kind: str = "in_episode",
                 train_proportion: float = TRAIN_PROPORTION, seed: int = 0, exact: bool = True,
                 rebalance: bool = True, attach: Callable[[DataFrame], DataFrame] | None = None) -> tuple[StudyInputs, StudyInputs]:
    """Cohort, note cohort, labels, split; returns (inputs with the
    rebalanced train set, inputs with the full train set). Split and
    rebalancing are exact unless ``exact`` is False. Where the texts lie apart
    from the notes, ``attach`` adds them to the in-episode notes only."""
    cohort = op.build_cohort(subjects, episodes)
    inep = op.notes_in_episode(cohort, notes, carry=op.text.COHORT)
    tokens = note_tokens(cohort, None, stopwords, notes_in_ep=attach(inep) if attach else inep)
    return inputs_from_tokens(tokens, scores, flags,
                              label_kind=label_kind, train_proportion=train_proportion, seed=seed, exact=exact,
                              rebalance=rebalance)


def note_tokens(cohort: DataFrame, notes: DataFrame | None, stopwords=None, *,
                notes_in_ep: DataFrame | None = None) -> DataFrame:
    """The tokenized in-episode notes with their cohort rows, written once:
    every other set of the study is derived from this table, so the notes are
    read and tokenized one time."""
    inep = notes_in_ep if notes_in_ep is not None else op.notes_in_episode(cohort, notes, carry=op.text.COHORT)
    return materialize(op.tokenize(inep, stopwords=stopwords))


def inputs_from_tokens(tokens: DataFrame, scores: DataFrame, flags: DataFrame, *, label_kind: str = "in_episode",
                       train_proportion: float = TRAIN_PROPORTION, seed: int = 0, exact: bool = True,
                       rebalance: bool = True) -> tuple[StudyInputs, StudyInputs]:
    """``build_inputs`` from the output of ``note_tokens``."""
    nc = op.note_cohort(None, tokens=tokens)
    kept = materialize(nc["subjects"])
    cohort, first = kept.drop("first_ts"), kept.select("pid", "first_ts")
    labels = materialize(op.label_events(cohort, label_kind))
    train, test = op.split_subjects(labels, train_proportion, seed, exact=exact)
    full = StudyInputs(cohort, first, nc["tokens"], scores, flags, labels, train.select("pid"), test.select("pid"))
    if not rebalance:
        return full, full
    sub = op.rebalance_negatives(train, "label", exact=exact, seed=seed).select("pid")
    return replace(full, train=sub), full


def run_study(inputs: tuple[StudyInputs, StudyInputs], cfg: StudyConfig = StudyConfig(), *,
              topic_sweep: bool = True, baseline_grid: Mapping | None = None,
              derived_grid: Mapping | None = None) -> dict[str, DataFrame]:
    """All experiments; the rebalanced train set feeds EXP-1 and EXP-3, the
    full one EXP-2 and EXP-4, as in the study. With grids, EXP-1 and EXP-4
    choose their SVM settings by cross-validation."""
    sub, full = inputs
    out = {"baseline": baseline_model(sub, cfg, grid=baseline_grid)[0],
           "retrospective_topics": retrospective_topic_model(sub, cfg),
           "derived": derived_model(full, cfg, grid=derived_grid)}
    if topic_sweep:
        out["hourly_topics"] = hourly_topic_model(full, cfg)
    return out


def study_summary(results: dict[str, DataFrame]) -> DataFrame:
    """One table: experiment, split, hour, total, positives, auc."""
    parts = []
    for name, df in results.items():
        hour = F.col("hour").cast("int") if "hour" in df.columns else F.lit(None).cast("int")
        parts.append(df.select(F.lit(name).alias("experiment"), "split", hour.alias("hour"),
                               "total", "positives", "auc"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


__all__ = ["StudyConfig", "StudyInputs", "baseline_model", "build_inputs", "derived_model",
           "hourly_auc", "hourly_topic_model", "inputs_from_tokens", "linear_score", "note_tokens",
           "retrospective_topic_model", "run_study", "study_summary", "fit_topics"]


def main(argv: list[str] | None = None) -> None:
    """Run the whole study from a folder of raw CSV exports.

        python -m cohortlab.plans.study --data DIR --out DIR [--stopwords FILE]

    Uses the active Spark session (e.g. under spark-submit); ``--master``
    builds a local one instead. Writes the summary table (experiment, split,
    hour, total, positives, auc) as CSV to ``--out``.
    """
    import argparse

    from ..sources.csv_io import read_word_list
    from ..sources.raw import load_raw_tables
    ap = argparse.ArgumentParser(prog="python -m cohortlab.plans.study")
    ap.add_argument("--data", required=True, help="folder with the five CSV exports")
    ap.add_argument("--out", required=True, help="output folder for the summary CSV")
    ap.add_argument("--stopwords", help="text file, one stop word per line")
    ap.add_argument("--label", default="in_episode", choices=["in_episode", "30d", "1y"])
    ap.add_argument("--seed", type=int, default=0)
    ap.add_argument("--solver", default="linear_svc", choices=["linear_svc", "subgradient"],
                    help="Spark ML's solver or the study's full-batch subgradient descent")
    ap.add_argument("--svm-iterations", type=int, default=SVM_ITERATIONS)
    ap.add_argument("--lda-k", type=int, default=LDA_K)
    ap.add_argument("--lda-iterations", type=int, default=LDA_ITERATIONS)
    ap.add_argument("--lda-optimizer", default="online", choices=["em", "online"])
    ap.add_argument("--cross-validate", action="store_true",
                    help="choose the SVM settings of EXP-1 and EXP-4 on the study's grids")
    ap.add_argument("--hash-split", action="store_true", help="approximate split and rebalancing")
    ap.add_argument("--no-topic-sweep", action="store_true", help="skip the hourly topic models")
    ap.add_argument("--master", help="build a local session with this master instead")
    a = ap.parse_args(argv)
    if a.master:
        from ..session import build_session
        spark = build_session(master=a.master)
    else:
        spark = SparkSession.builder.getOrCreate()
    t = load_raw_tables(spark, a.data)
    stop = read_word_list(spark, a.stopwords) if a.stopwords else None
    inputs = build_inputs(spark, t["subjects"], t["episodes"], t["notes"], t["scores"], t["flags"],
                          stopwords=stop, label_kind=a.label, seed=a.seed, exact=not a.hash_split)
    cfg = StudyConfig(svm_iterations=a.svm_iterations, lda_k=a.lda_k, lda_iterations=a.lda_iterations,
                      seed=a.seed, lda_optimizer=a.lda_optimizer, solver=a.solver)
    grids = {"baseline_grid": BASELINE_GRID, "derived_grid": DERIVED_GRID} if a.cross_validate else {}
    summary = study_summary(run_study(inputs, cfg, topic_sweep=not a.no_topic_sweep, **grids))
    summary.write.mode("overwrite").option("header", True).csv(a.out)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
