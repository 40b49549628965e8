"""Linear SVM by full-batch subgradient descent, many models at once.

The study's solver: weights start at zero; in iteration t the mean hinge
subgradient over the training points is followed by a step of 1/sqrt(t), and the
weights shrink by the factor 1 - reg/sqrt(t) (also the intercept's, which is the
weight of a constant feature). Nothing is drawn, so weights are reproducible to
rounding. The factor is a contraction only from t > reg**2 / 4 on: with reg = 100
weights grow for the first 2,500 iterations, in the study as well; use a
smaller reg where weights matter.

A grid search needs a model for each (intercept, reg, held-out fold); models that
differ in the number of iterations alone are one trajectory, read off at
several iterations. One pass over the points moves all trajectories: every
partition multiplies its block of points with the matrix of all weights and
returns one partial subgradient a model. Points are read once an iteration, not
once a model.

Points of at most ``LOCAL_BYTES`` go to the trajectories instead (a broadcast of
checked size) and each task walks some trajectories to the end: one job, not one
an iteration. Both ways do the same arithmetic and differ in the order of sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BASELINE_GRID, N_FOLDS, SVM_ITERATIONS, SVM_REG
from ..operators.metrics import auc_by_rank
from ..operators.sampling import fold_assignment
from ..session import materialize

#: Bytes of points that may be broadcast.
LOCAL_BYTES = 32 << 20
STEP = 1.0
#: No fold has this number: nothing is held out.
NO_FOLD = -1


@dataclass(frozen=True)
class Trajectory:
    """One series of weights: all points but those of ``held_out`` train it."""
    intercept: bool
    reg: float
    held_out: int = NO_FOLD


def _subgradients(x: np.ndarray, y: np.ndarray, fold: np.ndarray, w: np.ndarray, bias: np.ndarray,
                  held_out: np.ndarray) -> np.ndarray:
    """(models, features + 1): sums over the points a model trains on."""
    inside = y[:, None] * (x @ w.T) < 1.0
    inside &= fold[:, None] != held_out[None, :]
    g = -((inside * y[:, None]).T @ x)
    g[:, -1] *= bias
    return g


def _moved(w: np.ndarray, g: np.ndarray, n: np.ndarray, reg: np.ndarray, t: int, step: float) -> np.ndarray:
    size = step / np.sqrt(float(t))
    with np.errstate(over="ignore", invalid="ignore"):
        return w * (1.0 - size * reg)[:, None] - size * g / np.maximum(n, 1)[:, None]


def _arrays(b: pa.RecordBatch | pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features with a constant last, label as -1/1, fold)."""
    flat = b.column("x").combine_chunks() if isinstance(b, pa.Table) else b.column("x")
    x = np.ones((b.num_rows, width + 1))
    x[:, :width] = flat.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
    return x, np.where(b.column("label").to_numpy() > 0, 1.0, -1.0), b.column("fold").to_numpy()


def _table(points: DataFrame, features: str, label: str, fold: str | None) -> DataFrame:
    v = F.col(features)
    if isinstance(points.schema[features].dataType, VectorUDT):
        v = vector_to_array(v)
    held = F.lit(0) if fold is None else F.col(fold)
    return points.select(v.alias("x"), F.col(label).cast("double").alias("label"), held.cast("int").alias("fold"))


def descend(points: DataFrame, trajectories: Sequence[Trajectory], iterations: Sequence[int], *, features: str = "features",
            label: str = "label", fold: str | None = None, step: float = STEP,
            local_bytes: int = LOCAL_BYTES) -> dict[int, np.ndarray]:
    """{iterations: weights}, one row a trajectory, the intercept last (0 if
    it has none). ``points`` should be a written table or checkpoint; all feature
    vectors have one length. Without points all weights are zero."""
    spark = points.sparkSession
    marks = sorted({int(t) for t in iterations})
    src = _table(points, features, label, fold)
    row = src.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.min(F.size("x")).alias("least")).first()
    width = row["d"] or 0
    if row["d"] != row["least"]:
        raise ValueError(f"feature vectors of {row['least']} to {row['d']} numbers")
    bias = np.array([float(t.intercept) for t in trajectories])
    reg = np.array([t.reg for t in trajectories])
    held_out = np.array([t.held_out for t in trajectories])
    if not row["n"]:
        return {t: np.zeros((len(trajectories), width + 1)) for t in marks}
    if row["n"] * (width + 2) * 8 <= local_bytes:
        return _by_trajectory(spark, src, width, bias, reg, held_out, marks, step)
    per_fold = {r["fold"]: r["n"] for r in src.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = np.array([row["n"] - (per_fold.get(int(h), 0) if h != NO_FOLD else 0) for h in held_out])
    return _by_iteration(spark, src.persist(), width, bias, reg, held_out, n, marks, step)


def _by_iteration(spark, src: DataFrame, width: int, bias, reg, held_out, n, marks, step) -> dict[int, np.ndarray]:
    w, out = np.zeros((len(reg), width + 1)), {}
    for t in range(1, marks[-1] + 1):
        sent = spark.sparkContext.broadcast(w)

        def partial(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            g = np.zeros((len(reg), width + 1))
            for b in batches:
                g += _subgradients(*_arrays(b, width), sent.value, bias, held_out)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(g)), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))],
                                             names=["model", "g"])

        # one row a model and partition, summed per model
        sums = (src.mapInArrow(partial, "model int, g array<double>").groupBy("model")
                .agg(Summarizer.sum(array_to_vector("g")).alias("g")).collect())
        g = np.zeros_like(w)
        for r in sums:
            g[r["model"]] = r["g"].toArray()
        w = _moved(w, g, n, reg, t, step)
        sent.unpersist()
        if t in marks:
            out[t] = w
    src.unpersist()
    return out


def _by_trajectory(spark, src: DataFrame, width: int, bias, reg, held_out, marks, step) -> dict[int, np.ndarray]:
    held = spark.sparkContext.broadcast(_arrays(src.toArrow(), width))
    models = len(reg)
    tasks = min(models, max(1, spark.sparkContext.defaultParallelism))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array(sorted(i for b in batches for i in b.column(0).to_pylist()), dtype=np.int64)
        if not len(own):
            return
        x, y, fold = held.value
        n = (fold[:, None] != held_out[own][None, :]).sum(axis=0)
        w = np.zeros((len(own), width + 1))
        for t in range(1, marks[-1] + 1):
            with np.errstate(over="ignore", invalid="ignore"):
                g = _subgradients(x, y, fold, w, bias[own], held_out[own])
            w = _moved(w, g, n, reg[own], t, step)
            if t in marks:
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(np.full(len(own), t), pa.int32()),
                                                  pa.array(list(w), pa.list_(pa.float64()))], names=["model", "t", "w"])

    ids = spark.range(0, models, 1, tasks)
    out = {t: np.zeros((models, width + 1)) for t in marks}
    for r in ids.mapInArrow(walk, "model int, t int, w array<double>").collect():
        out[r["t"]][r["model"]] = r["w"]
    held.unpersist()
    return out


def fit_svm_subgradient(points: DataFrame, iterations: int = SVM_ITERATIONS, reg: float = SVM_REG, intercept: bool = True, *,
                        features: str = "features", label: str = "label", step: float = STEP):
    """Linear SVM on (label, features) by the study's solver."""
    from .models import LinearModel
    w = descend(points, [Trajectory(bool(intercept), float(reg))], [iterations], features=features, label=label, step=step)
    w = w[int(iterations)][0]
    return LinearModel([float(v) for v in w[:-1]], float(w[-1]))


def grid_points(grid: Mapping[str, Sequence]) -> list[tuple[bool, int, float]]:
    """(intercept, iterations, reg) in the study's order."""
    return [(bool(i), int(t), float(r)) for i in grid["intercept"] for t in grid["iterations"] for r in grid["reg"]]


def _held_out_scores(points: DataFrame, weights: dict[tuple[int, int], np.ndarray], n_grid: int, width: int) -> DataFrame:
    """(grid_point, fold, score, label): every point under each grid point's
    model that did not train on its fold. Equal points have equal scores."""
    held = points.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                x, y, fold = _arrays(part, width)
                for g in range(n_grid):
                    s = np.zeros(len(y))
                    for f in np.unique(fold):
                        at, w = fold == f, held.value[g, int(f)]
                        with np.errstate(over="ignore", invalid="ignore"):
                            for j in range(width + 1):
                                s[at] += x[at, j] * w[j]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(y), g), pa.int32()), part.column("fold"), pa.array(s), part.column("label")],
                        names=["grid_point", "fold", "score", "label"])

    return points.mapInArrow(run, "grid_point int, fold int, score double, label double")


def cv_grid_subgradient(points: DataFrame, grid: Mapping[str, Sequence] = BASELINE_GRID, k: int = N_FOLDS, *, seed: int = 0,
                        key: str = "pid", features: str = "features", label: str = "label",
                        step: float = STEP) -> tuple[DataFrame, dict]:
    """k-fold grid search by mean AUC with the study's solver; the first grid
    point with the highest mean wins. One row a grid point, and the best
    settings, as ``cv_grid`` gives them."""
    spark = points.sparkSession
    data = materialize(fold_assignment(points, k, seed, key=key).select(features, label, "fold"))
    rows = grid_points(grid)
    pairs = sorted({(i, r) for i, _, r in rows})
    trajectories = [Trajectory(i, r, f) for i, r in pairs for f in range(k)]
    found = descend(data, trajectories, grid["iterations"], features=features, label=label, fold="fold", step=step)
    width = next(iter(found.values())).shape[1] - 1
    weights = {(g, f): found[t][pairs.index((i, r)) * k + f] for g, (i, t, r) in enumerate(rows) for f in range(k)}
    scored = _held_out_scores(_table(data, features, label, "fold"), weights, len(rows), width)
    # one number a grid point and fold
    auc = {(r["grid_point"], r["fold"]): r["auc"] for r in auc_by_rank(scored, by=["grid_point", "fold"]).collect()}
    means = []
    for g in range(len(rows)):
        own = [auc[g, f] for f in range(k) if auc.get((g, f)) is not None]
        means.append(reduce(add, own) / len(own) if own else None)   # plain sums, unlike sum()
    known = [g for g, m in enumerate(means) if m is not None]
    best = max(known, key=lambda g: (means[g], -g)) if known else 0
    out = spark.createDataFrame([(g, i, t, r, means[g], g == best) for g, (i, t, r) in enumerate(rows)],
                                "grid_point int, intercept boolean, iterations int, reg double, mean_auc double, best boolean")
    i, t, r = rows[best]
    return out, {"intercept": i, "iterations": t, "reg": r, "mean_auc": means[best]}
