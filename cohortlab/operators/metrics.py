"""Evaluation metrics as DataFrame aggregates.

AUC is the exact Mann-Whitney statistic with tie-averaged ranks:

    AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s) / 2) / (P * N)

which equals the trapezoid area under the ROC curve with ties (what
``BinaryClassificationMetrics`` / ``BinaryClassificationEvaluator(numBins=0)``
report). neg_below is a prefix sum over the score order; computing it with
one window over all scores would put every distinct score in one task. So
rows are first collapsed per distinct score (map-side combine), the result is
range-partitioned by (group, score) and checkpointed, one total per
(partition, group) gives the partition's offset, and the prefix sum runs
inside each partition. Infinite scores are ordinary scores; NaN is above all.

``auc_by_rank`` and ``binary_metrics`` write that checkpoint when they are
called; everything after it is lazy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.loaders import table_counts
from .sampling import label_balance  # noqa: F401  (re-exported)


def _by(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(a.cast("double") / b.cast("double"))


def prediction(score: str, threshold: float | None) -> Column:
    """1/0 prediction; ``threshold=None`` keeps the raw score (the study
    compared raw margins with labels)."""
    if threshold is None:
        return F.col(score).cast("double")
    return F.when(F.col(score) > F.lit(float(threshold)), 1.0).otherwise(0.0)


def per_score_counts(df: DataFrame, score: str = "score", label: str = "label", *,
                     by: str | Sequence[str] | None = None) -> DataFrame:
    """(by..., score, _pos, _neg): rows collapsed per distinct score.

    Every metric below is computed from this one aggregate (partial
    aggregation before the shuffle), so the input is read once even when
    confusion counts and AUC are both wanted. Rows with a NULL score are not
    counted by any metric. Labels are 0/1 (positive when > 0).
    """
    g = _by(by)
    pos = F.when(F.col(label) > 0, 1).otherwise(0)
    return (df.filter(F.col(score).isNotNull()).groupBy(*g, score)
            .agg(F.sum(pos).cast("bigint").alias("_pos"), F.sum(1 - pos).cast("bigint").alias("_neg")))


def _confusion_aggs(score: str, threshold: float | None) -> list[Column]:
    s = F.col(score)

    def tot(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    if threshold is None:     # raw margin compared with the label, as in the study
        tp, tn = tot(F.when(s == 1.0, F.col("_pos"))), tot(F.when(s == 0.0, F.col("_neg")))
        return [tp.alias("tp"), (tot(F.col("_neg")) - tn).alias("fp"), tn.alias("tn"),
                (tot(F.col("_pos")) - tp).alias("fn")]
    above = s > F.lit(float(threshold))
    return [tot(F.when(above, F.col("_pos"))).alias("tp"), tot(F.when(above, F.col("_neg"))).alias("fp"),
            tot(F.when(~above, F.col("_neg"))).alias("tn"), tot(F.when(~above, F.col("_pos"))).alias("fn")]


def confusion_counts(df: DataFrame, score: str = "score", label: str = "label", *,
                     threshold: float | None = 0.0, by: str | Sequence[str] | None = None,
                     per_score: DataFrame | None = None) -> DataFrame:
    """tp, fp, tn, fn (bigint). Prediction is score > threshold (1/0); a row
    is correct when prediction == label and positive when label > 0."""
    g = _by(by)
    ps = per_score if per_score is not None else per_score_counts(df, score, label, by=g or None)
    aggs = _confusion_aggs(score, threshold)
    return ps.groupBy(*g).agg(*aggs) if g else ps.agg(*aggs)


def _ranked(ps: DataFrame, score: str, g: list[str]) -> DataFrame:
    """Per-score rows with ``_below`` = negatives with a smaller score in the
    same group.

    The rows are range-partitioned by (group, score); a partition is as large
    as the session's shuffle partitions are. Totals are one row per
    (partition, group): as many as there are partitions and groups.
    """
    s = materialize(ps.repartitionByRange(*g, score).withColumn("_part", F.spark_partition_id()))
    totals = s.groupBy(*g, "_part").agg(F.sum("_neg").alias("_pneg"))
    before = Window.partitionBy(*g).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_g_{c}") for c in g], F.col("_part").alias("_p"),
                            F.coalesce(F.sum("_pneg").over(before), F.lit(0)).alias("_off"))
    cond = (F.col("_part") == F.col("_p"))
    for c in g:
        cond = cond & s[c].eqNullSafe(F.col(f"_g_{c}"))
    inside = Window.partitionBy(*g, "_part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    return (s.join(offsets, cond, "inner")
            .withColumn("_below", F.col("_off") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))))


def _auc_aggs() -> list[Column]:
    contrib = F.col("_pos").cast("double") * (F.col("_below").cast("double") + F.col("_neg") / 2.0)
    return [F.sum(contrib).alias("_c"), F.sum("_pos").cast("bigint").alias("n_pos"),
            F.sum("_neg").cast("bigint").alias("n_neg")]


def _auc_col() -> Column:
    return _safe_div(F.col("_c"), F.col("n_pos") * F.col("n_neg"))


def auc_by_rank(df: DataFrame, score: str = "score", label: str = "label", *,
                by: str | Sequence[str] | None = None, out: str = "auc",
                per_score: DataFrame | None = None) -> DataFrame:
    """Exact AUC (ties averaged) per ``by`` group; NULL without positives or
    negatives. Also returns ``n_pos`` and ``n_neg``."""
    g = _by(by)
    ps = per_score if per_score is not None else per_score_counts(df, score, label, by=g or None)
    ranked = _ranked(ps, score, g)
    res = ranked.groupBy(*g).agg(*_auc_aggs()) if g else ranked.agg(*_auc_aggs())
    return res.select(*g, _auc_col().alias(out), "n_pos", "n_neg")


def binary_metrics(df: DataFrame, score: str = "score", label: str = "label", *,
                   by: str | Sequence[str] | None = None, threshold: float | None = 0.0) -> DataFrame:
    """total, positives, auc, accuracy, sensitivity, specificity per group.

    Confusion counts and the AUC sum come out of the same final aggregate
    over the ranked per-score rows, so there is no join of results."""
    g = _by(by)
    ranked = _ranked(per_score_counts(df, score, label, by=g or None), score, g)
    aggs = _auc_aggs() + _confusion_aggs(score, threshold)
    j = ranked.groupBy(*g).agg(*aggs) if g else ranked.agg(*aggs)
    total = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    positives = F.col("tp") + F.col("fn")
    negatives = F.col("fp") + F.col("tn")
    return j.select(
        *g, total.alias("total"), positives.alias("positives"), _auc_col().alias("auc"),
        _safe_div(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        _safe_div(F.col("tp"), positives).alias("sensitivity"),
        _safe_div(F.col("tn"), negatives).alias("specificity"))


def binary_metrics_over_marks(df: DataFrame, marks: Sequence[int], until: str, score: str = "score", label: str = "label", *,
                              out: str = "mark", threshold: float | None = 0.0) -> DataFrame:
    """``binary_metrics`` at each of ``marks`` (ascending) of rows that are
    present at the first ``until`` marks: (out, total, positives, auc, ...),
    without the marks at which no row is present.

    A row is not repeated for each mark. It counts once, at its last mark, in the
    counts of its score; sums from the last mark backwards turn these into the
    counts of every mark, and one pass over the scores in order gives all marks'
    ranks at once."""
    hs, n = [int(m) for m in marks], len(marks)
    if not n:
        return df.sparkSession.createDataFrame([], f"{out} int, total bigint, positives bigint, auc double, accuracy double, "
                                                   "sensitivity double, specificity double")
    pos = F.col(label) > 0

    def at(k: int, c: Column) -> Column:
        return F.sum(F.when(c & (F.col("_until") == k), 1).otherwise(0)).cast("bigint")

    last = (df.filter(F.col(score).isNotNull() & (F.col(until) > 0)).withColumn("_until", F.least(F.col(until), F.lit(n))).groupBy(score)
            .agg(*[at(k, pos).alias(f"_dp{k}") for k in range(1, n + 1)],
                 *[at(k, F.coalesce(~pos, F.lit(True))).alias(f"_dn{k}") for k in range(1, n + 1)]))
    # present at mark i: all whose last mark is i or a later one
    def present(kind: str, i: int) -> Column:
        return reduce(add, [F.col(f"_d{kind}{k}") for k in range(i + 1, n + 1)])

    ps = last.select(score, *[present("p", i).alias(f"_p{i}") for i in range(n)], *[present("n", i).alias(f"_n{i}") for i in range(n)])
    s = materialize(ps.repartitionByRange(score).withColumn("_part", F.spark_partition_id()))
    totals = s.groupBy(F.col("_part").alias("_p")).agg(*[F.sum(f"_n{i}").alias(f"_t{i}") for i in range(n)])
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)   # one row a partition
    offsets = totals.select("_p", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(n)])
    inside = Window.partitionBy("_part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = s.join(F.broadcast(offsets), F.col("_part") == F.col("_p")).select(
        score, *[f"_p{i}" for i in range(n)], *[f"_n{i}" for i in range(n)],
        *[(F.col(f"_o{i}") + F.coalesce(F.sum(f"_n{i}").over(inside), F.lit(0))).alias(f"_b{i}") for i in range(n)])
    v = F.col(score)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    aggs = []
    for i in range(n):
        p, q = F.col(f"_p{i}"), F.col(f"_n{i}")
        yes, no = (v == 1.0, v == 0.0) if threshold is None else (v > F.lit(float(threshold)), ~(v > F.lit(float(threshold))))
        aggs.append(F.struct(F.lit(hs[i]).alias(out), F.sum(p.cast("double") * (F.col(f"_b{i}").cast("double") + q / 2.0)).alias("_c"),
                             total(p).alias("n_pos"), total(q).alias("n_neg"), total(F.when(yes, p)).alias("tp"),
                             total(F.when(no, q)).alias("tn")).alias(f"_m{i}"))
    m = ranked.agg(*aggs).select(F.inline(F.array(*[F.col(f"_m{i}") for i in range(n)])))
    both = F.col("n_pos") + F.col("n_neg")
    return m.filter(both > 0).select(
        out, both.alias("total"), F.col("n_pos").alias("positives"), _auc_col().alias("auc"),
        _safe_div(F.col("tp") + F.col("tn"), both).alias("accuracy"), _safe_div(F.col("tp"), F.col("n_pos")).alias("sensitivity"),
        _safe_div(F.col("tn"), F.col("n_neg")).alias("specificity"))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, n) row counts of named intermediate results, one DataFrame."""
    return table_counts(stages, name_col="stage", count_col="n")
