"""Plan-shape checks for the properties that matter at scale."""
import contextlib
import io

import __spark_entry__ as E
from cohortlab import operators as op


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_latest_episode_aggregates_before_shuffle(spark, sf_dir):
    from cohortlab.plans.catalog import Tables
    p = plan(op.latest_episode(Tables(spark, sf_dir).episodes()))
    assert "partial_max" in p            # map-side combine per subject
    assert "Window" not in p


def test_no_cartesian_products(spark, sf_dir):
    for name in ("notes_in_episode", "note_cohort", "hourly_auc_baseline", "present_after_hours",
                 "subtract_rows", "derived_features", "auc_by_rank", "binary_metrics", "confusion_counts",
                 "labeled_points_sparse", "split_exact", "rebalance_negatives", "mean_vector_by_key"):
        p = plan(E.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_tokenizer_evaluated_once(spark, sf_dir):
    p = plan(E.queries()["term_counts"](spark, sf_dir))
    assert p.count("RLIKE(") == 1
    assert "partial_count" in p


def test_interval_conditions_inside_join(spark, sf_dir):
    p = plan(E.queries()["notes_in_episode"](spark, sf_dir))
    assert "Join condition: (((_c_in" in p


def test_exact_split_is_a_filter(spark, sf_dir):
    from cohortlab.plans.catalog import Tables
    c = Tables(spark, sf_dir).cohort().select("pid")
    train, test = op.split_exact(c, 0.7, 1)
    for part in (train, test):
        p = plan(part)
        assert "Window" not in p and "TakeOrderedAndProject" not in p and "GlobalLimit" not in p


def test_scans_are_pruned(spark, sf_dir):
    p = plan(E.queries()["cohort_latest_episode"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p
