"""Cohort, text, sampling, feature and metric operators.

Every operator is ``fn(DataFrame, ..., *, column names) -> DataFrame``, built
from Spark SQL expressions. They are lazy, but for those that need a number or
a written table to build the plan: ``split_exact``, ``take_smallest`` and
``rebalance_negatives`` count, ``auc_by_rank``, ``binary_metrics``,
``binary_metrics_over_marks`` and ``dense_index`` write a checkpoint,
``labeled_points_sparse`` and ``with_sparse_vectors`` a table."""

from .cohort import (build_cohort, cohort_episodes, cohort_subjects, events_within_hours,
                     first_event, join_subject_episode, label_all, label_events, latest_episode,
                     notes_in_episode, notes_in_episode_binned, present_after_hours, restrict_to_subjects,
                     with_first_event)
from .features import (array_to_long, baseline_features_long, baseline_features_wide,
                       concat_features, derived_features, feature_dictionary, flag_vector,
                       labeled_points_dense, labeled_points_sparse, mean_vector_by_key, with_sparse_vectors)
from .metrics import auc_by_rank, binary_metrics, binary_metrics_over_marks, confusion_counts, stage_counts
from .sampling import (fold_assignment, label_balance, rebalance_negatives, split_exact,
                       smallest, split_hash, split_subjects, subtract_rows, take_smallest)
from .text import (dense_index, min_word_subjects, note_cohort, term_counts, tokenize, vocabulary,
                   words_per_subject)

__all__ = [n for n in dir() if not n.startswith("_")]
