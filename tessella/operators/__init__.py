"""Operators: each takes DataFrames and rules, and returns a DataFrame."""

from ..session import durable
from .analytics import (
    band_by_f1,
    class_balance_eligibility,
    flag_frequency,
    gap_shift,
    rate_by_group,
    rate_gap,
    skill_frequencies,
    value_counts,
    value_shares,
)
from .cleaning import (
    dedupe_keep_first,
    dedupe_report,
    drop_missing,
    fill_missing_text,
    min_length_filter,
)
from .evaluation import (
    accuracy_macro_weighted,
    binary_metrics,
    classification_report,
    confusion_matrix,
    confusion_pct,
    cv_summary,
    majority_baseline,
    model_comparison,
    per_class_scores,
    roc_auc_ovr,
    select_best,
)
from .features import (
    degree_flags,
    echo_change_count,
    engineered_features,
    engineered_names,
    flag_names,
    group_counts,
    n_hits_total,
    one_hot,
    own_flags,
    pattern_inflation,
    strip_label_echo,
    tag_flags,
    taxonomy_features,
)
from .interpretation import top_signals_per_class, top_terms_per_class, top_weights
from .labelling import drop_unlabelled, map_category, route_query
from .learners import (
    Candidate,
    classify_ranked,
    cross_validate,
    fit_final_and_score,
    fit_linear_svm,
    fit_logreg,
    fit_naive_bayes,
    fit_random_forest,
)
from .retrieval import (
    answer_top_skills,
    build_corpus,
    build_index,
    load_index,
    grounding_quotes,
    retrieve_topk,
    skill_gap,
    top_sources,
    with_documents,
)
from .splits import (
    balanced_weights,
    class_counts,
    index_labels,
    split_quotas,
    stratified_folds,
    stratified_split,
)
from .vectorise import (
    TermTable,
    as_vectors,
    assemble,
    doc_frequency_audit,
    fit_tfidf,
    ngrams_1_2,
    per_group_tfidf,
    per_group_vocabulary,
    standardise,
    term_counts,
    tfidf,
    tfidf_transform,
    tokenize,
    vocabulary,
    weigh_per_group,
)

__all__ = [name for name in dir() if not name.startswith("_")]
