"""End-to-end jobs composed from the operators."""

from .answers import RoleModel, analyse_postings, answer_questions, load_role_model, train_role_model
from .dataset import labelled_postings, stage_report, tagged_postings
from .training import (
    Settings,
    build_features,
    echo_robustness,
    engineered_only,
    engineered_only_cv,
    feature_ablation,
    published_candidates,
    skill_cv,
    skill_loo,
    skill_prediction,
    train_and_evaluate,
)

__all__ = [
    "RoleModel",
    "Settings",
    "analyse_postings",
    "answer_questions",
    "build_features",
    "echo_robustness",
    "engineered_only",
    "engineered_only_cv",
    "feature_ablation",
    "labelled_postings",
    "load_role_model",
    "published_candidates",
    "skill_cv",
    "skill_loo",
    "skill_prediction",
    "stage_report",
    "tagged_postings",
    "train_and_evaluate",
    "train_role_model",
]
