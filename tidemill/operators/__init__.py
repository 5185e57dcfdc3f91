"""Feature, training-set, point-in-time and data-quality operators."""

from .asof import asof_join
from .features import all_features, experience_features, merged_experience_features, merged_user_features, session_features, user_features
from .quality import input_report, split_valid, validated_output
from .training import negatives, positives, ranking_set, two_tower

__all__ = [
    "all_features", "asof_join", "experience_features", "input_report", "merged_experience_features", "merged_user_features", "negatives", "positives", "ranking_set", "session_features", "split_valid", "two_tower", "user_features", "validated_output",
]
