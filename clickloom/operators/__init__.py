from clickloom.operators.batching import assign_batches, batch_summary, select_batches
from clickloom.operators.dictionary import IdDictionary, number_ids
from clickloom.operators.features import (
    feature_parts,
    merged_parts,
    segment_counts,
    segment_features,
    segment_features_of,
    transaction_features,
    transaction_features_of,
    with_segment_ratios,
)
from clickloom.operators.filters import known_events, merge_batches, with_keys
from clickloom.operators.ranking import rank_items
from clickloom.operators.ratings import ratings
from clickloom.operators.scaling import assembled_features, scaled_features
from clickloom.operators.scoring import (
    DEFAULT_RECOMMENDATIONS,
    explode_recs,
    recommend,
    recommend_by_id,
    score_transactions,
    segment_users,
    with_ranked,
)

__all__ = [
    "DEFAULT_RECOMMENDATIONS",
    "IdDictionary",
    "assembled_features",
    "assign_batches",
    "batch_summary",
    "explode_recs",
    "feature_parts",
    "known_events",
    "merge_batches",
    "merged_parts",
    "number_ids",
    "rank_items",
    "ratings",
    "recommend",
    "recommend_by_id",
    "scaled_features",
    "score_transactions",
    "segment_counts",
    "segment_features",
    "segment_features_of",
    "segment_users",
    "select_batches",
    "transaction_features",
    "transaction_features_of",
    "with_keys",
    "with_ranked",
    "with_segment_ratios",
]
