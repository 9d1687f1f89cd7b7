from clickloom.functions.columns import (
    batch_file_name,
    event_weight,
    is_event,
    lost_id,
    positive_probability,
    restored_id,
    safe_ratio,
)

__all__ = [
    "batch_file_name",
    "event_weight",
    "is_event",
    "lost_id",
    "positive_probability",
    "restored_id",
    "safe_ratio",
]
