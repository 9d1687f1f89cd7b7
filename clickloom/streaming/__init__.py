from clickloom.streaming.features import read_feature_parts, stream_features
from clickloom.streaming.landing import BAD_COLUMN, land_stream
from clickloom.streaming.progress import batch_counts, stop_when_idle

__all__ = ["BAD_COLUMN", "batch_counts", "land_stream", "read_feature_parts", "stop_when_idle", "stream_features"]
