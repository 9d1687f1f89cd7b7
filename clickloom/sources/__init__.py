from clickloom.sources.csv_events import (
    corrupt_rows,
    load_events_csv,
    read_batch_files,
    read_events_csv,
    write_batch_files,
)
from clickloom.sources.landed import land_batches, read_batches
from clickloom.sources.messages import decode_events, encode_events, publish_events, stream_events
from clickloom.sources.model_store import load_models, save_model

__all__ = [
    "corrupt_rows",
    "decode_events",
    "encode_events",
    "land_batches",
    "load_events_csv",
    "load_models",
    "publish_events",
    "read_batch_files",
    "read_batches",
    "read_events_csv",
    "save_model",
    "stream_events",
    "write_batch_files",
]
