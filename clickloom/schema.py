"""Column layout of the clickstream and of everything derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The event table's columns, in file order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
        T.StructField("visitorid", T.IntegerType()),
        T.StructField("event", T.StringType()),
        T.StructField("itemid", T.IntegerType()),
        T.StructField("transactionid", T.LongType()),  # only on transactions
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

# Producers that hold ids as floats, as they must where one is missing, write 4000.0 or NaN;
# so files and messages are read with ids as text and restored exactly afterwards.
ID_TYPES = {f.name: f.dataType for f in EVENT_SCHEMA.fields if f.name.endswith("id")}
WIRE_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name in ID_TYPES else f.dataType) for f in EVENT_SCHEMA.fields]
)

# Known event types and the rating each one stands for.
EVENT_WEIGHTS = {"view": 1.0, "addtocart": 3.0, "transaction": 5.0}

# Rows per landed batch.
BATCH_SIZE = 10_000

# Model inputs, in vector order.
TRANSACTION_FEATURES = ["num_views", "num_addtocart", "distinct_items_interacted"]
TRANSACTION_LABEL = "has_transaction"
SEGMENT_COUNTS = ["total_events", "total_views", "total_addtocart", "total_transactions"]
SEGMENT_RATIOS = ["view_ratio", "addtocart_ratio", "transaction_ratio"]
SEGMENT_FEATURES = SEGMENT_COUNTS + SEGMENT_RATIOS
