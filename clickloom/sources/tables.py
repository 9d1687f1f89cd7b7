"""The ``events`` test table in the clickstream layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TABLE_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# The table's event types that stand for a known clickstream type; others stay as they are.
_KINDS = {"view": "view", "click": "addtocart", "purchase": "transaction"}


def clickstream(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """The five event columns of ``<sf_dir>/events.parquet``, and the table's own columns in ``keep``."""
    table = spark.read.schema(_TABLE_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    # subtracting zone-less timestamps gives the same result under any session time zone; a
    # thousand times the interval has as many whole seconds as the interval has milliseconds
    millis = F.expr("cast(cast((ts - timestamp_ntz'1970-01-01') * 1000 as interval second) as bigint)")
    return table.select(
        *keep,
        millis.alias("timestamp"),
        F.col("user_id").cast("int").alias("visitorid"),
        F.coalesce(*[F.when(kind == F.lit(a), F.lit(b)) for a, b in _KINDS.items()], kind).alias("event"),
        F.get_json_object("props", "$.k").cast("int").alias("itemid"),
        F.when(kind == F.lit("purchase"), F.col("event_id")).alias("transactionid"),
    )
