"""Features of visitors kept up to date from a stream.

Each micro-batch adds one part: for the visitors it holds, what it adds to their counts. Parts
are Parquet below the path, a folder for each step of the stream; reading adds them up by
visitor. A step that is repeated after a crash replaces its own folder, so that nothing counts
twice, and what was read of the stream is known to its checkpoint alone.

Distinct items are counted exactly or by sketches. For exact counts the stream keeps every
pair of visitor and item it has seen as state; keyed by the pair, a busy visitor is spread over
all tasks, and a part holds the pairs that were new. Sketches need no state: parts hold the
sketch of their own items, and sketches unite.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions import is_event
from clickloom.operators.features import feature_parts
from clickloom.schema import EVENT_SCHEMA, SEGMENT_COUNTS
from clickloom.sources.files import child_names

log = logging.getLogger(__name__)

_KINDS = dict(zip(SEGMENT_COUNTS[1:], ("view", "addtocart", "transaction")))


def stream_features(
    stream: DataFrame, path: str, checkpoint: str, distinct: str = "exact", processing_time: str | None = None
) -> StreamingQuery:
    """Start a query that adds the events of ``stream`` to the features below ``path``.

    The path belongs to the checkpoint: one that was written from another is an error, as the
    stream would be counted again from its earliest event on. The query takes what the source
    has and ends; with ``processing_time`` it goes on.
    """
    if distinct not in ("exact", "approximate"):
        raise ValueError(f"distinct must be 'exact' or 'approximate', not {distinct!r}")
    rows = _with_new_pairs(stream) if distinct == "exact" else stream
    parts_of = _sums if distinct == "exact" else feature_parts

    def add(batch: DataFrame, step: int) -> None:
        parts_of(batch).write.mode("overwrite").parquet(f"{path}/step={step}")

    spark = stream.sparkSession
    if child_names(spark, path) and not child_names(spark, checkpoint):
        raise ValueError(f"{path} has features of a stream with another checkpoint")
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _with_new_pairs(stream: DataFrame) -> DataFrame:
    """A row for each event with what it counts for, and one for each pair that wasn't there before."""

    def flag(holds: Column) -> Column:
        return F.coalesce(holds, F.lit(False)).cast("bigint")

    counts = [F.lit(1).cast("bigint").alias("total_events")]
    counts += [flag(is_event(kind)).alias(name) for name, kind in _KINDS.items()]
    none = F.lit(0).cast("bigint")
    pairs = stream.filter(F.col("itemid").isNotNull()).dropDuplicates(["visitorid", "itemid"])
    new = pairs.select("visitorid", *[none.alias(c) for c in SEGMENT_COUNTS], F.lit(1).cast("bigint").alias("new_items"))
    return stream.select("visitorid", *counts, none.alias("new_items")).unionByName(new)


def _sums(batch: DataFrame) -> DataFrame:
    return batch.groupBy("visitorid").agg(*[F.sum(c).alias(c) for c in (*SEGMENT_COUNTS, "new_items")])


def read_feature_parts(spark: SparkSession, path: str) -> DataFrame:
    """All parts below ``path``, for ``transaction_features_of`` and ``segment_features_of``."""
    if not child_names(spark, path):
        log.warning("no features below %s", path)
        return feature_parts(spark.createDataFrame([], EVENT_SCHEMA))
    return spark.read.parquet(path).drop("step")
