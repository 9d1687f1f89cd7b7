"""Events as JSON messages on a Kafka topic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import lost_id, restored_id
from clickloom.schema import EVENT_COLUMNS, ID_TYPES, WIRE_SCHEMA

_CORRUPT = "_corrupt_record"


def encode_events(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``value``: one JSON object per row with all event columns, nulls written out.

    Messages have no key, so a topic spreads a busy visitor over its partitions.
    """
    payload = F.struct(*EVENT_COLUMNS)
    return df.select(*keep, F.to_json(payload, {"ignoreNullFields": "false"}).alias("value"))


def decode_events(
    df: DataFrame, keep: Sequence[str] = (), mode: str = "FAILFAST", bad: str | None = None
) -> DataFrame:
    """The event columns out of ``value``.

    A message that is not JSON, or has an id that is none, stops the job. With
    ``mode="PERMISSIVE"`` its row has nulls instead, and its text in a column ``bad``, if named.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be 'FAILFAST' or 'PERMISSIVE', not {mode!r}")
    schema = T.StructType([*WIRE_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = F.col("value").cast("string")
    parsed = df.select(*keep, text.alias("_text"), F.from_json(text, schema, options).alias("e"))
    broken = F.col(f"e.{_CORRUPT}").isNotNull() | (F.col("e").isNull() & F.col("_text").isNotNull())
    broken = reduce(Column.__or__, (lost_id(f"e.{name}", kind) for name, kind in ID_TYPES.items()), broken)
    columns = {c: restored_id(f"e.{c}", ID_TYPES[c]) if c in ID_TYPES else F.col(f"e.{c}") for c in EVENT_COLUMNS}
    if mode == "FAILFAST":
        said = F.concat(F.lit("MALFORMED_RECORD: "), F.left("_text", F.lit(200)))
        stop = F.when(broken, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
        checked = parsed.filter(stop)
        return checked.select(*keep, *[c.alias(name) for name, c in columns.items()])
    texts = [F.when(broken, F.col("_text")).alias(bad)] if bad else []
    return parsed.select(*keep, *[F.when(~broken, c).alias(name) for name, c in columns.items()], *texts)


def publish_events(df: DataFrame, topic: str, servers: str, **options: str) -> None:
    """Every row of ``df`` as a message; tasks publish in parallel."""
    (
        encode_events(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


def stream_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_per_trigger: int = 50_000_000,
    mode: str = "FAILFAST",
    bad: str | None = None,
    **options: str,
) -> DataFrame:
    """A topic from its earliest message on, decoded, with ``partition`` and ``offset`` as order.

    A query that has a checkpoint goes on where it stopped instead. ``max_per_trigger``
    bounds a micro-batch; landed batches are cut to size whatever it is. ``mode`` and ``bad``
    say what becomes of broken messages, as in ``decode_events``.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .options(**options)
        .load()
    )
    return decode_events(raw, ("partition", "offset"), mode, bad)
