"""Events as weighted visitor-item observations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import event_weight
from clickloom.operators.filters import known_events, with_keys
from clickloom.schema import EVENT_WEIGHTS


def ratings(
    df: DataFrame,
    weights: Mapping[str, float] = EVENT_WEIGHTS,
    dedupe: str | None = None,
) -> DataFrame:
    """``visitorid_int, itemid_int, rating``: one row per event with a positive weight.

    A repeated pair stays repeated, so it weighs more in a fit. ``dedupe="max"`` keeps
    the strongest event of each pair instead; it combines before its one shuffle and
    bounds the rows of the busiest visitor by the number of items.

    Ids must fit 32 bits; under ANSI casts a larger one stops the job.
    """
    if dedupe not in (None, "max"):
        raise ValueError(f"dedupe must be None or 'max', not {dedupe!r}")
    observations = (
        with_keys(known_events(df, weights))
        .select(
            F.col("visitorid").cast("int").alias("visitorid_int"),
            F.col("itemid").cast("int").alias("itemid_int"),
            event_weight("event", weights).alias("rating"),
        )
        .filter(F.col("rating") > 0)
    )
    if dedupe is None:
        return observations
    return observations.groupBy("visitorid_int", "itemid_int").agg(F.max("rating").alias("rating"))
