"""Row filters and the union of batches."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.schema import EVENT_WEIGHTS


def known_events(df: DataFrame, kinds: Iterable[str] = tuple(EVENT_WEIGHTS)) -> DataFrame:
    """Rows whose event type is one of ``kinds``; the IN list is pushed to the scan."""
    return df.filter(F.col("event").isin(list(kinds)))


def with_keys(df: DataFrame) -> DataFrame:
    """Rows that name both a visitor and an item; both tests are pushed to the scan."""
    return df.filter(F.col("visitorid").isNotNull()).filter(F.col("itemid").isNotNull())


def merge_batches(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)
