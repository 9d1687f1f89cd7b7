"""The n-th highest value of a column, in passes that each narrow down where it lies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = 512


def nth_highest(rows: DataFrame, value: str, weight: str, n: int) -> float | None:
    """Each row counts ``weight`` times, a positive whole number; None with fewer than ``n``.

    A pass counts the rows in each of ``_PARTS`` parts of the range and goes on with the part that
    holds the value, until all values in it are the same. Only those counts reach the driver.
    """
    low, high, total = rows.agg(F.min(value), F.max(value), F.sum(weight)).first()
    if n > (total or 0):
        return None
    while low < high:
        part = F.least(F.floor((F.col(value) - low) / ((high - low) / _PARTS)), F.lit(_PARTS - 1))
        inside = rows.filter(F.col(value).between(low, high)).groupBy(part.alias("part"))
        counts = inside.agg(F.sum(weight).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for c in sorted(counts, reverse=True):
            if n <= c["n"]:
                low, high = c["low"], c["high"]
                break
            n -= c["n"]
    return low
