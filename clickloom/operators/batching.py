"""Cutting an ordered event log into numbered batches of a fixed number of rows.

A running row number over the whole log would sort it in one task. Here the order
key itself says which bucket a row belongs to, so that

* the bucket counts are a combined aggregate over the key column alone,
* a running sum over the counts gives the number of rows before each bucket, and
* rows are numbered inside their bucket, all buckets in parallel.

A bucket depends on nothing but the row's key: a task that is run again after a lost
executor puts the same rows in the same place, and nothing has to be checkpointed
between the passes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import batch_file_name
from clickloom.schema import BATCH_SIZE

_KEYS = ["_gap", "_bucket"]
_BUCKETS_PER_PARTITION = 8
_SAMPLES_PER_BUCKET = 64
_HOT_BUCKETS = 4


def assign_batches(
    df: DataFrame,
    order_by: str | Sequence[str],
    size: int = BATCH_SIZE,
    rows_before: int = 0,
) -> DataFrame:
    """Add ``batch_no`` (from 1) and ``is_final`` (the last batch, if it is not full).

    ``order_by`` is one numeric column, or two when the first has ties; together they
    must be unique and not null, else the job stops or the cut depends on chance.
    ``rows_before`` continues the numbering of rows landed earlier.

    The call starts two jobs over the order columns: a count, and a sample whose size
    follows the shuffle width and not the data.
    """
    if size < 1:
        raise ValueError(f"size must be positive, not {size}")
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if not 1 <= len(order) <= 2:
        raise ValueError("order_by takes one column and at most one tie-break")

    bucketed = _with_buckets(df, order)
    before = _rows_before_bucket(bucketed)
    in_bucket = Window.partitionBy(*_KEYS).orderBy(*order)
    seq = F.lit(rows_before) + F.col("_before") + F.col("_row")
    last_full = _div(F.lit(rows_before) + F.col("_total"), size)
    return (
        bucketed.withColumn("_row", F.row_number().over(in_bucket))
        .join(F.broadcast(before), _KEYS)
        .withColumn("batch_no", _div(seq - 1, size) + 1)
        .withColumn("is_final", F.col("batch_no") > last_full)
        .select(*df.columns, "batch_no", "is_final")
    )


def _div(rows: Column, size: int) -> Column:
    return F.call_function("div", rows, F.lit(size))


def _checked(df: DataFrame, order: list[str]) -> DataFrame:
    """A missing or NaN key stops the job."""
    columns = {}
    for c in order:
        bad = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            bad |= F.isnan(c)
        message = F.raise_error(F.lit(f"order column {c} is null or NaN")).cast(df.schema[c].dataType)
        columns[c] = F.when(bad, message).otherwise(F.col(c))
    return df.withColumns(columns)


def _rows_before_bucket(bucketed: DataFrame) -> DataFrame:
    """``_before`` per bucket and ``_total``.

    The unpartitioned windows run over one row per bucket, of which there are at most twice
    ``_BUCKETS_PER_PARTITION`` times the session's shuffle width, whatever the data; the
    same bound makes the result safe to broadcast.
    """
    earlier = Window.orderBy(*_KEYS).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.groupBy(*_KEYS)
        .agg(F.count("*").alias("_rows"))
        .select(
            *_KEYS,
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(Window.partitionBy()).alias("_total"),
        )
    )


def _with_buckets(df: DataFrame, order: list[str]) -> DataFrame:
    """Add the bucket keys: monotone in the order, and near equal in rows.

    A sample of fixed size decides the cuts. A value of the first order column that fills
    ``_HOT_BUCKETS`` buckets or more by itself (a burst within one timestamp, a topic
    partition) gets as many buckets of its own, at quantiles of its own tie-breaks. Such
    values are told by equality, so it doesn't matter how large they are. All other rows
    are cut at quantiles of the first column, within the gaps that those values leave.

    With ``n`` buckets asked for, the values have at most ``n`` in all, there are at most
    ``n / _HOT_BUCKETS`` of them, and the gaps add no more than the cuts that the values
    take and two for each: never more than ``2 n``.
    """
    buckets = _BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, _SAMPLES_PER_BUCKET * buckets / max(1, df.count()))
    checked = _checked(df, order)
    keys = checked.select(*order)
    sample = (keys.sample(share, seed=0) if share < 1 else keys).toPandas()
    lead_cuts, hot = _cuts(sample, order, buckets)
    lead = F.col(order[0]).cast("double")
    cut = _at_or_below(lead, F.lit(lead_cuts).cast("array<double>"), len(lead_cuts))
    if not hot:
        return checked.withColumn("_gap", F.lit(0)).withColumn("_bucket", cut)

    values = F.lit(list(hot)).cast(f"array<{dict(df.dtypes)[order[0]]}>")
    below = _at_or_below(F.col(order[0]), values, len(hot))
    is_hot = F.coalesce(F.get(values, F.col("_below") - 1) == F.col(order[0]), F.lit(False))
    tie_cuts = F.array(*[F.lit(c).cast("array<double>") for c in hot.values()])
    most = max(map(len, hot.values()))
    tie = _at_or_below(F.col(order[1]).cast("double"), F.get(tie_cuts, F.col("_below") - 1), most)
    return (
        checked.withColumn("_below", below)
        .withColumn("_gap", 2 * F.col("_below") - F.when(is_hot, 1).otherwise(0))
        .withColumn("_bucket", F.when(is_hot, tie).otherwise(cut))
        .drop("_below")
    )


def _cuts(sample: pd.DataFrame, order: list[str], buckets: int) -> tuple[list[float], dict]:
    """Inner boundaries for the first column, and those of the tie-breaks of each hot value, in order.

    A sample decides only how evenly the buckets are filled; every row is put into one and numbered.
    """
    if not len(sample):
        return [], {}
    lead = sample[order[0]]
    hot = {}
    if len(order) == 2:
        filled = lead.value_counts() * buckets // len(lead)
        for value, own in filled[filled >= _HOT_BUCKETS].sort_index().items():
            ties = np.sort(sample.loc[lead == value, order[1]].to_numpy().astype(float))
            hot[value.item() if hasattr(value, "item") else value] = _quantiles(ties, int(own))
    return _quantiles(np.sort(lead.to_numpy().astype(float)), buckets), hot


def _quantiles(ordered: np.ndarray, parts: int) -> list[float]:
    at = np.arange(1, parts) * len(ordered) // parts
    return np.unique(ordered[at]).tolist()


def _at_or_below(value: Column, ordered: Column, most: int) -> Column:
    """How many of at most ``most`` ordered numbers are not above the value, by halving."""
    steps = [1 << k for k in reversed(range(most.bit_length()))]
    return F.aggregate(
        F.lit(steps).cast("array<int>"),
        F.lit(0),
        lambda found, step: F.when(F.get(ordered, found + step - 1) <= value, found + step).otherwise(found),
    )


def select_batches(df: DataFrame, start: int, end: int, include_final: bool = False) -> DataFrame:
    """Batches ``start`` to ``end``, both included; the unfinished last one only on request."""
    chosen = df.filter(F.col("batch_no").between(start, end))
    return chosen if include_final else chosen.filter(~F.col("is_final"))


def batch_summary(df: DataFrame) -> DataFrame:
    """Rows of each batch and the name it has in the CSV layout."""
    return (
        df.groupBy("batch_no", "is_final")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("file_name", batch_file_name())
    )
