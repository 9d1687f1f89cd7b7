"""Column expressions. All are built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schema import EVENT_WEIGHTS


def is_event(kind: str, column: str = "event") -> Column:
    return F.col(column) == F.lit(kind)


def event_weight(column: str | Column = "event", weights: Mapping[str, float] = EVENT_WEIGHTS) -> Column:
    """The rating an event stands for; unknown types and nulls weigh 0.0."""
    event = F.col(column) if isinstance(column, str) else column
    known = reduce(lambda chain, kv: chain.when(event == kv[0], F.lit(float(kv[1]))), weights.items(), F)
    return known.otherwise(F.lit(0.0))


def safe_ratio(numerator: str, denominator: str) -> Column:
    """numerator / denominator, and 0.0 where there is nothing to divide by."""
    return F.when(F.col(denominator) > 0, F.col(numerator) / F.col(denominator)).otherwise(F.lit(0.0))


def restored_id(column: str | Column, kind: T.DataType = T.LongType()) -> Column:
    """An id from text such as ``4000``, ``4000.0``, ``NaN`` or nothing; null for what is no id.

    Plain digits are cast at once. Other spellings go through decimal, which keeps ids beyond
    2**53 exact, as a double would not. A number with a fraction is no id.
    """
    text = F.col(column) if isinstance(column, str) else column
    number = text.try_cast("decimal(38,18)")
    return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def lost_id(column: str | Column, kind: T.DataType = T.LongType()) -> Column:
    """Whether the text, quoted or not, stands for an id that can't be restored."""
    text = F.col(column) if isinstance(column, str) else column
    bare = F.lower(F.btrim(text, F.lit('" ')))
    return text.isNotNull() & restored_id(text, kind).isNull() & (bare != "nan") & (bare != "")


def positive_probability(column: str = "probability") -> Column:
    """Probability of class 1; 0.0 when training saw only class 0 and the vector has one slot."""
    slots = vector_to_array(F.col(column))
    return F.when(F.size(slots) > 1, F.get(slots, F.lit(1))).otherwise(F.lit(0.0))


def batch_file_name(batch_no: str = "batch_no", is_final: str = "is_final", prefix: str = "batch_") -> Column:
    """File name of a batch in the CSV layout: ``batch_007.csv``, ``batch_008_final.csv``."""
    suffix = F.when(F.col(is_final), F.lit("_final")).otherwise(F.lit(""))
    return F.format_string(f"{prefix}%03d%s.csv", F.col(batch_no), suffix)
