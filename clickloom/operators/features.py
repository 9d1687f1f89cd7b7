"""Per-visitor features. Each frame is one aggregate over the events.

Every aggregate combines inside the map tasks, so a visitor with a third of all rows
sends at most one partial row per task. The distinct count is the one aggregate that
needs two exchanges: Spark first groups by (visitor, item), which spreads a busy visitor
over all tasks, and only then by visitor. Partitioning by visitor up front would save an
exchange but put that visitor's raw rows into one task, so it is not done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import is_event, safe_ratio
from clickloom.schema import SEGMENT_COUNTS, SEGMENT_RATIOS, TRANSACTION_FEATURES, TRANSACTION_LABEL

#: Theta sketches keep the 2**SKETCH_LG smallest hashes. Up to as many distinct items the count is exact; beyond,
#: its relative standard error is 1 / sqrt(2**SKETCH_LG - 1), 1.6 %.
SKETCH_LG = 12


def _events(kind: str) -> Column:
    return F.count_if(is_event(kind))


def _per_visitor(df: DataFrame, null_visitors: str, **aggregates: Column) -> DataFrame:
    """One row per visitor. The null group becomes key 0 next to a real visitor 0, or is left out."""
    if null_visitors not in ("as_zero", "drop"):
        raise ValueError(f"null_visitors must be 'as_zero' or 'drop', not {null_visitors!r}")
    if null_visitors == "drop":
        df = df.filter(F.col("visitorid").isNotNull())
    grouped = df.groupBy("visitorid").agg(*[column.alias(name) for name, column in aggregates.items()])
    return grouped.fillna(0)


def transaction_features(df: DataFrame, null_visitors: str = "as_zero", distinct: str = "exact") -> DataFrame:
    """Views, carts and distinct items of each visitor, with the label: any transaction.

    With ``distinct="approximate"`` items are counted by sketches, in one exchange.
    """
    if distinct not in ("exact", "approximate"):
        raise ValueError(f"distinct must be 'exact' or 'approximate', not {distinct!r}")
    if distinct == "approximate":
        return transaction_features_of(feature_parts(df), null_visitors)
    return _per_visitor(
        df,
        null_visitors,
        num_views=_events("view"),
        num_addtocart=_events("addtocart"),
        distinct_items_interacted=F.count_distinct("itemid"),
        has_transaction=F.max(F.coalesce(is_event("transaction"), F.lit(False)).cast("int")),
    )


def segment_counts(df: DataFrame, null_visitors: str = "as_zero") -> DataFrame:
    """How many events of each kind a visitor made; events of unknown kind count in the total."""
    return _per_visitor(
        df,
        null_visitors,
        total_events=F.count("*"),
        total_views=_events("view"),
        total_addtocart=_events("addtocart"),
        total_transactions=_events("transaction"),
    )


def with_segment_ratios(counts: DataFrame, ratios: Sequence[str] = SEGMENT_RATIOS) -> DataFrame:
    """Add the shares named. Transactions are set against views, not events, so that one can exceed 1."""
    of = {
        "view_ratio": safe_ratio("total_views", "total_events"),
        "addtocart_ratio": safe_ratio("total_addtocart", "total_events"),
        "transaction_ratio": safe_ratio("total_transactions", "total_views"),
    }
    return counts.withColumns({name: of[name] for name in ratios})


def segment_features(df: DataFrame, null_visitors: str = "as_zero") -> DataFrame:
    return with_segment_ratios(segment_counts(df, null_visitors))


def feature_parts(df: DataFrame) -> DataFrame:
    """Counts of each visitor, and ``items``, a sketch of the items: parts of several inputs can be merged.

    A visitor that is null has a row of its own.
    """
    counts = {"total_events": F.count("*"), "total_views": _events("view"), "total_addtocart": _events("addtocart")}
    counts["total_transactions"] = _events("transaction")
    sketch = F.theta_sketch_agg("itemid", F.lit(SKETCH_LG))
    return df.groupBy("visitorid").agg(*[c.alias(name) for name, c in counts.items()], sketch.alias("items"))


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per visitor from parts, in any order and however they were cut: counts are added, sketches united.

    Instead of a sketch, parts may have ``new_items``, a number of items that no other part counts.
    """
    sums = [F.sum(c).alias(c) for c in SEGMENT_COUNTS]
    items = F.theta_union_agg("items", F.lit(SKETCH_LG)) if "items" in parts.columns else F.sum("new_items")
    return parts.groupBy("visitorid").agg(*sums, items.alias("items" if "items" in parts.columns else "new_items"))


def _of_parts(parts: DataFrame, null_visitors: str) -> DataFrame:
    if null_visitors not in ("as_zero", "drop"):
        raise ValueError(f"null_visitors must be 'as_zero' or 'drop', not {null_visitors!r}")
    known = parts.filter(F.col("visitorid").isNotNull()) if null_visitors == "drop" else parts
    return merged_parts(known).fillna(0, ["visitorid"])


def transaction_features_of(parts: DataFrame, null_visitors: str = "as_zero") -> DataFrame:
    """What ``transaction_features`` gives, from parts."""
    merged = _of_parts(parts, null_visitors)
    items = F.theta_sketch_estimate("items") if "items" in merged.columns else F.col("new_items")
    columns = dict(zip(TRANSACTION_FEATURES, (F.col("total_views"), F.col("total_addtocart"), items)))
    columns[TRANSACTION_LABEL] = (F.col("total_transactions") > 0).cast("int")
    return merged.select("visitorid", *[c.alias(name) for name, c in columns.items()])


def segment_features_of(parts: DataFrame, null_visitors: str = "as_zero") -> DataFrame:
    """What ``segment_features`` gives, from parts."""
    return with_segment_ratios(_of_parts(parts, null_visitors).select("visitorid", *SEGMENT_COUNTS))
