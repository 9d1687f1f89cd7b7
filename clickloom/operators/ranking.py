"""The best items of every visitor, from factors on both sides, in blocks.

Items are cut into blocks by the length of their factors, longest first, and visitors into
blocks by their id. Every visitor meets the first block of items; what then is its k-th score
says which other blocks can hold anything as good: a score is never more than the product of
both lengths. A visitor meets those blocks alone. They are the ones before a certain place, as
blocks come by falling length, and one number for each block is all that is needed to find it.

Blocks meet in equi-joins. The visitors of a block that want a block of items are one row, and
blocks of items are repeated for a few groups of visitor blocks, so that the pairs spread over
the session's shuffle width whatever the size of the catalogue. A pair is scored and cut to
its best ``k`` in one step, and the best of the pairs are merged. Pairs that visitors have seen
are dealt to the same pairs of blocks and struck out before anything is cut. A score is summed
in doubles in the order of the factors, so it does not depend on how blocks are cut; equal
scores rank by item id.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.batching import assign_batches
from clickloom.session import scratch_path

log = logging.getLogger(__name__)

VISITORS_PER_BLOCK = ITEMS_PER_BLOCK = 4096
_SCORES_AT_ONCE = 2 * 2**20
#: What rounding may add to a score beyond the product of the lengths, in parts of it.
_ROUNDING = 1e-9
_BLOCKS = ["visitor_block", "item_block"]


def rank_items(
    visitors: DataFrame,
    items: DataFrame,
    k: int,
    visitors_per_block: int = VISITORS_PER_BLOCK,
    items_per_block: int = ITEMS_PER_BLOCK,
    seen: DataFrame | None = None,
    met: dict[str, int] | None = None,
) -> DataFrame:
    """``id, ranked``: for each visitor its ``k`` best items as ``array<struct<itemid, rating>>``, best first.

    Both sides have ``id`` and ``features``, an array of numbers; ids are unique. Pairs
    ``id, itemid`` of ``seen`` are left out; repeated ones, nulls and ids of neither side don't
    matter. A visitor that has seen all items has an empty array. Both sides are counted when
    this is called, and with more than one block of items the first is ranked. Without items,
    no visitor has a row. ``met`` is given the number of pairs of a visitor and a block of items
    that are scored, and of those there are.
    """
    count, n_items = visitors.count(), items.count()
    n_visitors = max(1, -(-count // visitors_per_block))
    blocked = _by_length(items, items_per_block) if n_items > items_per_block else items.withColumn("item_block", F.lit(0))
    rows = visitors.select("id", "features", F.pmod(F.xxhash64("id"), F.lit(n_visitors)).cast("int").alias("visitor_block"))
    struck = _struck(seen, rows, blocked) if seen is not None else None
    best = _best(rows.withColumn("item_block", F.lit(0)), blocked.filter("item_block = 0"), 1, n_visitors, struck, k)
    n_blocks = -(-n_items // items_per_block)
    if met is not None:
        met.update(scored=count * min(1, n_blocks), all=count * n_blocks)
    if n_blocks < 2:
        return best

    best = _written(best, "ranked")
    longest = blocked.groupBy("item_block").agg(F.max("_length").alias("most")).orderBy("item_block").collect()
    wanted = _written(_wanted(rows.join(best, "id"), [r["most"] for r in longest], k), "wanted")
    if met is not None:
        met["scored"] += wanted.agg(F.sum(F.col("_blocks") - 1)).first()[0]
        log.info("ranking: %(scored)d of %(all)d pairs of visitors and blocks of items are scored", met)
    others = wanted.filter("_blocks > 1").withColumn("item_block", F.explode(F.sequence(F.lit(1), F.col("_blocks") - 1)))
    more = _best(others.drop("_blocks"), blocked.filter("item_block > 0"), n_blocks - 1, n_visitors, struck, k)
    return _merged(best.unionByName(more).select("id", "ranked"), k)


def _written(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written once and read again.

    What ``_wanted`` adds must not be filtered above its join: where attributes have small ids, as
    in a session's first query, the optimizer takes some for variables of the lambda functions and
    moves the filter to the side that lacks them.
    """
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _length() -> Column:
    return F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def _by_length(items: DataFrame, items_per_block: int) -> DataFrame:
    """The items in blocks by falling length of their factors, written once."""
    keyed = items.select("id", "features", (-_length()).alias("_order"), F.xxhash64("id").alias("_tie"))
    ordered = assign_batches(keyed, ["_order", "_tie"], items_per_block)
    blocked = ordered.select("id", "features", (-F.col("_order")).alias("_length"), (F.col("batch_no") - 1).cast("int").alias("item_block"))
    return _written(blocked, "items")


def _wanted(ranked: DataFrame, longest: list[float], k: int) -> DataFrame:
    """For each visitor, before which block of items all are that may hold one of its best."""
    last = F.get("ranked", F.lit(k - 1)).getField("rating")
    reach = _length() * (1 + _ROUNDING)
    most = F.lit(longest).cast("array<double>")
    within = _prefix(lambda at: reach * F.get(most, at) >= last, len(longest))
    return ranked.select("id", "features", "visitor_block", F.when(last.isNull(), len(longest)).otherwise(within).alias("_blocks"))


def _prefix(holds, n: int) -> Column:
    """How many of the places 0 to n - 1 come before the first one that ``holds`` is not true of, by halving."""
    steps = [1 << b for b in reversed(range(n.bit_length()))]
    return F.aggregate(
        F.lit(steps).cast("array<int>"),
        F.lit(0),
        lambda found, step: F.when((found + step <= n) & holds(F.least(found + step, F.lit(n)) - 1), found + step).otherwise(found),
    )


def _struck(seen: DataFrame, rows: DataFrame, blocked: DataFrame) -> DataFrame:
    """Pairs seen, by the blocks they meet in. There are no more of them than the blocks have pairs."""
    pairs = seen.select("id", F.col("itemid").alias("itemid")).dropna().distinct()
    places = pairs.join(rows.select("id", "visitor_block"), "id").join(blocked.select(F.col("id").alias("itemid"), "item_block"), "itemid")
    return (
        places.groupBy(*_BLOCKS)
        .agg(F.collect_list(F.struct("id", "itemid")).alias("pairs"))
        .select(*_BLOCKS, F.col("pairs.id").alias("seen_ids"), F.col("pairs.itemid").alias("seen_items"))
    )


def _best(rows: DataFrame, items: DataFrame, n_items: int, n_visitors: int, struck: DataFrame | None, k: int) -> DataFrame:
    """``id, ranked`` of each visitor over the blocks of items that its rows ask for."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = min(n_visitors, -(-width // n_items))
    left = _packed(rows, _BLOCKS, "visitor").withColumn("group", F.col("visitor_block") % groups)
    right = _packed(items, ["item_block"], "item").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    pairs = left.join(right, ["group", "item_block"])
    none = [F.lit(None).cast(f"array<{rows.schema['id'].dataType.simpleString()}>"), F.lit(None).cast(f"array<{items.schema['id'].dataType.simpleString()}>")]
    pairs = pairs.join(struck, _BLOCKS, "left") if struck is not None else pairs.withColumns(dict(zip(("seen_ids", "seen_items"), none)))
    pairs = pairs.select("visitor_ids", "visitor_features", "item_ids", "item_features", "seen_ids", "seen_items")
    id_type, item_type = (df.schema["id"].dataType.simpleString() for df in (rows, items))
    found = pairs.mapInPandas(_ranker(k), f"id {id_type}, itemids array<{item_type}>, ratings array<double>")
    ranked = F.arrays_zip(F.col("itemids").alias("itemid"), F.col("ratings").alias("rating"))
    return _merged(found.select("id", ranked.alias("ranked")), k)


def _merged(parts: DataFrame, k: int) -> DataFrame:
    """The best of each visitor's lists."""
    order = F.transform("ranked", lambda x: F.struct((-x.rating).alias("least"), x.itemid.alias("itemid")))
    return (
        parts.select("id", order.alias("part"))
        .groupBy("id")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("part"))), 1, k).alias("best"))
        .select(
            "id",
            F.transform("best", lambda x: F.struct(x.itemid.alias("itemid"), (-x.least).alias("rating"))).alias("ranked"),
        )
    )


def _packed(side: DataFrame, blocks: list[str], name: str) -> DataFrame:
    """One row per block: ids, in order, and their features one after another."""
    rows = F.array_sort(F.collect_list(F.struct("id", F.col("features").cast("array<double>").alias("features"))))
    return (
        side.groupBy(*blocks)
        .agg(rows.alias("rows"))
        .select(
            *blocks,
            F.col("rows.id").alias(f"{name}_ids"),
            F.flatten("rows.features").alias(f"{name}_features"),
        )
    )


def _ranker(k: int):
    # all that tasks need is defined in here, so they need not import this package
    scores_at_once = _SCORES_AT_ONCE

    def best_columns(scores: np.ndarray, most: int) -> np.ndarray:
        n = scores.shape[1]
        width = max(1, min(int(n**0.5), n // most))
        maxima = np.stack([scores[:, at : at + width].max(axis=1) for at in range(0, n, width)], axis=1)
        # as many groups of columns reach that maximum, so no smaller value is among the best
        least = np.partition(maxima, -most, axis=1)[:, -most]
        row, column = np.nonzero(scores >= least[:, None])
        column = column[np.lexsort((column, -scores[row, column], row))]
        return column[np.searchsorted(row, np.arange(len(scores)))[:, None] + np.arange(most)]

    def places(ids: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Where each id stands among ordered ones; -1 if it doesn't."""
        at = np.minimum(np.searchsorted(among, ids), len(among) - 1)
        return np.where(among[at] == ids, at, -1)

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                ids = np.asarray(pair.item_ids)
                visitor_ids = np.asarray(pair.visitor_ids)
                items = np.asarray(pair.item_features, float).reshape(len(ids), -1)
                visitors = np.asarray(pair.visitor_features, float).reshape(len(visitor_ids), -1)
                row, column = np.zeros(0, int), np.zeros(0, int)
                if pair.seen_ids is not None:
                    row, column = places(np.asarray(pair.seen_ids), visitor_ids), places(np.asarray(pair.seen_items), ids)
                    asked = row >= 0
                    order = np.argsort(row[asked], kind="stable")
                    row, column = row[asked][order], column[asked][order]
                most, step = min(k, len(ids)), max(1, scores_at_once // len(ids))
                for at in range(0, len(visitors), step):
                    part = visitors[at : at + step]
                    scores = np.zeros((len(part), len(ids)))
                    for factor in range(items.shape[1]):
                        scores += part[:, factor, None] * items[None, :, factor]
                    low, high = np.searchsorted(row, (at, at + len(part)))
                    scores[row[low:high] - at, column[low:high]] = -np.inf
                    top = best_columns(scores, most)
                    ratings = np.take_along_axis(scores, top, axis=1)
                    itemids, ratings = list(ids[top]), list(ratings)
                    if high > low:
                        left = [r > -np.inf for r in ratings]
                        itemids, ratings = ([x[m] for x, m in zip(xs, left)] for xs in (itemids, ratings))
                    yield pd.DataFrame({"id": visitor_ids[at : at + step], "itemids": itemids, "ratings": ratings})

    return rank
