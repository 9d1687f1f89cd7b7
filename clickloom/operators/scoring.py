"""Whole tables of visitors against the fitted models.

Predicting and segmenting are row-wise, so they also run on a streaming DataFrame;
recommending joins and ranks, and is for batch input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import positive_probability
from clickloom.operators.dictionary import IdDictionary
from clickloom.operators.features import with_segment_ratios
from clickloom.operators.ranking import rank_items
from clickloom.schema import SEGMENT_COUNTS, SEGMENT_FEATURES, SEGMENT_RATIOS, TRANSACTION_FEATURES

# How many items may be asked for, and how many are given unasked.
MIN_RECOMMENDATIONS, MAX_RECOMMENDATIONS, DEFAULT_RECOMMENDATIONS = 1, 20, 5

_RECS = "array<struct<itemid:int,rating:float>>"


def recommend(
    model: ALSModel, users: DataFrame, k: int = DEFAULT_RECOMMENDATIONS, exclude_seen: DataFrame | None = None
) -> DataFrame:
    """Each row of ``users`` with its ``k`` best items, best first, in ``recommendations``.

    Items a visitor already had are not left out, unless ``exclude_seen`` has them: its pairs
    ``visitorid, itemid``, such as those of the events, are never recommended. A visitor the model does not know, or
    whose id is no integer, gets an empty array. Only the visitors asked for are scored,
    each once. Factors are counted when this is called.
    """
    if not MIN_RECOMMENDATIONS <= k <= MAX_RECOMMENDATIONS:
        raise ValueError(f"k must be {MIN_RECOMMENDATIONS} to {MAX_RECOMMENDATIONS}, not {k}")
    known_id = F.col("visitorid").try_cast("int")
    wanted = users.select(known_id.alias("id")).filter("id IS NOT NULL").distinct()
    seen = exclude_seen and exclude_seen.select(known_id.alias("id"), F.col("itemid").try_cast("int").alias("itemid"))
    ranked = rank_items(model.userFactors.join(wanted, "id", "left_semi"), model.itemFactors, k, seen=seen)
    return with_ranked(users, ranked, known_id)


def recommend_by_id(
    model: ALSModel,
    ids: IdDictionary,
    users: DataFrame,
    k: int = DEFAULT_RECOMMENDATIONS,
    exclude_seen: DataFrame | None = None,
) -> DataFrame:
    """``recommend`` for a model of numbered ids: ``users``, ``exclude_seen`` and the items have ids of any type.

    Equal scores rank by the items' numbers. A visitor whose id the dictionary doesn't know gets an empty array.
    """
    wanted = ids.numbered(users.select("visitorid").distinct()).dropna()
    seen = exclude_seen and ids.numbered(exclude_seen.select("visitorid", "itemid"))
    ranked = ids.restored(explode_recs(recommend(model, wanted, k, seen)))
    row = F.struct("rank", F.struct("itemid", "rating").alias("rec"))
    found = ranked.groupBy(F.col("visitorid").alias("_id")).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    recs = F.col("_rows.rec").alias("recommendations")
    out = users.join(found.select("_id", recs), F.col("visitorid") == F.col("_id"), "left").drop("_id")
    kind = out.schema["recommendations"].dataType
    return out.withColumn("recommendations", F.coalesce("recommendations", F.array().cast(kind)))


def with_ranked(users: DataFrame, ranked: DataFrame, known_id: Column) -> DataFrame:
    """``users`` with ``recommendations`` from ``ranked``, by the id that ``known_id`` makes of a row."""
    found = ranked.select(F.col("id").alias("_ranked_id"), F.col("ranked").cast(_RECS).alias("recommendations"))
    return (
        users.join(found, known_id == F.col("_ranked_id"), "left")
        .drop("_ranked_id")
        .withColumn("recommendations", F.coalesce("recommendations", F.array().cast(_RECS)))
    )


def explode_recs(recommended: DataFrame) -> DataFrame:
    """One row per visitor and rank (from 1); visitors without recommendations have none."""
    rest = [c for c in recommended.columns if c != "recommendations"]
    return recommended.select(*rest, F.posexplode("recommendations").alias("pos", "rec")).select(
        *rest,
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.itemid").alias("itemid"),
        F.col("rec.rating").alias("rating"),
    )


def score_transactions(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The caller's columns, without the features, plus ``will_transact`` and ``probability``."""
    rest = [c for c in features.columns if c not in TRANSACTION_FEATURES]
    return model.transform(features).select(
        *rest,
        (F.col("prediction") == 1.0).alias("will_transact"),
        positive_probability("probability").alias("probability"),
    )


def segment_users(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The caller's columns, without the features, plus ``cluster_id``, for every row.

    Ratios are taken as given, and those that a frame doesn't have are computed. A row with
    a missing feature has no segment: its ``cluster_id`` is null.
    """
    rest = [c for c in features.columns if c not in SEGMENT_COUNTS + SEGMENT_RATIOS]
    features = with_segment_ratios(features, [r for r in SEGMENT_RATIOS if r not in features.columns])
    whole = reduce(Column.__and__, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in SEGMENT_FEATURES))
    # the fitted pipeline skips rows with gaps, so they get a value here and lose the segment after it
    gaps = {c: F.when(F.col("_whole"), F.col(c)).otherwise(F.lit(0)) for c in SEGMENT_FEATURES}
    filled = features.withColumn("_whole", F.coalesce(whole, F.lit(False))).withColumns(gaps)
    segment = F.when(F.col("_whole"), F.col("prediction").cast("int")).alias("cluster_id")
    return model.transform(filled).select(*rest, segment)
