"""Fitting the three models, each on its own range of batches."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame

from clickloom.operators.dictionary import IdDictionary
from clickloom.operators.features import segment_features, transaction_features
from clickloom.operators.filters import known_events, with_keys
from clickloom.operators.ratings import ratings as to_ratings
from clickloom.operators.scaling import assembler, scaler
from clickloom.schema import EVENT_WEIGHTS, SEGMENT_FEATURES, TRANSACTION_FEATURES, TRANSACTION_LABEL
from clickloom.session import ensure_checkpoints
from clickloom.sources.model_store import dictionary_path, model_path, save_model

log = logging.getLogger(__name__)

# Batches each model is trained on, first and last.
TRAINING_RANGES = {
    "recommender": (1, 50),
    "transaction_predictor": (51, 100),
    "user_segmentation": (101, 150),
}

SEED = 42
# Fixed value: blocks of ratings on either side. A seed gives other factors with other blocks.
DEFAULT_BLOCKS = 10
MANY_RATINGS_PER_BLOCK = 2_000_000


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold ``df`` while an iterative fit reads it many times."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fit_recommender(ratings: DataFrame, seed: int = SEED, blocks: int = DEFAULT_BLOCKS) -> ALSModel | None:
    """Explicit-feedback ALS; ``None`` when there are no ratings.

    The ratings are split into ``blocks`` by visitor and by item. Starting factors are drawn
    block by block, so the model depends on their number, and on nothing else about the
    cluster or the size of the input; for many ratings ask for more of them.

    All ratings of one visitor, or of one item, are solved in one task. Where repeats make
    that too much, ``ratings(..., dedupe="max")`` leaves one per pair.
    """
    ensure_checkpoints(ratings.sparkSession)
    with _kept(ratings):
        n_ratings = ratings.count()
        if n_ratings == 0:
            return None
        per_block = n_ratings // blocks
        if per_block > MANY_RATINGS_PER_BLOCK:
            log.warning("recommender: %d ratings to a block; ask for more than %d blocks", per_block, blocks)
        als = ALS(
            userCol="visitorid_int",
            itemCol="itemid_int",
            ratingCol="rating",
            rank=10,
            regParam=0.1,
            nonnegative=True,
            coldStartStrategy="drop",
            seed=seed,
            numUserBlocks=blocks,
            numItemBlocks=blocks,
        )
        return als.fit(ratings)


def fit_recommender_by_id(
    events: DataFrame, out: str, seed: int = SEED, blocks: int = DEFAULT_BLOCKS, dedupe: str | None = None
) -> tuple[ALSModel, IdDictionary] | None:
    """Fit on events whose visitors and items have ids of any type; model and dictionary are saved below ``out``.

    ``None`` when there are no ratings.
    """
    keyed = with_keys(known_events(events, EVENT_WEIGHTS))
    ids = IdDictionary.of(keyed).save(dictionary_path(out))
    model = fit_recommender(to_ratings(ids.numbered(keyed), dedupe=dedupe), seed, blocks)
    if model is None:
        return None
    save_model(model, model_path(out, "recommender"))
    return model, ids


def fit_transaction_predictor(features: DataFrame, seed: int = SEED) -> PipelineModel | None:
    """Scaled counts into a random forest of 50 trees; ``None`` when there are no visitors.

    Counts and label come from the same events, the transaction itself included.
    """
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=TRANSACTION_LABEL, numTrees=50, maxDepth=5, seed=seed
    )
    return _fit(features, Pipeline(stages=[assembler(TRANSACTION_FEATURES), scaler(), forest]))


def fit_segments(features: DataFrame, k: int = 5, seed: int = 1) -> PipelineModel | None:
    """Scaled behaviour into k-means; ``None`` when there are no visitors.

    Fewer than ``k`` distinct points give fewer clusters; the block solver, which Spark may
    otherwise choose, fails on them.
    """
    kmeans = KMeans(featuresCol="features", k=k, seed=seed, solver="row")
    return _fit(features, Pipeline(stages=[assembler(SEGMENT_FEATURES, "skip"), scaler(), kmeans]))


def _fit(features: DataFrame, stages: Pipeline) -> PipelineModel | None:
    with _kept(features):
        return None if features.isEmpty() else stages.fit(features)


def train_all(
    read_range: Callable[[int, int], DataFrame],
    out: str,
    ranges: Mapping[str, tuple[int, int]] = TRAINING_RANGES,
    seed: int = SEED,
    blocks: int = DEFAULT_BLOCKS,
) -> dict[str, ALSModel | PipelineModel | None]:
    """Fit and save every model on its own range of batches; a range without rows is skipped.

    ``read_range(first, last)`` gives the events, for instance
    ``functools.partial(read_batches, spark, path)``.
    """
    fits = {
        "recommender": lambda events: fit_recommender(to_ratings(events), seed, blocks),
        "transaction_predictor": lambda events: fit_transaction_predictor(transaction_features(events), seed),
        "user_segmentation": lambda events: fit_segments(segment_features(events)),
    }
    models = {}
    for name, (first, last) in ranges.items():
        models[name] = fits[name](read_range(first, last))
        if models[name] is None:
            log.warning("no data for %s in batches %d to %d", name, first, last)
        else:
            save_model(models[name], model_path(out, name))
    return models
