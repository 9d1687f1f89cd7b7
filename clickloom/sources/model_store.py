"""Fitted models on disk."""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel

log = logging.getLogger(__name__)

# Each model's name, its folder and its class.
MODEL_FOLDERS = {
    "recommender": ("recommender_model_v1", ALSModel),
    "transaction_predictor": ("transaction_predictor_model_v1", PipelineModel),
    "user_segmentation": ("user_segmentation_model_v1", PipelineModel),
}


def model_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{MODEL_FOLDERS[name][0]}"


def dictionary_path(base: str) -> str:
    """Where the ids of a recommender that was fitted on numbered ones are."""
    return f"{base.rstrip('/')}/recommender_ids_v1"


def save_model(model: ALSModel | PipelineModel, path: str) -> None:
    """Write the model, in place of one that is there."""
    model.write().overwrite().save(path)


def load_models(base: str) -> tuple[dict[str, ALSModel | PipelineModel], list[str]]:
    """The models below ``base`` by name, and a warning for each that is missing or unreadable."""
    models, warnings = {}, []
    for name, (_, kind) in MODEL_FOLDERS.items():
        path = model_path(base, name)
        try:
            models[name] = kind.load(path)
        except Exception as problem:  # any unreadable model must leave the others usable
            warnings.append(f"model {name} cannot be loaded from {path}: {problem}")
            log.warning(warnings[-1])
    return models, warnings
