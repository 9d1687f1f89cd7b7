"""Feature vectors: assembled in a fixed order, then standardised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame


def assembler(cols: Sequence[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features_unscaled", handleInvalid=invalid)


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features_unscaled", outputCol="features", withMean=True, withStd=True)


def assembled_features(df: DataFrame, cols: Sequence[str], invalid: str = "error") -> DataFrame:
    """Add ``features_unscaled``. Rows with nulls stop the job, or are left out with ``invalid="skip"``."""
    return assembler(cols, invalid).transform(df)


def scaled_features(df: DataFrame, cols: Sequence[str], invalid: str = "error") -> DataFrame:
    """Add ``features``: mean 0, sample deviation 1; a constant column becomes 0.

    Mean and deviation come from one pass that reduces to a vector per task.
    """
    assembled = assembled_features(df, cols, invalid)
    return scaler().fit(assembled).transform(assembled)
