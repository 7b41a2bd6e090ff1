"""The session model: an autoencoder over the eight scaled features.

Layers 8 - h - h/2 - h - 8; rectified after the first and third. The weights are about 1,600 numbers, so they travel
with the task; rows are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from vigil.operators.features import Scaler, scaler_transform
from vigil.schemas import FEATURES

HIDDEN = 32
THRESHOLD_MULTIPLIER = 10.0
RECTIFIED = (True, False, True, False)


def layer_sizes(hidden: int = HIDDEN) -> list[tuple[int, int]]:
    sizes = [len(FEATURES), hidden, hidden // 2, hidden, len(FEATURES)]
    return list(zip(sizes[:-1], sizes[1:]))


@dataclass(frozen=True)
class Autoencoder:
    """``weights[l]`` has shape (inputs, outputs)."""

    weights: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]

    @staticmethod
    def seeded(seed: int = 0, hidden: int = HIDDEN) -> Autoencoder:
        """Uniform start values within one over the root of a layer's inputs."""
        rng = np.random.default_rng(seed)
        weights, biases = [], []
        for inputs, outputs in layer_sizes(hidden):
            bound = 1.0 / np.sqrt(inputs)
            weights.append(rng.uniform(-bound, bound, (inputs, outputs)))
            biases.append(rng.uniform(-bound, bound, outputs))
        return Autoencoder(tuple(weights), tuple(biases))

    @property
    def hidden(self) -> int:
        return self.weights[0].shape[1]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for pair in zip(self.weights, self.biases) for a in pair])

    @staticmethod
    def from_flat(values: np.ndarray, hidden: int = HIDDEN) -> Autoencoder:
        weights, biases, at = [], [], 0
        for inputs, outputs in layer_sizes(hidden):
            weights.append(values[at : at + inputs * outputs].reshape(inputs, outputs))
            at += inputs * outputs
            biases.append(values[at : at + outputs])
            at += outputs
        return Autoencoder(tuple(weights), tuple(biases))

    def activations(self, x: np.ndarray) -> list[np.ndarray]:
        outputs = [x]
        for w, b, rectified in zip(self.weights, self.biases, RECTIFIED):
            z = outputs[-1] @ w + b
            outputs.append(np.maximum(z, 0.0) if rectified else z)
        return outputs

    def reconstruct(self, x: np.ndarray) -> np.ndarray:
        return self.activations(x)[-1]

    def loss_and_gradient(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean squared error of a batch and its gradient, flattened like ``flat``."""
        outputs = self.activations(x)
        error = outputs[-1] - x
        delta = 2.0 * error / error.size
        gradients: list[np.ndarray] = []
        for layer in reversed(range(len(self.weights))):
            if RECTIFIED[layer]:
                delta = delta * (outputs[layer + 1] > 0)
            gradients[:0] = [(outputs[layer].T @ delta).ravel(), delta.sum(axis=0)]
            delta = delta @ self.weights[layer].T
        return float(np.mean(error**2)), np.concatenate(gradients)


def reconstruct(scaled: DataFrame, model: Autoencoder) -> DataFrame:
    """Adds ``reconstruction``, an array in the order of ``FEATURES``."""

    @F.pandas_udf("array<double>")
    def rebuilt(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
        return pd.Series(list(model.reconstruct(x)))

    return scaled.withColumn("reconstruction", rebuilt(*[F.col(c).cast("double") for c in FEATURES]))


def loss_column(model: Autoencoder, single_precision: bool = False) -> Column:
    """Mean squared reconstruction error of the scaled features of a row."""
    dtype = np.float32 if single_precision else np.float64
    model = Autoencoder(tuple(w.astype(dtype) for w in model.weights), tuple(b.astype(dtype) for b in model.biases))

    @F.pandas_udf(DoubleType())
    def loss(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=dtype) for c in columns])
            yield pd.Series(np.mean((model.reconstruct(x) - x) ** 2, axis=1).astype(np.float64))

    return loss(*[F.col(c).cast("double") for c in FEATURES])


def score(features: DataFrame, model: Autoencoder, scaler: Scaler, single_precision: bool = False) -> DataFrame:
    """Adds ``score``; the features keep their unscaled values."""
    scaled = {f"_{c}": c for c in FEATURES}
    kept = features.withColumns({k: F.col(c) for k, c in scaled.items()})
    scored = scaler_transform(kept, scaler).withColumn("score", loss_column(model, single_precision))
    return scored.withColumns({c: F.col(k) for k, c in scaled.items()}).drop(*scaled)


def ml_verdicts(
    batch_features: DataFrame,
    model: Autoencoder,
    scaler: Scaler,
    stored_threshold: float,
    multiplier: float = THRESHOLD_MULTIPLIER,
    single_precision: bool = False,
) -> DataFrame:
    """One verdict per full batch; its time and user are those of the event that completed the batch."""
    threshold = stored_threshold * multiplier
    scored = score(batch_features, model, scaler, single_precision)
    return scored.select(
        "seq",
        "sec",
        "batch",
        "user_id",
        "session_id",
        F.col("ts").alias("timestamp"),
        (F.col("score") > threshold).alias("anomaly"),
        "score",
        F.lit(threshold).alias("threshold"),
        "event_count",
        "unique_events",
        F.lit("ml").alias("source"),
    )
