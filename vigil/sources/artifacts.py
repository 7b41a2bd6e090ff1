"""Model artifacts and the training state as small tables in a shared folder.

Everything is read and written by Spark, so a folder may be any address the cluster can open.
"""

from __future__ import annotations

from dataclasses import fields

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.features import Scaler
from vigil.operators.model import Autoencoder
from vigil.operators.training import TrainedModel, TrainingState

ARTIFACTS = "weights ARRAY<DOUBLE>, hidden INT, mean ARRAY<DOUBLE>, scale ARRAY<DOUBLE>, metrics MAP<STRING, DOUBLE>"
STATE = "last_event_id LONG, trained_at STRING, total_events LONG, total_sessions LONG, metrics MAP<STRING, DOUBLE>"


def save_artifacts(spark: SparkSession, trained: TrainedModel, folder: str) -> None:
    """One row: weights, scaler and metrics of a model."""
    scaler = trained.scaler
    weights = [float(w) for w in trained.model.flat()]
    row = (weights, trained.model.hidden, list(scaler.mean), list(scaler.scale), trained.metrics)
    spark.createDataFrame([row], ARTIFACTS).coalesce(1).write.mode("overwrite").parquet(folder)


def load_artifacts(spark: SparkSession, folder: str) -> TrainedModel:
    row = spark.read.schema(ARTIFACTS).parquet(folder).first()
    model = Autoencoder.from_flat(np.array(row["weights"]), row["hidden"])
    return TrainedModel(model, Scaler(tuple(row["mean"]), tuple(row["scale"])), dict(row["metrics"]))


def state_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All states ever saved, typed by the declared schema: a line that is no state, and a missing folder, give no row."""
    try:
        lines = spark.read.text(folder)
    except AnalysisException:
        return spark.createDataFrame([], STATE)
    return lines.select(F.from_json("value", STATE).alias("state")).select("state.*").where("last_event_id IS NOT NULL")


def load_state(spark: SparkSession, folder: str) -> TrainingState:
    """The state that has seen most; without any, training starts from nothing."""
    newest = state_rows(spark, folder).orderBy(F.desc("last_event_id"), F.desc("trained_at")).first()
    return TrainingState(**newest.asDict()) if newest else TrainingState()


def save_state(spark: SparkSession, state: TrainingState, folder: str) -> None:
    """Add one line; earlier states stay, so a run that is cut off loses nothing."""
    row = tuple(getattr(state, f.name) for f in fields(state))
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("append").json(folder)
