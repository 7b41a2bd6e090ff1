"""The result tables the dashboards read, written once per session and data folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.columns import unix_seconds
from vigil.operators.detect import stat_verdicts
from vigil.operators.features import Scaler, ml_batch_features, scaler_transform, session_features
from vigil.operators.fusion import fuse
from vigil.operators.history import Tuning
from vigil.operators.model import Autoencoder, loss_column, ml_verdicts
from vigil.operators.training import evaluate, train_test_split
from vigil.session import intermediate_folder, materialise
from vigil.sources.canon import TIME_SCALE, load_canonical
from vigil.sources.stores import Store

# The tables hold about 66 events per user over a month, so windows are stretched and small totals count.
TUNING = Tuning(min_total_user=5).scaled_windows(TIME_SCALE)
IDLE = 300 * TIME_SCALE
MODEL_SEED = 7
MULTIPLIER = 1.5


@dataclass(frozen=True)
class Results:
    stat: DataFrame
    ml: DataFrame
    aggregated: DataFrame


def fixed_model() -> Autoencoder:
    return Autoencoder.seeded(MODEL_SEED)


def fitted_scaler(events: DataFrame) -> Scaler:
    return Scaler.fit(session_features(events))


def fitted(events: DataFrame) -> tuple[Scaler, DataFrame]:
    """The scaler, and the losses of the held-out sessions; session features are computed once for both."""
    features = materialise(session_features(events))
    scaler = Scaler.fit(features)
    held_out = train_test_split(scaler_transform(features, scaler)).where(~F.col("is_train"))
    return scaler, held_out.withColumn("loss", loss_column(fixed_model())).select("session_id", "loss")


def held_out_losses(events: DataFrame) -> DataFrame:
    return fitted(events)[1]


def model_verdicts(events: DataFrame) -> DataFrame:
    scaler, losses = fitted(events)
    threshold = evaluate(losses).first()["threshold"]
    return ml_verdicts(ml_batch_features(events), fixed_model(), scaler, threshold, MULTIPLIER)


def stat_table(events: DataFrame) -> DataFrame:
    verdicts = stat_verdicts(events, TUNING)
    keys = verdicts.where(F.col("status") == "ok")
    return keys.select(
        "event_id",
        "seq",
        unix_seconds("ts").alias("sec"),
        "user_id",
        "session_id",
        "event_type",
        "anomaly",
        "anomaly_type",
        "message",
        F.col("ts").alias("timestamp"),
    )


def build_results(spark: SparkSession, folder: str) -> Store:
    """Run the pipeline over the whole event table and store what it gives."""
    store = Store(spark, f"{intermediate_folder(spark)}/results-{uuid.uuid4().hex}")
    events = load_canonical(spark, folder)
    store.append(stat_table(events), "stat_results", "timestamp")
    store.append(model_verdicts(events), "ml_results", "timestamp")
    fused = fuse(store.read("stat_results"), store.read("ml_results"), IDLE)
    store.append(fused, "aggregated_results", "created_at")
    return store


_written: dict[tuple[str, str], str] = {}


def results(spark: SparkSession, folder: str) -> Results:
    """The stored tables; the first call of a session and data folder writes them."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _written:
        _written[key] = build_results(spark, folder).folder
    store = Store(spark, _written[key])
    return Results(store.read("stat_results"), store.read("ml_results"), store.read("aggregated_results"))
