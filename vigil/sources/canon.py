"""Canonical events from the generic ``events`` table.

The table has no session, address, agent or country. They follow from user id, time and the number in ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.columns import unix_seconds
from vigil.schemas import METADATA_FIELDS

# Event types of the table and the activity they stand for.
ACTIVITY = {
    "signup": "login",
    "purchase": "payment",
    "error": "failed_login",
    "view": "other",
    "click": "logout",
}
SESSION_SECONDS = 604800
# Mean distance of two events of a user in the table over that of a live system.
TIME_SCALE = 672


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def canonical_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    activity = F.create_map(*[F.lit(x) for pair in ACTIVITY.items() for x in pair])
    return (
        events.withColumns({"k": k, "sec": unix_seconds("ts")})
        .select(
            F.col("event_id"),
            F.col("event_id").alias("seq"),
            F.col("ts").cast("timestamp_ntz").alias("ts"),
            "sec",
            F.hour("ts").alias("hour"),
            "user_id",
            F.coalesce(activity[F.col("event_type")], F.col("event_type")).alias("event_type"),
            F.concat_ws("-", "user_id", F.floor(F.col("sec") / SESSION_SECONDS)).alias("session_id"),
            F.concat(
                F.lit("10.0."), F.col("user_id") % 250, F.lit("."), F.floor(F.col("k") / 25).cast("long")
            ).alias("ip"),
            F.concat(F.lit("ua"), F.col("k") % 3).alias("user_agent"),
            F.when(F.col("k") >= 95, F.lit("XX"))
            .otherwise(F.concat(F.lit("C"), F.col("user_id") % 10))
            .alias("country"),
            "value",
            "k",
        )
    )


def load_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return canonical_events(read_events(spark, folder))


def event_records(canonical: DataFrame) -> DataFrame:
    """The events as envelope JSON, one record per row; ``k`` 0 to 3 break one rule each."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = F.struct(
        F.when(F.col("k") == 2, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        F.col("event_type").alias("type"),
        stamp.alias("timestamp"),
        "session_id",
        F.struct(*METADATA_FIELDS).alias("metadata"),
        F.struct("value").alias("additional"),
    )
    envelope = F.struct(
        F.when(F.col("k") == 0, F.lit("")).otherwise(F.lit("1.0")).alias("spec_version"),
        F.when(F.col("k") == 1, F.lit("billing")).otherwise(F.lit("user_activity")).alias("domain"),
        "event_type",
        F.lit("table").alias("source"),
        stamp.alias("timestamp"),
        F.create_map(F.lit("session_id"), F.col("session_id")).alias("correlation"),
        payload.alias("payload"),
    )
    text = F.to_json(envelope)
    cut_off = F.expr("substring(_text, 1, length(_text) - 2)")
    return canonical.withColumn("_text", text).select(
        "event_id", F.when(F.col("k") == 3, cut_off).otherwise(F.col("_text")).alias("value")
    )
