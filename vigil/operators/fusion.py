"""Fusion of both verdicts per session.

A session waits until it has a model verdict and at least one statistical verdict, gives out one row and starts anew.
The last model verdict wins, statistical verdicts pile up.

Seen as runs of verdicts of the same kind, a row can only be complete at the first verdict of a run. Run j completes a
row unless run j-1 completed one and had a single verdict (then the session starts empty at run j). So the runs that
complete a row are every second one after the last run with two or more verdicts, or after the first run. That needs
run numbers and a running maximum, nothing that visits the verdicts one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.series import Running, by_key

IDLE_SECONDS = 300
STAT, ML = 0, 1


def _tagged(stat: DataFrame, ml: DataFrame) -> DataFrame:
    shared = ["session_id", "seq", "sec", "timestamp", "anomaly"]
    model_only = ["user_id", "score", "threshold", "event_count", "unique_events"]
    s = stat.select(*shared, "anomaly_type", F.lit(STAT).alias("kind"))
    m = ml.select(*shared, *model_only, F.lit(ML).alias("kind"))
    both = s.unionByName(m, allowMissingColumns=True)
    # Model verdicts always carry a session, so verdicts without one can never find a partner.
    return both.where(F.col("session_id").isNotNull() & (F.col("session_id") != ""))


def segments(stat: DataFrame, ml: DataFrame, idle: int | None = IDLE_SECONDS, limit: int | None = None) -> DataFrame:
    """All verdicts of all sessions with ``part``, ``segment`` and ``completes``.

    ``stat`` needs session_id, seq, sec, timestamp, anomaly, anomaly_type; ``ml`` needs session_id, seq, sec,
    timestamp, anomaly, user_id, score, threshold, event_count, unique_events. A verdict that comes more than ``idle``
    seconds after the one before it finds the session empty.
    """
    gap = F.lit(False) if idle is None else F.coalesce(F.col("sec") - F.col("sec_1") > idle, F.lit(False))
    starts = F.coalesce(F.col("kind") != F.col("kind_1"), F.lit(True)) | F.col("gap")
    anchor = F.greatest(F.lit(1), F.coalesce("_anchor", F.lit(1)))
    completes = F.col("starts") & (F.col("run") >= 2) & ((F.col("run") - anchor) % 2 == 1)
    return (
        by_key(_tagged(stat, ml), ["session_id"], ("sec", "seq", "kind"), limit)
        .apply(
            lambda s: s.colocate(),
            lambda s: s.lag(["sec", "kind"], 1).with_columns({"gap": gap}).with_columns({"starts": starts}),
            lambda s: s.running(Running("_parts", "sum", F.col("gap").cast("long"))).with_columns(
                {"part": F.col("_parts") + F.col("gap").cast("long")}
            ),
            lambda s: s.running(Running("_runs", "sum", F.col("starts").cast("long"), ("part",))).with_columns(
                {"run": F.col("_runs") + F.col("starts").cast("long")}
            ),
            lambda s: s.running(
                Running("_anchor", "max", F.when(~F.col("starts"), F.col("run")), ("part",))
            ).with_columns({"completes": completes}),
            lambda s: s.running(Running("segment", "sum", F.col("completes").cast("long"), ("part",))),
        )
        .frame()
        .drop("sec_1", "kind_1", "gap", "starts", "_parts", "_runs", "_anchor", "run")
    )


def stat_summary():
    """Any anomaly, and the distinct types of anomalous verdicts in sorted order; null when there are none."""
    types = F.array_join(F.array_sort(F.collect_set(F.when(F.col("anomaly"), F.col("anomaly_type")))), ", ")
    return F.bool_or("anomaly"), F.nullif(types, F.lit(""))


def fuse(stat: DataFrame, ml: DataFrame, idle: int | None = IDLE_SECONDS, limit: int | None = None) -> DataFrame:
    """One row per completed segment; its time is that of the verdict that completed it."""
    is_ml = F.col("kind") == ML
    last_ml = F.max_by(
        F.struct("user_id", "anomaly", "score", "threshold", "event_count", "unique_events"),
        F.when(is_ml, F.struct("sec", "seq")),
    )
    types = F.collect_set(F.when(~is_ml & F.col("anomaly"), F.col("anomaly_type")))
    return (
        segments(stat, ml, idle, limit)
        .groupBy("session_id", "part", "segment")
        .agg(
            last_ml.alias("_ml"),
            F.coalesce(F.bool_or(F.when(~is_ml, F.col("anomaly"))), F.lit(False)).alias("stat_anomaly"),
            F.nullif(F.array_join(F.array_sort(types), ", "), F.lit("")).alias("anomaly_type"),
            F.max(F.when(F.col("completes"), F.col("timestamp"))).alias("created_at"),
            F.max(F.when(F.col("completes"), F.col("seq"))).alias("seq"),
            F.bool_or("completes").alias("_done"),
        )
        .where(F.col("_done"))
        .select(
            "seq",
            "session_id",
            "_ml.user_id",
            F.col("_ml.anomaly").alias("ml_anomaly"),
            F.col("_ml.score").alias("ml_score"),
            F.col("_ml.threshold").alias("ml_threshold"),
            "stat_anomaly",
            "anomaly_type",
            "_ml.event_count",
            "_ml.unique_events",
            "created_at",
        )
    )


def join_ml_stat(stat: DataFrame, ml: DataFrame) -> DataFrame:
    """Every model verdict beside the summary of all statistical verdicts of its session, whatever their order.

    The statistical side is one row per session before it meets the model verdicts.
    """
    any_anomaly, types = stat_summary()
    summary = stat.groupBy("session_id").agg(any_anomaly.alias("stat_anomaly"), types.alias("anomaly_type"))
    return ml.withColumnRenamed("anomaly", "ml_anomaly").join(summary, "session_id")
