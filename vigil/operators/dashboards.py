"""Dashboard queries: minute buckets, filtered counts, top and latest rows.

Minutes without rows do not appear. Every limit is ordered with a tie-break, so it gives the same rows each time and
runs as a top-k per task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import minute


def any_anomaly() -> Column:
    return F.col("ml_anomaly") | F.col("stat_anomaly")


def in_range(column: str, start: datetime, end: datetime) -> Column:
    return F.col(column).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))


def in_days(rows: DataFrame, start: datetime, end: datetime) -> Column:
    """Days of a range, so that a table in folders by ``day`` is read from those only."""
    return F.col("day").between(F.lit(start.date()), F.lit(end.date())) if "day" in rows.columns else F.lit(True)


def total(rows: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
    rows = rows if condition is None else rows.where(condition)
    return rows.agg(F.count(F.lit(1)).alias(name))


def per_minute(
    rows: DataFrame,
    column: str,
    name: str,
    condition: Column | None = None,
    between: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Rows per minute, after an optional condition and time range."""
    if between is not None:
        rows = rows.where(in_range(column, *between) & in_days(rows, *between))
    if condition is not None:
        rows = rows.where(condition)
    return rows.groupBy(minute(column).alias("time")).agg(F.count(F.lit(1)).alias(name))


def counts_per_minute(
    rows: DataFrame, column: str, counts: dict[str, Column], between: tuple[datetime, datetime] | None = None
) -> DataFrame:
    """Several filtered counts per minute in one pass; minutes where a filter finds nothing show 0."""
    if between is not None:
        rows = rows.where(in_range(column, *between) & in_days(rows, *between))
    return rows.groupBy(minute(column).alias("time")).agg(
        *[F.count_if(condition).alias(name) for name, condition in counts.items()]
    )


def activity_breakdown(events: DataFrame, between: tuple[datetime, datetime] | None = None) -> DataFrame:
    kind = F.col("event_type")
    return counts_per_minute(
        events,
        "ts",
        {
            "total_events": F.lit(True),
            "logins": kind == "login",
            "payments": kind == "payment",
            "failed_logins": kind == "failed_login",
        },
        between,
    )


def recent_anomalies(aggregated: DataFrame, n: int = 200) -> DataFrame:
    return (
        aggregated.where(any_anomaly())
        .orderBy(F.desc("created_at"), F.desc("seq"))
        .limit(n)
        .select(
            "session_id",
            "user_id",
            "anomaly_type",
            "ml_anomaly",
            "stat_anomaly",
            "event_count",
            "unique_events",
            F.col("created_at").alias("timestamp"),
        )
    )


def anomalies_by_type(aggregated: DataFrame, n: int = 20) -> DataFrame:
    """By the joined text, so a row with two types is a group of its own."""
    named = aggregated.where(F.col("anomaly_type").isNotNull() & (F.col("anomaly_type") != ""))
    return counts_by(named, "anomaly_type", "type", "count").orderBy(F.desc("count"), "type").limit(n)


def recent_ml(ml: DataFrame, n: int = 200) -> DataFrame:
    return (
        ml.orderBy(F.desc("timestamp"), F.desc("seq"))
        .limit(n)
        .select(
            "session_id", "user_id", "anomaly", "score", "threshold", "event_count", "unique_events", "timestamp"
        )
    )


def counts_by(rows: DataFrame, column: str, name: str, count: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias(count))


def event_types(events: DataFrame) -> DataFrame:
    return counts_by(events, "event_type", "type", "count").orderBy(F.desc("count"), "type")


def top_users(events: DataFrame, n: int = 50) -> DataFrame:
    return counts_by(events, "user_id", "user_id", "events").orderBy(F.desc("events"), "user_id").limit(n)


def totals(events: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row with both totals."""
    e = events.select(F.lit(1).alias("is_event"))
    a = anomalies.select(F.lit(0).alias("is_event"))
    is_event = F.col("is_event") == 1
    return e.unionAll(a).agg(F.count_if(is_event).alias("events"), F.count_if(~is_event).alias("anomalies"))


def session_rollup(events: DataFrame, n: int = 50) -> DataFrame:
    return (
        events.groupBy("session_id", "user_id")
        .agg(
            F.min("ts").alias("start_time"),
            F.max("ts").alias("end_time"),
            F.count(F.lit(1)).alias("events"),
            F.bool_or(F.col("event_type") == "payment").alias("has_payment"),
            F.sum("value").alias("total_value"),
        )
        .orderBy(F.desc("start_time"), "session_id")
        .limit(n)
    )


def anomaly_rows(stat: DataFrame) -> DataFrame:
    return stat.where("anomaly").select("event_id", "anomaly_type", "user_id", "event_type", "timestamp", "message")


def anomaly_details(stat: DataFrame, n: int = 100) -> DataFrame:
    return anomaly_rows(stat).orderBy(F.desc("timestamp"), F.desc("event_id")).limit(n)


def anomaly_details_by_type(stat: DataFrame) -> DataFrame:
    return counts_by(stat.where("anomaly"), "anomaly_type", "type", "count").orderBy(F.desc("count"), "type")


def session_anomalies(stat: DataFrame, n: int = 50) -> DataFrame:
    return (
        stat.where("anomaly")
        .groupBy("session_id", "user_id")
        .agg(
            F.count(F.lit(1)).alias("anomalies_count"),
            F.array_join(F.array_sort(F.collect_set("anomaly_type")), ", ").alias("anomaly_types"),
        )
        .orderBy(F.desc("anomalies_count"), "session_id")
        .limit(n)
    )
