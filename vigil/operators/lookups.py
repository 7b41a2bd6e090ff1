"""Stored queries over the result tables: latest verdicts, events by id or user, users."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_of_session(results: DataFrame, session_id: str, order: tuple[str, ...]) -> DataFrame:
    """The newest row of one session. The session filter reaches the scan."""
    return results.where(F.col("session_id") == session_id).orderBy(*[F.desc(c) for c in order]).limit(1)


def latest_per_session(results: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The newest row of every session: a ranking whose first row is taken per task before the shuffle."""
    newest = Window.partitionBy("session_id").orderBy(*[F.desc(c) for c in order])
    return results.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def event_by_id(events: DataFrame, event_id: int) -> DataFrame:
    return events.where(F.col("event_id") == event_id)


def newest_first() -> list[Column]:
    return [F.desc("ts"), F.desc("event_id")]


def events_by_user(events: DataFrame, user_id: int, n: int) -> DataFrame:
    return events.where(F.col("user_id") == user_id).orderBy(*newest_first()).limit(n)


def latest_events(events: DataFrame, n: int) -> DataFrame:
    return events.orderBy(*newest_first()).limit(n)


def events_between(events: DataFrame, user_id: int, start: datetime, end: datetime) -> DataFrame:
    """Events of a user between two moments, both included, at second precision. All bounds reach the scan."""
    first = start if start.microsecond == 0 else start.replace(microsecond=0) + timedelta(seconds=1)
    behind = end.replace(microsecond=0) + timedelta(seconds=1)
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (first, behind))
    return events.where((F.col("user_id") == user_id) & (F.col("ts") >= low) & (F.col("ts") < high))


def users_seen(events: DataFrame) -> DataFrame:
    """First and last event of every user."""
    return events.groupBy(F.col("user_id").alias("id")).agg(
        F.min("ts").alias("created_at"), F.max("ts").alias("last_seen")
    )


def upsert_users_seen(stored: DataFrame, events: DataFrame) -> DataFrame:
    """New users are added, known ones get a new ``last_seen`` and keep their ``created_at``."""
    fresh = users_seen(events).withColumnsRenamed({"created_at": "_first", "last_seen": "_last"})
    return stored.join(fresh, "id", "full_outer").select(
        "id",
        F.coalesce("created_at", "_first").alias("created_at"),
        F.greatest("last_seen", "_last").alias("last_seen"),
    )


def user_profiles(events: DataFrame) -> DataFrame:
    """The most recent identity of every user as a profile."""
    newest = Window.partitionBy("user_id").orderBy(F.desc("sec"), F.desc("seq"))
    last = events.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1")
    name = F.concat(F.lit("user"), "user_id").alias("username")
    return last.select(F.col("user_id").alias("id"), name, "country", "ip", "user_agent")


def first_users(users: DataFrame, n: int) -> DataFrame:
    return users.orderBy("id").limit(n)


def user_by_id(users: DataFrame, user_id: int) -> DataFrame:
    return users.where(F.col("id") == user_id)


def require_user(users: DataFrame, user_id: int):
    """The user's row; an unknown id is an error."""
    row = user_by_id(users, user_id).first()
    if row is None:
        raise LookupError(f"no user with id {user_id}")
    return row


def within_retention(events: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Events not older than ``days`` at ``as_of``; the cut-off is a constant, so it prunes files and partitions."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return events.where(F.col("ts") >= cutoff)
