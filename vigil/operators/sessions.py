"""Session features from states that merge, so that training reads new events only.

A session's state is two sets of rows: its distinct values, one row per (session, field, value), and one row of sums. States of
any split of the events merge to the state of all of them. Values are told apart by grouping, never by distinct counts
of several columns at once (which would copy every event per column) and never in one task's set, so a session may hold a
large share of all events. Stored states lie in hash buckets of the session, and a merge reads and writes the touched buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import materialise
from vigil.sources.versions import Snapshot, Versioned

# Field of a value and the feature that counts it.
FIELDS = {"ip": "unique_ips", "country": "unique_countries", "user_agent": "unique_agents", "event_type": "unique_events"}
VALUES = "session_id STRING, field STRING, value STRING"
SUMS = (
    "session_id STRING, first_sec LONG, first_seq LONG, user_id LONG, events LONG, untyped BOOLEAN, "
    "min_hour INT, max_hour INT, hours LONG, timed LONG"
)


def _merged_sums(rows: DataFrame) -> DataFrame:
    first = F.min(F.when(F.col("user_id").isNotNull(), F.struct("first_sec", "first_seq", "user_id"))).alias("first")
    merged = rows.groupBy("session_id").agg(
        first,
        F.sum("events").alias("events"),
        F.max("untyped").alias("untyped"),
        F.min("min_hour").alias("min_hour"),
        F.max("max_hour").alias("max_hour"),
        F.sum("hours").alias("hours"),
        F.sum("timed").alias("timed"),
    )
    return merged.select(
        "session_id", "first.first_sec", "first.first_seq", "first.user_id", "events", "untyped", "min_hour", "max_hour", "hours", "timed"
    )


def session_states(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Values and sums of the sessions of ``events``; null sessions are left out."""
    rows = events.where(F.col("session_id").isNotNull())
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in FIELDS)))
    # the four values of an event mostly come together: one row per combination is what gets taken apart
    combined = rows.select("session_id", *FIELDS).distinct()
    values = combined.select("session_id", pairs.alias("p")).select("session_id", "p.field", "p.value").where("value IS NOT NULL").distinct()
    sums = rows.select(
        "session_id",
        F.col("sec").alias("first_sec"),
        F.col("seq").alias("first_seq"),
        "user_id",
        F.lit(1).cast("long").alias("events"),
        F.col("event_type").isNull().alias("untyped"),
        F.col("hour").alias("min_hour"),
        F.col("hour").alias("max_hour"),
        F.col("hour").cast("long").alias("hours"),
        F.col("hour").isNotNull().cast("long").alias("timed"),
    )
    return values, _merged_sums(sums)


def merge_states(*states: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    values, sums = states[0]
    for v, s in states[1:]:
        values, sums = values.unionByName(v), sums.unionByName(s)
    return values.distinct(), _merged_sums(sums)


def features_of(values: DataFrame, sums: DataFrame) -> DataFrame:
    """Session features, in the columns of ``session_features``."""
    counted = values.groupBy("session_id").agg(*(F.count_if(F.col("field") == f).alias(name) for f, name in FIELDS.items()))
    both = sums.join(counted, "session_id", "left")
    none = F.lit(0).cast("long")
    return both.select(
        "session_id",
        "user_id",
        F.coalesce("unique_ips", none).alias("unique_ips"),
        F.coalesce("unique_countries", none).alias("unique_countries"),
        F.coalesce("unique_agents", none).alias("unique_agents"),
        F.col("events").alias("event_count"),
        (F.coalesce("unique_events", none) + F.col("untyped").cast("long")).alias("unique_events"),
        "min_hour",
        "max_hour",
        F.try_divide("hours", "timed").alias("avg_hour"),
    )


class SessionTables:
    """States of all sessions seen so far, in a folder."""

    def __init__(self, spark, folder: str, buckets: int = 64):
        self.values = Versioned.by_hash(spark, f"{folder}/values", VALUES, "session_id", buckets)
        self.sums = Versioned.by_hash(spark, f"{folder}/sums", SUMS, "session_id", buckets)

    def merge(self, events: DataFrame) -> None:
        """Work in events that are not in the tables yet. Values may come twice, sums must not: they are written last, so a
        merge that failed in between can be repeated."""
        values, sums = (materialise(x) for x in session_states(events))
        touched = [r[0] for r in sums.select(self.sums.slot.alias("s")).distinct().collect()]  # at most the number of buckets
        seen_values, seen_sums = self.values.snapshot(), self.sums.snapshot()
        new_values, new_sums = merge_states((seen_values.read(touched), seen_sums.read(touched)), (values, sums))
        self.values.replace(seen_values, touched, new_values)
        self.sums.replace(seen_sums, touched, new_sums)

    def snapshots(self) -> tuple[Snapshot, Snapshot]:
        return self.values.snapshot(), self.sums.snapshot()

    def features(self) -> DataFrame:
        values, sums = self.snapshots()
        return features_of(values.read(), sums.read())

    def totals(self) -> DataFrame:
        """Events and sessions the tables hold, without reading an event."""
        return self.sums.read().agg(F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"), F.count(F.lit(1)).alias("total_sessions"))
