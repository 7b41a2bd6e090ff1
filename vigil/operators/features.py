"""Session features, scaling and the count window used when serving."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.series import Running, by_key
from vigil.schemas import FEATURES

GROUP = 5


def session_count_window(events: DataFrame, size: int = GROUP, limit: int | None = None) -> DataFrame:
    """Adds ``batch`` and ``position``: every ``size`` events of a session, in order, form one batch."""
    with_session = events.where(F.col("session_id").isNotNull() & (F.col("session_id") != ""))
    return (
        by_key(with_session, ["session_id"], limit=limit)
        .apply(
            lambda s: s.colocate(),
            lambda s: s.running(Running("_nth", "sum", F.lit(1))),
            lambda s: s.with_columns(
                {"batch": F.floor(F.col("_nth") / size), "position": F.col("_nth") % size}
            ),
        )
        .frame()
        .drop("_nth")
    )


def _few_values(column: str) -> Column:
    return F.size(F.collect_set(column)).cast("long")


def ml_batch_features(events: DataFrame, size: int = GROUP, limit: int | None = None) -> DataFrame:
    """Features of each full batch, with the user and time of the event that completed it.

    A batch has ``size`` rows, so its distinct values fit a small set: one aggregation instead of one per distinct
    column. Batches are spread by session and batch number, however long a session is.
    """
    numbered = session_count_window(events, size, limit)
    last = F.struct("sec", "seq")
    return (
        numbered.groupBy("session_id", "batch")
        .agg(
            _few_values("ip").alias("unique_ips"),
            _few_values("country").alias("unique_countries"),
            _few_values("user_agent").alias("unique_agents"),
            F.count(F.lit(1)).alias("event_count"),
            _few_values("event_type").alias("unique_events"),
            F.min("hour").alias("min_hour"),
            F.max("hour").alias("max_hour"),
            F.avg("hour").alias("avg_hour"),
            F.max_by("user_id", last).alias("user_id"),
            F.max_by("ts", last).alias("ts"),
            F.max_by("sec", last).alias("sec"),
            F.max("seq").alias("seq"),
        )
        .where(F.col("event_count") == size)
    )


def session_features(events: DataFrame, keep_empty: bool = True, limit: int | None = None) -> DataFrame:
    """The same features per whole session, for training.

    Null sessions are left out; the session ``""`` counts as one session unless ``keep_empty`` is false. Distinct
    counts of values skip null, the counts of events and of event types do not. Ordinary sessions are laid out once, in tasks
    of bounded size; an oversized one is combined where its events lie.
    """
    rows = events.where(F.col("session_id").isNotNull())
    if not keep_empty:
        rows = rows.where(F.col("session_id") != "")
    rows = rows.select("session_id", "user_id", "event_type", "ip", "country", "user_agent", "hour", "sec", "seq")
    parts = by_key(rows, ["session_id"], limit=limit)
    return parts.apply(lambda s: s.colocate(), lambda s: s.transform(_whole_sessions)).frame()


def _whole_sessions(rows: DataFrame) -> DataFrame:
    # A session's events mostly share few combinations of values: distinct counts copy these, not every event.
    combined = rows.groupBy("session_id", "ip", "country", "user_agent", "event_type").agg(
        F.min(F.when(F.col("user_id").isNotNull(), F.struct("sec", "seq", "user_id"))).alias("first"),
        F.count(F.lit(1)).alias("events"),
        F.min("hour").alias("min_hour"),
        F.max("hour").alias("max_hour"),
        F.sum("hour").alias("hours"),
        F.count("hour").alias("timed"),
    )
    null_types = F.max(F.col("event_type").isNull().cast("long"))
    return (
        combined.groupBy("session_id")
        .agg(
            F.min("first").alias("first"),
            F.count_distinct("ip").alias("unique_ips"),
            F.count_distinct("country").alias("unique_countries"),
            F.count_distinct("user_agent").alias("unique_agents"),
            F.sum("events").alias("event_count"),
            (F.count_distinct("event_type") + null_types).alias("unique_events"),
            F.min("min_hour").alias("min_hour"),
            F.max("max_hour").alias("max_hour"),
            F.try_divide(F.sum("hours"), F.sum("timed")).alias("avg_hour"),
        )
        .select("session_id", F.col("first.user_id").alias("user_id"), *FEATURES)
    )


def session_event_sequence(events: DataFrame, part_size: int = 10_000, limit: int | None = None) -> DataFrame:
    """The event types of each session in order, as lists of at most ``part_size``.

    A session of ordinary length is one row (``part`` 0). A longer one goes on in the next part, so a session that
    holds a large share of the table never becomes one list.
    """
    parts = _numbered(events, part_size, limit)
    ordered = F.sort_array(F.collect_list(F.struct("position", "event_type")))
    return parts.groupBy("session_id", F.col("batch").alias("part")).agg(
        F.transform(ordered, lambda e: e["event_type"]).alias("event_sequence")
    )


def _numbered(events: DataFrame, size: int, limit: int | None = None) -> DataFrame:
    """As ``session_count_window``, for the session ``""`` too."""
    rows = events.where(F.col("session_id").isNotNull()).select("session_id", "event_type", "sec", "seq")
    return (
        by_key(rows, ["session_id"], limit=limit)
        .apply(
            lambda s: s.colocate(),
            lambda s: s.running(Running("_nth", "sum", F.lit(1))),
        )
        .frame()
        .withColumns({"batch": F.floor(F.col("_nth") / size), "position": F.col("_nth") % size})
        .drop("_nth")
    )


# --- scaling ----------------------------------------------------------------------------------------------------


def scaler_fit(features: DataFrame) -> DataFrame:
    """One row per feature: mean and population deviation, 1 where a feature does not vary."""
    moments = features.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in FEATURES], *[F.stddev_pop(c).alias(f"{c}_std") for c in FEATURES]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("feature"),
                    F.col(f"{c}_mean").alias("mean"),
                    F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std")).alias("scale"),
                )
                for i, c in enumerate(FEATURES)
            ]
        )
    )
    return moments.select(rows.alias("_row")).select("_row.*")


@dataclass(frozen=True)
class Scaler:
    """The fitted scaler as plain numbers, in the order of ``FEATURES``."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]

    @staticmethod
    def fit(features: DataFrame) -> Scaler:
        """Eight rows come back, whatever the size of the table."""
        rows = sorted(scaler_fit(features).collect(), key=lambda r: r["position"])
        return Scaler(tuple(r["mean"] for r in rows), tuple(r["scale"] for r in rows))


def scaler_transform(features: DataFrame, scaler: Scaler | None) -> DataFrame:
    """Scaled features under their own names."""
    if scaler is None:
        raise ValueError("a fitted scaler is needed")
    return features.withColumns(
        {c: (F.col(c) - m) / s for c, m, s in zip(FEATURES, scaler.mean, scaler.scale, strict=True)}
    )
