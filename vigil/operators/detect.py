"""Detectors over point-in-time history, and the cascade that gives one verdict per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import improbable
from vigil.operators.history import (
    CLEAN_SERIES,
    FIRST,
    SECOND,
    Tuning,
    all_counts,
    global_transitions,
    moving_averages,
    previous_events,
    set_epochs,
    type_counts,
    users,
)
from vigil.operators.series import ByKey

# Texts of the verdicts, as consumers of the verdict stream expect them.
NEW_IP = "IP address never seen before"
NEW_USER_AGENT = "User agent never seen before"
NEW_COUNTRY = "Country never seen before"
NORMAL = "No anomaly deteceted"
EMA_MESSAGE = "Event frequency for %s deviates from baseline: %.2f vs EMA=%.2f (σ=%.2f)"
HOUR_MESSAGE = "Activity at unusual hour %d. Count=%d < stdDev=%.2f"
USER_BASELINE = "user history"
GLOBAL_BASELINE = "global history"

HISTORY_COLUMNS = (
    "event_id",
    "seq",
    "ts",
    "sec",
    "hour",
    "user_id",
    "session_id",
    "event_type",
    "ip",
    "user_agent",
    "country",
)

# What nothing after the user's history reads, and what the second stage and the verdict still read.
SPENT = ("ip", "user_agent", "country", "sec_1", "sec_2", "epoch")
SECOND_STAGE_COLUMNS = (
    "event_id",
    "seq",
    "ts",
    "sec",
    "hour",
    "user_id",
    "session_id",
    "event_type",
    "type_count",
    "hour_count",
    "hour_stddev",
    "stage1_type",
    "stage1_message",
    "clean",
)

NEW_VALUE = (("ip", "new_ip"), ("user_agent", "new_user_agent"), ("country", "new_country"))


def new_value(column: str) -> Column:
    return F.col(f"seen_{column}") == 0


def stored_value_type() -> Column:
    """First never-seen value of the event, in the order address, agent, country."""
    chain = None
    for column, name in NEW_VALUE:
        chain = F.when(new_value(column), name) if chain is None else chain.when(new_value(column), name)
    return chain


# --- transitions ------------------------------------------------------------------------------------------------


def markov_level(scope: str, order: int, tuning: Tuning = Tuning()) -> Column:
    """True or false by one histogram, null when it has too little data or the events before are gone."""
    least = tuning.min_total_user if scope == "user" else tuning.min_total_global
    total, count = F.col(f"{scope}_total_{order}"), F.col(f"{scope}_count_{order}")
    return F.when(F.col(f"visible_{order}"), improbable(total, count, least))


LEVELS = (("user", 2), ("user", 1), ("global", 2), ("global", 1))


def markov(df: DataFrame, tuning: Tuning = Tuning()) -> DataFrame:
    """``markov_anomaly`` and ``markov_message``: the first level with data decides, even when it finds nothing."""
    df = df.withColumns({f"_{s}_{o}": markov_level(s, o, tuning) for s, o in LEVELS})
    decided = F.coalesce(*[F.col(f"_{s}_{o}") for s, o in LEVELS])
    step = {
        1: F.concat(F.col(FIRST), F.lit("->"), F.col("event_type")),
        2: F.concat(F.col(SECOND), F.lit("->"), F.col(FIRST), F.lit("->"), F.col("event_type")),
    }
    baseline = {"user": USER_BASELINE, "global": GLOBAL_BASELINE}
    message = None
    for scope, order in LEVELS:
        text = F.concat(F.lit("Unusual transition "), step[order], F.lit(f" based on {baseline[scope]}"))
        has_data = F.col(f"_{scope}_{order}").isNotNull()
        message = F.when(has_data, text) if message is None else message.when(has_data, text)
    return (
        df.withColumn("markov_anomaly", F.coalesce(decided, F.lit(False)))
        .withColumn("markov_message", F.when(F.col("markov_anomaly"), message))
        .drop(*[f"_{s}_{o}" for s, o in LEVELS])
    )


# --- frequency and hour -----------------------------------------------------------------------------------------


def ema_outlier(tuning: Tuning = Tuning()) -> Column:
    sigma = F.col("sigma")
    k = F.when(sigma < 1, tuning.ema_k_small).otherwise(tuning.ema_k)
    return (F.col("deviation") > k * sigma) & (sigma > 0)


def missing_hour() -> Column:
    return F.col("hour_count") == 0


def time_deviation() -> Column:
    return F.col("hour_count") < F.col("hour_stddev")


# --- the cascade ------------------------------------------------------------------------------------------------


def user_history(events: DataFrame, tuning: Tuning = Tuning(), limit: int | None = None) -> ByKey:
    """All per-user history of the first stage, one shuffle by user."""
    return users(events.select(*HISTORY_COLUMNS), limit).apply(
        lambda s: previous_events(s, tuning),
        lambda s: set_epochs(s, tuning),
        all_counts,
        lambda s: type_counts(s, tuning),
    )


def stage1(df: DataFrame, tuning: Tuning = Tuning()) -> DataFrame:
    """``stage1_type`` and ``stage1_message``: stored values first, then transitions. Null when clean."""
    stored = stored_value_type()
    stored_message = F.when(new_value("ip"), NEW_IP).when(new_value("user_agent"), NEW_USER_AGENT).when(
        new_value("country"), NEW_COUNTRY
    )
    df = markov(df, tuning)
    return df.withColumns(
        {
            "stage1_type": F.coalesce(stored, F.when(F.col("markov_anomaly"), F.lit("markov_low_probability"))),
            "stage1_message": F.coalesce(stored_message, F.col("markov_message")),
        }
    ).withColumn("clean", F.col("stage1_type").isNull())


def stage2(df: DataFrame, tuning: Tuning = Tuning()) -> DataFrame:
    """``stage2_type``, ``stage2_message``, ``stage2_status``: frequency first, then hour of day.

    An hour the user never had is an error of the lookup, not a verdict; ``missing_hour='flag'`` counts it as 0.
    """
    outlier, unseen, unusual = ema_outlier(tuning), missing_hour(), time_deviation()
    fails = ~outlier & unseen if tuning.missing_hour == "error" else F.lit(False)
    ema_text = F.format_string(
        EMA_MESSAGE, "event_type", F.col("type_count").cast("double"), F.col("ema"), F.col("sigma")
    )
    hour_text = F.format_string(HOUR_MESSAGE, "hour", "hour_count", "hour_stddev")
    return df.withColumns(
        {
            "stage2_type": F.when(outlier, F.lit("ema_outlier"))
            .when(fails, F.lit(None).cast("string"))
            .when(unusual, F.lit("time_deviation")),
            "stage2_message": F.when(outlier, ema_text)
            .when(fails, F.lit(None).cast("string"))
            .when(unusual, hour_text),
            "stage2_status": F.when(fails, F.lit("error_missing_hour")).otherwise(F.lit("ok")),
        }
    )


def analyse(events: DataFrame, tuning: Tuning = Tuning(), limit: int | None = None) -> DataFrame:
    """Both stages, one row per event.

    The moving averages advance on clean events only. They are computed on series keyed by user, type and ``clean``,
    so flagged events never touch the series of clean ones and no row leaves the table in between.
    """
    history = user_history(events, tuning, limit).apply(lambda s: s.transform(lambda df: df.drop(*SPENT)))
    counted = global_transitions(history.frame(), limit, history.rows, keep=history.split)
    first = stage1(counted, tuning).select(*SECOND_STAGE_COLUMNS)
    series = history.again(first, CLEAN_SERIES, ("sec", "seq"))
    averaged = series.apply(lambda s: s.colocate(), lambda s: moving_averages(s, "type_count", tuning))
    return stage2(averaged.frame(), tuning)


def stat_verdicts(events: DataFrame, tuning: Tuning = Tuning(), limit: int | None = None) -> DataFrame:
    """One verdict per event, normal ones included. Rows whose ``status`` is not ``ok`` carry no verdict."""
    return verdict_rows(analyse(events, tuning, limit))


def verdict_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """The verdict of each row that went through both stages."""
    second = F.col("clean")
    kind = F.coalesce(F.col("stage1_type"), F.when(second, F.col("stage2_type")))
    status = F.when(second, F.col("stage2_status")).otherwise(F.lit("ok"))
    message = F.coalesce(F.col("stage1_message"), F.when(second, F.col("stage2_message")), F.lit(NORMAL))
    failed = F.col("status") != "ok"
    return rows.withColumns({"status": status, "_kind": kind, "_message": message}).select(
        "event_id",
        "seq",
        "ts",
        "user_id",
        "session_id",
        "event_type",
        F.when(~failed, F.col("_kind").isNotNull()).alias("anomaly"),
        F.when(~failed, F.coalesce("_kind", F.lit(""))).alias("anomaly_type"),
        F.when(~failed, F.col("_message")).alias("message"),
        "status",
        *keep,
    )


def stat_results(verdicts: DataFrame) -> DataFrame:
    """Verdicts as they are published; failed events stay out."""
    return verdicts.where(F.col("status") == "ok").select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        "anomaly",
        "anomaly_type",
        "message",
        F.col("ts").alias("timestamp"),
        F.lit("stat").alias("source"),
    )


def failed_events(verdicts: DataFrame) -> DataFrame:
    """Events without a verdict, kept with their reason."""
    return verdicts.where(F.col("status") != "ok").select("event_id", "user_id", "session_id", "ts", "status")
