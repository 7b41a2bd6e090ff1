"""One named query per operator, over the whole event table of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.columns import improbable, markov_threshold
from vigil.operators import contracts as c
from vigil.operators import dashboards as d
from vigil.operators import detect as det
from vigil.operators import features as feat
from vigil.operators import fusion as fus
from vigil.operators import history as h
from vigil.operators import lookups as look
from vigil.operators import model as mod
from vigil.operators import rollups as roll
from vigil.operators import strict
from vigil.operators import training as tr
from vigil.operators.sessions import SessionTables
from vigil.plans.results import (
    IDLE,
    TUNING,
    Results,
    fitted_scaler,
    fixed_model,
    held_out_losses,
    model_verdicts,
    results,
)
from vigil.schemas import FEATURES
from vigil.session import intermediate_folder
from vigil.sources import stores, topics, versions
from vigil.sources.canon import event_records, load_canonical

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Points in time and ids the parameterised queries use.
AS_OF = datetime(2024, 1, 31)
RANGE = (datetime(2024, 1, 8), datetime(2024, 1, 22))
SPLIT_AT = datetime(2024, 1, 15)
USER_ID = 7
EVENT_ID = 77
SESSION_ID = "7-2818"
LAST_TRAINED_ID = 500
EVENT = ("event_id", "user_id", "event_type", "ts", "ip", "user_agent", "country", "session_id")


def query(name: str):
    """Register a function of the canonical events."""

    def register(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(load_canonical(spark, folder))

        QUERIES[name] = run
        return fn

    return register


def result_query(name: str):
    """Register a function of the stored result tables."""

    def register(fn: Callable[[Results], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(results(spark, folder))

        QUERIES[name] = run
        return fn

    return register


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


def settled(name: str) -> Column:
    """Rounded a hair off exact ties: averages of counts have short decimals, which end in a 5 now and then."""
    return F.round(F.col(name) + 1e-10, 6).alias(name)


def additional(events: DataFrame) -> DataFrame:
    return events.withColumn("additional", F.to_json(F.struct("value")))


def new_store(df: DataFrame) -> stores.Store:
    return stores.Store(df.sparkSession, f"{intermediate_folder(df.sparkSession)}/store-{uuid.uuid4().hex}")


# --- sources and sinks ------------------------------------------------------------------------------------------


@query("src_keyed_events")
def src_keyed_events(ev: DataFrame) -> DataFrame:
    return topics.publish_events(event_records(ev))


@result_query("src_stat_out_json")
def src_stat_out_json(r: Results) -> DataFrame:
    return topics.publish_verdicts(published(r.stat))


def published(stat: DataFrame, *keep: str) -> DataFrame:
    return stat.select(
        *keep,
        "user_id",
        "session_id",
        "event_type",
        "anomaly",
        "anomaly_type",
        "message",
        "timestamp",
        F.lit("stat").alias("source"),
    )


def stored(rows: DataFrame, table: str, time_column: str) -> DataFrame:
    store = new_store(rows)
    store.append(rows, table, time_column)
    return store.read(table).drop("day")


@query("sink_raw_events")
def sink_raw_events(ev: DataFrame) -> DataFrame:
    return stored(stores.raw_event_rows(additional(ev)), "raw_events", "timestamp")


@result_query("sink_stat_results")
def sink_stat_results(r: Results) -> DataFrame:
    return stored(stores.stat_result_rows(r.stat), "stat_results", "timestamp")


@result_query("sink_ml_results")
def sink_ml_results(r: Results) -> DataFrame:
    rows = stored(stores.ml_result_rows(r.ml), "ml_results", "timestamp")
    return rows.withColumns({"score": F.round("score", 6), "threshold": F.round("threshold", 6)})


@result_query("sink_aggregated_results")
def sink_aggregated_results(r: Results) -> DataFrame:
    rows = stored(stores.aggregated_rows(r.aggregated), "aggregated_results", "created_at")
    return rows.withColumns({"ml_score": F.round("ml_score", 6), "ml_threshold": F.round("ml_threshold", 6)})


@query("scan_training_events")
def scan_training_events(ev: DataFrame) -> DataFrame:
    return stores.training_events(stores.raw_event_rows(additional(ev)))


@query("retention_7d")
def retention_7d(ev: DataFrame) -> DataFrame:
    store = new_store(ev)
    store.append(stores.raw_event_rows(additional(ev)), "raw_events", "timestamp")
    kept = store.retain("raw_events", AS_OF)
    return kept.select("id", "user_id", "event_type", "timestamp")


@query("upsert_users_seen")
def upsert_users_seen(ev: DataFrame) -> DataFrame:
    store = new_store(ev)
    store.upsert_seen(None, "seen_1", ev.where(F.col("ts") < F.lit(SPLIT_AT)))
    return store.upsert_seen("seen_1", "seen_2", ev.where(F.col("ts") >= F.lit(SPLIT_AT)))


RAW = (
    "id LONG, user_id LONG, event_type STRING, timestamp TIMESTAMP_NTZ, ip STRING, user_agent STRING, country STRING, "
    "metadata STRING, additional STRING, created_at TIMESTAMP_NTZ, session_id STRING"
)
LOOKUPS = "event_id LONG, user_id LONG, event_type STRING, ts TIMESTAMP_NTZ, ip STRING, user_agent STRING, country STRING, session_id STRING"
BUCKETS = 16


@query("retention_versions")
def retention_versions(ev: DataFrame) -> DataFrame:
    """What a reader of the version before and one of the version after the retention see."""
    table = versions.Versioned.by_day(ev.sparkSession, f"{new_store(ev).folder}/raw", RAW, "timestamp")
    before = table.append(stores.raw_event_rows(additional(ev))).read()
    after = versions.retain(table, "timestamp", AS_OF).read()
    return before.join(after.select("id", F.lit(True).alias("kept")), "id", "left").select(
        "id", "user_id", "timestamp", F.coalesce("kept", F.lit(False)).alias("kept")
    )


@query("upsert_seen_buckets")
def upsert_seen_buckets(ev: DataFrame) -> DataFrame:
    table = versions.Versioned.by_hash(ev.sparkSession, f"{new_store(ev).folder}/seen", versions.SEEN, "id", BUCKETS)
    versions.merge_seen(table, ev.where(F.col("ts") < F.lit(SPLIT_AT)))
    return versions.merge_seen(table, ev.where(F.col("ts") >= F.lit(SPLIT_AT))).read()


def clustered(ev: DataFrame, key: str, *bloom: str) -> versions.Snapshot:
    folder = f"{new_store(ev).folder}/{key}"
    return versions.Versioned.by_hash(ev.sparkSession, folder, LOOKUPS, key, BUCKETS, ("ts",), bloom=bloom).append(ev)


@query("clustered_events_by_user")
def clustered_events_by_user(ev: DataFrame) -> DataFrame:
    return look.events_by_user(clustered(ev, "user_id").lookup(USER_ID), USER_ID, 20).select(*EVENT)


@query("clustered_event_by_id")
def clustered_event_by_id(ev: DataFrame) -> DataFrame:
    return look.event_by_id(clustered(ev, "user_id", "event_id").read(), EVENT_ID).select(*EVENT)


@query("clustered_session")
def clustered_session(ev: DataFrame) -> DataFrame:
    return clustered(ev, "session_id").lookup(SESSION_ID).select(*EVENT)


# --- validation and routing -------------------------------------------------------------------------------------


def validated_envelopes(ev: DataFrame) -> DataFrame:
    return c.validate_envelope(c.parse_envelope(event_records(ev)))


@query("parse_envelope")
def parse_envelope(ev: DataFrame) -> DataFrame:
    parsed = c.parse_envelope(event_records(ev))
    fields = ["spec_version", "domain", "event_type", "source"]
    readable = [F.when(~F.col("malformed"), F.col(f"envelope.{f}")).alias(f) for f in fields]
    return parsed.select("event_id", "malformed", *readable)


@query("validate_envelope")
def validate_envelope(ev: DataFrame) -> DataFrame:
    return validated_envelopes(ev).select("event_id", "reject_reason")


@query("parse_payload")
def parse_payload(ev: DataFrame) -> DataFrame:
    parsed = c.parse_payload(validated_envelopes(ev)).where(F.col("reject_reason").isNull())
    return parsed.select(
        "event_id",
        "payload.user_id",
        "payload.type",
        "payload.session_id",
        "payload.metadata.ip",
        "payload.metadata.user_agent",
        "payload.metadata.country",
        "payload.additional",
    )


@query("validate_payload")
def validate_payload(ev: DataFrame) -> DataFrame:
    return c.validate(event_records(ev)).select("event_id", "reject_reason")


@query("filter_domain")
def filter_domain(ev: DataFrame) -> DataFrame:
    return c.filter_domain(validated_envelopes(ev)).select("event_id", "envelope.domain")


@query("quarantine_counts")
def quarantine_counts(ev: DataFrame) -> DataFrame:
    return c.quarantine_counts(c.validate(event_records(ev)))


@query("route_domains")
def route_domains(ev: DataFrame) -> DataFrame:
    def activity(df: DataFrame) -> DataFrame:
        return c.flatten_event(c.validate_payload(c.parse_payload(df)), "event_id").select(
            "event_id", "domain", "user_id"
        )

    def accounting(df: DataFrame) -> DataFrame:
        return df.select("event_id", "envelope.domain")

    return c.route_domains(
        validated_envelopes(ev),
        {c.USER_ACTIVITY: activity, "accounting": accounting},
        aliases={"billing": "accounting"},
    )


@query("flatten_event")
def flatten_event(ev: DataFrame) -> DataFrame:
    return c.flatten_event(c.validate(event_records(ev)), "event_id")


@query("build_envelope")
def build_envelope(ev: DataFrame) -> DataFrame:
    return c.build_envelope(additional(ev), "table", "event_id")


@query("ml_input_projection")
def ml_input_projection(ev: DataFrame) -> DataFrame:
    return c.ml_input(event_records(ev), "event_id")


@result_query("decode_stat_result")
def decode_stat_result(r: Results) -> DataFrame:
    records = c.encode(published(r.stat, "event_id"), "event_id")
    return c.decode_stat_result(records, "event_id")


@result_query("decode_ml_result")
def decode_ml_result(r: Results) -> DataFrame:
    rows = r.ml.select(
        "seq",
        "user_id",
        "session_id",
        "timestamp",
        "anomaly",
        "score",
        "threshold",
        "event_count",
        "unique_events",
        "source",
    )
    decoded = c.decode_ml_result(c.encode(rows, "seq"), "seq")
    return decoded.withColumns({"score": F.round("score", 6), "threshold": F.round("threshold", 6)})


@query("dedupe_events")
def dedupe_events(ev: DataFrame) -> DataFrame:
    coarse = ev.select(
        "seq", F.to_date("ts").alias("day"), "user_id", "event_type", "ip", "user_agent", "country"
    )
    return c.dedupe_events(coarse)


# --- history ----------------------------------------------------------------------------------------------------


def over_users(ev: DataFrame, *steps: Callable[[h.Series], h.Series]) -> DataFrame:
    return h.users(ev.select(*det.HISTORY_COLUMNS)).apply(*steps).frame()


def previous(s: h.Series) -> h.Series:
    return h.previous_events(s, TUNING)


def epochs(s: h.Series) -> h.Series:
    return h.set_epochs(s, TUNING)


@query("hist_prev_events")
def hist_prev_events(ev: DataFrame) -> DataFrame:
    return over_users(ev, previous).select("event_id", "event_type_1", "sec_1", "event_type_2", "sec_2")


@query("hist_visible_prev")
def hist_visible_prev(ev: DataFrame) -> DataFrame:
    return over_users(ev, previous).select("event_id", "visible_1", "visible_2", "recorded")


@query("ttl_epochs")
def ttl_epochs(ev: DataFrame) -> DataFrame:
    # A shorter expiry than the live one, so that the table has some.
    short = h.Tuning(set_ttl=2 * 86400)
    return over_users(ev, previous, lambda s: h.set_epochs(s, short)).select("event_id", "epoch")


WEEK = 7 * 86400


@query("win_range_events")
def win_range_events(ev: DataFrame) -> DataFrame:
    return over_users(ev, lambda s: h.count_in_window(s, F.lit(WEEK), [WEEK], "events_before")).select(
        "event_id", "events_before"
    )


@query("win_type_count")
def win_type_count(ev: DataFrame) -> DataFrame:
    return over_users(
        ev, lambda s: h.count_in_window(s.rekey(h.USER_TYPE), F.lit(WEEK), [WEEK], "type_count")
    ).select("event_id", "type_count")


@query("win_type_count_by_type")
def win_type_count_by_type(ev: DataFrame) -> DataFrame:
    return over_users(ev, lambda s: h.type_counts(s, TUNING)).select("event_id", "type_count")


TRANSITIONS = ("total_1", "count_1", "total_2", "count_2")


@query("transition_counts_user")
def transition_counts_user(ev: DataFrame) -> DataFrame:
    return over_users(ev, previous, h.user_transitions).select("event_id", *[f"user_{t}" for t in TRANSITIONS])


def with_global(ev: DataFrame, *steps) -> DataFrame:
    history = h.users(ev.select(*det.HISTORY_COLUMNS)).apply(previous, *steps)
    return h.global_transitions(history.frame(), rows=history.rows)


@query("transition_counts_global")
def transition_counts_global(ev: DataFrame) -> DataFrame:
    return with_global(ev).select("event_id", *[f"global_{t}" for t in TRANSITIONS])


@query("transition_histogram")
def transition_histogram(ev: DataFrame) -> DataFrame:
    return h.transition_histogram(ev, TUNING)


@query("hour_histogram")
def hour_histogram(ev: DataFrame) -> DataFrame:
    return over_users(ev, previous, epochs, h.hour_counts).select("event_id", "hour", "hour_count")


# --- detectors --------------------------------------------------------------------------------------------------


def _detect_new(column: str, name: str) -> None:
    @query(f"detect_{name}")
    def detect(ev: DataFrame) -> DataFrame:
        rows = over_users(ev, previous, epochs, lambda s: h.seen_before(s, column))
        return rows.select("event_id", det.new_value(column).alias(name))


for _column, _name in det.NEW_VALUE:
    _detect_new(_column, _name)


@query("detect_stored_user_data")
def detect_stored_user_data(ev: DataFrame) -> DataFrame:
    rows = over_users(ev, previous, epochs, h.seen_before)
    return rows.select("event_id", det.stored_value_type().alias("anomaly_type"))


def markov_levels(ev: DataFrame, order: int) -> DataFrame:
    rows = with_global(ev, h.user_transitions)
    return rows.select(
        "event_id",
        det.markov_level("user", order, TUNING).alias("by_user"),
        det.markov_level("global", order, TUNING).alias("by_all"),
    )


@query("detect_markov_first")
def detect_markov_first(ev: DataFrame) -> DataFrame:
    return markov_levels(ev, 1)


@query("detect_markov_second")
def detect_markov_second(ev: DataFrame) -> DataFrame:
    return markov_levels(ev, 2)


@query("markov_threshold")
def markov_threshold_query(ev: DataFrame) -> DataFrame:
    total, count = F.col("global_total_2"), F.col("global_count_2")
    return with_global(ev).select(
        "event_id",
        F.round(markov_threshold(total), 6).alias("threshold"),
        improbable(total, count).alias("improbable"),
    )


@query("detect_markov")
def detect_markov(ev: DataFrame) -> DataFrame:
    rows = det.markov(with_global(ev, h.user_transitions), TUNING)
    return rows.select("event_id", "markov_anomaly", "markov_message")


@query("ema_count")
def ema_count(ev: DataFrame) -> DataFrame:
    return all_averages(ev).select("event_id", settled("ema"))


def all_averages(ev: DataFrame) -> DataFrame:
    """Averages over all events of a user and type, without the first stage in front."""
    return over_users(
        ev, lambda s: h.type_counts(s, TUNING), lambda s: h.moving_averages(s, "type_count", TUNING)
    )


@query("ema_count_slow")
def ema_count_slow(ev: DataFrame) -> DataFrame:
    """An average with a long memory, over all events of a type whoever they are from: long series."""
    slow = replace(TUNING, alpha=0.05, ema_ttl=10**9)
    series = h.by_key(ev.withColumns({"x": F.pmod("event_id", F.lit(97))}), ("event_type",))
    averaged = series.apply(lambda s: h.moving_averages(s.colocate(), "x", slow)).frame()
    return averaged.select("event_id", settled("ema"), settled("sigma"))


@query("ema_deviation")
def ema_deviation(ev: DataFrame) -> DataFrame:
    return all_averages(ev).select("event_id", settled("deviation"), settled("sigma"))


@query("detect_ema_outlier")
def detect_ema_outlier(ev: DataFrame) -> DataFrame:
    return all_averages(ev).select("event_id", "type_count", det.ema_outlier(TUNING).alias("ema_outlier"))


@query("hour_stddev")
def hour_stddev(ev: DataFrame) -> DataFrame:
    return over_users(ev, previous, epochs, h.hour_counts).select("event_id", rounded("hour_stddev"))


@query("detect_time_deviation")
def detect_time_deviation(ev: DataFrame) -> DataFrame:
    rows = over_users(ev, previous, epochs, h.hour_counts)
    status = F.when(det.missing_hour(), "error_missing_hour").otherwise("ok")
    return rows.select(
        "event_id",
        status.alias("status"),
        F.when(~det.missing_hour(), det.time_deviation()).alias("time_deviation"),
    )


@query("stage1_cached")
def stage1_cached(ev: DataFrame) -> DataFrame:
    rows = det.stage1(with_global(ev, epochs, h.seen_before, h.user_transitions), TUNING)
    return rows.select("event_id", "stage1_type", "stage1_message")


@query("stage2_statistics")
def stage2_statistics(ev: DataFrame) -> DataFrame:
    rows = det.analyse(ev, TUNING).where("clean")
    return rows.select("event_id", "stage2_type", "stage2_status", settled("ema"), settled("sigma"))


@query("stat_verdicts")
def stat_verdicts(ev: DataFrame) -> DataFrame:
    return det.stat_verdicts(ev, TUNING).drop("seq")


@query("strict_verdicts")
def strict_verdicts(ev: DataFrame) -> DataFrame:
    return strict.strict_verdicts(ev, TUNING).drop("seq")


# --- session features and model ---------------------------------------------------------------------------------


@query("session_count_window")
def session_count_window(ev: DataFrame) -> DataFrame:
    return feat.session_count_window(ev).select("event_id", "batch", "position")


@query("ml_batch_features")
def ml_batch_features(ev: DataFrame) -> DataFrame:
    return feat.ml_batch_features(ev).select("session_id", "batch", *_feature_columns())


def _feature_columns() -> list[Column]:
    return [rounded(f) if f == "avg_hour" else F.col(f) for f in FEATURES]


@query("session_features")
def session_features(ev: DataFrame) -> DataFrame:
    return feat.session_features(ev).select("session_id", "user_id", *_feature_columns())


@query("session_event_sequence")
def session_event_sequence(ev: DataFrame) -> DataFrame:
    rows = feat.session_event_sequence(ev)
    return rows.select("session_id", "part", F.array_join("event_sequence", ",").alias("event_sequence"))


@query("scaler_fit")
def scaler_fit(ev: DataFrame) -> DataFrame:
    return feat.scaler_fit(feat.session_features(ev)).select("feature", rounded("mean"), rounded("scale"))


@query("scaler_transform")
def scaler_transform(ev: DataFrame) -> DataFrame:
    scaled = feat.scaler_transform(feat.session_features(ev), fitted_scaler(ev))
    return scaled.select("session_id", *[rounded(f) for f in FEATURES])


@query("ae_reconstruct")
def ae_reconstruct(ev: DataFrame) -> DataFrame:
    scaled = feat.scaler_transform(feat.session_features(ev), fitted_scaler(ev))
    rebuilt = mod.reconstruct(scaled, fixed_model())
    return rebuilt.select(
        "session_id", *[F.round(F.col("reconstruction")[i], 6).alias(f) for i, f in enumerate(FEATURES)]
    )


@query("ml_verdicts")
def ml_verdicts(ev: DataFrame) -> DataFrame:
    return model_verdicts(ev).select("session_id", "batch", "anomaly", rounded("score"), rounded("threshold"))


@query("ml_verdict_shape")
def ml_verdict_shape(ev: DataFrame) -> DataFrame:
    return model_verdicts(ev).select(
        "user_id", "session_id", "timestamp", "anomaly", "event_count", "unique_events", "source"
    )


@query("train_test_split")
def train_test_split(ev: DataFrame) -> DataFrame:
    return tr.train_test_split(feat.session_features(ev)).select("session_id", "is_train")


@query("ae_train")
def ae_train(ev: DataFrame) -> DataFrame:
    trained = tr.fit(ev)
    return ev.sparkSession.createDataFrame([tuple(trained.metrics.values())], list(trained.metrics))


@query("session_features_merged")
def session_features_merged(ev: DataFrame) -> DataFrame:
    """Features from stored states: of the events before a moment first, then of those after it."""
    tables = SessionTables(ev.sparkSession, f"{new_store(ev).folder}/sessions", BUCKETS)
    tables.merge(ev.where(F.col("ts") < F.lit(SPLIT_AT)))
    tables.merge(ev.where(F.col("ts") >= F.lit(SPLIT_AT)))
    return tables.features().select("session_id", "user_id", *_feature_columns())


@query("minute_rollup")
def minute_rollup(ev: DataFrame) -> DataFrame:
    """Dashboard counts from partial minute counts of two batches that share minutes."""
    store = new_store(ev)
    sink = roll.minutes_sink(store)
    for batch in (0, 1):
        sink(ev.where(F.col("event_id") % 2 == batch), batch)
    kind = F.col("event_type")
    counts = {"total_events": None, "logins": kind == "login", "payments": kind == "payment", "failed_logins": kind == "failed_login"}
    return roll.from_minutes(roll.rolled_up(store, "minutes", "by_day"), counts, RANGE)


@query("ae_gradient")
def ae_gradient(ev: DataFrame) -> DataFrame:
    """One synchronous step's gradient over all training sessions, and their loss behind the last parameter."""
    scaled = feat.scaler_transform(feat.session_features(ev), fitted_scaler(ev))
    gradient = tr.loss_gradient(tr.train_test_split(scaled).where("is_train"), fixed_model())
    return gradient.select("position", F.round("value", 7).alias("value"))


@query("loss_threshold")
def loss_threshold(ev: DataFrame) -> DataFrame:
    return tr.evaluate(held_out_losses(ev)).select(rounded("test_loss"), rounded("threshold"), "batches")


@query("training_metadata")
def training_metadata(ev: DataFrame) -> DataFrame:
    return tr.training_metadata(ev)


@query("retrain_new_events")
def retrain_new_events(ev: DataFrame) -> DataFrame:
    return tr.new_events(ev, LAST_TRAINED_ID)


@query("retrain_decision")
def retrain_decision(ev: DataFrame) -> DataFrame:
    state = tr.TrainingState(last_event_id=LAST_TRAINED_ID, trained_at="2024-01-30T20:00:00+00:00")
    return tr.retrain_decision(ev, state, AS_OF)


# --- fusion -----------------------------------------------------------------------------------------------------


FUSED = ("session_id", "user_id", "ml_anomaly", "stat_anomaly", "event_count", "unique_events", "created_at")


@result_query("fuse_sessions")
def fuse_sessions(r: Results) -> DataFrame:
    return fus.fuse(r.stat, r.ml, idle=None).select(*FUSED, rounded("ml_score"), rounded("ml_threshold"))


@result_query("fuse_anomaly_types")
def fuse_anomaly_types(r: Results) -> DataFrame:
    return fus.fuse(r.stat, r.ml, idle=None).select("session_id", "created_at", "anomaly_type")


@result_query("fuse_idle_expiry")
def fuse_idle_expiry(r: Results) -> DataFrame:
    return fus.fuse(r.stat, r.ml, IDLE).select(*FUSED, "anomaly_type")


@result_query("join_ml_stat")
def join_ml_stat(r: Results) -> DataFrame:
    return fus.join_ml_stat(r.stat, r.ml).select(
        "session_id", "timestamp", "ml_anomaly", rounded("score"), "stat_anomaly", "anomaly_type"
    )


# --- stored queries ---------------------------------------------------------------------------------------------


@result_query("latest_aggregated")
def latest_aggregated(r: Results) -> DataFrame:
    rows = look.latest_per_session(r.aggregated, ("created_at", "seq"))
    return rows.select("session_id", "created_at", "ml_anomaly", "stat_anomaly", "anomaly_type")


@result_query("latest_ml")
def latest_ml(r: Results) -> DataFrame:
    rows = look.latest_per_session(r.ml, ("timestamp", "seq"))
    return rows.select("session_id", "timestamp", "anomaly", rounded("score"))


@result_query("latest_stat")
def latest_stat(r: Results) -> DataFrame:
    rows = look.latest_per_session(r.stat, ("timestamp", "seq"))
    return rows.select("session_id", "timestamp", "event_type", "anomaly", "anomaly_type")


@result_query("latest_stat_of_session")
def latest_stat_of_session(r: Results) -> DataFrame:
    rows = look.latest_of_session(r.stat, SESSION_ID, ("timestamp", "seq"))
    return rows.select("session_id", "timestamp", "event_type", "anomaly", "anomaly_type")


@query("event_by_id")
def event_by_id(ev: DataFrame) -> DataFrame:
    return look.event_by_id(ev, EVENT_ID).select(*EVENT)


@query("events_by_user")
def events_by_user(ev: DataFrame) -> DataFrame:
    return look.events_by_user(ev, USER_ID, 20).select(*EVENT)


@query("latest_events")
def latest_events(ev: DataFrame) -> DataFrame:
    return look.latest_events(ev, 50).select(*EVENT)


@query("events_between")
def events_between(ev: DataFrame) -> DataFrame:
    return look.events_between(ev, USER_ID, *RANGE).select(*EVENT)


@query("user_seen_by_id")
def user_seen_by_id(ev: DataFrame) -> DataFrame:
    return look.user_by_id(look.users_seen(ev), USER_ID)


@query("users_limit")
def users_limit(ev: DataFrame) -> DataFrame:
    return look.first_users(look.user_profiles(ev), 10)


@query("user_profile_by_id")
def user_profile_by_id(ev: DataFrame) -> DataFrame:
    return look.user_by_id(look.user_profiles(ev), USER_ID)


# --- dashboards -------------------------------------------------------------------------------------------------


def _register_dashboards() -> None:
    on_events: dict[str, Callable[[DataFrame], DataFrame]] = {
        "dash_events_per_min": lambda ev: d.per_minute(ev, "ts", "events", between=RANGE),
        "dash_login_per_min": lambda ev: d.counts_per_minute(
            ev, "ts", {"login": F.col("event_type") == "login"}, RANGE
        ),
        "dash_payment_per_min": lambda ev: d.counts_per_minute(
            ev, "ts", {"payment": F.col("event_type") == "payment"}, RANGE
        ),
        "dash_failed_login_per_min": lambda ev: d.counts_per_minute(
            ev, "ts", {"failed_login": F.col("event_type") == "failed_login"}, RANGE
        ),
        "dash_event_types": d.event_types,
        "dash_top_users": d.top_users,
        "dash_activity_breakdown": lambda ev: d.activity_breakdown(ev, RANGE),
        "session_rollup": lambda ev: d.session_rollup(ev).withColumn("total_value", F.round("total_value", 4)),
    }
    on_results: dict[str, Callable[[Results], DataFrame]] = {
        "dash_total_results": lambda r: d.total(r.aggregated, "total_results"),
        "dash_ml_anomalies": lambda r: d.total(r.aggregated, "ml_anomalies", F.col("ml_anomaly")),
        "dash_stat_anomalies": lambda r: d.total(r.aggregated, "stat_anomalies", F.col("stat_anomaly")),
        "dash_anomalies_per_min": lambda r: d.per_minute(r.aggregated, "created_at", "anomalies", d.any_anomaly()),
        "dash_ml_per_min": lambda r: d.per_minute(r.aggregated, "created_at", "ml_only", F.col("ml_anomaly")),
        "dash_stat_per_min": lambda r: d.per_minute(
            r.aggregated, "created_at", "stat_only", F.col("stat_anomaly")
        ),
        "dash_recent_anomalies": lambda r: d.recent_anomalies(r.aggregated),
        "dash_raw_ml_per_min": lambda r: d.per_minute(r.ml, "timestamp", "ml_events", F.col("anomaly")),
        "dash_raw_stat_per_min": lambda r: d.per_minute(r.stat, "timestamp", "stat_events", F.col("anomaly")),
        "dash_by_type": lambda r: d.anomalies_by_type(r.aggregated),
        "dash_recent_ml": lambda r: d.recent_ml(r.ml).withColumns(
            {"score": F.round("score", 6), "threshold": F.round("threshold", 6)}
        ),
        "dash_anomalies_per_min_range": lambda r: d.per_minute(
            r.aggregated, "created_at", "anomalies", d.any_anomaly(), RANGE
        ),
        "anomaly_details": lambda r: d.anomaly_details(r.stat),
        "anomaly_details_by_type": lambda r: d.anomaly_details_by_type(r.stat),
        "session_anomalies": lambda r: d.session_anomalies(r.stat),
    }
    for name, fn in on_events.items():
        query(name)(fn)
    for name, fn in on_results.items():
        result_query(name)(fn)


_register_dashboards()


def _dash_totals(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return d.totals(load_canonical(spark, folder), d.anomaly_rows(results(spark, folder).stat))


QUERIES["dash_totals"] = _dash_totals
