"""Streaming jobs: from event records to stored verdicts.

    events -> user history -> [stage 1 with transitions of all users] -> averages -> statistical verdicts
    events -> session batches -> model verdicts
    both verdicts -> fusion -> aggregated rows

Per-user and per-session work is keyed state. What concerns all users at once, the transition histogram, is a small
table that each micro-batch reads and extends; inside a micro-batch the table operator counts in event order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.functions.columns import minute, unix_seconds
from vigil.operators import contracts, detect, strict
from vigil.operators.features import Scaler
from vigil.operators.fusion import ML, STAT
from vigil.operators.history import FIRST, SECOND, Tuning, global_transitions
from vigil.operators.model import THRESHOLD_MULTIPLIER, Autoencoder, ml_verdicts
from vigil.operators.series import join_null_safe
from vigil.sources.stores import Store, raw_event_rows
from vigil.streaming import processors as p

DAY_MS = 86_400_000
LATENESS = "10 minutes"
ALL_THERE_IS = {"availableNow": True}


def raw_events(records: DataFrame) -> DataFrame:
    """Rows of the raw-event table from a record stream, ``additional`` included."""
    flat = contracts.flatten_event(contracts.validate(records), "seq")
    return raw_event_rows(flat.withColumn("event_id", F.col("seq")))


def scored_events(records: DataFrame) -> DataFrame:
    """What the session model sees of a record stream: session from the payload or else the correlation map."""
    return contracts.ml_input(records, "seq").where("ts IS NOT NULL").withColumn("sec", unix_seconds("ts"))


def valid_events(records: DataFrame) -> DataFrame:
    """Flat valid events of a record stream; ``seq`` is the arrival order of the source."""
    flat = contracts.flatten_event(contracts.validate(records), "seq")
    return flat.select(
        F.col("seq").alias("event_id"),
        "seq",
        "ts",
        unix_seconds("ts").alias("sec"),
        "hour",
        "user_id",
        "session_id",
        "event_type",
        "ip",
        "user_agent",
        "country",
    )


def distinct_events(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Exact copies of an event within ``lateness`` collapse to the first to arrive, as on tables.

    Spark leaves out every row behind the watermark, copy or not: unlike on tables, an event that comes more than ``lateness``
    behind the latest one before its micro-batch can be lost.
    """
    content = [c for c in events.columns if c not in ("event_id", "seq")]
    timed = events.withColumn("_at", F.timestamp_seconds("sec")).withWatermark("_at", lateness)
    return timed.dropDuplicatesWithinWatermark(content).drop("_at")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed(
    df: DataFrame, key: str | list[str], processor, schema: str, ttl_ms: int | None, lateness: str = LATENESS
) -> DataFrame:
    """Keyed state over ``df``. With ``ttl_ms`` silent keys go by event time; ``lateness`` is how far the watermark lags."""
    keys = [key] if isinstance(key, str) else key
    if ttl_ms is not None:
        df = df.withColumn("_at", F.timestamp_seconds("sec")).withWatermark("_at", lateness)
    # The only state store that holds several states of one processor.
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    mode = "None" if ttl_ms is None else "EventTime"
    return df.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", mode)


def user_history(events: DataFrame, tuning: Tuning = Tuning(), ttl_ms: int | None = None) -> DataFrame:
    return _keyed(events, "user_id", p.UserHistory(tuning, ttl_ms), p.HISTORY_SCHEMA, ttl_ms)


def strict_verdicts(
    events: DataFrame, stored_events: DataFrame, tuning: Tuning = Tuning(), ttl_ms: int | None = None
) -> DataFrame:
    """Verdicts in strict mode. The histogram of the stored events is written once, in parts that tasks look up."""
    processor = p.StrictHistory(tuning, strict.stored_transitions(stored_events, tuning), ttl_ms)
    return strict.verdicts_of(_keyed(events, "user_id", processor, p.STRICT_SCHEMA, ttl_ms), tuning)


def revised_verdicts(
    events: DataFrame,
    stored_events: DataFrame,
    tuning: Tuning = Tuning(),
    lateness: int = 3600,
    strict_mode: bool = False,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Verdicts of events in any order of arrival, as if each had come at its time.

    An event that comes at most ``lateness`` seconds behind its user's newest one gives its own verdict and, with it, new ones for
    the events of the user after it; ``current`` takes the last of each. Later events come out with the status ``late`` and no
    verdict, to be worked in by ``strict.corrected``. No event is lost.
    """
    everyone = strict.stored_transitions(stored_events, tuning)
    processor = p.RevisedHistory(tuning, everyone, lateness, strict_mode, ttl_ms)
    rows = _keyed(events, "user_id", processor, p.REVISED_SCHEMA, ttl_ms)
    checked = strict.verdicts_of(rows, tuning, "late")  # one branch: two would keep the state twice
    none = {c: F.when(~F.col("late"), F.col(c)) for c in ("anomaly", "anomaly_type", "message")}
    return checked.withColumns(none | {"status": F.when(F.col("late"), F.lit("late")).otherwise(F.col("status"))}).drop("late")


def current(stored: DataFrame) -> DataFrame:
    """The last verdict of every event of a table written by ``store_stream``."""
    newest = Window.partitionBy("event_id", "seq").orderBy(F.desc("batch_id"))
    return stored.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", "batch_id")


# --- transitions of all users -----------------------------------------------------------------------------------

LEVELS = {
    "global_total_1": [FIRST],
    "global_count_1": [FIRST, "event_type"],
    "global_total_2": [FIRST, SECOND],
    "global_count_2": [FIRST, SECOND, "event_type"],
}


def extend_transitions(history: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Global counts for the rows of a micro-batch, and the histogram after it.

    ``before`` is the histogram of all earlier micro-batches.
    """
    counted = global_transitions(history)
    fresh = history.groupBy(SECOND, FIRST, "event_type").agg(F.sum("recorded").alias("n")).where("n > 0")
    if before is None:
        return counted, fresh
    for name, keys in LEVELS.items():
        opening = before.groupBy(*keys).agg(F.sum("n").alias("_opening"))
        joined = join_null_safe(counted, opening, keys, "left")
        counted = joined.withColumn(name, F.col(name) + F.coalesce("_opening", F.lit(0))).drop("_opening")
    after = fresh.unionByName(before.select(*fresh.columns))
    return counted, after.groupBy(SECOND, FIRST, "event_type").agg(F.sum("n").alias("n"))


def first_stage_sink(store: Store, tuning: Tuning = Tuning()) -> Callable[[DataFrame, int], None]:
    """Stores the history of a micro-batch, then its first-stage verdicts and the extended histogram.

    A batch that is repeated after a failure runs again in full: its keyed state has to be committed, and all it writes
    replaces itself. The state runs once per attempt: everything after it reads the stored history. The rows of a user and
    type lie in one file, so their order survives a reader that takes the files of a batch in several steps.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch, "history", batch_id)
        history = store.batch("history", batch_id)
        before = store.batch("transitions", batch_id - 1) if batch_id else None
        counted, after = extend_transitions(history, before)
        store.write_batch(after, "transitions", batch_id)
        store.write_batch(detect.stage1(counted, tuning), "stage1", batch_id, ("user_id", "event_type"))

    return write


def start_first_stage(
    events: DataFrame,
    store: Store,
    checkpoint: str,
    tuning: Tuning = Tuning(),
    ttl_ms: int | None = None,
    trigger: Mapping = ALL_THERE_IS,
) -> StreamingQuery:
    return (
        user_history(events, tuning, ttl_ms)
        .writeStream.foreachBatch(first_stage_sink(store, tuning))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


# --- statistical verdicts ---------------------------------------------------------------------------------------


def stat_verdicts(stage1: DataFrame, tuning: Tuning = Tuning(), ttl_ms: int | None = None) -> DataFrame:
    """Second stage over a stream of first-stage rows."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stage1.schema.fields)
    averaged = _keyed(
        stage1,
        ["user_id", "event_type"],
        p.Averages(tuning, ttl_ms),
        f"{schema}, ema DOUBLE, deviation DOUBLE, sigma DOUBLE",
        ttl_ms,
    )
    return detect.verdict_rows(detect.stage2(averaged, tuning))


# --- model verdicts ---------------------------------------------------------------------------------------------


def model_verdicts(
    events: DataFrame,
    model: Autoencoder,
    scaler: Scaler,
    stored_threshold: float,
    multiplier: float = THRESHOLD_MULTIPLIER,
    ttl_ms: int | None = 7 * DAY_MS,
) -> DataFrame:
    """Verdicts of full session batches. Events without a session are never scored."""
    with_session = events.where(F.col("session_id") != "")
    features = _keyed(with_session, "session_id", p.SessionBatches(ttl_ms=ttl_ms), p.BATCH_FEATURES_SCHEMA, ttl_ms)
    return ml_verdicts(features, model, scaler, stored_threshold, multiplier)


# --- fusion -----------------------------------------------------------------------------------------------------


def fuse(stat: DataFrame, ml: DataFrame, idle: int | None = 300, ttl_ms: int | None = None) -> DataFrame:
    """Two verdict streams into aggregated rows, both in the columns of the table operator."""
    none = {"user_id": "long", "score": "double", "threshold": "double", "event_count": "long", "unique_events": "long"}
    shared = ["session_id", "seq", "sec", "timestamp", "anomaly"]
    s = stat.select(
        *shared, "anomaly_type", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.lit(STAT).alias("kind")
    )
    m = ml.select(*shared, F.lit(None).cast("string").alias("anomaly_type"), *none, F.lit(ML).alias("kind"))
    both = s.unionByName(m).where(F.col("session_id") != "")
    return _keyed(both, "session_id", p.Fusion(idle, ttl_ms), p.FUSED_SCHEMA, ttl_ms)


# --- minute buckets ---------------------------------------------------------------------------------------------


def events_per_minute(events: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Minute counts of a stream, given out once no earlier event is expected."""
    timed = events.withColumn("_at", F.col("ts").cast("timestamp")).withWatermark("_at", lateness)
    counts = timed.groupBy(F.window("_at", "1 minute")).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(minute(F.col("window.start")).alias("time"), "events")


def store_stream(
    rows: DataFrame,
    store: Store,
    table: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    trigger: Mapping = ALL_THERE_IS,
) -> StreamingQuery:
    """Append a stream to a table, each micro-batch exactly once."""
    return (
        rows.writeStream.foreachBatch(store.sink(table, shape))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def quarantine_sink(store: Store, valid: str = "accepted", broken: str = "quarantine") -> Callable[[DataFrame, int], None]:
    """Splits a micro-batch of records into valid events and rejected records with their reason."""

    def write(batch: DataFrame, batch_id: int) -> None:
        validated = contracts.validate(batch)
        store.write_batch(contracts.flatten_event(validated, "seq"), valid, batch_id)
        rejected = contracts.quarantined(validated).select("seq", "value", "reject_reason")
        store.write_batch(rejected, broken, batch_id)

    return write
