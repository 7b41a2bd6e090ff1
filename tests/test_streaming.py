"""The same events as a stream give the same rows as the table operators."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.operators import contracts, detect, fusion, strict
from vigil.operators.features import Scaler, ml_batch_features, session_features
from vigil.operators.history import Tuning
from vigil.operators.model import Autoencoder, ml_verdicts
from vigil.operators.past import Past
from vigil.plans.results import IDLE, TUNING
from vigil.sources.canon import event_records
from vigil.sources.stores import Store
from vigil.sources.topics import EVENTS, Folder
from vigil.streaming import jobs
from vigil.streaming import processors as p


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.fixture(scope="module")
def topic(spark, events, tmp_path_factory):
    """The events as record files in four steps of time."""
    root = tmp_path_factory.mktemp("topics")
    records = event_records(events).select(
        F.lit(None).cast("string").alias("key"), "value", F.col("event_id").alias("seq")
    )
    for step in range(4):
        part = records.where((F.col("seq") >= step * 250) & (F.col("seq") < (step + 1) * 250))
        part.coalesce(1).write.mode("append").parquet(f"{root}/{EVENTS}")
    return Folder(str(root))


@pytest.fixture(scope="module")
def arrived(spark, topic):
    """What the stream sees, as a table."""
    return jobs.valid_events(spark.read.parquet(f"{topic.root}/{EVENTS}")).cache()


@pytest.fixture(scope="module")
def first_stage(spark, topic, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stage1")
    store = Store(spark, f"{folder}/store")
    stream = jobs.valid_events(topic.read(spark, EVENTS))
    jobs.start_first_stage(stream, store, f"{folder}/checkpoint", TUNING).awaitTermination()
    return store


def test_first_stage_equals_tables(first_stage, arrived):
    history = detect.user_history(arrived, TUNING)
    table = detect.stage1(detect.global_transitions(history.frame()), TUNING)
    columns = [c for c in first_stage.batch("stage1", 0).columns]
    streamed = first_stage.read("stage1").select(*columns)
    assert first_stage.read("stage1").select("batch_id").distinct().count() == 4
    assert rows(rounded(streamed)) == rows(rounded(table.select(*columns)))


def test_stat_verdicts_equal_tables(spark, first_stage, arrived, tmp_path):
    schema = ", ".join(f"{n} {t}" for n, t in first_stage.batch("stage1", 0).dtypes)
    verdicts = jobs.stat_verdicts(first_stage.stream("stage1", schema, 1), TUNING)
    store = Store(spark, str(tmp_path / "out"))
    jobs.store_stream(verdicts, store, "verdicts", str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(store.read("verdicts").drop("batch_id")) == rows(detect.stat_verdicts(arrived, TUNING))


def test_model_verdicts_equal_tables(spark, topic, arrived, tmp_path):
    scaler = Scaler.fit(session_features(arrived))
    model = Autoencoder.seeded(3)
    stream = jobs.valid_events(topic.read(spark, EVENTS))
    store = Store(spark, str(tmp_path / "out"))
    verdicts = jobs.model_verdicts(stream, model, scaler, 1.0, 1.0, ttl_ms=None)
    jobs.store_stream(verdicts, store, "ml", str(tmp_path / "checkpoint")).awaitTermination()
    table = ml_verdicts(ml_batch_features(arrived), model, scaler, 1.0, 1.0)
    assert rows(rounded(store.read("ml").drop("batch_id"))) == rows(rounded(table))


def test_fusion_equals_tables(spark, arrived, tmp_path):
    verdicts = detect.stat_verdicts(arrived, TUNING).where("status = 'ok'").join(
        arrived.select("event_id", "sec"), "event_id"
    )
    stat = verdicts.withColumnRenamed("ts", "timestamp")
    scaler = Scaler.fit(session_features(arrived))
    ml = ml_verdicts(ml_batch_features(arrived), Autoencoder.seeded(3), scaler, 1.0, 1.0)
    root = tmp_path
    for step in range(3):
        mine = (F.col("seq") >= step * 350) & (F.col("seq") < (step + 1) * 350)
        stat.where(mine).coalesce(1).write.mode("append").parquet(f"{root}/stat")
        ml.where(mine).coalesce(1).write.mode("append").parquet(f"{root}/ml")

    def stream(name, df):
        schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")

    store = Store(spark, f"{root}/out")
    fused = jobs.fuse(stream("stat", stat), stream("ml", ml), IDLE)
    jobs.store_stream(fused, store, "fused", f"{root}/checkpoint").awaitTermination()
    assert rows(rounded(store.read("fused").drop("batch_id"))) == rows(rounded(fusion.fuse(stat, ml, IDLE)))


def test_strict_mode_equals_tables(spark, topic, arrived, tmp_path):
    stream = jobs.valid_events(topic.read(spark, EVENTS))
    store = Store(spark, str(tmp_path / "out"))
    verdicts = jobs.strict_verdicts(stream, arrived, TUNING)
    jobs.store_stream(verdicts, store, "strict", str(tmp_path / "checkpoint")).awaitTermination()
    table = strict.strict_verdicts(arrived, TUNING, strict.stored_transitions(arrived, TUNING), limit=120)
    assert rows(store.read("strict").drop("batch_id")) == rows(table)


@pytest.mark.parametrize("lateness,strict_mode", [(40 * 86400, False), (40 * 86400, True), (2 * 86400, True)])
def test_late_events_count(spark, arrived, tmp_path, lateness, strict_mode):
    """Events in four shuffled steps; what is too late for the stream is worked in afterwards."""
    for step in range(4):
        arrived.where(F.pmod(F.hash("event_id"), F.lit(4)) == step).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = ", ".join(f"{n} {t}" for n, t in arrived.dtypes)

    def start():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        verdicts = jobs.revised_verdicts(stream, arrived, TUNING, lateness, strict_mode)
        return jobs.store_stream(verdicts, store, "v", str(tmp_path / "c"))

    store = Store(spark, str(tmp_path / "out"))
    start_again(start, tmp_path / "c")
    streamed = jobs.current(store.read("v"))
    late = arrived.join(streamed.where("status = 'late'").select("event_id"), "event_id", "left_semi")
    assert streamed.count() == arrived.count()
    assert (late.count() > 50) == (lateness < 40 * 86400)
    everyone = strict.stored_transitions(arrived, TUNING)
    table = strict.verdicts_of(strict.folded_history(arrived, TUNING, everyone, strict_mode), TUNING)
    assert rows(strict.corrected(streamed, arrived, late, TUNING, everyone, strict_mode)) == rows(table)


class CountedMap:
    """A map state that counts what is read."""

    def __init__(self):
        self.rows, self.reads = {}, 0

    def getValue(self, key):
        self.reads += 1
        return self.rows.get(key)

    def containsKey(self, key):
        self.reads += 1
        return key in self.rows

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]

    def clear(self):
        self.rows.clear()


def test_reads_do_not_grow_with_the_history():
    """After 50 or 2,000 events of a user, one more event reads the same few entries."""
    maps = {name: CountedMap() for name in Past.MAPS}
    last, hours, reads = None, None, {}
    for i in range(2001):
        past = Past(TUNING, lambda name: p.Points(maps[name]))
        if last:
            past.last, past.hours = last, hours
        before = sum(m.reads for m in maps.values())
        event = {"sec": i * 40, "hour": i // 90 % 24, "event_type": ("login", "other")[i % 2], "ip": f"ip{i}", "user_agent": f"a{i % 9}", "country": "C"}
        seen = past.observe(event)
        window = TUNING.type_windows.get(event["event_type"], TUNING.default_type_window)
        assert seen["type_count"] == sum(1 for k in range(i % 2, i, 2) if k * 40 >= i * 40 - window)
        past.store(event, seen["recorded"])
        for entries in past.maps.values():
            entries.save()
        last, hours = past.last, past.hours
        reads[i] = sum(m.reads for m in maps.values()) - before
    assert len(maps["values"].rows) > 2000
    assert max(reads[i] for i in range(1900, 2001)) <= max(reads[i] for i in range(20, 60)) + 4 <= 24


def test_order_survives_a_batch_of_many_files(spark, first_stage, arrived, tmp_path):
    """Every micro-batch of the first stage lies in several files, and these are read one per step."""
    names = [c for c in first_stage.batch("stage1", 0).columns]
    store = Store(spark, str(tmp_path / "in"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for b in range(2):
            half = first_stage.read("stage1").where(F.col("batch_id").between(2 * b, 2 * b + 1)).select(*names)
            store.write_batch(half.repartition(4), "stage1", b, ("user_id", "event_type"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "in" / "stage1").rglob("part-*.parquet"))) > 8
    schema = ", ".join(f"{n} {t}" for n, t in first_stage.batch("stage1", 0).dtypes)
    verdicts = jobs.stat_verdicts(store.stream("stage1", schema, 1), TUNING)
    jobs.store_stream(verdicts, store, "verdicts", str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(store.read("verdicts").drop("batch_id")) == rows(detect.stat_verdicts(arrived, TUNING))


def start_again(start, checkpoint):
    """Run, forget that the last batch was committed, run again."""
    start().awaitTermination()
    commits = sorted((checkpoint / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for f in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        f.unlink(missing_ok=True)
    start().awaitTermination()


def test_first_stage_starts_again(spark, topic, first_stage, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    stream = jobs.valid_events(topic.read(spark, EVENTS))
    start_again(lambda: jobs.start_first_stage(stream, store, str(tmp_path / "c"), TUNING), tmp_path / "c")
    for table in ("history", "stage1", "transitions"):
        assert rows(rounded(store.read(table))) == rows(rounded(first_stage.read(table)))


@pytest.mark.parametrize("ttl_ms", [None, 400 * jobs.DAY_MS])
def test_model_verdicts_start_again(spark, topic, arrived, tmp_path, ttl_ms):
    scaler, model = Scaler.fit(session_features(arrived)), Autoencoder.seeded(3)
    store = Store(spark, str(tmp_path / "out"))
    stream = jobs.valid_events(topic.read(spark, EVENTS))

    def start():
        verdicts = jobs.model_verdicts(stream, model, scaler, 1.0, 1.0, ttl_ms=ttl_ms)
        return jobs.store_stream(verdicts, store, "ml", str(tmp_path / "c"))

    start_again(start, tmp_path / "c")
    table = ml_verdicts(ml_batch_features(arrived), model, scaler, 1.0, 1.0)
    assert rows(rounded(store.read("ml").drop("batch_id"))) == rows(rounded(table))


def test_silent_sessions_leave_no_state(spark, tmp_path):
    """Sessions fall silent one after the other; with an expiry the run ends by itself and forgets them."""
    base = "session_id STRING, seq LONG, sec LONG, timestamp TIMESTAMP_NTZ, anomaly BOOLEAN"
    for step in range(4):
        some = spark.range(step * 20, step * 20 + 20).select(
            F.concat(F.lit("s"), "id").alias("session_id"), F.col("id").alias("seq"), F.lit((step + 1) * 10_000).cast("long").alias("sec"),
            F.timestamp_seconds(F.lit((step + 1) * 10_000)).cast("timestamp_ntz").alias("timestamp"), F.lit(True).alias("anomaly"),
        )
        some.withColumn("anomaly_type", F.lit("new_ip")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/stat")
        ml = some.where("seq % 2 = 0").withColumns(
            {"user_id": F.lit(1).cast("long"), "score": F.lit(1.0), "threshold": F.lit(0.5), "event_count": F.lit(5).cast("long"), "unique_events": F.lit(2).cast("long")}
        )
        ml.coalesce(1).write.mode("append").parquet(f"{tmp_path}/ml")

    def stream(name, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")

    store = Store(spark, f"{tmp_path}/out")
    stat = stream("stat", f"{base}, anomaly_type STRING")
    ml = stream("ml", f"{base}, user_id LONG, score DOUBLE, threshold DOUBLE, event_count LONG, unique_events LONG")
    query = jobs.store_stream(jobs.fuse(stat, ml, 300, ttl_ms=600_000), store, "fused", f"{tmp_path}/c")
    assert query.awaitTermination(240)
    assert store.read("fused").count() == 40
    # two rows, state and end, for each of the ten sessions of the last step that still wait
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 20


def test_raw_and_scored_events_of_a_stream(spark, topic, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    jobs.store_stream(jobs.raw_events(topic.read(spark, EVENTS)), store, "raw", str(tmp_path / "c1")).awaitTermination()
    jobs.store_stream(jobs.scored_events(topic.read(spark, EVENTS)), store, "scored", str(tmp_path / "c2")).awaitTermination()
    records = spark.read.parquet(f"{topic.root}/{EVENTS}")
    assert rows(store.read("raw").drop("batch_id")) == rows(jobs.raw_events(records))
    assert rows(store.read("scored").drop("batch_id")) == rows(jobs.scored_events(records))


def test_copies_of_events_collapse(spark, topic, arrived, tmp_path):
    twice = spark.read.parquet(f"{topic.root}/{EVENTS}")
    twice = twice.unionByName(twice.withColumn("seq", F.col("seq") + 100_000))
    twice.coalesce(1).write.parquet(f"{tmp_path}/t/{EVENTS}")
    events = jobs.distinct_events(jobs.valid_events(Folder(f"{tmp_path}/t").read(spark, EVENTS)))
    store = Store(spark, str(tmp_path / "out"))
    jobs.store_stream(events, store, "e", str(tmp_path / "c")).awaitTermination()
    content = [c for c in arrived.columns if c not in ("event_id", "seq")]
    assert rows(store.read("e").select(*content)) == rows(arrived.select(*content).distinct())


def test_strict_lookups_equal_the_histogram(spark, arrived, tmp_path):
    counts = {(None, "a", "b"): 2, ("x", "a", "b"): 3, ("x", "a", "c"): 5, ("y", "a", "b"): 7}
    df = spark.createDataFrame([(*k, v) for k, v in counts.items()], "prev2 STRING, prev1 STRING, cur STRING, n LONG")
    df.withColumn("part", F.pmod(F.crc32("prev1"), F.lit(8))).write.partitionBy("part").parquet(f"{tmp_path}/h")
    stored = strict.StoredTransitions(f"file://{tmp_path}/h", 8, most=1)
    assert stored.of("x", "a", "b") == (17, 12, 8, 3)
    assert stored.of("x", "q", "b") == (0, 0, 0, 0) == stored.of(None, None, "b")


def test_quarantine_keeps_rejected_records(spark, topic, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    (
        topic.read(spark, EVENTS)
        .writeStream.foreachBatch(jobs.quarantine_sink(store))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    everything = spark.read.parquet(f"{topic.root}/{EVENTS}").count()
    assert store.read("accepted").count() + store.read("quarantine").count() == everything
    reasons = {r[0] for r in store.read("quarantine").select("reject_reason").distinct().collect()}
    assert reasons == {"malformed", "spec_version", "domain_mismatch", "user_id"}


def test_minute_counts_with_watermark(spark, topic, arrived, tmp_path):
    stream = jobs.valid_events(topic.read(spark, EVENTS))
    query = (
        jobs.events_per_minute(stream)
        .writeStream.format("memory")
        .queryName("minutes")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    table = arrived.groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("time")).agg(
        F.count(F.lit(1)).alias("events")
    )
    assert rows(spark.table("minutes")) == rows(table)


def test_results_of_a_stream_without_nulls(arrived):
    assert detect.stat_results(detect.stat_verdicts(arrived, Tuning())).where("anomaly IS NULL").count() == 0


def test_keyed_records_are_unchanged(spark, topic):
    records = spark.read.parquet(f"{topic.root}/{EVENTS}")
    keyed = contracts.keyed(records)
    assert keyed.join(records.select("value").distinct(), "value", "left_anti").count() == 0
    assert keyed.where("key IS NULL").count() == 0
