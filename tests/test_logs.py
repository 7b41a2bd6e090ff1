"""Record logs: offsets, restarts, the start behind the last record, several topics in one query."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streaming import start_again

from vigil.sources.canon import event_records
from vigil.sources.logs import Log, consume
from vigil.sources.stores import Store
from vigil.sources.topics import EVENTS, ML_OUT, STAT_OUT
from vigil.streaming import jobs


@pytest.fixture
def records(events):
    key = F.get_json_object("value", "$.payload.user_id").alias("key")  # null where the text is cut off
    return event_records(events).select(key, "value", F.col("event_id").alias("seq"))


def stored(log, spark, store, checkpoint, *topics):
    sink = store.sink("r")
    return log.read_topics(spark, *topics).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def test_records_come_once_and_in_order(spark, records, tmp_path):
    log = Log(str(tmp_path / "log"), "earliest", 5)
    store, checkpoint = Store(spark, str(tmp_path / "out")), str(tmp_path / "c")
    half = F.col("seq") < 500
    n = log.publish(records.where(half), EVENTS, "seq")
    stored(log, spark, store, checkpoint, EVENTS).awaitTermination()
    assert store.read("r").count() == n
    n += log.publish(records.where(~half), EVENTS, "seq")
    start_again(lambda: stored(log, spark, store, checkpoint, EVENTS), tmp_path / "c")
    stored(log, spark, store, checkpoint, EVENTS).awaitTermination()  # nothing new
    got = store.read("r")
    assert n == records.count() == got.count() == got.select("seq").distinct().count()
    assert rows(got.select("key", "value")) == rows(records.select("key", "value"))
    ends = got.groupBy("part").agg(F.count("*").alias("n"), F.max("pos").alias("last"), F.countDistinct("key").alias("keys")).collect()
    assert len(ends) == 5 and all(r["n"] == r["last"] + 1 for r in ends)
    assert got.where("key IS NOT NULL").groupBy("key").agg(F.countDistinct("part").alias("p")).where("p > 1").isEmpty()
    # within a key, positions follow the order of publication
    order = got.join(records.select("value", F.col("seq").alias("sent")), "value").where("key IS NOT NULL")
    for r in order.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("seq", "sent"))).alias("s")).collect():
        sent = [x["sent"] for x in r["s"]]
        assert sent == sorted(sent)


def test_latest_starts_behind_what_is_there(spark, records, tmp_path):
    log = Log(str(tmp_path / "log"), "latest", 3)
    store, checkpoint = Store(spark, str(tmp_path / "out")), str(tmp_path / "c")
    log.publish(records.where("seq < 100"), EVENTS, "seq")
    stored(log, spark, store, checkpoint, EVENTS).awaitTermination()
    log.publish(records.where("seq >= 100 AND seq < 150"), EVENTS, "seq")
    stored(log, spark, store, checkpoint, EVENTS).awaitTermination()
    assert rows(store.read("r").select("value")) == rows(records.where("seq >= 100 AND seq < 150").select("value"))
    with pytest.raises(Exception, match="startingOffsets"):
        Log(str(tmp_path / "log"), "tomorrow").read_topics(spark, EVENTS).isStreaming  # noqa: B018
        stored(Log(str(tmp_path / "log"), "tomorrow"), spark, store, str(tmp_path / "d"), EVENTS).awaitTermination()


def test_three_topics_in_one_query(spark, records, tmp_path):
    log = Log(f"file://{tmp_path}/log", "earliest", 2)
    sent = {EVENTS: records.where("seq < 60"), STAT_OUT: records.where("seq >= 60 AND seq < 90").select("value", "seq"), ML_OUT: records.where("seq >= 90 AND seq < 100")}
    for topic, some in sent.items():
        log.publish(some, topic, "seq")
    store = Store(spark, str(tmp_path / "out"))
    handlers = {t: store.sink(t) for t in (*sent, "empty")}
    start_again(lambda: consume(log, spark, handlers, str(tmp_path / "c")), tmp_path / "c")
    for topic, some in sent.items():
        assert rows(store.read(topic).select("value")) == rows(some.select("value"))
    assert store.read("empty").count() == 0


def test_a_log_feeds_the_jobs(spark, records, events, tmp_path):
    log = Log(str(tmp_path / "log"), "earliest", 4)
    log.publish(records, EVENTS, "seq")
    store = Store(spark, str(tmp_path / "out"))
    raw = jobs.store_stream(jobs.valid_events(log.read(spark, EVENTS)), store, "e", str(tmp_path / "c"))
    raw.awaitTermination()
    want = jobs.valid_events(records)
    content = [c for c in want.columns if c not in ("event_id", "seq")]
    assert rows(store.read("e").select(*content)) == rows(want.select(*content))
