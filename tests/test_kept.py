"""What is kept from batch to batch: session states and minute counts."""

from conftest import rows, same
from pyspark.sql import functions as F

from vigil.operators import features as feat
from vigil.operators import rollups
from vigil.operators import sessions as ss
from vigil.operators.dashboards import activity_breakdown, per_minute
from vigil.sources.stores import Store

def holes():
    return {
        "session_id": F.when(F.col("seq") % 50 == 0, None).when(F.col("seq") % 41 == 0, "").otherwise(F.col("session_id")),
        "event_type": F.when(F.col("seq") % 9 != 0, F.col("event_type")),
        "ip": F.when(F.col("seq") % 7 != 0, F.col("ip")),
        "user_id": F.when(F.col("seq") % 5 != 0, F.col("user_id")),
        "country": F.lit(None).cast("string"),
    }


def test_states_give_the_features(events):
    for some in (events, events.withColumns(holes()), events.limit(0)):
        same(ss.features_of(*ss.session_states(some)), feat.session_features(some))


def test_states_of_any_split_merge(events):
    odd = events.withColumns(holes())
    parts = [ss.session_states(odd.where(F.pmod(F.hash("event_id"), F.lit(3)) == i)) for i in range(3)]
    same(ss.features_of(*ss.merge_states(*parts)), feat.session_features(odd))


def test_no_event_is_copied_per_column(events):
    plan = ss.features_of(*ss.session_states(events))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Expand" in feat.session_features(events)._jdf.queryExecution().executedPlan().toString()


def test_a_merge_writes_the_touched_buckets(spark, events, tmp_path):
    tables = ss.SessionTables(spark, str(tmp_path), 32)
    tables.merge(events.where("event_id < 900"))
    before = tables.snapshots()
    last = events.where("event_id = 950")
    tables.merge(last)
    for old, new in zip(before, tables.snapshots(), strict=True):
        assert len([s for s in new.slots if new.slots[s] != old.slots.get(s)]) == 1 and len(new.slots) > 20
    tables.merge(events.where("event_id >= 900 AND event_id <> 950"))
    same(tables.features(), feat.session_features(events))
    want = events.agg(F.count("*"), F.count_distinct("session_id")).first()
    assert tuple(tables.totals().first()) == tuple(want)


def test_minutes_of_a_stream_with_late_events(spark, events, tmp_path):
    """Four shuffled batches share their minutes; a batch that comes again replaces itself."""
    store = Store(spark, str(tmp_path / "s"))
    sink = rollups.minutes_sink(store)
    for batch in (0, 1, 2, 3, 3):
        sink(events.where(F.pmod(F.hash("event_id"), F.lit(4)) == batch), batch)
    kept = rollups.rolled_up(store, "minutes", "by_day")
    kind = F.col("event_type")
    counts = {"total_events": None, "logins": kind == "login", "payments": kind == "payment", "failed_logins": kind == "failed_login"}
    same(rollups.from_minutes(kept, counts), activity_breakdown(events))
    same(rollups.from_minutes(store.read("minutes"), {"events": None}), per_minute(events, "ts", "events"))


def test_minutes_are_far_fewer_rows(spark, tmp_path):
    many = spark.range(50_000).select(
        F.timestamp_seconds(F.col("id") % 600).cast("timestamp_ntz").alias("ts"), F.lit("login").alias("event_type")
    )
    kept = rollups.minute_partials(many)
    assert kept.count() == 10 and rows(rollups.from_minutes(kept, {"events": None})) == rows(per_minute(many, "ts", "events"))
