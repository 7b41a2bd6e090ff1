from datetime import date, datetime

import pytest
from conftest import rows, same
from pyspark.sql import functions as F

from vigil.operators import dashboards as d
from vigil.operators import lookups as look
from vigil.sources import stores

AS_OF = datetime(2024, 1, 31)


@pytest.fixture
def store(spark, tmp_path):
    return stores.Store(spark, str(tmp_path / "store"))


def raw(events):
    return stores.raw_event_rows(events.withColumn("additional", F.to_json(F.struct("value"))))


def test_raw_events_round_trip(store, events):
    store.append(raw(events), "raw_events", "timestamp")
    same(store.read("raw_events").drop("day"), raw(events))


def test_day_filter_prunes_directories(store, events):
    store.append(raw(events), "raw_events", "timestamp")
    one = store.read("raw_events").where(F.col("day") == date(2024, 1, 9))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_retention_keeps_the_boundary(spark, store, events):
    edge = datetime(2024, 1, 24)
    moved = raw(events).limit(2).withColumn("timestamp", F.lit(edge).cast("timestamp_ntz"))
    old = raw(events).limit(1).withColumn("timestamp", F.lit(datetime(2024, 1, 23, 23, 59, 59)).cast("timestamp_ntz"))
    store.append(moved.unionByName(old), "raw", "timestamp")
    store.append(raw(events), "raw", "timestamp")
    want = raw(events).where(F.col("timestamp") >= F.lit(edge).cast("timestamp_ntz")).count() + 2
    assert store.days("raw")[0] < "2024-01-24"
    for _ in range(2):
        assert store.retain("raw", AS_OF).count() == want
        assert store.days("raw")[0] == "2024-01-24"


def test_repeated_batches_replace_themselves(store, events):
    for _ in range(2):
        store.write_batch(raw(events), "raw", 3)
    store.sink("raw")(raw(events).limit(5), 3)
    assert store.read("raw").count() == 5  # a repeated batch runs again and its rows take the place of the earlier ones
    store.sink("raw")(raw(events), 3)
    assert store.read("raw").count() == events.count()
    store.write_batch(raw(events).where("false"), "raw", 4)
    assert store.has_batch("raw", 4) and store.batch("raw", 4).count() == 0


def test_users_seen_upsert(store, events):
    middle = F.col("ts") < F.lit(datetime(2024, 1, 15))
    store.upsert_seen(None, "v1", events.where(middle))
    same(store.upsert_seen("v1", "v2", events.where(~middle)), look.users_seen(events))


def test_profiles(store, events):
    store.save_users(look.user_profiles(events))
    users = store.read("users")
    assert [r["id"] for r in look.first_users(users, 3).collect()] == [0, 1, 2]
    assert look.require_user(users, 7)["username"] == "user7"
    with pytest.raises(LookupError):
        look.require_user(users, -1)


def test_latest_of_session_equals_latest_per_session(events):
    every = look.latest_per_session(events, ("ts", "seq"))
    sid = events.first()["session_id"]
    one = look.latest_of_session(events, sid, ("ts", "seq"))
    assert rows(every.where(F.col("session_id") == sid)) == rows(one)


def test_lookups_push_filters_to_the_scan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = look.event_by_id(table, 5)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_id,5)" in plan
    top = look.latest_events(table, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top


def test_between_includes_both_ends(events):
    e = events.where("user_id = 7").orderBy("ts").collect()
    start, end = e[1]["ts"].replace(microsecond=0), e[3]["ts"].replace(microsecond=0)
    assert look.events_between(events, 7, start, end).count() == 3


def test_minutes_with_nothing_to_count_stay(events):
    some = d.counts_per_minute(events, "ts", {"login": F.col("event_type") == "login"})
    every = d.per_minute(events, "ts", "events")
    assert some.count() == every.count() and some.where("login = 0").count() > 0


def test_joined_types_are_their_own_group(spark):
    data = [("a, b",), ("a",), ("a",), ("",), (None,)]
    got = d.anomalies_by_type(spark.createDataFrame(data, "anomaly_type STRING")).collect()
    assert [tuple(r) for r in got] == [("a", 2), ("a, b", 1)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_prune_days_and_reach_the_scan(spark, store, events):
    store.append(raw(events), "raw_events", "timestamp")
    stored = store.read("raw_events")
    some = d.per_minute(stored, "timestamp", "n", between=(datetime(2024, 1, 8), datetime(2024, 1, 9)))
    assert "PartitionFilters: [isnotnull(day" in plan_of(some)
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    between = plan_of(look.events_between(table, 7, datetime(2024, 1, 8), datetime(2024, 1, 9)))
    assert "date_trunc" not in between and "DataFilters: [isnotnull(user_id" in between and "(ts#" in between.split("DataFilters")[1]


def test_latest_takes_the_first_per_task(events):
    plan = plan_of(look.latest_per_session(events, ("ts", "seq")))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
