"""Tables in versions: readers during writes, writers at once, and how little a lookup or an upsert touches."""

from datetime import datetime

import pytest
from conftest import rows, same
from pyspark.sql import functions as F

from vigil.operators import lookups as look
from vigil.plans.queries import LOOKUPS, RAW
from vigil.sources import stores, versions

AS_OF = datetime(2024, 1, 31)


def raw(events):
    return stores.raw_event_rows(events.withColumn("additional", F.to_json(F.struct("value"))))


@pytest.fixture
def days(spark, tmp_path):
    return versions.Versioned.by_day(spark, str(tmp_path / "raw"), RAW, "timestamp")


def users(spark, path, buckets=32):
    return versions.Versioned.by_hash(spark, str(path / "seen"), versions.SEEN, "id", buckets)


def scanned(df):
    """Rows and files the scan of a plan read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = {}
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        leaf = leaf.executedPlan().collectLeaves().apply(0) if "AdaptiveSparkPlan" in leaf.getClass().getName() else leaf
        metrics = leaf.metrics()
        for name in ("numOutputRows", "numFiles"):
            if metrics.contains(name):
                found[name] = found.get(name, 0) + metrics.apply(name).value()
    return found


def test_rows_come_back(days, events):
    assert days.read().count() == 0 and days.versions() == []
    days.append(raw(events))
    same(days.read(), raw(events))
    days.append(raw(events).limit(3))
    assert days.read().count() == events.count() + 3 and days.versions() == [1, 2]


def test_a_reader_during_retention_sees_old_rows_or_new_ones(days, events):
    days.append(raw(events))
    before = days.read()
    old = rows(before)
    days_before = set(days.snapshot().slots)
    after = versions.retain(days, "timestamp", AS_OF).read()
    edge = F.lit(datetime(2024, 1, 24)).cast("timestamp_ntz")
    assert rows(before) == old  # planned before, read after
    same(after, raw(events).where(F.col("timestamp") >= edge))
    # only the day of the cut-off was written; later days are the same files
    first, second = days.snapshot(1), days.snapshot(2)
    assert all(second.slots[d] == first.slots[d] for d in second.slots if d > "2024-01-24")
    assert min(second.slots) == "2024-01-24" and min(days_before) < "2024-01-24"
    same(versions.retain(days, "timestamp", AS_OF).read(), after)
    assert days.vacuum(keep=1) > 5
    same(days.read(), raw(events).where(F.col("timestamp") >= edge))


def test_rows_without_a_time_stay(spark, days, events):
    days.append(raw(events).limit(5).withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    assert versions.retain(days, "timestamp", AS_OF).read().count() == 5


def test_writers_at_once(spark, days, events):
    some = raw(events).limit(10)
    days.append(some)
    seen = days.snapshot()
    slot = next(iter(seen.slots))
    days.append(some.where(F.date_format("timestamp", "yyyy-MM-dd") == slot))
    with pytest.raises(versions.Conflict):
        days.replace(seen, [slot], None)
    assert not days._publish(2, {})  # a version is never replaced
    assert sorted(days.versions()) == [1, 2]
    other = days._write(some)
    days.append(some)
    days._commit(lambda slots: slots | {s: slots.get(s, []) + p for s, p in other.items()})
    want = 30 + seen.read([slot]).count()
    assert days.read().count() == want
    with pytest.raises(ValueError):
        days.replace(days.snapshot(), ["1999-01-01"], some)


def test_upsert_touches_few_buckets(spark, tmp_path, events):
    table = users(spark, tmp_path)
    versions.merge_seen(table, events.where("ts < '2024-01-15'"))
    first = table.snapshot()
    one = versions.merge_seen(table, events.where("ts >= '2024-01-15' AND user_id = 7"))
    changed = [s for s in one.slots if one.slots[s] != first.slots.get(s)]
    assert len(changed) == 1 and len(first.slots) > 5
    same(versions.merge_seen(table, events.where("ts >= '2024-01-15'")).read(), look.users_seen(events))
    same(versions.merge_seen(table, events).read(), look.users_seen(events))


def test_a_lookup_reads_a_small_part(spark, tmp_path):
    many = spark.range(40_000).select(
        F.col("id").alias("event_id"), (F.col("id") % 997).alias("user_id"), F.lit("login").alias("event_type"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"), F.lit("ip").alias("ip"), F.lit("a").alias("user_agent"),
        F.lit("C").alias("country"), F.concat(F.lit("s"), F.col("id") % 4000).alias("session_id"),
    )
    by_user = versions.Versioned.by_hash(spark, str(tmp_path / "u"), LOOKUPS, "user_id", 64, ("ts",), bloom=("event_id",))
    snapshot = by_user.append(many)
    found = snapshot.lookup(7)
    assert rows(found) == rows(many.where("user_id = 7"))
    read = scanned(found)
    assert read["numFiles"] <= 2 and read["numOutputRows"] < 40_000 / 20
    every = scanned(snapshot.read())
    assert every["numFiles"] >= 50 and every["numOutputRows"] == 40_000
    # ids are spread over all files, so statistics cannot tell: bloom filters can
    one = look.event_by_id(snapshot.read(), 20_011)
    assert one.count() == 1 and scanned(one)["numOutputRows"] < 40_000 / 8
    by_session = versions.Versioned.by_hash(spark, str(tmp_path / "s"), LOOKUPS, "session_id", 64, ("ts",))
    session = by_session.append(many).lookup("s77")
    assert session.count() == 10 and scanned(session)["numOutputRows"] < 40_000 / 20
    assert snapshot.lookup(None).count() == 0 == snapshot.lookup(5000).count()


def test_compaction_and_empty_writes(spark, tmp_path, events):
    table = users(spark, tmp_path, 2)
    for i in range(4):
        table.append(look.users_seen(events.where(f"user_id = {i}")))
    want = rows(table.read())
    assert max(len(p) for p in table.compact(most=1).slots.values()) == 1
    assert rows(table.read()) == want
    table.append(look.users_seen(events.limit(0)))
    assert rows(table.read()) == want and table.compact(most=1).version == table.snapshot().version
