"""Running values are the same whether a key fits one task or is cut into blocks."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.operators.history import USER, count_in_window, moving_averages, type_counts, users
from vigil.operators.history import Tuning
from vigil.operators.series import Running, by_key, cut_into_blocks, in_one_order
from vigil.operators.training import exact_percentile



def specs():
    return (
        Running("n", "sum", F.lit(1), ("kind",)),
        Running("largest", "max", F.col("x")),
        Running("latest", "last", F.when(F.col("x") > 50, F.col("x")), ("kind",)),
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one key, some to no key, and many share a second."""
    rng = random.Random(5)
    data = [
        (rng.choice([1, 1, 1, None, *range(2, 8)]), rng.randrange(60) * 10, i, rng.choice(["a", "b", None]), rng.randrange(100))
        for i in range(900)
    ]
    return spark.createDataFrame(data, "key LONG, sec LONG, seq LONG, kind STRING, x LONG").cache()


def brute_force(data):
    """One pass over each key, as plain Python."""
    result, state = [], {}
    for r in sorted(data, key=lambda r: (r["sec"], r["seq"])):
        s = state.setdefault(r["key"], {"n": {}, "max": None, "last": {}, "seen": []})
        result.append(
            (
                r["seq"],
                s["n"].get(r["kind"], 0),
                s["max"],
                s["last"].get(r["kind"]),
                *[s["seen"][-i]["x"] if len(s["seen"]) >= i else None for i in (1, 2)],
            )
        )
        s["n"][r["kind"]] = s["n"].get(r["kind"], 0) + 1
        s["max"] = r["x"] if s["max"] is None else max(s["max"], r["x"])
        if r["x"] > 50:
            s["last"][r["kind"]] = r["x"]
        s["seen"].append(r)
    return sorted(result, key=repr)


@pytest.mark.parametrize("limit", [10_000, 150, 20, 3])
def test_running_and_lag(skewed, limit):
    got = (
        by_key(skewed, ["key"], limit=limit)
        .apply(lambda s: s.lag(["x"], 2), lambda s: s.running(*specs()))
        .frame()
        .select("seq", "n", "largest", "latest", "x_1", "x_2")
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(skewed.collect())


@pytest.mark.parametrize("limit", [10_000, 100])
def test_one_order_over_all_rows(skewed, limit):
    got = in_one_order(skewed, limit=limit).running(*specs()).df.select("seq", "n", "largest", "latest")
    alone = [{**r.asDict(), "key": 0} for r in skewed.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((r[:4] for r in brute_force(alone)), key=repr)


def rows_per_task(df):
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()), reverse=True)


def test_a_tasks_share_of_ordinary_keys_does_not_grow_with_the_table(spark):
    table = spark.range(20_000).select((F.col("id") % 4000).alias("key"), F.col("id").alias("sec"), F.col("id").alias("seq"))
    spark.conf.set("vigil.rowsPerBlock", "500")
    try:
        counted = by_key(table, ["key"]).apply(lambda s: s.colocate(), lambda s: s.running(Running("n", "sum", F.lit(1)))).frame()
        assert rows_per_task(counted)[0] <= 1000
    finally:
        spark.conf.unset("vigil.rowsPerBlock")


def test_blocks_do_not_meet_in_a_task(spark):
    table = spark.range(5000).select(F.col("id").alias("sec"), F.col("id").alias("seq"))
    series = in_one_order(table, limit=250)
    for cut in (series.running(Running("n", "sum", F.lit(1)), keep=False).df, series.lag(["sec"], 1).running(Running("n", "sum", F.lit(1)), keep=False).df):
        met = cut.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("_block").alias("blocks")).collect()
        assert len(met) == 20 and max(r["blocks"] for r in met) == 1


def test_no_task_holds_a_hot_key(skewed):
    hot = by_key(skewed, ["key"], limit=60).parts[1]
    sizes = [r["count"] for r in hot.df.groupBy("_block").count().collect()]
    assert sum(sizes) == hot.df.count() and max(sizes) <= 3 * 60


def test_window_counts_agree(events):
    def counts(limit):
        series = users(events, limit).apply(lambda s: count_in_window(s, F.lit(86400), [86400], "n"))
        return rows(series.frame().select("event_id", "n"))

    assert counts(10_000) == counts(30)


def test_window_counts_of_dense_events(spark):
    data = [(1, s // 3, s) for s in range(300)]
    df = spark.createDataFrame(data, "user_id LONG, sec LONG, seq LONG")
    for limit in (10_000, 40):
        got = by_key(df, USER, limit=limit).apply(lambda s: count_in_window(s, F.lit(10), [10], "n")).frame().collect()
        for r in got:
            expected = sum(1 for _, sec, seq in data if sec >= r["sec"] - 10 and (sec, seq) < (r["sec"], r["seq"]))
            assert r["n"] == expected


@pytest.mark.parametrize("alpha", [0.01, 0.05, 0.3, 0.9, 1.0])
@pytest.mark.parametrize("limit", [10_000, 400])
def test_averages_follow_the_recurrence(spark, limit, alpha):
    rng = random.Random(1)
    sec, data = 0, []
    for i in range(1500):
        sec += rng.choice([10, 10, 10, 3 * 86400 * 10 if i == 400 else 10])
        data.append((1, "login", sec, i, rng.randrange(9)))
    df = spark.createDataFrame(data, "user_id LONG, event_type STRING, sec LONG, seq LONG, v LONG")
    tuning = Tuning(ema_ttl=86400, alpha=alpha)
    got = by_key(df, ["user_id", "event_type"], limit=limit).apply(lambda s: moving_averages(s, "v", tuning)).frame()
    ema = sigma = last = None
    for r, (_, _, at, _, v) in zip(got.orderBy("seq").collect(), data, strict=True):
        if ema is None or at - last >= 86400:
            ema, sigma, deviation = float(v), 0.0, 0.0
        else:
            ema = alpha * v + (1 - alpha) * ema
            deviation = abs(v - ema)
            sigma = alpha * deviation + (1 - alpha) * sigma
        last = at
        assert r["ema"] == pytest.approx(ema, abs=1e-12)
        assert r["sigma"] == pytest.approx(sigma, abs=1e-12)


def test_windows_without_a_common_length(spark):
    lengths = [907, 613, 3581, 86_399]
    data = [(u, s * (37 + u), i) for u in range(4) for i, s in enumerate(range(200))]
    df = spark.createDataFrame(data, "user_id LONG, sec LONG, seq LONG")
    span = F.element_at(F.array(*map(F.lit, lengths)), (F.col("user_id") + 1).cast("int"))
    for limit in (10_000, 60):
        got = by_key(df, USER, limit=limit).apply(lambda s: count_in_window(s, span, lengths, "n")).frame().collect()
        for r in got:
            mine = [s for u, s, i in data if u == r["user_id"] and (s, i) < (r["sec"], r["seq"])]
            assert r["n"] == sum(s >= r["sec"] - lengths[r["user_id"]] for s in mine)


def test_type_windows_of_unknown_types(spark):
    data = [(1, t, s, i) for i, (t, s) in enumerate([("odd", 0), ("odd", 3600), ("odd", 7201), ("payment", 7801), ("payment", 8401), ("payment", 9002)])]
    df = spark.createDataFrame(data, "user_id LONG, event_type STRING, sec LONG, seq LONG")
    got = by_key(df, USER).apply(lambda s: type_counts(s)).frame().orderBy("seq").collect()
    assert [r["type_count"] for r in got] == [0, 1, 0, 0, 1, 0]


def test_percentile_in_blocks_equals_builtin(skewed):
    whole = exact_percentile(skewed, "x", 0.95, ("seq",)).first()[0]
    cut = exact_percentile(skewed, "x", 0.95, ("seq",), limit=50).first()[0]
    assert whole == pytest.approx(cut)


def test_blocks_are_runs_of_consecutive_rows(skewed):
    series = cut_into_blocks(skewed, ["key"], ("sec", "seq"), 12)
    bounds = series.df.groupBy("_block").agg(F.min(F.struct("key", "sec", "seq")).alias("a"), F.max(F.struct("key", "sec", "seq")).alias("b"))
    found = bounds.orderBy("_block").collect()
    key = lambda s: tuple((x is not None, x or 0) for x in s)
    assert all(key(x["b"]) < key(y["a"]) for x, y in zip(found, found[1:]))
