import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators.fusion import fuse, join_ml_stat

STAT_DDL = "session_id STRING, seq LONG, sec LONG, timestamp TIMESTAMP_NTZ, anomaly BOOLEAN, anomaly_type STRING"
ML_DDL = (
    "session_id STRING, seq LONG, sec LONG, timestamp TIMESTAMP_NTZ, anomaly BOOLEAN, user_id LONG, score DOUBLE, "
    "threshold DOUBLE, event_count LONG, unique_events LONG"
)


def frames(spark, verdicts):
    """``verdicts``: (session, seq, sec, kind, anomaly type or None)."""
    stat = [(s, q, t, None, a is not None, a or "") for s, q, t, k, a in verdicts if k == "stat"]
    ml = [(s, q, t, None, a is not None, 1, float(q), 1.0, 5, 2) for s, q, t, k, a in verdicts if k == "ml"]
    return spark.createDataFrame(stat, STAT_DDL), spark.createDataFrame(ml, ML_DDL)


def greedy(verdicts, idle):
    """The rule as a loop: wait for both kinds, give out a row, start anew."""
    pending, last, out = {}, {}, []
    for s, q, t, k, a in sorted(verdicts, key=lambda v: (v[2], v[1], v[3] == "ml")):
        entry = pending.setdefault(s, {"ml": None, "stat": []})
        if idle is not None and s in last and t - last[s] > idle:
            entry = pending[s] = {"ml": None, "stat": []}
        last[s] = t
        if k == "ml":
            entry["ml"] = q
        else:
            entry["stat"].append(a)
        if entry["ml"] is not None and entry["stat"]:
            types = sorted({x for x in entry["stat"] if x})
            out.append((s, q, float(entry["ml"]), bool(types), ", ".join(types) or None))
            del pending[s]
    return sorted(out)


def fused(spark, verdicts, idle, limit=None):
    stat, ml = frames(spark, verdicts)
    got = fuse(stat, ml, idle, limit).select("session_id", "seq", "ml_score", "stat_anomaly", "anomaly_type")
    return sorted(tuple(r) for r in got.collect())


def random_verdicts(rng, sessions, most):
    out = []
    for s in range(sessions):
        t = 0
        for q in range(rng.randrange(most)):
            t += rng.choice([0, 10, 10, 400])
            out.append((f"s{s}", q, t, rng.choice(["stat", "stat", "ml"]), rng.choice([None, "a", "b"])))
    return out


@pytest.mark.parametrize("idle", [None, 300])
@pytest.mark.parametrize("limit", [None, 12])
def test_equals_greedy_loop(spark, idle, limit):
    verdicts = random_verdicts(random.Random(11), 60, 40)
    assert fused(spark, verdicts, idle, limit) == greedy(verdicts, idle)


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000))
def test_any_order(spark, seed):
    verdicts = random_verdicts(random.Random(seed), 80, 25)
    assert fused(spark, verdicts, 300) == greedy(verdicts, 300)


def test_restart_after_a_row(spark):
    order = ["stat", "stat", "ml", "ml", "stat"]
    got = fused(spark, [("s", i, i, k, None) for i, k in enumerate(order)], 300)
    assert [(g[1], g[2]) for g in got] == [(2, 2.0), (4, 3.0)]


def test_idle_sessions_start_empty(spark):
    assert fused(spark, [("s", 0, 0, "stat", None), ("s", 1, 301, "ml", None)], 300) == []
    assert len(fused(spark, [("s", 0, 0, "stat", None), ("s", 1, 300, "ml", None)], 300)) == 1


def test_verdicts_without_session_never_fuse(spark):
    assert fused(spark, [("", 0, 0, "stat", "a"), ("", 1, 1, "ml", None)], None) == []


def test_plain_join(spark):
    stat, ml = frames(spark, [("s", 0, 0, "stat", "b"), ("s", 1, 1, "ml", None), ("s", 2, 2, "stat", "a"), ("t", 0, 0, "ml", None)])
    got = join_ml_stat(stat, ml).select("session_id", "stat_anomaly", "anomaly_type").collect()
    assert [tuple(r) for r in got] == [("s", True, "a, b")]
    assert join_ml_stat(stat.where(F.lit(False)), ml).count() == 0
