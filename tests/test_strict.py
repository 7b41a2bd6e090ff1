"""Strict mode on tables against a plain replay, with and without oversized users, and the round trip of the state."""

import random

import pytest
from pyspark.sql import functions as F
from test_detect import Replay, frame

from vigil.operators import strict
from vigil.operators.history import Tuning
from vigil.operators.past import Past
from vigil.plans.queries import QUERIES
from vigil.plans.results import TUNING


def replayed(events, tuning):
    replay = Replay(tuning)
    out = {}
    for e in events:
        u = replay.users.setdefault(e["user_id"], {"past": [], "sets": {}, "hours": {}, "steps": {}, "ema": {}})
        if u["past"] and e["sec"] - u["past"][-1]["sec"] >= tuning.set_ttl:
            u["sets"], u["hours"] = {}, {}
        kind = replay.check(u, e)
        if kind == "error":
            out[e["event_id"]] = "error_missing_hour"
            continue
        past = u["past"]
        if len(past) > 1 and e["sec"] - past[-2]["sec"] < tuning.history_ttl:
            for steps in (u["steps"], replay.everyone):
                for k in ((past[-1]["event_type"],), (past[-2]["event_type"], past[-1]["event_type"])):
                    step = (*k, e["event_type"])
                    steps[step] = steps.get(step, 0) + 1
        for f in ("ip", "user_agent", "country"):
            u["sets"].setdefault(f, set()).add(e[f])
        u["hours"][e["hour"]] = u["hours"].get(e["hour"], 0) + 1
        past.append(e)
        out[e["event_id"]] = kind or ""
    return out


def found(df):
    return {r["event_id"]: r["anomaly_type"] if r["status"] == "ok" else r["status"] for r in df.collect()}


@pytest.mark.parametrize("limit", [None, 60])
def test_equals_replay(events, limit):
    past = [r.asDict() for r in events.orderBy("sec", "seq").collect()]
    assert found(strict.strict_verdicts(events, TUNING, limit=limit)) == replayed(past, TUNING)


@pytest.mark.parametrize("limit", [None, 90])
def test_equals_replay_with_ties_expiry_and_many_failures(spark, limit):
    rng = random.Random(3)
    types = ["login", "payment", "logout", "other", "strange"]
    data, sec = [], 0
    for _ in range(600):
        sec += rng.choice([0, 0, 0, 7200, 7200, 21600, 86400 * 5 if rng.random() < 0.05 else 0])
        u = rng.choice([1, 1, 2, 3])
        data.append((u, rng.choice(types), sec, f"i{rng.randrange(3)}", f"a{rng.randrange(2)}", "PL"))
    tuning = Tuning(min_total_user=5, min_total_global=10, set_ttl=4 * 86400)
    df = frame(spark, data)
    want = replayed([r.asDict() for r in df.orderBy("seq").collect()], tuning)
    got = found(strict.strict_verdicts(df, tuning, limit=limit))
    assert got == want
    assert list(want.values()).count("error_missing_hour") > 20 and len(set(want.values())) >= 5


def test_query_equals_replay(spark, events):
    past = [r.asDict() for r in events.orderBy("sec", "seq").collect()]
    assert found(QUERIES["strict_verdicts"](spark, "/root/testdata/sf0.001")) == replayed(past, TUNING)


def test_no_events_and_other_columns(spark, events):
    assert strict.strict_verdicts(events.limit(0), TUNING).count() == 0
    clash = events
    for c in ("_map", "_key", "ema", "recorded", "clean", "assumed_1", "global_total_1", "status"):
        clash = clash.withColumn(c, F.lit("x"))
    some = clash.where("user_id < 10")
    assert found(strict.strict_verdicts(some, TUNING)) == found(strict.strict_verdicts(events.where("user_id < 10"), TUNING))


def test_state_survives_as_rows():
    rng = random.Random(1)
    stream = [
        {"sec": i * 3600, "hour": i % 24, "event_type": rng.choice("abc"), "ip": None if i % 7 == 0 else f"i{i % 5}", "user_agent": "u", "country": "C"}
        for i in range(200)
    ]
    whole, carried = Past(TUNING), Past(TUNING)
    for i, e in enumerate(stream):
        if i % 13 == 0:
            rows, carried = list(carried.rows()), Past(TUNING)
            for row in rows:
                carried.take(*row)
        assert whole.check(e, lambda *_: (0, 0, 0, 0)) == carried.check(e, lambda *_: (0, 0, 0, 0))


def test_drafts_leave_the_past_alone():
    rng = random.Random(2)
    past, plain = Past(TUNING), Past(TUNING)
    for i in range(150):
        e = {"sec": i * 5000 + (86400 * 15 if i > 100 else 0), "hour": i % 24, "event_type": rng.choice("ab"), "ip": f"i{i % 4}", "user_agent": "u", "country": "C"}
        draft = past.draft()
        for k in range(3):
            draft.check(e | {"sec": e["sec"] + k * 86400 * 8, "ip": f"other{k}"}, lambda *_: (9, 1, 9, 1))
        assert past.check(e, lambda *_: (0, 0, 0, 0)) == plain.check(e, lambda *_: (0, 0, 0, 0))


def test_fold_without_strict_mode_equals_the_cascade(events):
    """With all events stored, the fold gives the verdicts of the window plan."""
    from vigil.operators.detect import stat_verdicts

    folded = strict.verdicts_of(strict.folded_history(events, TUNING, strict=False), TUNING)
    assert found(folded) == found(stat_verdicts(events, TUNING))


def test_corrections(spark, events):
    everyone = strict.stored_transitions(events, TUNING)
    late = events.where("event_id % 37 = 5 AND user_id <> 3")
    before = strict.strict_verdicts(events.join(late, "event_id", "left_anti"), TUNING, everyone)
    want = strict.strict_verdicts(events, TUNING, everyone)
    got = strict.corrected(before, events, late, TUNING, everyone)
    assert found(before) != found(want)
    assert got.count() == events.count() and found(got) == found(want)
    assert found(strict.corrected(want, events, late.limit(0), TUNING, everyone)) == found(want)


@pytest.mark.parametrize("limit", [None, 300])
def test_only_users_with_another_decision_are_folded_again(events, limit, monkeypatch):
    folded, fold = [], strict._folded

    def counting(rows, *rest):
        folded.append(rows.count())
        return fold(rows, *rest)

    monkeypatch.setattr(strict, "_folded", counting)
    strict.folded_history(events, TUNING, limit=limit)
    assert folded.count(events.count()) == 1
