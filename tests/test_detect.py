"""Detectors against a plain replay of the events, one at a time, and against hand-made cases."""

from math import sqrt

import pytest
from pyspark.sql import functions as F

from vigil.functions.columns import improbable, markov_threshold
from vigil.operators import detect
from vigil.operators.history import Tuning, transition_histogram
from vigil.plans.results import TUNING

HOUR = 3600
SCHEMA = (
    "event_id LONG, seq LONG, ts TIMESTAMP_NTZ, sec LONG, hour INT, user_id LONG, session_id STRING, "
    "event_type STRING, ip STRING, user_agent STRING, country STRING"
)


def frame(spark, data):
    """``data``: (user, type, seconds, ip, agent, country) in order of arrival."""
    plain = [
        (i, i, None, s, (s // HOUR) % 24, u, "s", t, ip, ua, c) for i, (u, t, s, ip, ua, c) in enumerate(data)
    ]
    df = spark.createDataFrame(plain, SCHEMA)
    return df.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))


def verdicts(spark, data, tuning=Tuning()):
    got = detect.stat_verdicts(frame(spark, data), tuning).orderBy("seq").collect()
    return [r["anomaly_type"] if r["status"] == "ok" else r["status"] for r in got]


class Replay:
    """The rules as a loop over dictionaries: every event is stored, whatever its verdict."""

    def __init__(self, tuning):
        self.t = tuning
        self.users, self.everyone = {}, {}

    @staticmethod
    def level(steps, prev, cur, least):
        total = sum(n for k, n in steps.items() if k[:-1] == prev and len(k) == len(prev) + 1)
        if total < least:
            return None
        limit = 0.02 if total < 50 else 0.05 if total > 200 else max(0.01, 1 / sqrt(total))
        return steps.get((*prev, cur), 0) / total < limit

    def verdict(self, e):
        u = self.users.setdefault(e["user_id"], {"past": [], "sets": {}, "hours": {}, "steps": {}, "ema": {}})
        if u["past"] and e["sec"] - u["past"][-1]["sec"] >= self.t.set_ttl:
            u["sets"], u["hours"] = {}, {}
        kind, status = self.check(u, e), "ok"
        if kind == "error":
            kind, status = None, "error_missing_hour"
        past = u["past"]
        if len(past) > 1 and e["sec"] - past[-2]["sec"] < self.t.history_ttl:
            for steps in (u["steps"], self.everyone):
                for k in ((past[-1]["event_type"],), (past[-2]["event_type"], past[-1]["event_type"])):
                    step = (*k, e["event_type"])
                    steps[step] = steps.get(step, 0) + 1
        for f in ("ip", "user_agent", "country"):
            u["sets"].setdefault(f, set()).add(e[f])
        u["hours"][e["hour"]] = u["hours"].get(e["hour"], 0) + 1
        past.append(e)
        return (kind or "") if status == "ok" else status

    def check(self, u, e):
        for f, name in (("ip", "new_ip"), ("user_agent", "new_user_agent"), ("country", "new_country")):
            if e[f] not in u["sets"].get(f, ()):
                return name
        past, ttl = u["past"], self.t.history_ttl
        one = past[-1]["event_type"] if past and e["sec"] - past[-1]["sec"] < ttl else None
        two = (
            past[-2]["event_type"]
            if one is not None and len(past) > 1 and past[-1]["sec"] - past[-2]["sec"] < ttl
            else None
        )
        for steps, least in ((u["steps"], self.t.min_total_user), (self.everyone, self.t.min_total_global)):
            for prev in ((two, one), (one,)):
                found = None if None in prev else self.level(steps, prev, e["event_type"], least)
                if found is not None:
                    break
            else:
                continue
            if found:
                return "markov_low_probability"
            break
        window = self.t.type_windows.get(e["event_type"], self.t.default_type_window)
        count = sum(1 for p in past if p["event_type"] == e["event_type"] and p["sec"] >= e["sec"] - window)
        ema, sigma = u["ema"].get(e["event_type"], (None, None))
        if ema is None:
            ema, deviation, sigma = float(count), 0.0, 0.0
        else:
            ema = 0.3 * count + 0.7 * ema
            deviation = abs(count - ema)
            sigma = 0.3 * deviation + 0.7 * sigma
        u["ema"][e["event_type"]] = (ema, sigma)
        if sigma > 0 and deviation > (4.0 if sigma < 1 else 2.5) * sigma:
            return "ema_outlier"
        mean = sum(u["hours"].values()) / 24
        spread = sqrt(sum((u["hours"].get(h, 0) - mean) ** 2 for h in range(24)) / 24)
        if e["hour"] not in u["hours"]:
            return "error"
        return "time_deviation" if u["hours"][e["hour"]] < spread else None


@pytest.mark.parametrize("limit", [None, 60])
def test_cascade_equals_replay(events, limit):
    got = detect.stat_verdicts(events, TUNING, limit).orderBy("ts", "seq").collect()
    replay = Replay(TUNING)
    past = [r.asDict() for r in events.orderBy("sec", "seq").collect()]
    expected = {e["event_id"]: replay.verdict(e) for e in past}
    assert {r["event_id"]: r["anomaly_type"] if r["status"] == "ok" else r["status"] for r in got} == expected


def test_replay_with_ties_and_expiry(spark):
    """Coarse clocks: many events in one second, sets that expire."""
    import random

    rng = random.Random(3)
    types = ["login", "payment", "logout", "other", "strange"]
    data, sec = [], 0
    for _ in range(600):
        sec += rng.choice([0, 0, 0, 7200, 7200, 21600, 86400 * 5 if rng.random() < 0.05 else 0])
        u = rng.choice([1, 1, 2, 3])
        data.append((u, rng.choice(types), sec, f"i{rng.randrange(3)}", f"a{rng.randrange(2)}", "PL"))
    tuning = Tuning(min_total_user=5, min_total_global=10, set_ttl=4 * 86400)
    replay = Replay(tuning)
    expected = [replay.verdict(r.asDict()) for r in frame(spark, data).orderBy("seq").collect()]
    assert verdicts(spark, data, tuning) == expected
    assert len(set(expected)) >= 5


ME = ("ip", "ua", "PL")


def test_first_event_and_priority(spark):
    got = verdicts(spark, [(1, "login", 0, *ME), (1, "login", 10, "ip", "ua2", "DE"), (1, "login", 20, "ip", "ua", "FR")])
    assert got == ["new_ip", "new_user_agent", "new_country"]


def test_sets_expire_after_two_idle_weeks(spark):
    day = 86400
    known = verdicts(spark, [(1, "login", 0, *ME), (1, "login", 14 * day - 1, *ME)])
    gone = verdicts(spark, [(1, "login", 0, *ME), (1, "login", 14 * day, *ME)])
    assert (known[1], gone[1]) == ("error_missing_hour", "new_ip")


def test_hour_never_seen_and_unusual_hour(spark):
    at_ten = [(1, "login", d * 86400 + 10 * HOUR, *ME) for d in range(40)]
    once_at_three = [(1, "login", 40 * 86400 + 3 * HOUR, *ME), (1, "login", 41 * 86400 + 3 * HOUR, *ME)]
    got = verdicts(spark, at_ten + once_at_three)
    assert got[40:] == ["error_missing_hour", "time_deviation"]
    flagged = verdicts(spark, at_ten + once_at_three, Tuning(missing_hour="flag"))
    assert flagged[40:] == ["time_deviation", "time_deviation"]


def test_frequency_outlier_needs_five(spark):
    """Counts 0, 0, 0 and then a burst: the average of deviations must reach 1, which takes a count of 5."""
    quiet = [(1, "login", d * 86400 + 10 * HOUR, *ME) for d in range(6)]
    burst = [(1, "login", 6 * 86400 + 10 * HOUR + i, "new%d" % i, "ua", "PL") for i in range(5)]
    last = [(1, "login", 6 * 86400 + 10 * HOUR + 9, *ME)]
    assert verdicts(spark, quiet + burst + last)[-1] == "ema_outlier"
    assert verdicts(spark, quiet + burst[:3] + last)[-1] == ""


def test_global_history_decides_without_user_history(spark):
    shared = []
    for u in range(100, 130):
        shared += [(u, t, u * 10 + i, *ME) for i, t in enumerate(["login", "payment", "logout"])]
    probe = [(1, t, 5000 + i, *ME) for i, t in enumerate(["login", "payment", "other"])]
    rows = detect.stat_verdicts(frame(spark, shared + probe)).where("user_id = 1").orderBy("seq").collect()
    assert rows[-1]["anomaly_type"] == "markov_low_probability"
    assert rows[-1]["message"] == "Unusual transition login->payment->other based on global history"


@pytest.mark.parametrize(
    "total,limit", [(19, None), (20, 0.02), (49, 0.02), (50, 50**-0.5), (200, 200**-0.5), (201, 0.05)]
)
def test_markov_threshold(spark, total, limit):
    df = spark.createDataFrame([(total,)], "t LONG")
    row = df.select(
        markov_threshold(F.col("t")).alias("limit"), improbable(F.col("t"), F.lit(0)).alias("never_seen")
    ).first()
    assert row["limit"] == (None if limit is None else pytest.approx(limit))
    assert row["never_seen"] is (None if limit is None else True)


def test_histogram_has_both_orders(spark):
    data = [(1, t, i, *ME) for i, t in enumerate(["login", "payment", "payment", "logout"])]
    got = {tuple(r) for r in transition_histogram(frame(spark, data)).collect()}
    assert got == {
        (1, None, "payment", "payment", 1),
        (1, None, "payment", "logout", 1),
        (2, "login", "payment", "payment", 1),
        (2, "payment", "payment", "logout", 1),
    }


def test_small_sigma_never_fires(events):
    rows = detect.analyse(events, TUNING).where("clean AND sigma < 1 AND stage2_type = 'ema_outlier'")
    assert rows.count() == 0


# --- scenarios of a traffic simulator: identity of the user (G) or a new one (R) per event -----------------------

GOOD, NEW = "G", "R"
SCENARIOS = {
    "normal": ([(GOOD, "login"), (GOOD, "payment"), (GOOD, "logout")], ["", "", ""]),
    "anomalous login": ([(NEW, "login")], ["new_ip"]),
    "brute force": ([(NEW, "failed_login")] * 5, ["new_ip"] * 5),
    "account takeover": (
        [(GOOD, "login"), (NEW, "password_reset"), (NEW, "login")],
        ["", "new_ip", "new_ip"],
    ),
    "bot activity": ([(NEW, "login"), (NEW, "payment"), (NEW, "other")], ["new_ip"] * 3),
    "fraud payment": ([(GOOD, "login"), (NEW, "payment")], ["", "new_ip"]),
    "payment retry": (
        [(GOOD, "login"), (NEW, "payment"), (GOOD, "payment"), (GOOD, "logout")],
        ["", "new_ip", "", ""],
    ),
    "profile update": ([(GOOD, "login"), (GOOD, "other"), (GOOD, "logout")], ["", "", ""]),
}


def test_scenarios(spark):
    """Six ordinary days, then one scenario per user, all at ten in the morning."""
    data, expected = [], {}
    for user, (steps, verdict) in enumerate(SCENARIOS.values(), 1):
        past = [
            (user, t, d * 86400 + 10 * HOUR + i, *ME)
            for d in range(6)
            for i, t in enumerate(["login", "payment", "logout"])
        ]
        today = [
            (user, t, 6 * 86400 + 10 * HOUR + i, *(ME if who == GOOD else (f"r{i}", f"r{i}", "XX")))
            for i, (who, t) in enumerate(steps)
        ]
        data += past + today
        expected[user] = verdict
    got = detect.stat_verdicts(frame(spark, data), Tuning(min_total_global=10_000)).orderBy("seq").collect()
    for user, verdict in expected.items():
        mine = [r["anomaly_type"] for r in got if r["user_id"] == user]
        assert mine[-len(verdict) :] == verdict, list(SCENARIOS)[user - 1]
