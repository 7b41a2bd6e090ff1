import json

import pytest
from conftest import rows, same
from pyspark.sql import functions as F

from vigil.operators import contracts as c
from vigil.sources.canon import event_records

GOOD = {
    "spec_version": "1.0",
    "domain": "user_activity",
    "event_type": "login",
    "source": "test",
    "timestamp": "2025-01-01T10:00:00Z",
    "correlation": {"session_id": "s1"},
    "payload": {
        "user_id": 7,
        "type": "login",
        "timestamp": "2025-01-01T10:00:00+01:00",
        "session_id": "s1",
        "metadata": {"ip": "10.0.0.1", "user_agent": "ua1", "country": "PL"},
        "additional": {"device": "app", "source": "WEB"},
    },
}


def changed(path, value):
    record = json.loads(json.dumps(GOOD))
    at = record
    for p in path[:-1]:
        at = at[p]
    if value is None:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return json.dumps(record)


def records(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "seq LONG, value STRING")


def reason(spark, text):
    return c.validate(records(spark, text)).first()["reject_reason"]


@pytest.mark.parametrize(
    "text,expected",
    [
        (json.dumps(GOOD)[:-2], "malformed"),
        ("no json", "malformed"),
        (changed(["spec_version"], ""), "spec_version"),
        (changed(["domain"], ""), "domain"),
        (changed(["event_type"], ""), "event_type"),
        (changed(["payload"], None), "payload"),
        (changed(["domain"], "billing"), "domain_mismatch"),
        (changed(["payload"], "text"), "payload_malformed"),
        (changed(["payload", "user_id"], 0), "user_id"),
        (changed(["payload", "user_id"], None), "user_id"),
        (changed(["payload", "type"], ""), "type"),
        (changed(["payload", "timestamp"], None), "timestamp"),
        (changed(["payload", "timestamp"], "soon"), "timestamp"),
        (json.dumps(GOOD), None),
        (changed(["payload", "type"], "unheard_of"), None),
        (changed(["payload", "session_id"], None), None),
        (changed(["payload", "metadata"], None), None),
        (changed(["spec_version"], "9"), None),
    ],
)
def test_first_broken_rule(spark, text, expected):
    assert reason(spark, text) == expected


def test_flat_event_keeps_local_hour(spark):
    row = c.flatten_event(c.validate(records(spark, json.dumps(GOOD))), "seq").first()
    assert row["hour"] == 10 and row["ts"].hour == 9
    assert json.loads(row["additional"]) == GOOD["payload"]["additional"]


def test_missing_texts_become_empty(spark):
    text = changed(["payload", "metadata"], None)
    row = c.flatten_event(c.validate(records(spark, text))).first()
    assert (row["ip"], row["country"], row["session_id"]) == ("", "", "s1")


def test_additional_defaults_to_an_empty_object(spark):
    text = changed(["payload", "additional"], None)
    assert c.flatten_event(c.validate(records(spark, text))).first()["additional"] == "{}"


def test_ml_input_falls_back(spark):
    texts = [
        changed(["payload", "session_id"], None),
        changed(["payload", "timestamp"], None),
        changed(["payload", "user_id"], 0),
        changed(["correlation"], None),
    ]
    got = c.ml_input(records(spark, *texts), "seq").orderBy("seq").collect()
    assert [r["seq"] for r in got] == [0, 1, 3]
    assert got[0]["session_id"] == "s1" and got[1]["ts"].hour == 10 and got[0]["ts"].hour == 9


def test_routes_and_aliases(spark):
    validated = c.validate_envelope(
        c.parse_envelope(records(spark, json.dumps(GOOD), changed(["domain"], "billing"), changed(["domain"], "x")))
    )
    seen = c.route_domains(
        validated,
        {c.USER_ACTIVITY: lambda d: d.select("seq", "envelope.domain"), "money": lambda d: d.select("seq", "envelope.domain")},
        aliases={"billing": "money"},
    )
    assert {tuple(r) for r in seen.collect()} == {(0, "user_activity"), (1, "money")}


def test_envelope_round_trip(spark, events):
    built = c.build_envelope(events.withColumn("additional", F.to_json(F.struct("value"))), "test", "event_id")
    flat = c.flatten_event(c.validate(built), "event_id")
    columns = ["event_id", "user_id", "event_type", "session_id", "ip", "user_agent", "country", "ts", "hour"]
    same(flat.select(*columns), events.where("user_id <> 0").select(*columns))


def test_every_record_is_accepted_or_quarantined(events):
    validated = c.validate(event_records(events))
    assert c.accepted(validated).count() + c.quarantined(validated).count() == events.count()


def test_parsing_happens_once(events):
    flat = c.flatten_event(c.validate(event_records(events)), "event_id")
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2


def test_verdicts_survive_the_wire(spark, events):
    stat = events.select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        F.lit(True).alias("anomaly"),
        F.lit("new_ip").alias("anomaly_type"),
        F.lit("text").alias("message"),
        F.col("ts").alias("timestamp"),
        F.lit("stat").alias("source"),
    )
    same(c.decode_stat_result(c.encode(stat, "event_id"), "event_id"), stat)
    assert c.decode_stat_result(records(spark, "{broken", "no")).count() == 0


def test_copies_collapse_to_the_first(spark):
    data = [(1, "a", 5), (1, "a", 3), (2, "a", 4), (None, None, 1), (None, None, 2)]
    df = spark.createDataFrame(data, "user_id LONG, ip STRING, seq LONG")
    assert rows(c.dedupe_events(df)) == rows(spark.createDataFrame([(1, "a", 3), (2, "a", 4), (None, None, 1)], df.schema))


@pytest.mark.parametrize("stamp", ["notaTime", "2024-01-02", "2024-01-02T25:00:00Z", "2024-01-02T03:04:05", "", "T", "2024-01-02Txx:00:00Z"])
def test_bad_times_never_stop_a_job(spark, stamp):
    text = f'{{"spec_version":"1.0","domain":"user_activity","event_type":"login","payload":{{"user_id":1,"type":"login","timestamp":"{stamp}","session_id":"s"}}}}'
    records = spark.createDataFrame([(text,)], "value STRING")
    assert c.validate(records).first()["reject_reason"] == "timestamp"
    assert c.ml_input(records).first()["ts"] is None


def test_bad_additional_never_stops_a_job(spark):
    rows = [(1, "login", "{broken", "s"), (2, "login", '{"a": 1}', "s"), (3, "login", None, "s")]
    events = spark.createDataFrame(rows, "user_id LONG, event_type STRING, additional STRING, session_id STRING").withColumns(
        {"ts": F.lit("2024-01-02").cast("timestamp_ntz"), "ip": F.lit("i"), "user_agent": F.lit("u"), "country": F.lit("c")}
    )
    sent = c.build_envelope(events, "test", "user_id").orderBy("user_id").collect()
    assert [json.loads(r["value"])["payload"]["additional"] for r in sent] == [{}, {"a": 1}, {}]
    assert [(r["user_id"], r["reject_reason"]) for r in c.unreadable_additional(events).collect()] == [(1, "additional")]


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"spec_version": 1}, "malformed"),
        ({"event_type": {"a": 1}}, "malformed"),
        ({"domain": ["user_activity"]}, "malformed"),
        ({"source": None}, None),
        ({"payload": {"user_id": 1, "type": 5, "timestamp": "2024-01-02T03:04:05Z"}}, "payload_malformed"),
        ({"payload": {"user_id": 1, "type": "login", "timestamp": "2024-01-02T03:04:05Z", "session_id": {"x": 1}}}, "payload_malformed"),
        ({"payload": {"user_id": 1, "type": "login", "timestamp": "2024-01-02T03:04:05Z", "additional": {"type": 5}}}, None),
    ],
)
def test_other_kinds_of_values_are_rejected(spark, change, reason):
    records = spark.createDataFrame([(json.dumps(GOOD | change),)], "value STRING")
    assert c.validate(records).first()["reject_reason"] == reason
