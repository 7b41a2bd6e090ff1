"""Decoding, validation and routing of event envelopes.

Input is a table or stream with one JSON text per row in ``value``. Nothing is dropped on the way: a row that breaks a
rule keeps its text and gets the name of the first broken rule in ``reject_reason``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import empty_as_null, first_rule, has_offset
from vigil.schemas import ENVELOPE, ML_RESULT, PAYLOAD, STAT_RESULT
from vigil.session import materialise

USER_ACTIVITY = "user_activity"
SPEC_VERSION = "1.0"
MALFORMED = "_malformed"
TEXTS = ("spec_version", "domain", "event_type", "source")
PAYLOAD_TEXTS = ("type", "timestamp", "session_id")
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}


def _decode(text: Column, ddl: str) -> Column:
    return F.from_json(text, f"{ddl}, {MALFORMED} STRING", OPTIONS)


def _parsed_once(df: DataFrame, name: str, struct: Column) -> DataFrame:
    """Adds ``struct`` as a column that is computed once per row.

    A filter on parsed fields would otherwise be moved below the parsing and bring a copy of it along for every field
    it reads. Filters do not move below a generator, and an array of one element keeps every row.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(struct)).alias(name))


def wrong_types(text: Column, fields: tuple[str, ...]) -> Column:
    """Whether a top-level field that has to be a text is another kind of value.

    The parser takes numbers and objects for texts. Records in which such a field is followed by anything but a quote are
    rare; only these are looked at again, with their types.
    """
    suspect = text.rlike(f'"({"|".join(fields)})"\\s*:\\s*[^"\\s]')
    kinds = [F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{f}", "variant")) for f in fields]
    wrong = reduce(lambda a, b: a | b, [F.coalesce(~k.isin("STRING", "VOID"), F.lit(False)) for k in kinds])
    return F.coalesce(F.when(suspect, wrong), F.lit(False))


def parse_envelope(records: DataFrame) -> DataFrame:
    """Adds ``envelope`` and ``malformed``. The payload stays text until the domain is known."""
    decoded = _parsed_once(records, "envelope", _decode(F.col("value"), ENVELOPE))
    broken = F.col("envelope").isNull() | F.col(f"envelope.{MALFORMED}").isNotNull() | wrong_types(F.col("value"), TEXTS)
    return decoded.withColumn("malformed", broken)


def _missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def envelope_reason() -> Column:
    """First broken rule of an envelope. Any non-empty version and any domain passes."""
    return first_rule(
        (F.col("malformed"), "malformed"),
        (_missing("envelope.spec_version"), "spec_version"),
        (_missing("envelope.domain"), "domain"),
        (_missing("envelope.event_type"), "event_type"),
        (_missing("envelope.payload"), "payload"),
    )


def validate_envelope(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("reject_reason", envelope_reason())


def domain_is(domain: str) -> Column:
    return F.col("envelope.domain") == domain


def filter_domain(validated: DataFrame, domain: str = USER_ACTIVITY) -> DataFrame:
    """Valid envelopes of one domain."""
    return validated.where(F.col("reject_reason").isNull() & domain_is(domain))


def parse_payload(validated: DataFrame, domain: str = USER_ACTIVITY) -> DataFrame:
    """Adds ``payload`` for valid envelopes of the domain; others get the reason ``domain_mismatch``."""
    fits = F.col("reject_reason").isNull() & domain_is(domain)
    parsed = _parsed_once(validated, "payload", F.when(fits, _decode(F.col("envelope.payload"), PAYLOAD)))
    return parsed.withColumn("reject_reason", F.coalesce("reject_reason", F.when(~fits, F.lit("domain_mismatch"))))


def event_time(text: Column) -> Column:
    """Moment of an RFC 3339 text as zone-less UTC; null when the text is no timestamp or names no offset."""
    moment = F.try_to_timestamp(F.when(has_offset(text), text))
    return F.to_utc_timestamp(moment, F.current_timezone()).cast("timestamp_ntz")


def local_hour(text: Column) -> Column:
    """Hour of day in the offset the producer wrote, as it stands in the text; null when there is none."""
    return F.try_element_at(F.split(text, "[T ]"), F.lit(2)).substr(1, 2).try_cast("int")


def validate_payload(parsed: DataFrame) -> DataFrame:
    """Completes ``reject_reason``. Session and metadata may be missing; ``additional`` defaults to ``{}``."""
    payload = F.col("payload")
    reason = first_rule(
        (
            payload.isNull() | payload[MALFORMED].isNotNull() | wrong_types(F.col("envelope.payload"), PAYLOAD_TEXTS),
            "payload_malformed",
        ),
        (F.coalesce(payload["user_id"], F.lit(0)) == 0, "user_id"),
        (F.coalesce(payload["type"], F.lit("")) == "", "type"),
        (event_time(payload["timestamp"]).isNull(), "timestamp"),
    )
    additional = F.coalesce(payload["additional"], F.lit("{}"))
    return parsed.withColumns(
        {
            "reject_reason": F.coalesce("reject_reason", reason),
            "payload": F.when(payload.isNotNull(), payload.withField("additional", additional)),
        }
    )


def validate(records: DataFrame, domain: str = USER_ACTIVITY) -> DataFrame:
    """The whole chain from text to ``envelope``, ``payload`` and ``reject_reason``."""
    return validate_payload(parse_payload(validate_envelope(parse_envelope(records)), domain))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_reason").isNull())


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_reason").isNotNull())


def quarantine_counts(validated: DataFrame) -> DataFrame:
    return quarantined(validated).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def flatten_event(validated: DataFrame, *keep: str) -> DataFrame:
    """One flat event per valid row; missing texts become empty, as the store expects them."""
    payload, envelope = F.col("payload"), F.col("envelope")

    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    ts = event_time(payload["timestamp"])
    return accepted(validated).select(
        *keep,
        envelope["domain"].alias("domain"),
        text(envelope["source"]).alias("source"),
        event_time(envelope["timestamp"]).alias("envelope_ts"),
        payload["user_id"].alias("user_id"),
        payload["type"].alias("event_type"),
        ts.alias("ts"),
        local_hour(payload["timestamp"]).alias("hour"),
        text(payload["session_id"]).alias("session_id"),
        text(payload["metadata"]["ip"]).alias("ip"),
        text(payload["metadata"]["user_agent"]).alias("user_agent"),
        text(payload["metadata"]["country"]).alias("country"),
        payload["additional"].alias("additional"),
    )


def ml_input(records: DataFrame, *keep: str) -> DataFrame:
    """Events for session scoring: session from the payload, else from the correlation map; no session or user, no row."""
    parsed = _parsed_once(parse_envelope(records), "payload", _decode(F.col("envelope.payload"), PAYLOAD))
    payload, envelope = F.col("payload"), F.col("envelope")
    session = F.coalesce(empty_as_null(payload["session_id"]), empty_as_null(envelope["correlation"]["session_id"]))
    stamp = F.coalesce(empty_as_null(payload["timestamp"]), empty_as_null(envelope["timestamp"]))
    return (
        parsed.where(~F.col("malformed"))
        .select(
            *keep,
            session.alias("session_id"),
            F.nullif(payload["user_id"], F.lit(0)).alias("user_id"),
            payload["type"].alias("event_type"),
            payload["metadata"]["ip"].alias("ip"),
            payload["metadata"]["country"].alias("country"),
            payload["metadata"]["user_agent"].alias("user_agent"),
            event_time(stamp).alias("ts"),
            local_hour(stamp).alias("hour"),
        )
        .where(F.col("session_id").isNotNull() & F.col("user_id").isNotNull())
    )


Route = Callable[[DataFrame], DataFrame]


def route_domains(
    validated: DataFrame, routes: Mapping[str, Route], aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Hand each domain's envelopes to its route and put the results together; unknown domains are skipped.

    ``aliases`` maps a domain name to the name it is handled under, and the envelope carries that name on.
    """
    for name, handled_as in (aliases or {}).items():
        domain = F.when(F.col("envelope.domain") == name, F.lit(handled_as)).otherwise(F.col("envelope.domain"))
        validated = validated.withColumn("envelope", F.col("envelope").withField("domain", domain))
    # One parse for all routes: the rows of known domains are stored once, each route reads its own.
    known = validated.where(F.col("reject_reason").isNull() & F.col("envelope.domain").isin(*routes))
    if len(routes) > 1 and not known.isStreaming:
        known = materialise(known)
    results = [route(known.where(domain_is(domain))) for domain, route in routes.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def build_envelope(events: DataFrame, source: str, *keep: str) -> DataFrame:
    """Envelope JSON in ``value`` from flat events; the session goes into the correlation map when there is one.

    An ``additional`` that is no JSON becomes ``{}``; ``unreadable_additional`` gives those events.
    """
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    session = F.coalesce("session_id", F.lit(""))
    payload = F.struct(
        "user_id",
        F.col("event_type").alias("type"),
        stamp.alias("timestamp"),
        session.alias("session_id"),
        F.struct("ip", "user_agent", "country").alias("metadata"),
        F.coalesce(F.try_parse_json("additional"), F.parse_json(F.lit("{}"))).alias("additional"),
    )
    envelope = F.struct(
        F.lit(SPEC_VERSION).alias("spec_version"),
        F.lit(USER_ACTIVITY).alias("domain"),
        "event_type",
        F.lit(source).alias("source"),
        stamp.alias("timestamp"),
        F.when(session != "", F.create_map(F.lit("session_id"), session)).alias("correlation"),
        payload.alias("payload"),
    )
    return events.select(*keep, F.to_json(envelope).alias("value"))


def unreadable_additional(events: DataFrame) -> DataFrame:
    """Events whose ``additional`` is no JSON, with the reason; their envelopes go out without it."""
    broken = F.col("additional").isNotNull() & F.try_parse_json("additional").isNull()
    return events.where(broken).withColumn("reject_reason", F.lit("additional"))


def keyed(records: DataFrame) -> DataFrame:
    """``key`` is the user id as text, ``value`` the unchanged record; rows without a usable key are left out."""
    return accepted(validate(records)).select(F.col("payload.user_id").cast("string").alias("key"), "value")


def encode(rows: DataFrame, *keep: str) -> DataFrame:
    """Every column but ``keep`` as one JSON text in ``value``, timestamps in RFC 3339."""
    columns = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if t.startswith("timestamp") else F.col(c)
        for c, t in rows.dtypes
        if c not in keep
    ]
    return rows.select(*keep, F.to_json(F.struct(*columns)).alias("value"))


def _decode_result(records: DataFrame, ddl: str, keep: tuple[str, ...]) -> DataFrame:
    decoded = _parsed_once(records, "_result", _decode(F.col("value"), ddl)).where(
        F.col("_result").isNotNull() & F.col(f"_result.{MALFORMED}").isNull()
    )
    return decoded.select(*keep, "_result.*").drop(MALFORMED).withColumn("timestamp", event_time(F.col("timestamp")))


def decode_stat_result(records: DataFrame, *keep: str) -> DataFrame:
    return _decode_result(records, STAT_RESULT, keep)


def decode_ml_result(records: DataFrame, *keep: str) -> DataFrame:
    return _decode_result(records, ML_RESULT, keep)


def dedupe_events(events: DataFrame, arrival: str = "seq") -> DataFrame:
    """Exact copies of an event collapse to the first to arrive."""
    content = [c for c in events.columns if c != arrival]
    return events.groupBy(*content).agg(F.min(arrival).alias(arrival)).select(*events.columns)
