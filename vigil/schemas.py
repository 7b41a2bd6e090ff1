"""Record and table schemas, as DDL text."""

from __future__ import annotations

METADATA_FIELDS = ("ip", "user_agent", "country")

# ``payload`` stays text until the domain is known; ``correlation`` and ``metadata`` are free string maps.
ENVELOPE = (
    "spec_version STRING, domain STRING, event_type STRING, source STRING, timestamp STRING, "
    "correlation MAP<STRING, STRING>, metadata MAP<STRING, STRING>, payload STRING"
)

PAYLOAD = (
    "user_id BIGINT, type STRING, timestamp STRING, session_id STRING, "
    "metadata STRUCT<ip: STRING, user_agent: STRING, country: STRING>, additional STRING"
)

STAT_RESULT = (
    "user_id BIGINT, session_id STRING, event_type STRING, anomaly BOOLEAN, anomaly_type STRING, "
    "message STRING, timestamp STRING, source STRING"
)

ML_RESULT = (
    "user_id BIGINT, session_id STRING, timestamp STRING, anomaly BOOLEAN, score DOUBLE, threshold DOUBLE, "
    "event_count BIGINT, unique_events BIGINT, source STRING"
)

RAW_EVENTS = (
    "id BIGINT, user_id BIGINT, event_type STRING, timestamp TIMESTAMP_NTZ, ip STRING, user_agent STRING, "
    "country STRING, metadata STRING, additional STRING, created_at TIMESTAMP_NTZ, session_id STRING"
)

USERS = "id BIGINT, username STRING, country STRING, ip STRING, user_agent STRING"

FEATURES = (
    "unique_ips",
    "unique_countries",
    "unique_agents",
    "event_count",
    "unique_events",
    "min_hour",
    "max_hour",
    "avg_hour",
)
