"""The same queries in plain SQL, for a second engine to check them.

Written in another form than the library wherever that is practical: earlier events are found by joining a user's
events with each other instead of by windows, averages are folds over lists, and fusion steps through the verdicts of
a session one by one. Shared parts are common table expressions, put in front of a query together with what they need.
"""

from __future__ import annotations

import numpy as np

from vigil.functions.columns import DAY, HOUR, TYPE_WINDOWS
from vigil.plans.results import IDLE, MULTIPLIER, TUNING, fixed_model
from vigil.schemas import FEATURES
from vigil.sources.canon import ACTIVITY, SESSION_SECONDS

ORACLE: dict[str, str] = {}


def _case(column: str, mapping: dict, otherwise: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


MARKOV_LIMIT = (
    "CASE WHEN {t} < {least} THEN NULL WHEN {t} < 50 THEN 0.02 WHEN {t} > 200 THEN 0.05 "
    "ELSE greatest(0.01, 1.0 / sqrt({t})) END"
)


def _improbable(total: str, count: str, least: int) -> str:
    limit = MARKOV_LIMIT.format(t=total, least=least)
    return f"CASE WHEN {total} >= {least} THEN {count}::DOUBLE / {total} < {limit} END"


def _level(scope: str, order: int) -> str:
    least = TUNING.min_total_user if scope == "user" else TUNING.min_total_global
    test = _improbable(f"{scope}_total_{order}", f"{scope}_count_{order}", least)
    return f"CASE WHEN visible_{order} THEN {test} END"


def _fold(column: str, order: str = "pos", within: str = "user_id, event_type", alpha: float = 0.3) -> str:
    return (
        f"list_reduce(list({column}) OVER (PARTITION BY {within} ORDER BY {order} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda a, x: {alpha} * x + {round(1 - alpha, 9)} * a)"
    )


def _averages(source: str) -> str:
    """Average, deviation and its average over the rows of ``source``, by user and type."""
    return f"""
  SELECT *, {_fold('deviation', 'sec, seq')} AS sigma
  FROM (SELECT *, abs(type_count - ema) AS deviation
        FROM (SELECT *, {_fold('type_count::DOUBLE', 'sec, seq')} AS ema FROM {source}))"""


STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
NUMBER = "CAST(value AS VARCHAR)"


def _layer(inputs: str, weights: np.ndarray, biases: np.ndarray, rectified: bool) -> str:
    rows = ", ".join(
        "[" + ", ".join(repr(float(v)) for v in [*weights[:, j], biases[j]]) + "]" for j in range(weights.shape[1])
    )
    product = f"list_dot_product(list_append({inputs}, 1.0::DOUBLE), w)"
    value = f"greatest(0.0::DOUBLE, {product})" if rectified else product
    return f"list_transform([{rows}]::DOUBLE[][], lambda w: {value})"


def _network(source: str) -> str:
    """``rebuilt`` for every row of ``source``, which holds the scaled features as list ``x``."""
    model = fixed_model()
    sql, inputs = f"SELECT *, x AS y0 FROM {source}", "y0"
    for i, (w, b, rectified) in enumerate(zip(model.weights, model.biases, (True, False, True, False))):
        sql = f"SELECT *, {_layer(inputs, w, b, rectified)} AS y{i + 1} FROM ({sql})"
        inputs = f"y{i + 1}"
    return f"SELECT * EXCLUDE (y0, y1, y2, y3, y4), y4 AS rebuilt FROM ({sql})"


def _gradient(source: str) -> str:
    """Gradient of the mean loss over the rows of ``source``, parameter by parameter in the order of the flattened model."""
    model = fixed_model()
    sql, inputs = f"SELECT x AS y0 FROM {source}", "y0"
    for i, (w, b, rectified) in enumerate(zip(model.weights, model.biases, (True, False, True, False))):
        sql = f"SELECT *, {_layer(inputs, w, b, rectified)} AS y{i + 1} FROM ({sql})"
        inputs = f"y{i + 1}"
    sql = f"SELECT *, list_transform(list_zip(y4, y0), lambda p: 2 * (p[1] - p[2]) / 8) AS d4 FROM ({sql})"
    for layer in (3, 2, 1):  # what reaches a layer's outputs, from the layer above
        w = model.weights[layer]
        back = _layer(f"d{layer + 1}", w.T, np.zeros(len(w)), False)
        if layer in (3, 1):
            back = f"list_transform(list_zip({back}, y{layer}), lambda p: CASE WHEN p[2] > 0 THEN p[1] ELSE 0 END)"
        sql = f"SELECT *, {back} AS d{layer} FROM ({sql})"
    parts, at = [], 0
    for layer, w in enumerate(model.weights):
        rows, columns = w.shape
        ends = f"list_append(y{layer}, 1.0::DOUBLE)"  # the last row holds the biases
        parts.append(
            f"SELECT {at} + i * {columns} + j AS position, sum({ends}[i + 1] * d{layer + 1}[j + 1]) / count(*) AS value "
            f"FROM net, range({rows + 1}) r(i), range({columns}) c(j) GROUP BY ALL"
        )
        at += (rows + 1) * columns
    parts.append(f"SELECT {at}, avg(list_sum(list_transform(list_zip(y4, y0), lambda p: (p[1] - p[2]) ** 2)) / 8) FROM net")
    return f"WITH net AS ({sql}) " + " UNION ALL ".join(parts)


LOSS = "list_sum(list_transform(list_zip(x, rebuilt), lambda p: (p[1] - p[2]) ** 2)) / 8"
BUCKET = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"
SCALED = ", ".join(f"({f} - {f}_mean) / {f}_scale" for f in FEATURES)

# name -> (what it needs, query)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": (
        (),
        f"""
  SELECT event_id, event_id AS seq, ts, sec, CAST(hour(ts) AS INTEGER) AS hour, user_id,
    {_case('event_type', ACTIVITY, 'event_type')} AS event_type,
    user_id || '-' || (sec // {SESSION_SECONDS}) AS session_id,
    '10.0.' || (user_id % 250) || '.' || (k // 25) AS ip,
    'ua' || (k % 3) AS user_agent,
    CASE WHEN k >= 95 THEN 'XX' ELSE 'C' || (user_id % 10) END AS country,
    value, k
  FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events)""",
    ),
    "rec": (
        ("ev",),
        f"""
  SELECT *, '{{"user_id":' || (CASE WHEN k = 2 THEN 0 ELSE user_id END) || ',"type":"' || event_type
      || '","timestamp":"' || {STAMP} || '","session_id":"' || session_id
      || '","metadata":{{"ip":"' || ip || '","user_agent":"' || user_agent || '","country":"' || country
      || '"}},"additional":{{"value":' || {NUMBER} || '}}}}' AS payload_text,
    CASE WHEN k = 0 THEN 'spec_version' WHEN k = 3 THEN 'malformed' END AS envelope_reason,
    CASE WHEN k = 0 THEN 'spec_version' WHEN k = 1 THEN 'domain_mismatch' WHEN k = 3 THEN 'malformed'
      WHEN k = 2 OR user_id = 0 THEN 'user_id' END AS reject_reason
  FROM ev""",
    ),
    "prev": (
        ("ev",),
        f"""
  SELECT *, coalesce(sec - sec_1 < {72 * HOUR}, FALSE) AS visible_1,
    coalesce(sec - sec_1 < {72 * HOUR} AND sec_1 - sec_2 < {72 * HOUR}, FALSE) AS visible_2,
    CASE WHEN sec - sec_2 < {72 * HOUR} THEN 1 ELSE 0 END::BIGINT AS recorded
  FROM (SELECT *, lag(sec, 1) OVER u AS sec_1, lag(sec, 2) OVER u AS sec_2,
          lag(event_type, 1) OVER u AS event_type_1, lag(event_type, 2) OVER u AS event_type_2
        FROM ev WINDOW u AS (PARTITION BY user_id ORDER BY sec, seq))""",
    ),
    "ep": (
        ("prev",),
        f"""
  SELECT e.*, (SELECT count(*) FROM prev p WHERE p.user_id = e.user_id AND (p.sec, p.seq) <= (e.sec, e.seq)
               AND p.sec - p.sec_1 >= {14 * DAY}) AS epoch
  FROM prev e""",
    ),
    "seen": (
        ("ep",),
        """
  SELECT e.event_id, count(*) FILTER (p.ip = e.ip) AS seen_ip,
    count(*) FILTER (p.user_agent = e.user_agent) AS seen_user_agent,
    count(*) FILTER (p.country = e.country) AS seen_country,
    count(*) FILTER (p.hour = e.hour) AS hour_count
  FROM ep e LEFT JOIN ep p ON p.user_id = e.user_id AND p.epoch = e.epoch AND (p.sec, p.seq) < (e.sec, e.seq)
  GROUP BY e.event_id""",
    ),
    "hours": (
        ("ep",),
        """
  SELECT e.event_id, sqrt(sum((coalesce(h.n, 0) - e.mean) ** 2) / 24) AS hour_stddev
  FROM (SELECT e.event_id, count(p.event_id) / 24.0 AS mean
        FROM ep e LEFT JOIN ep p ON p.user_id = e.user_id AND p.epoch = e.epoch AND (p.sec, p.seq) < (e.sec, e.seq)
        GROUP BY e.event_id) e
  CROSS JOIN range(24) r(hour)
  LEFT JOIN (SELECT e.event_id, p.hour, count(*) AS n
             FROM ep e JOIN ep p ON p.user_id = e.user_id AND p.epoch = e.epoch AND (p.sec, p.seq) < (e.sec, e.seq)
             GROUP BY ALL) h ON h.event_id = e.event_id AND h.hour = r.hour
  GROUP BY e.event_id""",
    ),
    "tu": (
        ("prev",),
        """
  SELECT e.event_id,
    CAST(coalesce(sum(p.recorded), 0) AS BIGINT) AS user_total_1,
    CAST(coalesce(sum(p.recorded) FILTER (p.event_type = e.event_type), 0) AS BIGINT) AS user_count_1,
    CAST(coalesce(sum(p.recorded) FILTER (p.event_type_2 IS NOT DISTINCT FROM e.event_type_2), 0) AS BIGINT)
      AS user_total_2,
    CAST(coalesce(sum(p.recorded) FILTER (p.event_type_2 IS NOT DISTINCT FROM e.event_type_2
      AND p.event_type = e.event_type), 0) AS BIGINT) AS user_count_2
  FROM prev e LEFT JOIN prev p ON p.user_id = e.user_id AND p.event_type_1 IS NOT DISTINCT FROM e.event_type_1
    AND (p.sec, p.seq) < (e.sec, e.seq)
  GROUP BY e.event_id""",
    ),
    "tg": (
        ("prev",),
        """
  SELECT event_id,
    CAST(sum(recorded) OVER (PARTITION BY event_type_1 ORDER BY sec, seq) - recorded AS BIGINT) AS global_total_1,
    CAST(sum(recorded) OVER (PARTITION BY event_type_1, event_type ORDER BY sec, seq) - recorded AS BIGINT)
      AS global_count_1,
    CAST(sum(recorded) OVER (PARTITION BY event_type_2, event_type_1 ORDER BY sec, seq) - recorded AS BIGINT)
      AS global_total_2,
    CAST(sum(recorded) OVER (PARTITION BY event_type_2, event_type_1, event_type ORDER BY sec, seq) - recorded
      AS BIGINT) AS global_count_2
  FROM prev""",
    ),
    "tc": (
        ("ev",),
        f"""
  SELECT e.event_id, count(p.event_id) AS type_count
  FROM (SELECT *, {_case('event_type', TUNING.type_windows, str(TUNING.default_type_window))} AS span FROM ev) e
  LEFT JOIN ev p ON p.user_id = e.user_id AND p.event_type = e.event_type AND (p.sec, p.seq) < (e.sec, e.seq)
    AND p.sec >= e.sec - e.span
  GROUP BY e.event_id""",
    ),
    "mk": (
        ("prev", "tu", "tg"),
        f"""
  SELECT *, coalesce(u2, u1, g2, g1, FALSE) AS markov_anomaly,
    CASE WHEN coalesce(u2, u1, g2, g1, FALSE) THEN 'Unusual transition '
      || CASE WHEN u2 IS NOT NULL OR (u1 IS NULL AND g2 IS NOT NULL) THEN event_type_2 || '->' ELSE '' END
      || event_type_1 || '->' || event_type || ' based on '
      || CASE WHEN u2 IS NOT NULL OR u1 IS NOT NULL THEN 'user history' ELSE 'global history' END
    END AS markov_message
  FROM (SELECT *, {_level('user', 2)} AS u2, {_level('user', 1)} AS u1, {_level('global', 2)} AS g2,
          {_level('global', 1)} AS g1
        FROM prev JOIN tu USING (event_id) JOIN tg USING (event_id))""",
    ),
    "s1": (
        ("mk", "seen"),
        """
  SELECT *, CASE WHEN seen_ip = 0 THEN 'new_ip' WHEN seen_user_agent = 0 THEN 'new_user_agent'
      WHEN seen_country = 0 THEN 'new_country' WHEN markov_anomaly THEN 'markov_low_probability' END AS stage1_type,
    CASE WHEN seen_ip = 0 THEN 'IP address never seen before'
      WHEN seen_user_agent = 0 THEN 'User agent never seen before'
      WHEN seen_country = 0 THEN 'Country never seen before' ELSE markov_message END AS stage1_message
  FROM mk JOIN seen USING (event_id)""",
    ),
    "s2": (
        ("s1", "tc", "hours", "outlier"),
        """
  SELECT *, outlier AS ema_outlier,
    CASE WHEN NOT outlier AND hour_count = 0 THEN 'error_missing_hour' ELSE 'ok' END AS stage2_status,
    CASE WHEN outlier THEN 'ema_outlier' WHEN hour_count = 0 THEN NULL
      WHEN hour_count < hour_stddev THEN 'time_deviation' END AS stage2_type,
    CASE WHEN outlier THEN 'Event frequency for ' || event_type || ' deviates from baseline: '
        || printf('%.2f', type_count::DOUBLE) || ' vs EMA=' || printf('%.2f', ema)
        || ' (σ=' || printf('%.2f', sigma) || ')'
      WHEN hour_count = 0 THEN NULL
      WHEN hour_count < hour_stddev THEN 'Activity at unusual hour ' || hour || '. Count=' || hour_count
        || ' < stdDev=' || printf('%.2f', hour_stddev) END AS stage2_message
  FROM outlier JOIN hours USING (event_id)""",
    ),
    "clean": (("s1", "tc"), "SELECT * FROM s1 JOIN tc USING (event_id) WHERE stage1_type IS NULL"),
    "clean_avg": (("clean",), _averages("clean")),
    "outlier": (
        ("clean_avg",),
        """
  SELECT *, deviation > (CASE WHEN sigma < 1 THEN 4.0 ELSE 2.5 END) * sigma AND sigma > 0 AS outlier
  FROM clean_avg""",
    ),
    "all_types": (("ev", "tc"), "SELECT * FROM ev JOIN tc USING (event_id)"),
    "all_avg": (("all_types",), _averages("all_types")),
    "verdict": (
        ("s1", "s2"),
        """
  SELECT s1.event_id, s1.seq, s1.sec, s1.ts, s1.user_id, s1.session_id, s1.event_type,
    CASE WHEN failed THEN NULL ELSE coalesce(s1.stage1_type, s2.stage2_type) IS NOT NULL END AS anomaly,
    CASE WHEN failed THEN NULL ELSE coalesce(s1.stage1_type, s2.stage2_type, '') END AS anomaly_type,
    CASE WHEN failed THEN NULL ELSE coalesce(s1.stage1_message, s2.stage2_message, 'No anomaly deteceted') END
      AS message,
    coalesce(s2.stage2_status, 'ok') AS status
  FROM s1 LEFT JOIN s2 ON s2.event_id = s1.event_id,
    LATERAL (SELECT coalesce(s2.stage2_status, 'ok') <> 'ok' AS failed)""",
    ),
    "stat": (("verdict",), "SELECT *, ts AS timestamp FROM verdict WHERE status = 'ok'"),
    "sw": (
        ("ev",),
        """
  SELECT *, CAST((n - 1) // 5 AS BIGINT) AS batch, CAST((n - 1) % 5 AS BIGINT) AS position
  FROM (SELECT e.*, (SELECT count(*) FROM ev p WHERE p.session_id = e.session_id
                     AND (p.sec, p.seq) <= (e.sec, e.seq)) AS n FROM ev e)""",
    ),
    "bf": (
        ("sw",),
        """
  SELECT session_id, batch, count(DISTINCT ip) AS unique_ips, count(DISTINCT country) AS unique_countries,
    count(DISTINCT user_agent) AS unique_agents, count(*) AS event_count,
    count(DISTINCT event_type) AS unique_events, min(hour) AS min_hour, max(hour) AS max_hour,
    avg(hour) AS avg_hour, max(user_id) FILTER (position = 4) AS user_id, max(ts) FILTER (position = 4) AS ts,
    max(sec) FILTER (position = 4) AS sec, max(seq) FILTER (position = 4) AS seq
  FROM sw GROUP BY session_id, batch HAVING count(*) = 5""",
    ),
    "sf": (
        ("ev",),
        """
  SELECT session_id, min(user_id) AS user_id, count(DISTINCT ip) AS unique_ips,
    count(DISTINCT country) AS unique_countries, count(DISTINCT user_agent) AS unique_agents,
    count(*) AS event_count, count(DISTINCT event_type) AS unique_events, min(hour) AS min_hour,
    max(hour) AS max_hour, avg(hour) AS avg_hour
  FROM ev GROUP BY session_id""",
    ),
    "sc": (
        ("sf",),
        "SELECT "
        + ", ".join(
            f"avg({f}) AS {f}_mean, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS {f}_scale"
            for f in FEATURES
        )
        + " FROM sf",
    ),
    "sx": (("sf", "sc"), f"SELECT session_id, [{SCALED}]::DOUBLE[] AS x FROM sf CROSS JOIN sc"),
    "sn": (("sx",), _network("sx")),
    "held": (
        ("sn",),
        f"SELECT session_id, {LOSS} AS loss FROM sn WHERE {BUCKET.format('session_id')} % 100 >= 80",
    ),
    "losses": (
        ("held",),
        f"""
  SELECT g, (row_number() OVER (PARTITION BY g ORDER BY session_id) - 1) // 256 AS b, loss
  FROM (SELECT *, {BUCKET.format('session_id')} % (SELECT greatest(1, (count(*) + 65535) // 65536) FROM held) AS g
        FROM held)""",
    ),
    "metrics": (
        ("losses",),
        """
  SELECT avg(loss) AS test_loss, quantile_cont(loss, 0.95) AS threshold, count(*) AS batches
  FROM (SELECT avg(loss) AS loss FROM losses GROUP BY g, b)""",
    ),
    "bx": (("bf", "sc"), f"SELECT bf.*, [{SCALED}]::DOUBLE[] AS x FROM bf CROSS JOIN sc"),
    "bn": (("bx",), _network("bx")),
    "ml": (
        ("bn", "metrics"),
        f"""
  SELECT session_id, batch, user_id, ts AS timestamp, sec, seq, {LOSS} AS score,
    threshold * {MULTIPLIER} AS threshold, {LOSS} > threshold * {MULTIPLIER} AS anomaly, event_count, unique_events,
    'ml' AS source
  FROM bn CROSS JOIN metrics""",
    ),
    "tagged": (
        ("stat", "ml"),
        """
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY sec, seq, kind) AS n,
    sec - lag(sec) OVER (PARTITION BY session_id ORDER BY sec, seq, kind) AS gap
  FROM (SELECT session_id, seq, sec, timestamp, anomaly, anomaly_type, 0 AS kind FROM stat
        UNION ALL SELECT session_id, seq, sec, timestamp, anomaly, NULL, 1 FROM ml)""",
    ),
}


def _fused(idle: int | None) -> str:
    """Steps through the verdicts of all sessions at once, one verdict per session and step."""
    reset = "FALSE" if idle is None else f"coalesce(t.gap > {idle}, FALSE)"
    alive = f"(NOT f.done AND NOT {reset})"
    return f"""
  SELECT session_id, n, 1 AS step, kind = 1 AS has_ml, kind = 0 AS has_stat, FALSE AS done,
    CASE WHEN kind = 1 THEN seq END AS ml_seq, coalesce(kind = 0 AND anomaly, FALSE) AS stat_anomaly,
    CASE WHEN kind = 0 AND anomaly THEN [anomaly_type] ELSE []::VARCHAR[] END AS types, timestamp
  FROM tagged WHERE n = 1
  UNION ALL
  SELECT t.session_id, t.n, f.step + 1,
    t.kind = 1 OR ({alive} AND f.has_ml), t.kind = 0 OR ({alive} AND f.has_stat),
    (t.kind = 1 OR ({alive} AND f.has_ml)) AND (t.kind = 0 OR ({alive} AND f.has_stat)),
    CASE WHEN t.kind = 1 THEN t.seq WHEN {alive} THEN f.ml_seq END,
    coalesce(t.kind = 0 AND t.anomaly, FALSE) OR ({alive} AND f.stat_anomaly),
    list_concat(CASE WHEN {alive} THEN f.types ELSE []::VARCHAR[] END,
      CASE WHEN t.kind = 0 AND t.anomaly THEN [t.anomaly_type] ELSE []::VARCHAR[] END),
    t.timestamp
  FROM walk{'' if idle is None else '_idle'} f JOIN tagged t ON t.session_id = f.session_id AND t.n = f.n + 1"""


def _fused_rows(walk: str) -> str:
    return f"""
  SELECT w.session_id, m.user_id, m.anomaly AS ml_anomaly, m.score AS ml_score, m.threshold AS ml_threshold,
    w.stat_anomaly, nullif(array_to_string(list_sort(list_distinct(w.types)), ', '), '') AS anomaly_type,
    m.event_count, m.unique_events, w.timestamp AS created_at, t.seq
  FROM {walk} w JOIN tagged t ON t.session_id = w.session_id AND t.n = w.n
  JOIN ml m ON m.session_id = w.session_id AND m.seq = w.ml_seq
  WHERE w.done"""


PARTS["walk"] = (("tagged",), _fused(None))
PARTS["walk_idle"] = (("tagged",), _fused(IDLE))
PARTS["fused"] = (("walk", "ml"), _fused_rows("walk"))
PARTS["agg"] = (("walk_idle", "ml"), _fused_rows("walk_idle"))


def _needed(names: tuple[str, ...], found: list[str] | None = None) -> list[str]:
    found = [] if found is None else found
    for name in names:
        if name not in found:
            _needed(PARTS[name][0], found)
            if name not in found:
                found.append(name)
    return found


# Parts that several others read are computed once.
STORED = {"ev", "prev", "ep", "seen", "hours", "tu", "tg", "tc", "mk", "s1", "clean_avg", "outlier", "s2", "verdict"}
STORED |= {"stat", "bf", "sf", "ml", "tagged", "held", "sc", "fused", "agg"}


def sql(name: str, needs: str, body: str) -> None:
    parts = _needed(tuple(needs.split()))
    recursive = "RECURSIVE " if any(p.startswith("walk") for p in parts) else ""
    ctes = ",\n".join(
        f"{p} AS {'MATERIALIZED ' if p in STORED else ''}({PARTS[p][1]})" for p in parts
    )
    ORACLE[name] = f"WITH {recursive}{ctes}\n{body}" if parts else body


# --- sources and sinks ------------------------------------------------------------------------------------------

VALUE = (
    "'{\"spec_version\":\"' || CASE WHEN k = 0 THEN '' ELSE '1.0' END || '\",\"domain\":\"' "
    "|| CASE WHEN k = 1 THEN 'billing' ELSE 'user_activity' END || '\",\"event_type\":\"' || event_type "
    f"|| '\",\"source\":\"table\",\"timestamp\":\"' || {STAMP} || '\",\"correlation\":{{\"session_id\":\"' "
    "|| session_id || '\"},\"payload\":' || payload_text || '}'"
)
sql(
    "src_keyed_events",
    "rec",
    f"SELECT CAST(user_id AS VARCHAR) AS key, {VALUE} AS value FROM rec WHERE reject_reason IS NULL",
)
STAT_JSON = (
    "'{\"user_id\":' || user_id || ',\"session_id\":\"' || session_id || '\",\"event_type\":\"' || event_type "
    "|| '\",\"anomaly\":' || anomaly || ',\"anomaly_type\":\"' || anomaly_type || '\",\"message\":\"' || message "
    f"|| '\",\"timestamp\":\"' || {STAMP} || '\",\"source\":\"stat\"}}'"
)
sql("src_stat_out_json", "stat", f"SELECT {STAT_JSON} AS value FROM stat")
RAW = (
    "event_id AS id, user_id, event_type, ts AS timestamp, ip, user_agent, country, '{\"ip\":\"' || ip "
    "|| '\",\"user_agent\":\"' || user_agent || '\",\"country\":\"' || country || '\"}' AS metadata, "
    f"'{{\"value\":' || {NUMBER} || '}}' AS additional, ts AS created_at, session_id"
)
sql("sink_raw_events", "ev", f"SELECT {RAW} FROM ev")
sql(
    "sink_stat_results",
    "stat",
    "SELECT event_id AS id, user_id, session_id, event_type, anomaly, anomaly_type, message, timestamp, "
    "'stat' AS source, timestamp AS created_at FROM stat",
)
sql(
    "sink_ml_results",
    "ml",
    "SELECT seq AS id, user_id, session_id, timestamp, anomaly, round(score, 6) AS score, "
    "round(threshold, 6) AS threshold, event_count, unique_events, source, timestamp AS created_at FROM ml",
)
sql(
    "sink_aggregated_results",
    "agg",
    "SELECT seq AS id, session_id, user_id, ml_anomaly, round(ml_score, 6) AS ml_score, "
    "round(ml_threshold, 6) AS ml_threshold, stat_anomaly, anomaly_type, event_count, unique_events, created_at "
    "FROM agg",
)
sql(
    "scan_training_events",
    "ev",
    "SELECT event_id AS id, user_id, event_type, ts AS timestamp, ip, user_agent, country, session_id, hour FROM ev",
)
sql(
    "retention_7d",
    "ev",
    "SELECT event_id AS id, user_id, event_type, ts AS timestamp FROM ev "
    "WHERE NOT ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY",
)
sql("upsert_users_seen", "", "SELECT user_id AS id, min(ts) AS created_at, max(ts) AS last_seen FROM events GROUP BY 1")

# --- validation and routing -------------------------------------------------------------------------------------

sql(
    "parse_envelope",
    "rec",
    "SELECT event_id, k = 3 AS malformed, CASE WHEN k = 0 THEN '' WHEN k <> 3 THEN '1.0' END AS spec_version, "
    "CASE WHEN k = 1 THEN 'billing' WHEN k <> 3 THEN 'user_activity' END AS domain, "
    "CASE WHEN k <> 3 THEN event_type END AS event_type, CASE WHEN k <> 3 THEN 'table' END AS source FROM rec",
)
sql("validate_envelope", "rec", "SELECT event_id, envelope_reason AS reject_reason FROM rec")
sql(
    "parse_payload",
    "rec",
    "SELECT event_id, CASE WHEN k = 2 THEN 0 ELSE user_id END AS user_id, event_type AS type, session_id, ip, "
    f"user_agent, country, '{{\"value\":' || {NUMBER} || '}}' AS additional FROM rec WHERE k NOT IN (0, 1, 3)",
)
sql("validate_payload", "rec", "SELECT event_id, reject_reason FROM rec")
sql("filter_domain", "rec", "SELECT event_id, 'user_activity' AS domain FROM rec WHERE k NOT IN (0, 1, 3)")
sql(
    "quarantine_counts",
    "rec",
    "SELECT reject_reason, count(*) AS n FROM rec WHERE reject_reason IS NOT NULL GROUP BY 1",
)
sql(
    "route_domains",
    "rec",
    "SELECT event_id, 'user_activity' AS domain, user_id FROM rec WHERE reject_reason IS NULL UNION ALL "
    "SELECT event_id, 'accounting', NULL FROM rec WHERE k = 1",
)
sql(
    "flatten_event",
    "rec",
    "SELECT event_id, 'user_activity' AS domain, 'table' AS source, ts AS envelope_ts, user_id, event_type, ts, hour, "
    f"session_id, ip, user_agent, country, '{{\"value\":' || {NUMBER} || '}}' AS additional "
    "FROM rec WHERE reject_reason IS NULL",
)
sql(
    "build_envelope",
    "rec",
    # Whole numbers lose their ".0" on the way through a JSON value.
    "SELECT event_id, '{\"spec_version\":\"1.0\",\"domain\":\"user_activity\",\"event_type\":\"' || event_type "
    f"|| '\",\"source\":\"table\",\"timestamp\":\"' || {STAMP} || '\",\"correlation\":{{\"session_id\":\"' "
    "|| session_id || '\"},\"payload\":{\"user_id\":' || user_id "
    "|| replace(substr(payload_text, strpos(payload_text, ',')), '.0}}', '}}') || '}' AS value FROM rec",
)
sql(
    "ml_input_projection",
    "rec",
    "SELECT event_id, session_id, user_id, event_type, ip, country, user_agent, ts, hour FROM rec "
    "WHERE k NOT IN (2, 3) AND user_id <> 0",
)
sql(
    "decode_stat_result",
    "stat",
    "SELECT event_id, user_id, session_id, event_type, anomaly, anomaly_type, message, timestamp, 'stat' AS source "
    "FROM stat",
)
sql(
    "decode_ml_result",
    "ml",
    "SELECT seq, user_id, session_id, timestamp, anomaly, round(score, 6) AS score, round(threshold, 6) AS threshold, "
    "event_count, unique_events, source FROM ml",
)
sql(
    "dedupe_events",
    "ev",
    "SELECT min(seq) AS seq, CAST(ts AS DATE) AS day, user_id, event_type, ip, user_agent, country FROM ev "
    "GROUP BY ALL",
)

# --- history ----------------------------------------------------------------------------------------------------

sql("hist_prev_events", "prev", "SELECT event_id, event_type_1, sec_1, event_type_2, sec_2 FROM prev")
sql("hist_visible_prev", "prev", "SELECT event_id, visible_1, visible_2, recorded FROM prev")
sql(
    "ttl_epochs",
    "prev",
    "SELECT e.event_id, count(p.event_id) AS epoch FROM prev e LEFT JOIN prev p ON p.user_id = e.user_id "
    f"AND (p.sec, p.seq) <= (e.sec, e.seq) AND p.sec - p.sec_1 >= {2 * DAY} GROUP BY e.event_id",
)
EARLIER = "p.user_id = e.user_id AND (p.sec, p.seq) < (e.sec, e.seq)"
sql(
    "win_range_events",
    "ev",
    f"SELECT e.event_id, count(p.event_id) AS events_before FROM ev e LEFT JOIN ev p ON {EARLIER} "
    f"AND p.sec >= e.sec - {7 * DAY} GROUP BY e.event_id",
)
sql(
    "win_type_count",
    "ev",
    f"SELECT e.event_id, count(p.event_id) AS type_count FROM ev e LEFT JOIN ev p ON {EARLIER} "
    f"AND p.event_type = e.event_type AND p.sec >= e.sec - {7 * DAY} GROUP BY e.event_id",
)
sql("win_type_count_by_type", "tc", "SELECT * FROM tc")
sql("transition_counts_user", "tu", "SELECT * FROM tu")
sql("transition_counts_global", "tg", "SELECT * FROM tg")
sql(
    "transition_histogram",
    "prev",
    "SELECT 2 AS markov_order, event_type_2 AS prev2, event_type_1 AS prev1, event_type AS cur, count(*) AS n "
    "FROM prev WHERE recorded = 1 GROUP BY ALL UNION ALL "
    "SELECT 1, NULL, event_type_1, event_type, count(*) FROM prev WHERE recorded = 1 GROUP BY ALL",
)
sql("hour_histogram", "ev seen", "SELECT event_id, hour, hour_count FROM ev JOIN seen USING (event_id)")

# --- detectors --------------------------------------------------------------------------------------------------

for _name in ("ip", "user_agent", "country"):
    sql(f"detect_new_{_name}", "seen", f"SELECT event_id, seen_{_name} = 0 AS new_{_name} FROM seen")
sql(
    "detect_stored_user_data",
    "seen",
    "SELECT event_id, CASE WHEN seen_ip = 0 THEN 'new_ip' WHEN seen_user_agent = 0 THEN 'new_user_agent' "
    "WHEN seen_country = 0 THEN 'new_country' END AS anomaly_type FROM seen",
)
sql("detect_markov_first", "mk", "SELECT event_id, u1 AS by_user, g1 AS by_all FROM mk")
sql("detect_markov_second", "mk", "SELECT event_id, u2 AS by_user, g2 AS by_all FROM mk")
sql(
    "markov_threshold",
    "tg",
    f"SELECT event_id, round({MARKOV_LIMIT.format(t='global_total_2', least=20)}, 6) AS threshold, "
    f"{_improbable('global_total_2', 'global_count_2', 20)} AS improbable FROM tg",
)
sql("detect_markov", "mk", "SELECT event_id, markov_anomaly, markov_message FROM mk")
sql("ema_count", "all_avg", "SELECT event_id, round(ema + 1e-10, 6) AS ema FROM all_avg")
_SLOW = {"order": "sec, seq", "within": "event_type", "alpha": 0.05}
sql(
    "ema_count_slow",
    "ev",
    f"SELECT event_id, round(ema + 1e-10, 6) AS ema, round({_fold('abs(x - ema)', **_SLOW)} + 1e-10, 6) AS sigma "
    f"FROM (SELECT *, {_fold('x', **_SLOW)} AS ema FROM (SELECT *, (event_id % 97)::DOUBLE AS x FROM ev))",
)
sql(
    "ema_deviation",
    "all_avg",
    "SELECT event_id, round(deviation + 1e-10, 6) AS deviation, round(sigma + 1e-10, 6) AS sigma FROM all_avg",
)
sql(
    "detect_ema_outlier",
    "all_avg",
    "SELECT event_id, type_count, deviation > (CASE WHEN sigma < 1 THEN 4.0 ELSE 2.5 END) * sigma AND sigma > 0 "
    "AS ema_outlier FROM all_avg",
)
sql("hour_stddev", "hours", "SELECT event_id, round(hour_stddev, 6) AS hour_stddev FROM hours")
sql(
    "detect_time_deviation",
    "seen hours",
    "SELECT event_id, CASE WHEN hour_count = 0 THEN 'error_missing_hour' ELSE 'ok' END AS status, "
    "CASE WHEN hour_count > 0 THEN hour_count < hour_stddev END AS time_deviation "
    "FROM seen JOIN hours USING (event_id)",
)
sql("stage1_cached", "s1", "SELECT event_id, stage1_type, stage1_message FROM s1")
sql(
    "stage2_statistics",
    "s2",
    "SELECT event_id, stage2_type, stage2_status, round(ema + 1e-10, 6) AS ema, round(sigma + 1e-10, 6) AS sigma FROM s2",
)
sql(
    "stat_verdicts",
    "verdict",
    "SELECT event_id, ts, user_id, session_id, event_type, anomaly, anomaly_type, message, status FROM verdict",
)

# --- session features and model ---------------------------------------------------------------------------------

PLAIN = "unique_ips, unique_countries, unique_agents, event_count, unique_events, min_hour, max_hour"
sql("session_count_window", "sw", "SELECT event_id, batch, position FROM sw")
sql("ml_batch_features", "bf", f"SELECT session_id, batch, {PLAIN}, round(avg_hour, 6) AS avg_hour FROM bf")
sql("session_features", "sf", f"SELECT session_id, user_id, {PLAIN}, round(avg_hour, 6) AS avg_hour FROM sf")
sql(
    "session_event_sequence",
    "ev",
    "SELECT session_id, CAST(n // 10000 AS BIGINT) AS part, "
    "string_agg(event_type, ',' ORDER BY sec, seq) AS event_sequence "
    "FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY sec, seq) - 1 AS n FROM ev) GROUP BY 1, 2",
)
sql(
    "scaler_fit",
    "sc",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round({f}_mean, 6) AS mean, round({f}_scale, 6) AS scale FROM sc" for f in FEATURES
    ),
)
sql(
    "scaler_transform",
    "sx",
    "SELECT session_id, " + ", ".join(f"round(x[{i + 1}], 6) AS {f}" for i, f in enumerate(FEATURES)) + " FROM sx",
)
sql(
    "ae_reconstruct",
    "sn",
    "SELECT session_id, "
    + ", ".join(f"round(rebuilt[{i + 1}], 6) AS {f}" for i, f in enumerate(FEATURES))
    + " FROM sn",
)
sql(
    "ml_verdicts",
    "ml",
    "SELECT session_id, batch, anomaly, round(score, 6) AS score, round(threshold, 6) AS threshold FROM ml",
)
sql(
    "ml_verdict_shape",
    "ml",
    "SELECT user_id, session_id, timestamp, anomaly, event_count, unique_events, source FROM ml",
)
sql("session_features_merged", "sf", f"SELECT session_id, user_id, {PLAIN}, round(avg_hour, 6) AS avg_hour FROM sf")
sql(
    "minute_rollup",
    "ev",
    "SELECT date_trunc('minute', ts) AS time, count(*) AS total_events, count(*) FILTER (event_type = 'login') AS logins, "
    "count(*) FILTER (event_type = 'payment') AS payments, count(*) FILTER (event_type = 'failed_login') AS failed_logins "
    "FROM ev WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY 1",
)
sql("train_test_split", "sf", f"SELECT session_id, {BUCKET.format('session_id')} % 100 < 80 AS is_train FROM sf")
sql(
    "ae_gradient",
    "sx",
    "SELECT CAST(position AS BIGINT) AS position, round(value, 7) AS value FROM ("
    + _gradient(f"(SELECT * FROM sx WHERE {BUCKET.format('session_id')} % 100 < 80)")
    + ")",
)
sql(
    "loss_threshold",
    "metrics",
    "SELECT round(test_loss, 6) AS test_loss, round(threshold, 6) AS threshold, batches FROM metrics",
)
sql(
    "training_metadata",
    "ev",
    "SELECT count(*) AS total_events, count(DISTINCT session_id) AS total_sessions, max(event_id) AS last_event_id, "
    "max(ts) AS last_event_at FROM ev",
)
sql(
    "retrain_new_events",
    "",
    "SELECT count(*) AS new_events, coalesce(max(event_id), 500) AS max_event_id FROM events WHERE event_id > 500",
)
sql(
    "retrain_decision",
    "",
    "SELECT count(*) AS new_events, coalesce(max(event_id), 500) AS max_event_id, count(*) >= 2000 AS retrain, "
    "CASE WHEN count(*) >= 2000 THEN 'volume: ' || count(*) || ' events to learn from' ELSE '' END AS reason FROM events WHERE event_id > 500",
)

# --- fusion -----------------------------------------------------------------------------------------------------

FUSED = "session_id, user_id, ml_anomaly, stat_anomaly, event_count, unique_events, created_at"
sql(
    "fuse_sessions",
    "fused",
    f"SELECT {FUSED}, round(ml_score, 6) AS ml_score, round(ml_threshold, 6) AS ml_threshold FROM fused",
)
sql("fuse_anomaly_types", "fused", "SELECT session_id, created_at, anomaly_type FROM fused")
sql("fuse_idle_expiry", "agg", f"SELECT {FUSED}, anomaly_type FROM agg")
sql(
    "join_ml_stat",
    "ml stat",
    "SELECT m.session_id, m.timestamp, m.anomaly AS ml_anomaly, round(m.score, 6) AS score, "
    "bool_or(s.anomaly) AS stat_anomaly, "
    "nullif(coalesce(string_agg(DISTINCT s.anomaly_type, ', ' ORDER BY s.anomaly_type) FILTER (s.anomaly), ''), '') "
    "AS anomaly_type FROM ml m JOIN stat s ON s.session_id = m.session_id "
    "GROUP BY m.session_id, m.timestamp, m.batch, m.anomaly, m.score",
)

# --- stored queries ---------------------------------------------------------------------------------------------


def _latest(table: str, order: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM {table} QUALIFY row_number() OVER (PARTITION BY session_id "
        f"ORDER BY {order} DESC, seq DESC) = 1"
    )


sql("latest_aggregated", "agg", _latest("agg", "created_at", "session_id, created_at, ml_anomaly, stat_anomaly, anomaly_type"))
sql("latest_ml", "ml", _latest("ml", "timestamp", "session_id, timestamp, anomaly, round(score, 6) AS score"))
sql("latest_stat", "stat", _latest("stat", "timestamp", "session_id, timestamp, event_type, anomaly, anomaly_type"))
sql(
    "latest_stat_of_session",
    "stat",
    "SELECT session_id, timestamp, event_type, anomaly, anomaly_type FROM stat WHERE session_id = '7-2818' "
    "ORDER BY timestamp DESC, seq DESC LIMIT 1",
)
EVENT = "event_id, user_id, event_type, ts, ip, user_agent, country, session_id"
sql("event_by_id", "ev", f"SELECT {EVENT} FROM ev WHERE event_id = 77")
sql("events_by_user", "ev", f"SELECT {EVENT} FROM ev WHERE user_id = 7 ORDER BY ts DESC, event_id DESC LIMIT 20")
sql("clustered_events_by_user", "ev", f"SELECT {EVENT} FROM ev WHERE user_id = 7 ORDER BY ts DESC, event_id DESC LIMIT 20")
sql("clustered_event_by_id", "ev", f"SELECT {EVENT} FROM ev WHERE event_id = 77")
sql("clustered_session", "ev", f"SELECT {EVENT} FROM ev WHERE session_id = '7-2818'")
sql(
    "retention_versions",
    "ev",
    "SELECT event_id AS id, user_id, ts AS timestamp, ts >= TIMESTAMP '2024-01-24' AS kept FROM ev",
)
sql("upsert_seen_buckets", "", "SELECT user_id AS id, min(ts) AS created_at, max(ts) AS last_seen FROM events GROUP BY 1")
sql("latest_events", "ev", f"SELECT {EVENT} FROM ev ORDER BY ts DESC, event_id DESC LIMIT 50")
sql(
    "events_between",
    "ev",
    f"SELECT {EVENT} FROM ev WHERE user_id = 7 AND sec BETWEEN epoch(TIMESTAMP '2024-01-08') "
    "AND epoch(TIMESTAMP '2024-01-22')",
)
sql(
    "user_seen_by_id",
    "",
    "SELECT user_id AS id, min(ts) AS created_at, max(ts) AS last_seen FROM events WHERE user_id = 7 GROUP BY 1",
)
PROFILE = (
    "SELECT user_id AS id, 'user' || user_id AS username, country, ip, user_agent FROM ev "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sec DESC, seq DESC) = 1"
)
sql("users_limit", "ev", f"SELECT * FROM ({PROFILE}) ORDER BY id LIMIT 10")
sql("user_profile_by_id", "ev", f"SELECT * FROM ({PROFILE}) WHERE id = 7")

# --- dashboards -------------------------------------------------------------------------------------------------

ANY = "(ml_anomaly OR stat_anomaly)"


def _between(column: str) -> str:
    return f"{column} BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-22'"


def _per_minute(table: str, column: str, counts: str, where: str) -> str:
    return f"SELECT date_trunc('minute', {column}) AS time, {counts} FROM {table} WHERE {where} GROUP BY 1"


sql("dash_total_results", "agg", "SELECT count(*) AS total_results FROM agg")
sql("dash_ml_anomalies", "agg", "SELECT count(*) AS ml_anomalies FROM agg WHERE ml_anomaly")
sql("dash_stat_anomalies", "agg", "SELECT count(*) AS stat_anomalies FROM agg WHERE stat_anomaly")
sql("dash_anomalies_per_min", "agg", _per_minute("agg", "created_at", "count(*) AS anomalies", ANY))
sql("dash_ml_per_min", "agg", _per_minute("agg", "created_at", "count(*) AS ml_only", "ml_anomaly"))
sql("dash_stat_per_min", "agg", _per_minute("agg", "created_at", "count(*) AS stat_only", "stat_anomaly"))
sql(
    "dash_recent_anomalies",
    "agg",
    "SELECT session_id, user_id, anomaly_type, ml_anomaly, stat_anomaly, event_count, unique_events, "
    f"created_at AS timestamp FROM agg WHERE {ANY} ORDER BY created_at DESC, seq DESC LIMIT 200",
)
sql("dash_raw_ml_per_min", "ml", _per_minute("ml", "timestamp", "count(*) AS ml_events", "anomaly"))
sql("dash_raw_stat_per_min", "stat", _per_minute("stat", "timestamp", "count(*) AS stat_events", "anomaly"))
sql(
    "dash_by_type",
    "agg",
    "SELECT anomaly_type AS type, count(*) AS count FROM agg WHERE anomaly_type <> '' GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 20",
)
sql(
    "dash_recent_ml",
    "ml",
    "SELECT session_id, user_id, anomaly, round(score, 6) AS score, round(threshold, 6) AS threshold, event_count, "
    "unique_events, timestamp FROM ml ORDER BY timestamp DESC, seq DESC LIMIT 200",
)
sql("dash_events_per_min", "ev", _per_minute("ev", "ts", "count(*) AS events", _between("ts")))
sql(
    "dash_anomalies_per_min_range",
    "agg",
    _per_minute("agg", "created_at", "count(*) AS anomalies", f"{_between('created_at')} AND {ANY}"),
)
for _type in ("login", "payment", "failed_login"):
    sql(
        f"dash_{_type}_per_min",
        "ev",
        _per_minute("ev", "ts", f"count(*) FILTER (event_type = '{_type}') AS {_type}", _between("ts")),
    )
sql("dash_event_types", "ev", "SELECT event_type AS type, count(*) AS count FROM ev GROUP BY 1")
sql("dash_top_users", "ev", "SELECT user_id, count(*) AS events FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
sql(
    "dash_totals",
    "ev stat",
    "SELECT (SELECT count(*) FROM ev) AS events, (SELECT count(*) FROM stat WHERE anomaly) AS anomalies",
)
sql(
    "dash_activity_breakdown",
    "ev",
    _per_minute(
        "ev",
        "ts",
        "count(*) AS total_events, count(*) FILTER (event_type = 'login') AS logins, "
        "count(*) FILTER (event_type = 'payment') AS payments, "
        "count(*) FILTER (event_type = 'failed_login') AS failed_logins",
        _between("ts"),
    ),
)
sql(
    "session_rollup",
    "ev",
    "SELECT session_id, user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS events, "
    "bool_or(event_type = 'payment') AS has_payment, round(sum(value), 4) AS total_value FROM ev GROUP BY 1, 2 "
    "ORDER BY start_time DESC, session_id LIMIT 50",
)
DETAILS = "event_id, anomaly_type, user_id, event_type, timestamp, message"
sql(
    "anomaly_details",
    "stat",
    f"SELECT {DETAILS} FROM stat WHERE anomaly ORDER BY timestamp DESC, event_id DESC LIMIT 100",
)
sql("anomaly_details_by_type", "stat", "SELECT anomaly_type AS type, count(*) AS count FROM stat WHERE anomaly GROUP BY 1")
sql(
    "session_anomalies",
    "stat",
    "SELECT session_id, user_id, count(*) AS anomalies_count, "
    "string_agg(DISTINCT anomaly_type, ', ' ORDER BY anomaly_type) AS anomaly_types FROM stat WHERE anomaly "
    "GROUP BY 1, 2 ORDER BY 3 DESC, session_id LIMIT 50",
)
