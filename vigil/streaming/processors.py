"""Keyed state for streams: user history, moving averages, session batches, fusion.

Each processor walks the new rows of a key in ``(sec, seq)`` order; state that grows with a key's history is read and written
entry by entry. The columns it gives out are those of the table operators, so everything after it is shared.

Expiry follows event time, so a replay gives the same rows. With ``ttl_ms`` the state of a key that falls silent is dropped
by an event-time timer, once the watermark has passed its last event by that much; events behind the watermark are late
and are left out by Spark then. Without it, state stays and late events are taken in the order they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vigil.operators.features import GROUP
from vigil.operators.history import Tuning
from vigil.operators.past import Past, advance
from vigil.operators.strict import AVERAGES, COUNTED, HISTORY, StoredTransitions

HISTORY_SCHEMA = (
    "event_id LONG, seq LONG, ts TIMESTAMP_NTZ, sec LONG, hour INT, user_id LONG, session_id STRING, "
    f"event_type STRING, ip STRING, user_agent STRING, country STRING, {HISTORY}"
)
STRICT_SCHEMA = f"{HISTORY_SCHEMA}, {COUNTED}, {AVERAGES}"
REVISED_SCHEMA = f"{STRICT_SCHEMA}, late BOOLEAN"

BATCH_FEATURES_SCHEMA = (
    "session_id STRING, batch LONG, unique_ips LONG, unique_countries LONG, unique_agents LONG, event_count LONG, "
    "unique_events LONG, min_hour INT, max_hour INT, avg_hour DOUBLE, user_id LONG, ts TIMESTAMP_NTZ, sec LONG, "
    "seq LONG"
)

FUSED_SCHEMA = (
    "seq LONG, session_id STRING, user_id LONG, ml_anomaly BOOLEAN, ml_score DOUBLE, ml_threshold DOUBLE, "
    "stat_anomaly BOOLEAN, anomaly_type STRING, event_count LONG, unique_events LONG, created_at TIMESTAMP_NTZ"
)


class Silent(StatefulProcessor):
    """State that goes when its key has had no event for ``ttl_ms``. Subclasses name their states in ``self.all``."""

    ttl_ms: int | None = None

    def remember(self, handle: StatefulProcessorHandle, *states) -> None:
        self.handle, self.all = handle, states
        self.until = handle.getValueState("until", "ms LONG", None) if self.ttl_ms is not None else None

    def heard(self, sec: int) -> None:
        """Put the end of the key's state off."""
        if self.until is None:
            return
        end = int(sec) * 1000 + self.ttl_ms
        if not self.until.exists() or self.until.get()[0] < end:
            if self.until.exists():
                self.handle.deleteTimer(self.until.get()[0])
            self.handle.registerTimer(end)
            self.until.update((end,))

    def forget(self) -> None:
        if self.until is not None and self.until.exists():
            self.handle.deleteTimer(self.until.get()[0])
            self.until.clear()
        for state in self.all:
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.until.clear()
        for state in self.all:
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def in_order(rows: Iterator[pd.DataFrame], *order: str) -> pd.DataFrame:
    frame = pd.concat(list(rows), ignore_index=True).drop(columns="_at", errors="ignore")
    return frame.sort_values(list(order), kind="stable", ignore_index=True)


class Points:
    """A map state read entry by entry: each entry at most once per micro-batch, and written once if it changed."""

    def __init__(self, state):
        self.state = state
        self.known: dict[tuple, tuple | None] = {}
        self.changed: set[tuple] = set()

    def get(self, key: tuple) -> tuple | None:
        if key not in self.known:
            found = self.state.getValue(key)
            self.known[key] = None if found is None else tuple(found)
        return self.known[key]

    def put(self, key: tuple, value: tuple | None) -> None:
        self.known[key] = value
        self.changed.add(key)

    def remove(self, key: tuple) -> None:
        self.put(key, None)

    def clear(self) -> None:
        self.state.clear()
        self.known.clear()
        self.changed.clear()

    def save(self) -> None:
        for key in self.changed:
            value = self.known[key]
            if value is not None:
                self.state.updateValue(key, value)
            elif self.state.containsKey(key):
                self.state.removeKey(key)


class UserHistory(Silent):
    """What was known about a user before each event; the stream form of ``user_history``.

    An event reads and writes a fixed number of state entries, however long the user's history is.
    """

    STATES = {
        "values": ("field STRING, value STRING", "n LONG"),
        "steps": ("level STRING, a STRING, b STRING, c STRING", "n LONG"),
        "ends": ("type STRING", "first LONG, behind LONG, n LONG"),
        "waiting": ("type STRING, i LONG", "sec LONG, n LONG"),
        "averages": ("type STRING", "ema DOUBLE, sigma DOUBLE, sec LONG"),
    }

    def __init__(self, tuning: Tuning = Tuning(), ttl_ms: int | None = None):
        self.tuning = tuning
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "sec_1 LONG, type_1 STRING, sec_2 LONG, type_2 STRING", None)
        self.hours = handle.getValueState("hours", "n ARRAY<LONG>", None)
        self.maps = {name: handle.getMapState(name, *kinds, None) for name, kinds in self.STATES.items()}
        self.remember(handle, self.last, self.hours, *self.maps.values())

    def _past(self) -> Past:
        past = Past(self.tuning, lambda name: Points(self.maps[name]))
        if self.last.exists():
            past.last = tuple(self.last.get())
            past.hours = [int(n) for n in self.hours.get()[0]]
        return past

    def step(self, past: Past, event: dict) -> dict:
        seen = past.observe(event)
        past.store(event, seen["recorded"])
        return seen

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        past = self._past()
        frame = in_order(rows, "sec", "seq")
        seen = [self.step(past, event) for event in frame.to_dict("records")]
        self.last.update(past.last)
        self.hours.update((past.hours,))
        for entries in past.maps.values():
            entries.save()
        self.heard(frame["sec"].iloc[-1])
        yield pd.concat([frame, pd.DataFrame(seen)], axis=1)


class StrictHistory(UserHistory):
    """Strict mode: an event at an hour the user never had is not stored.

    Transitions of all users cannot be read from the state of one: ``everyone`` looks them up in the stored histogram, which
    is fixed when the stream starts.
    """

    def __init__(self, tuning: Tuning, everyone: StoredTransitions, ttl_ms: int | None = None):
        super().__init__(tuning, ttl_ms)
        self.everyone = everyone

    def step(self, past: Past, event: dict) -> dict:
        return past.check(event, self.everyone.of)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in super().handleInputRows(key, rows, timerValues):
            yield frame.astype({c: "float64" for c in ("ema", "deviation", "sigma")})


class RevisedHistory(UserHistory):
    """The whole cascade in one pass over events that may come late.

    Events younger than ``lateness`` seconds before the user's newest one wait in the state beside the settled past. They are checked
    at once, on a draft of it; when an event arrives before some of them, the rows from it on come out again and replace the
    earlier ones. Events before the settled past change nothing here: they come out with ``late`` set, for ``strict.corrected``.
    """

    PENDING = (
        "event_id LONG, seq LONG, ts TIMESTAMP_NTZ, sec LONG, hour INT, user_id LONG, session_id STRING, event_type STRING, "
        "ip STRING, user_agent STRING, country STRING"
    )

    def __init__(
        self, tuning: Tuning, everyone: StoredTransitions, lateness: int, strict: bool = False, ttl_ms: int | None = None
    ):
        super().__init__(tuning, ttl_ms)
        self.everyone, self.lateness, self.strict = everyone, lateness, strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.pending = handle.getListState("pending", self.PENDING, None)
        self.reach = handle.getValueState("reach", "settled LONG, newest LONG", None)
        self.all = (*self.all, self.pending, self.reach)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in self.PENDING.split(", ")]
        fresh = in_order(rows, "sec", "seq")[names].astype(object)
        fresh["ts"] = [t.to_pydatetime() for t in fresh["ts"]]
        fresh = fresh.where(fresh.notna(), None).to_dict("records")
        settled, newest = tuple(self.reach.get()) if self.reach.exists() else (None, None)
        late = [e | {"late": True} for e in fresh if settled is not None and e["sec"] < settled]
        on_time = fresh[len(late) :]
        out = late
        if on_time:
            newest = max(int(on_time[-1]["sec"]), newest if newest is not None else int(on_time[-1]["sec"]))
            settled = newest - self.lateness  # never falls: newest does not
            first = (on_time[0]["sec"], on_time[0]["seq"])
            waiting = [dict(zip(names, row, strict=True)) for row in self.pending.get()]
            past, draft, pending = self._past(), None, []
            for e in sorted(waiting + on_time, key=lambda e: (e["sec"], e["seq"])):
                if e["sec"] < settled:
                    seen = past.check(e, self.everyone.of, self.strict)
                else:
                    draft = draft or past.draft()
                    seen = draft.check(e, self.everyone.of, self.strict)
                    pending.append(tuple(e[c] for c in names))
                if (e["sec"], e["seq"]) >= first:
                    out.append(e | seen | {"late": False})
            self.last.update(past.last)
            self.hours.update((past.hours,))
            for entries in past.maps.values():
                entries.save()
            self.pending.put(pending)
            self.reach.update((settled, newest))
            self.heard(newest)
        columns = [f.split()[0] for f in REVISED_SCHEMA.split(", ")]
        frame = pd.DataFrame(out, columns=columns, dtype=object)
        yield frame.where(frame.notna(), None).assign(ts=pd.to_datetime(frame["ts"]))


class Averages(Silent):
    """Moving averages per user and type. Only clean events advance them; others pass with null averages."""

    def __init__(self, tuning: Tuning = Tuning(), ttl_ms: int | None = None):
        self.tuning = tuning
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("averages", "ema DOUBLE, sigma DOUBLE, sec LONG", None)
        self.remember(handle, self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.state.get()) if self.state.exists() else None
        frame = in_order(rows, "sec", "seq")
        results = []
        for row in frame.itertuples(index=False):
            if not row.clean:
                results.append((None, None, None))
                continue
            state, deviation = advance(state, float(row.type_count), int(row.sec), self.tuning)
            results.append((state[0], deviation, state[1]))
        if state is not None:
            self.state.update(state)
            self.heard(state[2])
        averages = pd.DataFrame(results, columns=["ema", "deviation", "sigma"], dtype="float64")
        yield pd.concat([frame, averages], axis=1)


class SessionBatches(Silent):
    """Features of every ``size`` events of a session; what is left over waits for more."""

    FIELDS = "user_id LONG, event_type STRING, ip STRING, country STRING, user_agent STRING, hour INT, sec LONG, seq LONG, ts TIMESTAMP_NTZ"

    def __init__(self, size: int = GROUP, ttl_ms: int | None = None):
        self.size = size
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getListState("buffer", self.FIELDS, None)
        self.batches = handle.getValueState("batches", "n LONG", None)
        self.remember(handle, self.buffer, self.batches)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in self.FIELDS.split(", ")]
        waiting = [tuple(r) for r in self.buffer.get()]
        fresh = in_order(rows, "sec", "seq")[names]
        fresh["ts"] = [t.to_pydatetime() for t in fresh["ts"]]
        waiting += list(fresh.itertuples(index=False, name=None))
        n = self.batches.get()[0] if self.batches.exists() else 0
        done = []
        while len(waiting) >= self.size:
            group, waiting = pd.DataFrame(waiting[: self.size], columns=names), waiting[self.size :]
            last = group.iloc[-1]
            done.append(
                {
                    "session_id": key[0],
                    "batch": n,
                    "unique_ips": group["ip"].nunique(),
                    "unique_countries": group["country"].nunique(),
                    "unique_agents": group["user_agent"].nunique(),
                    "event_count": len(group),
                    "unique_events": group["event_type"].nunique(),
                    "min_hour": group["hour"].min(),
                    "max_hour": group["hour"].max(),
                    "avg_hour": float(group["hour"].mean()),
                    **{c: last[c] for c in ("user_id", "ts", "sec", "seq")},
                }
            )
            n += 1
        self.batches.update((n,))
        self.heard(fresh["sec"].iloc[-1])
        if waiting:
            self.buffer.put(waiting)
        else:
            self.buffer.clear()
        if done:
            yield pd.DataFrame(done)


class Fusion(Silent):
    """One row as soon as a session has both kinds of verdicts, then an empty session again.

    The statistical side is kept as its summary: whether any was anomalous, and the types.
    """

    def __init__(self, idle: int | None = 300, ttl_ms: int | None = None):
        self.idle = idle
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            "pending",
            "sec LONG, has_ml BOOLEAN, user_id LONG, ml_anomaly BOOLEAN, score DOUBLE, threshold DOUBLE, "
            "event_count LONG, unique_events LONG, has_stat BOOLEAN, stat_anomaly BOOLEAN, types ARRAY<STRING>",
            None,
        )
        self.remember(handle, self.state)

    EMPTY = (False, None, None, None, None, None, None, False, False, [])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, pending = None, self.EMPTY
        if self.state.exists():
            stored = tuple(self.state.get())
            last, pending = stored[0], stored[1:]
        done = []
        for row in in_order(rows, "sec", "seq", "kind").itertuples(index=False):
            if self.idle is not None and last is not None and row.sec - last > self.idle:
                pending = self.EMPTY
            last = int(row.sec)
            ml, stat = pending[:7], pending[7:]
            if row.kind == 1:
                ml = (
                    True,
                    int(row.user_id),
                    bool(row.anomaly),
                    float(row.score),
                    float(row.threshold),
                    int(row.event_count),
                    int(row.unique_events),
                )
            else:
                types = set(stat[2] or []) | ({row.anomaly_type} if row.anomaly else set())
                stat = (True, bool(stat[1] or row.anomaly), sorted(types))
            pending = (*ml, *stat)
            if ml[0] and stat[0]:
                done.append(
                    {
                        "seq": row.seq,
                        "session_id": key[0],
                        "user_id": ml[1],
                        "ml_anomaly": ml[2],
                        "ml_score": ml[3],
                        "ml_threshold": ml[4],
                        "stat_anomaly": stat[1],
                        "anomaly_type": ", ".join(stat[2]) or None,
                        "event_count": ml[5],
                        "unique_events": ml[6],
                        "created_at": row.timestamp,
                    }
                )
                pending = self.EMPTY
        if pending == self.EMPTY:
            self.forget()  # nothing waits: a later verdict finds an empty session either way
        else:
            self.state.update((last, *pending))
            self.heard(last)
        if done:
            yield pd.DataFrame(done)
