"""A user's history as a fold: what is known before an event, and what the event adds to it.

Everything is kept in maps of small entries that are read and written one at a time, so an event costs the same however
long the history is; the maps may be plain dictionaries (tables) or keyed state (streams). Sums are kept beside their parts:
transition totals by level, 24 hourly counts, and the events of a type's window as a queue of seconds with its length, from
whose old end each entry is taken once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import sqrt

from vigil.operators.history import Tuning

FIELDS = ("ip", "user_agent", "country")
GLOBAL = ("global_total_1", "global_count_1", "global_total_2", "global_count_2")
NOTHING = (None, None, None, None)


class Entries:
    """A map in memory."""

    def __init__(self):
        self.rows: dict[tuple, tuple] = {}

    def get(self, key: tuple) -> tuple | None:
        return self.rows.get(key)

    def put(self, key: tuple, value: tuple) -> None:
        self.rows[key] = value

    def remove(self, key: tuple) -> None:
        self.rows.pop(key, None)

    def clear(self) -> None:
        self.rows.clear()


class Draft:
    """Entries over others that stay as they are."""

    def __init__(self, below):
        self.below, self.rows = below, {}

    def get(self, key: tuple) -> tuple | None:
        if key in self.rows:
            return self.rows[key]
        return None if self.below is None else self.below.get(key)

    def put(self, key: tuple, value: tuple | None) -> None:
        self.rows[key] = value

    def remove(self, key: tuple) -> None:
        self.rows[key] = None

    def clear(self) -> None:
        self.below, self.rows = None, {}


def steps_of(before_2, before_1, current) -> tuple[tuple, ...]:
    """Keys of a transition's four counts: total and count of first order, then of second order."""
    return (
        ("total_1", before_1, None, None),
        ("count_1", before_1, current, None),
        ("total_2", before_2, before_1, None),
        ("count_2", before_2, before_1, current),
    )


def advance(state, value: float, sec: int, tuning: Tuning):
    """Next ``(ema, sigma, sec)`` and the deviation of ``value``."""
    if state is None or sec - state[2] >= tuning.ema_ttl:
        return (value, 0.0, sec), 0.0
    ema = tuning.alpha * value + (1 - tuning.alpha) * state[0]
    deviation = abs(value - ema)
    return (ema, tuning.alpha * deviation + (1 - tuning.alpha) * state[1], sec), deviation


class Past:
    """Maps: ``values`` (field, value), ``steps`` of transitions, ``ends`` and ``waiting`` of the queues, ``averages``."""

    MAPS = ("values", "steps", "ends", "waiting", "averages")

    def __init__(self, tuning: Tuning, make: Callable[[str], Entries] = lambda name: Entries()):
        self.tuning = tuning
        self.maps = {name: make(name) for name in self.MAPS}
        self.last: tuple = NOTHING
        self.hours: list[int] = [0] * 24

    def draft(self) -> Past:
        """The same past, to go on from without changing this one."""
        out = Past(self.tuning, lambda name: Draft(self.maps[name]))
        out.last, out.hours = self.last, list(self.hours)
        return out

    # --- what was known before an event ---------------------------------------------------------------------------

    def _expire(self, sec: int) -> None:
        """Value sets and hours go together after ``set_ttl`` without an event."""
        if self.last[0] is not None and sec - self.last[0] >= self.tuning.set_ttl:
            self.maps["values"].clear()
            self.hours = [0] * 24

    def _in_window(self, event_type: str, sec: int) -> int:
        """Stored events of the type that are not older than its window; older ones leave the queue."""
        ends, waiting = self.maps["ends"], self.maps["waiting"]
        first, behind, n = ends.get((event_type,)) or (0, 0, 0)
        oldest = sec - self.tuning.type_windows.get(event_type, self.tuning.default_type_window)
        start = first
        while first < behind:
            at, count = waiting.get((event_type, first))
            if at >= oldest:
                break
            waiting.remove((event_type, first))
            first, n = first + 1, n - count
        if first != start:
            ends.put((event_type,), (first, behind, n))
        return n

    def _count(self, name: str, key: tuple) -> int:
        found = self.maps[name].get(key)
        return found[0] if found else 0

    def _spread(self) -> float:
        mean = sum(self.hours) / 24.0
        return sqrt(max(0.0, sum(n * n for n in self.hours) / 24.0 - mean * mean))

    def observe(self, e: dict) -> dict:
        """History columns of an event, from the state before it."""
        sec = int(e["sec"])
        self._expire(sec)
        sec_1, type_1, sec_2, type_2 = self.last
        ttl = self.tuning.history_ttl
        visible_1 = sec_1 is not None and sec - sec_1 < ttl
        totals = [self._count("steps", k) for k in steps_of(type_2, type_1, e["event_type"])]
        return {
            "event_type_1": type_1,
            "event_type_2": type_2,
            "visible_1": visible_1,
            "visible_2": visible_1 and sec_2 is not None and sec_1 - sec_2 < ttl,
            "recorded": int(sec_2 is not None and sec - sec_2 < ttl),
            **{f"seen_{f}": self._count("values", (f, e[f])) for f in FIELDS},
            **dict(zip(("user_total_1", "user_count_1", "user_total_2", "user_count_2"), totals, strict=True)),
            "hour_count": self.hours[int(e["hour"])],
            "hour_stddev": self._spread(),
            "type_count": self._in_window(e["event_type"], sec),
        }

    # --- what an event adds ---------------------------------------------------------------------------------------

    def _add(self, name: str, key: tuple) -> None:
        self.maps[name].put(key, (self._count(name, key) + 1,))

    def store(self, e: dict, recorded: int) -> None:
        sec, kind = int(e["sec"]), e["event_type"]
        sec_1, type_1, _, type_2 = self.last
        for f in FIELDS:
            self._add("values", (f, e[f]))
        self.hours[int(e["hour"])] += 1
        if recorded:
            for key in steps_of(type_2, type_1, kind):
                self._add("steps", key)
        ends, waiting = self.maps["ends"], self.maps["waiting"]
        first, behind, n = ends.get((kind,)) or (0, 0, 0)
        newest = waiting.get((kind, behind - 1)) if first < behind else None
        if newest is not None and newest[0] == sec:
            waiting.put((kind, behind - 1), (sec, newest[1] + 1))
        else:
            waiting.put((kind, behind), (sec, 1))
            behind += 1
        ends.put((kind,), (first, behind, n + 1))
        self.last = (sec, kind, sec_1, type_1)

    # --- both stages ----------------------------------------------------------------------------------------------

    def check(self, e: dict, everyone: Callable[..., tuple[int, int, int, int]], strict: bool = True) -> dict:
        """All columns both stages read, and the event is stored. In strict mode an event whose hour was never seen is not:
        it leaves no trace but in the moving average, which is advanced before the hour is looked up."""
        seen = self.observe(e)
        seen |= zip(GLOBAL, everyone(seen["event_type_2"], seen["event_type_1"], e["event_type"]), strict=True)
        seen |= {"ema": None, "deviation": None, "sigma": None}
        fails = False
        if not self._first_stage(seen):
            key = (e["event_type"],)
            state, deviation = advance(self.maps["averages"].get(key), float(seen["type_count"]), int(e["sec"]), self.tuning)
            self.maps["averages"].put(key, state)
            seen |= {"ema": state[0], "deviation": deviation, "sigma": state[1]}
            k = self.tuning.ema_k_small if state[1] < 1 else self.tuning.ema_k
            fails = strict and seen["hour_count"] == 0 and not (state[1] > 0 and deviation > k * state[1])
        if fails:
            seen["recorded"] = 0
        else:
            self.store(e, seen["recorded"])
        return seen

    def _first_stage(self, seen: dict) -> bool:
        """Whether the first stage flags the event."""
        if any(seen[f"seen_{f}"] == 0 for f in FIELDS):
            return True
        for scope, least in (("user", self.tuning.min_total_user), ("global", self.tuning.min_total_global)):
            for order in (2, 1):
                total = seen[f"{scope}_total_{order}"]
                if seen[f"visible_{order}"] and total >= least:
                    limit = 0.02 if total < 50 else 0.05 if total > 200 else max(0.01, 1 / sqrt(total))
                    return seen[f"{scope}_count_{order}"] / total < limit
        return False

    # --- as rows --------------------------------------------------------------------------------------------------

    def rows(self) -> Iterator[tuple[str, list, list]]:
        """The state in memory as (map, key, value) rows."""
        yield "last", [], list(self.last)
        yield "hours", [], self.hours
        for name, entries in self.maps.items():
            for key, value in entries.rows.items():
                yield name, list(key), list(value)

    def take(self, name: str, key: list, value: list) -> None:
        """Put one of the ``rows`` back."""
        if name == "last":
            self.last = tuple(value)
        elif name == "hours":
            self.hours = value
        else:
            self.maps[name].put(tuple(key), tuple(value))
