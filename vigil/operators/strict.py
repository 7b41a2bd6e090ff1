"""The cascade as a fold over each user's events: strict mode on tables, and corrections.

In strict mode an event at an hour its user never had is not stored at all. What is left out changes every later check of the user, so the verdicts of a user are a fold over its events. Tasks stream the
sorted events of their users through ``Past``. A user with more events than a block is cut into consecutive blocks; round r
folds the r-th block of all such users, and the state after it travels to the next round as rows of a table. So no task has more
than a block of a user and each block's result is written before the next one starts.

Transitions of all users depend on what other users left out. They are counted by the table operator from the transitions the fold
recorded, and the users for whom these counts decide an event otherwise than the fold did are folded again, until there are none:
all verdicts before the first wrong one are right in every round and its user is among those folded again, so this ends with
exactly the verdicts of a replay, after a few rounds as a rule. Such events lie where transitions are still few: the first block of
all events is settled alone, and the counts found there go into the first fold of the whole table. With a fixed histogram, as in
the stream, one fold is enough.

``corrected`` takes events that a stream set aside as too late: the verdicts of their users are folded again from the first of them
on and replace what was stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyarrow.dataset import dataset
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vigil.operators.detect import HISTORY_COLUMNS, markov_level, stage1, stage2, verdict_rows
from vigil.operators.history import FIRST, SECOND, USER, Tuning, global_transitions, transition_histogram
from vigil.operators.past import GLOBAL, Past, steps_of
from vigil.operators.series import BLOCK, by_key, join_null_safe
from vigil.session import intermediate_folder, materialise, rows_per_block

PARTS = 256
ASSUMED = ("assumed_1", "assumed_2")
HISTORY = (
    "event_type_1 STRING, event_type_2 STRING, visible_1 BOOLEAN, visible_2 BOOLEAN, recorded LONG, seen_ip LONG, "
    "seen_user_agent LONG, seen_country LONG, user_total_1 LONG, user_count_1 LONG, user_total_2 LONG, user_count_2 LONG, "
    "hour_count LONG, hour_stddev DOUBLE, type_count LONG"
)
AVERAGES = "ema DOUBLE, deviation DOUBLE, sigma DOUBLE"
COUNTED = ", ".join(f"{c} LONG" for c in GLOBAL)
STATE = "_map STRING, _key STRING, _value STRING"


class StoredTransitions:
    """Transition counts of all users in a folder of ``parts`` by the hash of the last type.

    A task reads the parts its events ask for and keeps the last ``most`` of them, so the histogram may have any size.
    """

    def __init__(self, folder: str, parts: int, most: int = 64):
        self.folder, self.parts, self.most = folder, parts, most
        self.read: dict[int, dict[tuple, int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"read": {}}

    def of(self, before_2, before_1, current) -> tuple[int, int, int, int]:
        if before_1 is None:
            return 0, 0, 0, 0
        part = crc32(before_1.encode()) % self.parts
        if part not in self.read:
            if len(self.read) >= self.most:
                self.read.pop(next(iter(self.read)))
            self.read[part] = self._levels(part)
        counts = self.read[part]
        return tuple(counts.get(k, 0) for k in steps_of(before_2, before_1, current))

    def _levels(self, part: int) -> dict[tuple, int]:
        files, root = FileSystem.from_uri(self.folder)
        path = f"{root}/part={part}"
        counts: dict[tuple, int] = {}
        if files.get_file_info(path).type != FileType.NotFound:
            for r in dataset(path, filesystem=files, format="parquet").to_table().to_pylist():
                for key in steps_of(r["prev2"], r["prev1"], r["cur"]):
                    counts[key] = counts.get(key, 0) + r["n"]
        return counts


def stored_transitions(events: DataFrame, tuning: Tuning = Tuning()) -> StoredTransitions:
    """The final histogram of ``events``, written once in parts that tasks look up."""
    histogram = transition_histogram(events, tuning).where("markov_order = 2")
    folder = f"{intermediate_folder(events.sparkSession)}/transitions-{uuid.uuid4().hex}"
    part = F.pmod(F.crc32("prev1"), F.lit(PARTS))
    histogram.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(folder)
    return StoredTransitions(folder, PARTS)


def _fold(
    rows: DataFrame,
    tuning: Tuning,
    everyone: Callable | None,
    strict: bool,
    state: DataFrame | None = None,
    keep_state: bool = False,
) -> DataFrame:
    """Fold events by user. ``rows`` may carry counts of all users for the types they were counted with.

    ``state`` are rows of users whose fold goes on; with ``keep_state`` such rows come out behind a user's events.
    """
    names = rows.columns
    if state is not None:
        rows = rows.unionByName(state, allowMissingColumns=True)
    else:
        rows = rows.withColumns({c.split()[0]: F.lit(None).cast("string") for c in STATE.split(", ")})
    schema = StructType([f for f in rows.schema.fields if f.name in HISTORY_COLUMNS])
    schema = StructType.fromDDL(", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] + [HISTORY, COUNTED, AVERAGES, STATE]))
    arrow = to_arrow_schema(schema)
    counted = GLOBAL[0] in names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user: object = run  # no user's id
        past = Past(tuning)

        def leave() -> list[dict]:
            if not keep_state or user is run:
                return []
            return [{"user_id": user, "_map": m, "_key": json.dumps(k), "_value": json.dumps(v)} for m, k, v in past.rows()]

        for batch in batches:
            out: list[dict] = []
            for e in batch.to_pylist():
                if e["user_id"] != user:
                    out += leave()
                    user, past = e["user_id"], Past(tuning)
                if e["_map"] is not None:
                    past.take(e["_map"], json.loads(e["_key"]), json.loads(e["_value"]))
                    continue

                def known(before_2, before_1, current, e=e) -> tuple:
                    if everyone is not None:
                        return everyone(before_2, before_1, current)
                    right = counted and (before_1, before_2) == (e["assumed_1"], e["assumed_2"])
                    return tuple(e[c] or 0 for c in GLOBAL) if right else (0, 0, 0, 0)

                out.append({c: e[c] for c in HISTORY_COLUMNS} | past.check(e, known, strict))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if rest := leave():
            yield pa.RecordBatch.from_pylist(rest, schema=arrow)

    order = [F.col("user_id"), F.col("_map").isNull(), F.col("sec"), F.col("seq")]
    return rows.repartition("user_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def _folded(rows: DataFrame, tuning: Tuning, everyone: Callable | None, strict: bool, limit: int | None) -> DataFrame:
    """The fold over all users, oversized ones block by block; written to the shared folder."""
    state_columns = [c.split()[0] for c in STATE.split(", ")]
    parts = by_key(rows, USER, limit=limit).parts
    found = materialise(_fold(parts[0].df, tuning, everyone, strict).drop(*state_columns))
    if len(parts) == 1:
        return found
    blocks = parts[1].df
    turns = blocks.select("user_id", BLOCK).distinct()
    turns = turns.withColumn("_turn", F.row_number().over(Window.partitionBy("user_id").orderBy(BLOCK)))
    blocks = materialise(blocks.join(F.broadcast(turns), ["user_id", BLOCK]).drop(BLOCK))
    state = None
    for turn in range(1, turns.agg(F.max("_turn")).first()[0] + 1):
        block = blocks.where(F.col("_turn") == turn).drop("_turn")
        step = materialise(_fold(block, tuning, everyone, strict, state, keep_state=True))
        found = found.unionByName(step.where("_map IS NULL").drop(*state_columns))
        state = step.where("_map IS NOT NULL").select("user_id", *state_columns)
    return found


def folded_history(
    events: DataFrame,
    tuning: Tuning = Tuning(),
    everyone: StoredTransitions | None = None,
    strict: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """All columns both stages read, one row per event.

    Without ``everyone`` the transitions of all users are those stored before each event.
    """
    rows = events.select(*HISTORY_COLUMNS)
    if everyone is not None:
        return _folded(rows, tuning, everyone.of, strict, limit)
    known, most, total = None, rows_per_block(events.sparkSession, limit), rows.count()
    if total > most:
        until = rows.agg(F.percentile_approx("sec", most / total)).first()[0]
        early = _settled(rows.where(F.col("sec") <= until), None, tuning, strict, limit)
        known = early.select("event_id", "seq", *GLOBAL, *_assumed()).dropDuplicates(["event_id", "seq"])
    return _settled(rows, known, tuning, strict, limit)


def _assumed() -> list[Column]:
    return [F.col(c).alias(a) for a, c in zip(ASSUMED, (FIRST, SECOND), strict=True)]


def _settled(rows: DataFrame, known: DataFrame | None, tuning: Tuning, strict: bool, limit: int | None) -> DataFrame:
    """The fold whose counts of all users are those of the transitions it recorded; ``known`` are counts to begin with."""
    start = rows if known is None else join_null_safe(rows, known, ["event_id", "seq"], "left")
    found = _folded(start, tuning, None, strict, limit)
    by_all = F.coalesce(*(markov_level("global", order, tuning) for order in (2, 1)), F.lit(False))
    by_user = F.coalesce(*(markov_level("user", order, tuning) for order in (2, 1)))
    while True:
        used = found.withColumn("_used", by_all).drop(*GLOBAL)
        counted = materialise(global_transitions(used, limit))
        other = counted.where(by_user.isNull() & (F.col("_used") != by_all)).select("user_id").distinct()
        other, counted = materialise(other), counted.drop("_used")
        if other.isEmpty():
            return counted
        theirs = join_null_safe(counted, other, ["user_id"], "left_semi")
        again = _folded(theirs.select(*HISTORY_COLUMNS, *GLOBAL, *_assumed()), tuning, None, strict, limit)
        found = join_null_safe(counted, other, ["user_id"], "left_anti").unionByName(again)


def strict_verdicts(
    events: DataFrame, tuning: Tuning = Tuning(), everyone: StoredTransitions | None = None, limit: int | None = None
) -> DataFrame:
    """One verdict per event, in the columns of ``stat_verdicts``; events that were left out have an error status."""
    return verdicts_of(folded_history(events, tuning, everyone, True, limit), tuning)


def verdicts_of(rows: DataFrame, tuning: Tuning = Tuning(), *keep: str) -> DataFrame:
    return verdict_rows(stage2(stage1(rows, tuning), tuning), *keep)


def corrected(
    verdicts: DataFrame,
    events: DataFrame,
    late: DataFrame,
    tuning: Tuning,
    everyone: StoredTransitions,
    strict: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """``verdicts`` with those of users who have ``late`` events folded again, from the first late event on.

    ``events`` are all stored events, the late ones among them. Only their users' events are read again, and a user without
    late events keeps its rows. Both sides are matched by hash of the user; the late events are the small side.
    """
    since = late.groupBy("user_id").agg(F.min(F.struct("sec", "seq")).alias("_since"))
    since = materialise(since)
    mine = join_null_safe(events.select(*HISTORY_COLUMNS), since.select("user_id"), ["user_id"], "left_semi")
    again = folded_history(mine, tuning, everyone, strict, limit)
    again = join_null_safe(again, since, ["user_id"], "inner").where(F.struct("sec", "seq") >= F.col("_since"))
    fresh = materialise(verdicts_of(again.drop("_since"), tuning))
    stay = join_null_safe(verdicts, fresh.select("event_id", "seq"), ["event_id", "seq"], "left_anti")
    return stay.unionByName(fresh)
