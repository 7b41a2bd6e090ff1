"""Tables in versions: readers keep the rows they began with, writers touch only the slots they change.

A table's rows lie in slots, days of a time column or hash buckets of a key; each write puts its rows as Parquet files into a
folder of its own. A version is a small file that names the folders of each slot, and comes into being by a rename that never
replaces another file. Whoever reads a version sees exactly its rows, whatever is written meanwhile; files go only by ``vacuum``,
when no kept version names them. Two writers at once: appends are added to the newer version, and a rewrite of slots that changed
since its snapshot fails with ``Conflict``.

Hash slots answer point lookups: the key's bucket is known before anything is read, files are sorted by ``order``, and columns
in ``bloom`` carry Parquet bloom filters, by which row groups without the value are skipped.

The version file has a line per slot and folder; ``compact`` keeps that small. The rename is atomic on file systems that have
atomic renames.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.operators.lookups import upsert_users_seen, users_seen
from vigil.session import materialise

SLOT = "_slot"
NULL_SLOT = "none"
Slots = dict[str, list[str]]


class Conflict(RuntimeError):
    """Another writer changed the same slots since the snapshot was taken."""


@dataclass(frozen=True)
class Snapshot:
    table: Versioned
    version: int
    slots: Slots

    def read(self, slots: Iterable[str] | None = None) -> DataFrame:
        """The rows of this version, or of some of its slots."""
        names = self.slots if slots is None else [s for s in slots if s in self.slots]
        paths = [f"{self.table.folder}/{p}" for s in names for p in self.slots[s]]
        spark = self.table.spark
        return spark.read.schema(self.table.schema).parquet(*paths) if paths else spark.createDataFrame([], self.table.schema)

    def lookup(self, value) -> DataFrame:
        """The rows of one key; only its bucket is read, and the filter reaches the scan."""
        key = self.table.key
        if key is None:
            raise ValueError("lookups need hash slots")
        return self.read([self.table.slot_of(value)]).where(F.col(key).eqNullSafe(value))


class Versioned:
    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: str | StructType,
        slot: Column,
        order: Sequence[str] = (),
        bloom: Sequence[str] = (),
        key: str | None = None,
        buckets: int = 0,
    ):
        self.spark, self.folder, self.slot = spark, folder.rstrip("/"), slot
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.order, self.bloom, self.key, self.buckets = tuple(order), tuple(bloom), key, buckets

    @staticmethod
    def by_day(spark: SparkSession, folder: str, schema: str | StructType, time_column: str, **layout) -> Versioned:
        day = F.coalesce(F.date_format(time_column, "yyyy-MM-dd"), F.lit(NULL_SLOT))
        return Versioned(spark, folder, schema, day, order=(time_column,), **layout)

    @staticmethod
    def by_hash(spark: SparkSession, folder: str, schema: str | StructType, key: str, buckets: int, order: Sequence[str] = (), **layout) -> Versioned:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")
        return Versioned(spark, folder, schema, bucket, order=(key, *order), key=key, buckets=buckets, **layout)

    def slot_of(self, value) -> str:
        kind = self.schema[self.key].dataType.simpleString()
        return str(self.spark.sql(f"SELECT pmod(xxhash64(CAST(:v AS {kind})), {self.buckets})", args={"v": value}).first()[0])

    # --- files ----------------------------------------------------------------------------------------------------

    def _files(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        target, files = self._files(path)
        return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []

    def _read_text(self, path: str) -> str:
        target, files = self._files(path)
        stream = files.open(target)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def _publish(self, version: int, slots: Slots) -> bool:
        """Make ``slots`` the given version; False when that version is there already."""
        draft, files = self._files(f"{self.folder}/versions/.{uuid.uuid4().hex}")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(slots).encode()))
        stream.close()
        jvm = self.spark.sparkContext._jvm
        target, _ = self._files(f"{self.folder}/versions/{version:012d}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(target), options)
            return True
        except Exception:
            files.delete(draft, False)
            if not files.exists(target):
                raise
            return False

    def _write(self, rows: DataFrame) -> Slots:
        """Put rows into a new folder, one directory per slot; a large slot is split over several files."""
        name = f"segments/{uuid.uuid4().hex}"
        laid = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(SLOT, self.slot)
        laid = laid.hint("rebalance", SLOT).sortWithinPartitions(SLOT, *self.order)
        writer = laid.write.partitionBy(SLOT)
        for column in self.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(f"{self.folder}/{name}")
        found = [n for n in self._names(f"{self.folder}/{name}") if n.startswith(f"{SLOT}=")]
        return {n.removeprefix(f"{SLOT}="): [f"{name}/{n}"] for n in found}

    # --- versions -------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n) for n in self._names(f"{self.folder}/versions") if n.isdigit()]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or an older one that is still kept. A new table is version 0 without rows."""
        if version is None:
            version = max(self.versions(), default=0)
        return Snapshot(self, version, json.loads(self._read_text(f"{self.folder}/versions/{version:012d}")) if version else {})

    def read(self) -> DataFrame:
        return self.snapshot().read()

    def _commit(self, change: Callable[[Slots], Slots]) -> Snapshot:
        """Apply ``change`` to the newest version, again if another writer comes first."""
        while True:
            now = self.snapshot()
            slots = change({s: list(p) for s, p in now.slots.items()})
            if self._publish(now.version + 1, slots):
                return Snapshot(self, now.version + 1, slots)

    def append(self, rows: DataFrame) -> Snapshot:
        fresh = self._write(rows)
        return self._commit(lambda slots: slots | {s: slots.get(s, []) + p for s, p in fresh.items()})

    def replace(self, seen: Snapshot, slots: Iterable[str], rows: DataFrame | None) -> Snapshot:
        """Put ``rows`` in the place of all rows of ``slots`` in the snapshot ``seen``; without rows the slots go."""
        gone = set(slots)
        fresh = self._write(rows) if rows is not None else {}
        if fresh.keys() - gone:
            raise ValueError("rows of other slots than those replaced")

        def change(now: Slots) -> Slots:
            if any(now.get(s) != seen.slots.get(s) for s in gone):
                raise Conflict(f"slots changed since version {seen.version}")
            return {s: p for s, p in now.items() if s not in gone} | fresh

        return self._commit(change)

    def compact(self, most: int = 8) -> Snapshot:
        """Write slots of more than ``most`` folders anew as one."""
        seen = self.snapshot()
        many = [s for s, paths in seen.slots.items() if len(paths) > most]
        return self.replace(seen, many, seen.read(many)) if many else seen

    def vacuum(self, keep: int = 2) -> int:
        """Forget all but the last ``keep`` versions and delete the folders only they named; gives the number of folders.

        Folders of a write that is under way are named by no version yet, so no writer may be active.
        """
        old, kept = self.versions()[:-keep], self.versions()[-keep:]
        named = {p for v in kept for paths in self.snapshot(v).slots.values() for p in paths}
        for version in old:
            target, files = self._files(f"{self.folder}/versions/{version:012d}")
            files.delete(target, False)
        deleted = 0
        for segment in self._names(f"{self.folder}/segments"):
            for slot in [n for n in self._names(f"{self.folder}/segments/{segment}") if n.startswith(f"{SLOT}=")]:
                if f"segments/{segment}/{slot}" not in named:
                    target, files = self._files(f"{self.folder}/segments/{segment}/{slot}")
                    files.delete(target, True)
                    deleted += 1
        return deleted


def retain(table: Versioned, time_column: str, as_of: datetime, days: int = 7) -> Snapshot:
    """A version without the rows older than ``days`` at ``as_of``: older days are no longer named, and only the day of the cut-off
    is written anew. Whoever reads meanwhile sees the old rows or the new ones."""
    seen = table.snapshot()
    cutoff = as_of - timedelta(days=days)
    edge = cutoff.strftime("%Y-%m-%d")
    gone = [s for s in seen.slots if s != NULL_SLOT and s <= edge]
    if not gone:
        return seen
    stay = seen.read([edge]).where(F.col(time_column) >= F.lit(cutoff).cast("timestamp_ntz")) if edge in seen.slots else None
    return table.replace(seen, gone, stay)


SEEN = "id LONG, created_at TIMESTAMP_NTZ, last_seen TIMESTAMP_NTZ"


def merge_seen(table: Versioned, events: DataFrame) -> Snapshot:
    """Users of ``events`` added or put forward; only the buckets they fall into are read and written."""
    fresh = materialise(users_seen(events))
    touched = [r[0] for r in fresh.select(table.slot.alias("s")).distinct().collect()]  # at most the number of buckets
    seen = table.snapshot()
    stored = fresh.withColumnRenamed("created_at", "ts").select(F.col("id").alias("user_id"), "ts")
    both = stored.unionByName(fresh.select(F.col("id").alias("user_id"), F.col("last_seen").alias("ts")))
    return table.replace(seen, touched, upsert_users_seen(seen.read(touched), both))
