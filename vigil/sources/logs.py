"""Record logs: topics of numbered records in partitions, as files, with offsets of their own.

A topic is a folder of partitions; a partition holds Parquet segments named by their first offset and their number of
records, so offsets are known from the names alone. Records of one key share a partition and keep their order; the others are dealt
by their number. Segments are never changed. One query may read several topics; its offsets, per topic and partition, are stored
with the checkpoint, so it goes on behind the last record it finished, and a query without a checkpoint begins at the first
record (``earliest``) or behind the last (``latest``). One publisher per topic at a time.

Register with ``spark.dataSource.register(LogSource)``; format ``record_log`` with the options ``path``, ``topics`` (comma-separated)
and ``startingOffsets``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

MOST_PARTITIONS = 4096
SCHEMA = "topic string, part int, pos bigint, key string, value string"
_ARROW = pa.schema([("topic", pa.string()), ("part", pa.int32()), ("pos", pa.int64()), ("key", pa.string()), ("value", pa.string())])
Offsets = dict[str, dict[str, int]]


@dataclass
class Span(InputPartition):
    """Records ``begin`` to ``end`` (not included) of a segment that starts at ``first``."""

    path: str
    topic: str
    part: int
    first: int
    begin: int
    end: int


def segments(fs: pafs.FileSystem, root: str, topic: str) -> list[Span]:
    """All segments of a topic, by partition and offset; files under other names are not there yet."""
    if fs.get_file_info(f"{root}/{topic}").type != pafs.FileType.Directory:
        return []
    out = []
    for info in fs.get_file_info(pafs.FileSelector(f"{root}/{topic}", recursive=True)):
        stem, dot, kind = info.base_name.rpartition(".")
        folder = info.path.rsplit("/", 2)[-2]
        if kind == "parquet" and folder.startswith("part=") and stem.replace("-", "").isdigit():
            first, n = map(int, stem.split("-"))
            out.append(Span(info.path, topic, int(folder.removeprefix("part=")), first, first, first + n))
    return sorted(out, key=lambda s: (s.part, s.first))


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.topics = options["path"], [t.strip() for t in options["topics"].split(",")]
        self.start = options.get("startingoffsets", options.get("startingOffsets", "latest"))
        if self.start not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets must be earliest or latest: {self.start}")

    def _segments(self) -> list[Span]:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        return [s for topic in self.topics for s in segments(fs, root, topic)]

    def initialOffset(self) -> Offsets:
        return {t: {} for t in self.topics} if self.start == "earliest" else self.latestOffset()

    def latestOffset(self) -> Offsets:
        ends: Offsets = {t: {} for t in self.topics}
        for s in self._segments():
            ends[s.topic][str(s.part)] = max(s.end, ends[s.topic].get(str(s.part), 0))
        return ends

    def partitions(self, start: Offsets, end: Offsets) -> list[Span]:
        out = []
        for s in self._segments():
            begin = max(s.first, start.get(s.topic, {}).get(str(s.part), 0))
            stop = min(s.end, end.get(s.topic, {}).get(str(s.part), 0))
            if begin < stop:
                out.append(Span(s.path, s.topic, s.part, s.first, begin, stop))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        at = partition.first
        with fs.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=10_000, columns=["key", "value"]):
                low, high = max(partition.begin - at, 0), min(partition.end - at, batch.num_rows)
                if low < high:
                    n, part = high - low, batch.slice(low, high - low)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([partition.topic] * n, pa.string()),
                            pa.array([partition.part] * n, pa.int32()),
                            pa.array(range(at + low, at + high), pa.int64()),
                            part.column("key").cast(pa.string()),
                            part.column("value").cast(pa.string()),
                        ],
                        schema=_ARROW,
                    )
                at += batch.num_rows

    def commit(self, end: Offsets) -> None:
        """Offsets are kept by the checkpoint; segments stay for other readers."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


@dataclass(frozen=True)
class Log:
    """Topics in ``root``, an URI or a path."""

    root: str
    starting_offsets: str = "latest"
    partitions: int = 8

    def read_topics(self, spark: SparkSession, *topics: str) -> DataFrame:
        """One stream over several topics: topic, partition, position, key, value and ``seq``.

        ``seq`` follows the positions of a partition and is unique over all partitions of a topic, whatever their number.
        """
        spark.dataSource.register(LogSource)
        options = {"topics": ",".join(topics), "startingOffsets": self.starting_offsets}
        rows = spark.readStream.format("record_log").options(**options).load(self.root)
        return rows.withColumn("seq", F.col("pos") * MOST_PARTITIONS + F.col("part"))

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return self.read_topics(spark, topic).select("key", "value", "seq")

    def publish(self, records: DataFrame, topic: str, order: str | None = None) -> int:
        """Append records (``value``, optionally ``key``) in the order of ``order``; gives their number.

        Each partition's records become one segment; segments appear under their final names when all are written.
        """
        if not 0 < self.partitions <= MOST_PARTITIONS:
            raise ValueError(f"1 to {MOST_PARTITIONS} partitions")
        spark = records.sparkSession
        fs, root = pafs.FileSystem.from_uri(self.root)
        ends: dict[int, int] = {}
        for s in segments(fs, root, topic):
            ends[s.part] = max(s.end, ends.get(s.part, 0))
        keys = F.col("key").cast("string") if "key" in records.columns else F.lit(None).cast("string")
        place = F.col(order) if order else F.lit(0)
        rows = records.select(keys.alias("key"), F.col("value").cast("string").alias("value"), place.alias("_order"))
        part = F.pmod(F.coalesce(F.crc32("key"), F.xxhash64("value")), F.lit(self.partitions)).cast("int")
        staging = f"{self.root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
        laid = rows.withColumn("part", part).repartition("part").sortWithinPartitions("part", "_order")
        laid.drop("_order").write.option("maxRecordsPerFile", 0).partitionBy("part").parquet(staging)
        written, moves = spark.read.parquet(staging), []
        counts = {r["part"]: r["n"] for r in written.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per partition
        local = pafs.FileSystem.from_uri(staging)[1]
        for info in fs.get_file_info(pafs.FileSelector(local, recursive=True)):
            if info.base_name.endswith(".parquet") and info.base_name.startswith("part-"):
                p = int(info.path.rsplit("/", 2)[-2].removeprefix("part="))
                moves.append((info.path, p))
        if len(moves) != len(counts):
            raise RuntimeError("a partition was written in several files")
        for path, p in moves:
            first = ends.get(p, 0)
            fs.create_dir(f"{root}/{topic}/part={p}", recursive=True)
            fs.move(path, f"{root}/{topic}/part={p}/{first:020d}-{counts[p]}.parquet")
        fs.delete_dir(local)
        return sum(counts.values())

    def write(self, records: DataFrame, topic: str) -> DataStreamWriter:
        """A stream onto a topic. A micro-batch that comes again is published again: delivery is at least once."""
        return records.writeStream.foreachBatch(lambda batch, _: self.publish(batch, topic, "seq" if "seq" in batch.columns else None))


def consume(log: Log, spark: SparkSession, handlers: dict, checkpoint: str, **trigger) -> StreamingQuery:
    """One query over all topics of ``handlers``; each handler gets the records of its topic of a micro-batch, and its number."""
    stream = log.read_topics(spark, *handlers)

    def deal(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for topic, handle in handlers.items():
                handle(batch.where(F.col("topic") == topic).drop("topic"), batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
