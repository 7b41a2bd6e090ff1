"""Record streams: topics of a broker, or folders of record files as their local twin.

A record is one JSON text in ``value``, optionally with a ``key``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vigil.operators.contracts import encode, keyed
from vigil.sources.logs import Log

EVENTS, STAT_OUT, ML_OUT = "events", "stat_out", "ml_out"


@dataclass(frozen=True)
class Broker:
    """Topics of a broker. Needs the connector jar of Spark on the class path."""

    servers: str
    group: str = "vigil"
    starting_offsets: str = "latest"
    options: dict[str, str] = field(default_factory=dict)
    partitions: int = 4096

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        """Records with ``seq``, which follows the offsets of a partition and is unique over all of them.

        A user's events share a partition, so ``seq`` is their order of arrival.
        """
        rows = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", topic)
            .option("kafka.group.id", f"{self.group}-{topic}")
            .option("startingOffsets", self.starting_offsets)
            .options(**self.options)
            .load()
        )
        fits = F.col("partition") < self.partitions
        seq = F.when(fits, F.col("offset") * self.partitions + F.col("partition")).otherwise(
            F.raise_error(F.lit("more partitions than the source was told")).cast("long")
        )
        return rows.select(F.col("key").cast("string"), F.col("value").cast("string"), seq.alias("seq"))

    def write(self, records: DataFrame, topic: str) -> DataStreamWriter:
        return (
            records.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("topic", topic)
            .options(**self.options)
        )


@dataclass(frozen=True)
class Folder:
    """Record files in ``<root>/<topic>``: parquet with ``value`` and, if known, ``key`` and ``seq``."""

    root: str
    files_per_batch: int = 1

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return (
            spark.readStream.schema("key STRING, value STRING, seq LONG")
            .option("maxFilesPerTrigger", self.files_per_batch)
            .parquet(f"{self.root}/{topic}")
        )

    def write(self, records: DataFrame, topic: str) -> DataStreamWriter:
        return records.writeStream.format("parquet").option("path", f"{self.root}/{topic}")


Topics = Broker | Folder | Log


def publish_events(records: DataFrame) -> DataFrame:
    """Valid event records keyed by user, the text unchanged: what goes onto the ``events`` topic."""
    return keyed(records)


def publish_verdicts(verdicts: DataFrame) -> DataFrame:
    """Verdicts as JSON records without a key."""
    return encode(verdicts)
