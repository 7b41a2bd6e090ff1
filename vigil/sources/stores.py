"""Result tables: what is stored, how it is appended, how old rows go."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.lookups import upsert_users_seen, within_retention
from vigil.session import materialise

# --- rows as they are stored ------------------------------------------------------------------------------------


def raw_event_rows(events: DataFrame) -> DataFrame:
    """``metadata`` and ``additional`` go to their own columns; ``created_at`` is the event time."""
    identity = F.to_json(F.struct("ip", "user_agent", "country"))
    return events.select(
        F.col("event_id").alias("id"),
        "user_id",
        "event_type",
        F.col("ts").alias("timestamp"),
        "ip",
        "user_agent",
        "country",
        identity.alias("metadata"),
        "additional",
        F.col("ts").alias("created_at"),
        "session_id",
    )


def stat_result_rows(stat: DataFrame) -> DataFrame:
    return stat.select(
        F.col("event_id").alias("id"),
        "user_id",
        "session_id",
        "event_type",
        "anomaly",
        "anomaly_type",
        "message",
        "timestamp",
        F.lit("stat").alias("source"),
        F.col("timestamp").alias("created_at"),
    )


def ml_result_rows(ml: DataFrame) -> DataFrame:
    return ml.select(
        F.col("seq").alias("id"),
        "user_id",
        "session_id",
        "timestamp",
        "anomaly",
        "score",
        "threshold",
        "event_count",
        "unique_events",
        F.lit("ml").alias("source"),
        F.col("timestamp").alias("created_at"),
    )


def aggregated_rows(fused: DataFrame) -> DataFrame:
    return fused.select(
        F.col("seq").alias("id"),
        "session_id",
        "user_id",
        "ml_anomaly",
        "ml_score",
        "ml_threshold",
        "stat_anomaly",
        "anomaly_type",
        "event_count",
        "unique_events",
        "created_at",
    )


def training_events(raw: DataFrame) -> DataFrame:
    """The eight columns training reads, and the hour of day."""
    return raw.select(
        "id", "user_id", "event_type", "timestamp", "ip", "user_agent", "country", "session_id"
    ).withColumn("hour", F.hour("timestamp"))


# --- tables in a folder -----------------------------------------------------------------------------------------


class Store:
    """Parquet tables in one folder, each partitioned by the day of its time column."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def append(self, rows: DataFrame, table: str, time_column: str) -> None:
        """One directory per day, in files of even size.

        Rows are brought together by day; a day too large for one writer is split and small days share one.
        """
        dated = rows.withColumn("day", F.to_date(time_column))
        dated.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(self.path(table))

    def write_batch(self, rows: DataFrame, table: str, batch_id: int, by: Sequence[str] = ()) -> None:
        """Write one micro-batch as one partition. A repeated batch replaces itself.

        ``by`` names key columns whose rows go into one file together.
        """
        rows = rows.repartition(*by) if by else rows
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(self.path(table))
        )
        if not self.has_batch(table, batch_id):
            # Nothing to write leaves no partition: mark the batch with an empty file.
            rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path(table)}/batch_id={batch_id}")

    def _hadoop_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def has_batch(self, table: str, batch_id: int) -> bool:
        path, files = self._hadoop_path(f"{self.path(table)}/batch_id={batch_id}")
        return files.exists(path)

    def batch(self, table: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(table)}/batch_id={batch_id}")

    def stream(self, table: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
        """The table as a stream, oldest micro-batches first.

        The files of one micro-batch may be read in several steps: order within a key holds if the batch was written with
        ``by``, which keeps all its rows of a key in one file.
        """
        return (
            self.spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{self.path(table)}/batch_id=*")
        )

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def exists(self, table: str) -> bool:
        path, files = self._hadoop_path(self.path(table))
        return files.exists(path)

    def sink(self, table: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df):
        """A ``foreachBatch`` function that stores each micro-batch once.

        A batch that comes again after a failure runs again in full, since its keyed state has to be committed; what it
        writes replaces what was there.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            self.write_batch(shape(batch), table, batch_id)

        return write

    def retain(self, table: str, as_of: datetime, days: int = 7) -> DataFrame:
        """Drop what is older than ``days`` at ``as_of``: whole days by their folders, and only the day of the cut-off is
        written anew. The day's rows are stored aside first, so a run that is cut off can be repeated."""
        cutoff_day = (as_of - timedelta(days=days)).date()
        boundary = self.read(table).where(F.col("day") == F.lit(cutoff_day))
        kept = within_retention(boundary.withColumnRenamed("timestamp", "ts"), as_of, days).withColumnRenamed("ts", "timestamp")
        kept = materialise(kept)
        if kept.isEmpty():
            self._drop_day(table, str(cutoff_day))
        else:
            (
                kept.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day")
                .parquet(self.path(table))
            )
        for day in self.days(table):
            if day < str(cutoff_day):
                self._drop_day(table, day)
        return self.read(table)

    def days(self, table: str) -> list[str]:
        """The days a table has a folder of; at most one per day of its history."""
        path, files = self._hadoop_path(self.path(table))
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(n.removeprefix("day=") for n in names if n.startswith("day="))

    def _drop_day(self, table: str, day: str) -> None:
        path, files = self._hadoop_path(f"{self.path(table)}/day={day}")
        files.delete(path, True)

    def save_users(self, profiles: DataFrame, table: str = "users") -> None:
        profiles.select("id", "username", "country", "ip", "user_agent").write.mode("append").parquet(
            self.path(table)
        )

    def upsert_seen(self, current: str | None, target: str, events: DataFrame) -> DataFrame:
        """Users seen so far merged with new events, written as a new version of the table."""
        stored = (
            self.read(current)
            if current
            else self.spark.createDataFrame([], "id LONG, created_at TIMESTAMP_NTZ, last_seen TIMESTAMP_NTZ")
        )
        upsert_users_seen(stored, events).write.mode("overwrite").parquet(self.path(target))
        return self.read(target)


def read_jdbc(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A database table read in parallel ranges of ``id``. Needs the driver jar of that database."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn="id",
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


def write_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
