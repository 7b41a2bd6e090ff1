"""What the operators of this folder share: intermediate tables and the registry of their queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.session import intermediate_folder

Query = Callable[[SparkSession, str], DataFrame]


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows, compressed well.

    Whatever is lost afterwards, readers see these rows again; the application's folder goes when it ends.
    """
    path = f"{intermediate_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table of ``stored`` from which nothing is read any more: all that came of it is written, too."""
    files = df.inputFiles()
    if not files:
        return
    context = df.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


BATCH_BYTES = "8m"


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes, whatever the rows' length; unused memory goes back after each."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(bounded, schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")
