"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_BLOCK = "vigil.rowsPerBlock"
DEFAULT_ROWS_PER_BLOCK = 250_000  # a task of the cascade holds up to 4 KB of sorted rows per event


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "vigil") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if folder is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="vigil-")
    if current is None:
        context.setCheckpointDir(folder)
    return folder or current


_folders: dict[str, str] = {}


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def intermediate_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one; it goes when the application ends."""
    application = spark.sparkContext.applicationId
    if application not in _folders:
        _folders[application] = f"{shared_folder(spark)}/intermediate-{application}"
        atexit.register(_delete, spark, _folders[application])
    return _folders[application]


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from the written rows.

    The lineage ends there: a lost executor cannot bring back other rows, and readers take the columns they need.
    """
    path = f"{intermediate_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_per_block(spark: SparkSession, limit: int | None = None) -> int:
    return int(limit or spark.conf.get(ROWS_PER_BLOCK, str(DEFAULT_ROWS_PER_BLOCK)))
