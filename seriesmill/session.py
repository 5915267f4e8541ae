"""Session set-up and staging of intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOOKUP_ROWS = 200_000
INITIAL_PARTITIONS = "8192"
#: With this on, Spark deletes the shuffle files of a query when it has ended, and not only when the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "seriesmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Partition counts are left to adaptive execution: it starts from
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` (or
    ``spark.sql.shuffle.partitions``) and merges small partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        # Adaptive execution merges partitions of a range or window shuffle but never splits them.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", INITIAL_PARTITIONS)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables, taken from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder of its own. On a cluster a machine-local folder would be lost with the
    machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="seriesmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stage(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where a plan is read by several passes or where a column depends on the
    physical layout (partition numbers): the written rows survive the loss of
    executors, and later passes still prune columns. The shuffle files behind them go
    with the end of the write: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, largest: int = LOOKUP_ROWS) -> DataFrame:
    """Prepare a derived table to be joined to many rows.

    It is computed once and counted. Up to ``largest`` rows it is marked for
    broadcast, so the many rows are not shuffled onto few keys; a longer one is
    joined by shuffle, where adaptive execution splits the partitions of hot keys.
    """
    kept = stage(df, "lookup")
    return F.broadcast(kept) if kept.count() <= largest else kept
