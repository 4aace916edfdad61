"""Session defaults and the shared-folder helper that lineage cuts rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings use `__` for a dot."""
    builder = SparkSession.builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's `spark.checkpoint.dir`; set a local folder only where none is named.

    A master other than local[*] without that setting is an error: a machine-local folder would
    not survive the loss of an executor.
    """
    context = spark.sparkContext
    # files of checkpoints that nothing refers to any more go, unless the cluster says otherwise
    context._jsc.sc().conf().setIfMissing("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = context.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = os.path.join(tempfile.gettempdir(), "kaghamar-checkpoints")
    context.setCheckpointDir(shared)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once, so that several readers don't compute it again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession) -> str:
    """The name of a new folder in the shared one; it goes when the session ends."""
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    path = f"{context._jsc.sc().getCheckpointDir().get()}/scratch-{uuid.uuid4().hex}"
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame) -> DataFrame:
    """`df` as a compressed table in the shared folder, read back; for wide rows, of which readers take some columns.

    The table goes when the session ends.
    """
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """`df` marked for broadcast if it has at most `rows` rows, else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """The scan, dealt out over the cores if its files make fewer tasks than there are; large scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
