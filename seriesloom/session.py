"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seriesloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="seriesloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/seriesloom/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch path that is no longer read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages read files instead of recomputing ``df``."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
