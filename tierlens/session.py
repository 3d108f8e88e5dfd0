"""Session helpers: local sessions for tests/bench and the shared checkpoint dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tierlens", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster the caller builds its own session; nothing here hard-codes
    cluster paths.
    """
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete checkpoint files once their DataFrame is garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # skip per-call Python call-site capture (error context only)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS / object store) folder there and we use
    it as is. Only a local-mode session without one gets a folder of its own
    (tests); a cluster session without one is an error, because a
    machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
        d = tempfile.mkdtemp(prefix="tierlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise a stage as a Parquet table in the shared checkpoint dir
    and continue from a scan of it.

    Like a reliable checkpoint it survives executor loss and cuts the
    lineage; unlike an RDD checkpoint it is computed exactly once (no extra
    job to write), and later stages read it columnar, with column pruning,
    filter pushdown and size statistics for the planner.
    """
    spark = df.sparkSession
    path = stage_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written stage tables."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage table that no later step reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
