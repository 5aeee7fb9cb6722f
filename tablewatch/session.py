"""Session helpers: a sensible local session for tests/bench and checkpoint-dir resolution."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tablewatch") -> SparkSession:
    """Local session for tests and the bench. Cluster jobs bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # per-call Python stack capture for error messages; off for batch jobs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Taken from the running context or ``spark.checkpoint.dir``. Only a local-mode session
    without one gets a private temporary folder; on a cluster the setting is required,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.split("[")[0] == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tablewatch-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) before running graph operators")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return it with a short plan."""
    try:
        checkpoint_dir(df.sparkSession)
    except AttributeError:  # Spark Connect: the server-side session owns the folder
        pass
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for tables written by operators."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tablewatch-tables/{name}-{uuid.uuid4().hex}"
