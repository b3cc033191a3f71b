"""Session settings and the shared folder used for checkpoints and landed tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. All can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Merge session windows on the map side, so a hot key ships sessions, not rows.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Streaming state on disk instead of the heap, the same store on every master.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def build_session(app: str = "paddock", cores: str | int = "*", **conf) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter makes it."""
    cpus = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        # Checkpoint files go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    master, where driver and executors are one process, may fall back to a
    temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="paddock-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/paddock/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table or a stream's state."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_workspace(spark: SparkSession) -> bool:
    """Delete all that this application got from ``workspace``; for the end of a job, when its results are elsewhere."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of the workspace and continue from there; for loops with joins.

    A checkpointed frame keeps the estimate of its size, and estimates of joins
    are products, so after some rounds Spark would reckon with numbers of millions
    of digits. A table has the size it has, and small ones are broadcast for it.
    """
    path = workspace(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """Write ``df`` once for several readers, who then read the columns they need; Parquet has no untyped columns, which are checkpointed."""
    return checkpoint(df) if "void" in df.schema.simpleString() else written(df)
