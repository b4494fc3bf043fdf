"""Session creation and cluster-wide helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a lookup side may have before we stop broadcasting it ourselves and let
# the planner pick a shuffle join instead.
BROADCAST_MAX_ROWS = 100_000

# How stored tables and the tables between a job's steps are compressed.
PACKED = {"compression": "zstd"}


def get_session(app: str = "snapweave", cores: int | str = "*",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the existing one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location is read from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir). Only when neither is set, as in a bare local test, a new
    local folder is made and registered as the checkpoint dir.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # no context handle (Spark Connect): conf only
            base = None
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # Only for bare local sessions; spark.checkpoint.dir itself cannot be
        # changed at runtime, so the folder is registered on the context.
        base = tempfile.mkdtemp(prefix="snapweave-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:
            pass
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    if "://" not in path and spark.conf.get("spark.master", "").startswith("local") and not path.startswith("file:"):
        os.makedirs(path, exist_ok=True)  # elsewhere a path without a scheme may be on the cluster's file system
    return path


def free_shuffles(spark: SparkSession) -> None:
    """From now on a query of the session that has ended drops its shuffle files at once.

    Otherwise they stay until the driver's garbage collection meets their handles, and a job of several
    writes holds the shuffles of all of them on disk. A frame that is run once more makes them anew.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def collocating(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` (its settings as they are now) whose joins leave sides that are laid out by
    some of the join's keys where they are."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job made for itself; without a JVM handle (Spark Connect) it stays."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:
        return
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after checking its row count.

    Over the bound the frame is returned as is, and the planner (with AQE's
    runtime statistics) chooses the join strategy.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a frame over at least the cluster's parallelism.

    A scan of large, split files already has thousands of partitions and is
    returned untouched. A small unsplittable input (one file, one row group)
    would otherwise run every row-wise step before the first shuffle in a
    single task; it gets a round-robin repartition instead.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (Spark Connect): leave it to the planner
        return df
    if have >= want:
        return df
    # Hash of the whole row: deterministic on retry like round-robin, but
    # without the local sort Spark adds before a round-robin repartition.
    return df.repartition(want, *[F.col(c) for c in df.columns])
