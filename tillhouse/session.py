"""Session settings the jobs are written for, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where a later operator then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}

# Input bytes per shuffle partition, and the most that a task reads of a file or, where there is no hot key, of a shuffle.
PARTITION_BYTES = 4 << 20
TASK_BYTES = 16 << 20


def build_session(app: str = "tillhouse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above. Without ``master`` the submit command decides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
            builder = builder.config("spark.driver.host", "127.0.0.1")
            builder = builder.config("spark.driver.bindAddress", "127.0.0.1")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_skew_splits(spark: SparkSession) -> SparkSession:
    """For a session that was built elsewhere: let adaptive execution split a skewed join also where the
    next operator groups by the same key."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def fit_partitions(spark: SparkSession, size: int) -> SparkSession:
    """For a session that was built elsewhere and input of ``size`` bytes: shuffles start with one partition per ``PARTITION_BYTES`` of it, at least the
    session's own number, and adaptive execution joins them up to ``TASK_BYTES``, also what a task reads of files at most. So a larger
    input gives more tasks and not larger ones, whatever number the session has fixed."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    return spark


def partitions(spark: SparkSession) -> int:
    """The number of partitions that shuffles start with, for steps that need a fixed number."""
    own = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(own), int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or own))


@contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """For steps that join stored tables: a file of narrow, repeated columns holds twenty times its bytes as rows, and the driver makes a broadcast of
    the rows. So only files up to 1 MB are broadcast by their size; what a run shows to be at most 10 MB of rows still is."""
    names = {"spark.sql.autoBroadcastJoinThreshold": str(1 << 20), "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 << 20)}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; only a local session may fall back to its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillhouse-checkpoint-"))
    return context.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each step that runs inside deletes its shuffle files when it has ended. Else they stay until the driver happens to collect its garbage, so a
    job of many steps would hold the shuffles of all of them. For steps that run once: a frame that runs again computes its shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def settle(df: DataFrame, packed: bool = False) -> DataFrame:
    """Write ``df`` once below the checkpoint folder and read it back: its consumers get the same rows, only
    the columns they need, and joins know its size. Survives the loss of any executor. The shuffles that made it are deleted. ``packed`` files take less
    space and so are dealt to tasks otherwise: not for rows of which an approximate percentile is taken, which depends on that."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/settled-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        (df.write.option("compression", "zstd") if packed else df.write).parquet(folder)
    settled = df.sparkSession.read.schema(df.schema).parquet(folder)
    settled.settled_in = folder
    return settled


def let_go(*settled: DataFrame) -> None:
    """Delete what ``settle`` wrote for these frames, when nothing reads them, or what was made of them, any more."""
    for df in settled:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.settled_in)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def observed(seen: Observation) -> dict:
    """The metrics of an observed write. None where the optimiser found that there are no rows and left the observation out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def settle_counted(df: DataFrame, *metrics: Column, packed: bool = False) -> tuple[DataFrame, dict]:
    """``settle`` that computes named aggregates of the rows while it writes them, so that they need not be read again for it."""
    seen = Observation()
    settled = settle(df.observe(seen, *metrics), packed)
    return settled, observed(seen)
