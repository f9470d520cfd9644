"""Session settings and the shared stage folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

# Runtime settings every job relies on; none of them fixes a partition count.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join whose hot key was split keeps its extra shuffle instead of one giant task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Bytes a task takes from a shuffle unless the session says otherwise. Hash tables and sorts hold up to twenty times
# these compressed bytes, so that Spark's own 64 MB can put more than a gigabyte into one task.
TASK_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    key, value = TASK_BYTES
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "martloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster passes its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        # plan building only: no Python stack capture for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def stage_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the cluster's `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own; on a cluster a missing
    setting is an error because a machine-local folder dies with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="martloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_STAGES: dict[str, list[str]] = {}  # paths handed out, by application


def stage_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_stages(spark: SparkSession) -> int:
    """Delete the stages this application has written so far; call it once a query's result is stored.

    Frames that still read a stage can't be computed afterwards.
    """
    paths = _STAGES.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate, which is exactly one row, to every row."""
    return df.join(broadcast(row))


def sized(df: DataFrame) -> DataFrame:
    """Write a summary first, so that its true size decides how it is joined.

    Joined by a scope key that most rows share, a big table would otherwise be shuffled into a few
    tasks before Spark learns at run time that the other side is small.
    """
    return materialise(df, "summary")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage with a written table: survives lost executors and is computed once.

    A frame that already reads a stage is returned as it is.
    """
    if getattr(df, "_martloom_stage", False):
        return df
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._martloom_stage = True
    return staged
