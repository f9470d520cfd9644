"""Layered tables: naming, reading, idempotent writing, slices, backups, exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ["raw", "staged", "transformed", "standardized", "processed", "cleansed", "app"]


@dataclass(frozen=True)
class TableRef:
    """A table of one layer under a root folder."""

    root: str
    layer: str
    entity: str

    @property
    def path(self) -> str:
        return f"{self.root}/{self.layer}/{self.entity}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, ref: TableRef) -> bool:
    fs, p = _fs(spark, ref.path)
    return fs.exists(p)


def read_first(spark: SparkSession, refs: list[TableRef]) -> DataFrame:
    """The first existing of several candidate tables."""
    for ref in refs:
        if exists(spark, ref):
            return spark.read.parquet(ref.path)
    raise FileNotFoundError(f"none of {[r.path for r in refs]} exists")


def read_since(df: DataFrame, col: str, date: str) -> DataFrame:
    """Source rows from a day on; the predicate reaches a parquet or JDBC scan."""
    kind = dict(df.dtypes)[col]
    return df.filter(F.col(col) >= F.lit(date).cast("string" if kind == "string" else kind))


def write_table(df: DataFrame, ref: TableRef, partition_by: list[str] | None = None) -> int:
    """Overwrite and check the row count read back against the rows written."""
    seen = Observation("written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(ref.path)
    rows = seen.get["rows"]
    back = df.sparkSession.read.schema(df.schema).parquet(ref.path).count()
    if back != rows:
        raise RuntimeError(f"{ref.path}: wrote {rows} rows, read {back}")
    return rows


def append_audit(df: DataFrame, ref: TableRef) -> None:
    df.write.mode("append").parquet(ref.path)


def balanced(df: DataFrame, *by: str) -> DataFrame:
    """Rows of one folder together, in tasks near the advisory partition size.

    Adaptive execution splits a folder that is too large for one task and joins small ones, so the number
    of files follows the bytes written and not tasks x folders.
    """
    return df.hint("rebalance", *by)


def write_platform_slice(df: DataFrame, ref: TableRef, by: str = "platform_id") -> None:
    """Replace only the platforms present in `df`; the others' partitions stay."""
    balanced(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(ref.path)


def write_by_line(df: DataFrame, ref: TableRef) -> None:
    """One partition folder per product line; a large line's rows are spread over tasks, small lines share one."""
    balanced(df, "product_line_id").write.mode("overwrite").partitionBy("product_line_id").parquet(ref.path)


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def backup_then_overwrite(df: DataFrame, ref: TableRef) -> TableRef:
    """Keep the current state as the one rolling backup, then overwrite."""
    spark = df.sparkSession
    backup = TableRef(ref.root, ref.layer, f"{ref.entity}_backup_rolling")
    if exists(spark, ref):
        spark.read.parquet(ref.path).write.mode("overwrite").parquet(backup.path)
    df.write.mode("overwrite").parquet(ref.path)
    return backup


def purge_dated_backups(spark: SparkSession, root: str, layer: str, entity: str) -> list[str]:
    """Remove legacy backups named `{entity}_backup_<digits>`; returns their names."""
    fs, p = _fs(spark, f"{root}/{layer}")
    gone = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        stem = f"{entity}_backup_"
        if name.startswith(stem) and name[len(stem) :].replace("_", "").isdigit():
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def export_layers_csv(spark: SparkSession, root: str, out: str) -> list[str]:
    """Every table of every layer as CSV in one folder per layer."""
    done = []
    for layer in LAYERS:
        fs, p = _fs(spark, f"{root}/{layer}")
        if not fs.exists(p):
            continue
        for status in fs.listStatus(p):
            entity = status.getPath().getName()
            spark.read.parquet(f"{root}/{layer}/{entity}").write.mode("overwrite").option("header", True).csv(f"{out}/{layer}/{entity}")
            done.append(f"{layer}/{entity}")
    return sorted(done)


def write_report(df: DataFrame, folder: str, run_day: str, keep_days: int) -> None:
    """Report partition of this run, a `latest` copy, and removal of runs older than `keep_days`."""
    spark = df.sparkSession
    df.withColumn("run_day", F.lit(run_day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_day").parquet(f"{folder}/runs")
    spark.read.parquet(f"{folder}/runs").filter(F.col("run_day") == run_day).drop("run_day").write.mode("overwrite").parquet(f"{folder}/latest")
    oldest = spark.range(1).select(F.date_sub(F.lit(run_day).cast("date"), keep_days).cast("string")).first()[0]
    fs, p = _fs(spark, f"{folder}/runs")
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("run_day=") and name.split("=", 1)[1] < oldest:
            fs.delete(status.getPath(), True)
