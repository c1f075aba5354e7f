"""Session helpers: one place for Spark settings and for the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("issueloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session that has none gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="issueloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def files(spark: SparkSession, path: str):
    """(file system, path) as Spark's own writers see a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends there, survives lost executors, and later
    stages see the true size of the table and read only the columns they need."""
    spark = df.sparkSession
    path = fresh_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Owner of tables that cut lineage: each is dropped when nothing that is still to run reads it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def cut(self, df: DataFrame) -> DataFrame:
        """Like `cut`; the table belongs to this owner."""
        path = fresh_path(self.spark, "cut")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        """The table outlives its owner."""
        self.paths.pop(id(df), None)
        return df

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables whose readers have all been written; what is not owned here stays."""
        for df in tables:
            _, path = self.paths.pop(id(df), (None, None))
            if path is not None:
                fs, at = files(self.spark, path)
                fs.delete(at, True)

    def close(self) -> None:
        self.drop(*[df for df, _ in list(self.paths.values())])


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan of few splits over all cores before heavy per-row work; a scan of many splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
