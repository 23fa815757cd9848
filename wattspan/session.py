"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wattspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE (coalescing and skew joins) and dynamic partition overwrite."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may go without the setting (tests on one machine): it takes a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="wattspan-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), "wattspan", f"{label}-{uuid.uuid4().hex}")


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Write the frame to the shared folder and read it back: lineage ends at durable files.

    The shuffle files behind the write are dropped as soon as it is done. `settings` hold during the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    settings = {_CLEAN: "true", **(settings or {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that `materialise` wrote; nothing may read it afterwards."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def delete_path(spark: SparkSession, folder: str) -> None:
    """Delete a folder of any file system that Spark knows; one that isn't there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def task_count(spark: SparkSession) -> int:
    """Partition count for Python stages, where the work per byte is high.

    An explicit count keeps AQE from merging small but compute-heavy partitions into one task.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
