"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("answerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables, shared by all executors.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder; a cluster without it is an error,
    because a folder of one machine would be invisible to the others.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="answerloom-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared work folder once and read it from there.

    Everything later starts from the files, also after losing an executor.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per context.

    A worker started in another folder than the driver's cannot import it otherwise.
    """
    context = spark.sparkContext
    if getattr(context, "_answerloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="answerloom-package-")
    archive = Path(folder, "answerloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in root.rglob("*.py"):
            out.write(file, Path(root.name, file.relative_to(root)))
    context.addPyFile(str(archive))
    context._answerloom_shipped = True
