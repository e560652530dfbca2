"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "veleta") -> SparkSession:
    """Session for one machine. On a cluster, use the session the cluster gives you."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Call-site capture costs milliseconds per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a scratch folder on a local master.

    A cluster session without that setting is refused, since a driver-local folder would
    not survive the loss of an executor.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="veleta-"))
    return context.getCheckpointDir()


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stabilise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Materialise a costly frame that several later jobs read.

    The rows go to a parquet folder below the shared folder, so they survive lost executors,
    and later readers take only the columns they need.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever it lies on the driver.

    Does nothing when the package came as an archive, as with --py-files, or was shipped before.
    """
    package = Path(__file__).resolve().parent
    context = spark.sparkContext
    archive = f"{package.name}.zip"
    if not package.is_dir() or any(f.endswith(f"/{archive}") for f in context.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="veleta-package-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
