"""Session, lineage and broadcast helpers shared by the operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and local runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("treatflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # polygon work is heavy per byte, so small shuffles keep their tasks
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting, as in tests; there a temporary folder is used, which goes when Python ends.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="treatflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    Computed once, survives the loss of executors, and the written size is known to the optimizer.
    The folder's owner removes old tables, as with checkpoints.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Size the optimizer gives the plan; file size for file sources."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only when the plan's size is known to be under ``limit``.

    Otherwise no hint: Spark then joins by shuffle, and adaptive execution splits skewed keys.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def small_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A lookup held in the program (rules, demo crosswalks), with a size Spark knows."""
    arrays = [pa.array([r[i] for r in rows]) for i in range(len(columns))]
    return spark.createDataFrame(pa.table(dict(zip(columns, arrays))))
