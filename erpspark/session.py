"""Session settings the plans rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets AQE split a hot key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is compressed: judge broadcast sizes by the decoded size, not the file size
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # key maps of a dimension are sent out up to this decoded size, so that the facts that look them up need not travel
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # rows that lie by a part of a join's keys stay where they are; the other side comes to them
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # a task sorts and joins many times what it reads
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # a job that has written or returned its rows leaves no shuffle files behind
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # short value lists reach Parquet as single values, so that Bloom filters can answer them
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "erpspark") -> SparkSession:
    """Single-JVM session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Clusters name it in ``spark.checkpoint.dir``; only where that is unset
    (tests, local runs) one local folder is made for the process, and removed when it ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="erpspark-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the work folder and read it back: it is evaluated once, and a lost executor costs no recomputation."""
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
