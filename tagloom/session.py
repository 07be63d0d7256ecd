"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Relied on by the joins and writes: run-time broadcast checks, splitting of skewed
# partitions, and file sizes set from the data.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder. A cluster without one is an
    error: a folder on one machine would be lost with that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; no two calls return the same one."""
    return f"{shared_root(spark)}/tagloom/{label}-{uuid.uuid4().hex}"


def deal(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt out evenly, by default to as many partitions as there are cores or shuffle partitions, whichever are more.

    A scan has no more tasks with rows than its files have row groups, so without this heavy work per row may
    run on a single core, whatever the number of splits is.
    """
    spark = df.sparkSession
    return df.repartition(partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
