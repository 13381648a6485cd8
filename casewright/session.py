"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python call site of every column call doubles planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("casewright")
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.driver.memory", memory)
    # Small test tables cost CPU, not bytes: keep them on several cores.
    builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names for checkpoints.

    Only where ``spark.checkpoint.dir`` is unset, as on a single machine, a
    temporary folder takes its place and is kept for the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _local.setdefault(app, "") or tempfile.mkdtemp(prefix="casewright-")
        _local[app] = base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
