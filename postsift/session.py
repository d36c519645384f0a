"""Session helpers.

The library never creates a session on its own; these helpers are for tests,
the bench and command-line use. On a cluster the session comes from the
launcher and ``spark.checkpoint.dir`` names a shared folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the engine's plans at any scale.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast decisions use measured sizes, not guesses.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "postsift") -> SparkSession:
    """A local session for tests and the bench (no UI, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("POSTSIFT_DRIVER_MEMORY", "8g"))
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for stored intermediate data: ``spark.checkpoint.dir``, shared by driver and executors.

    Only a local session (one machine: a test, the bench, a laptop) may go
    without it and then gets a scratch folder; any other session must name one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="postsift-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below ``spark.checkpoint.dir`` and read it back: it is evaluated once, and its lineage ends at the files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postsift-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, asked of the store that Spark reads."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def table_exists(spark: SparkSession, path: str, kind: str = "parquet") -> bool:
    """Whether a stored table (Parquet unless told) with files is there; any other failure is raised."""
    try:
        spark.read.format(kind).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
