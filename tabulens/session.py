"""Session settings the operators are tuned for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "tabulens", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir. Only a local session may lack that setting; it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^,\]]*(,\d+)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/tabulens-{spark.sparkContext.applicationId}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder the cluster names."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
