"""Session settings for tests and the bench; a cluster brings its own session."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tonegauge")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small local files still give every core a split.
        .config("spark.sql.files.openCostInBytes", str(512 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch folder only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tonegauge-")
    return os.path.join(folder, "tonegauge") if "://" not in folder else f"{folder}/tonegauge"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go where the session says; only an unset folder is filled in."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
