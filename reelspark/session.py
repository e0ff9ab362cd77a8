"""Session defaults and the place where cut lineage is stored."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benches on one machine. A cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir; fall back to a temp folder in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="reelspark-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise once in the checkpoint folder: later readers share the result, and a lost executor
    costs a re-read instead of a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
