"""Session helpers: defaults for local runs, reliable lineage cuts, reuse of a frame."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "veloflow", **conf: str) -> SparkSession:
    """Session for tests and benches; a cluster brings its own session and settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", os.environ.get("VELOFLOW_DRIVER_MEMORY", "12g"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config("spark." + key.replace("__", "."), value)
    return builder.getOrCreate()


def local_folder(spark: SparkSession, label: str) -> str:
    """A new folder on this machine, for a local master only: on a cluster executors would not see it."""
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=label)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a folder made for this session is set; only a local master may leave it unset.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = local_folder(df.sparkSession, "veloflow-ckpt-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that nothing else uses, in the folder of ``spark.checkpoint.dir``; where that is unset (local master), a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or local_folder(spark, "veloflow-")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reuse(df: DataFrame) -> DataFrame:
    """Keep a frame that several branches of one plan read; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
