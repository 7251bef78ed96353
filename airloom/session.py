"""Session settings every operator relies on, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bounds on what one task takes in, for sessions that name none. Rollups hold a row per
#: group in their hash tables, some ten to fifteen times the bytes that a task reads, so with the
#: stock 64 and 128 MB a task needs about 1 GB.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators assume. Idempotent, only SQL confs."""
    for key, value in TASK_BYTES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # split a hot sensor's join even when its grouping then needs another shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A folder of our own is used only in a local session (one machine, as in tests) that
    names none; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured or f"file://{tempfile.mkdtemp(prefix='airloom-')}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)
