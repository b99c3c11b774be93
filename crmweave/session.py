"""Session settings the library relies on, and checkpointing."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings: re-planning, skew splitting also where a later operator would
# otherwise forbid it, and a fixed zone so that timestamp arithmetic repeats.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Apply the settings, and the number of shuffle partitions where one is given.

    Adaptive execution merges small shuffle partitions but does not split all of
    them, so it must start from enough; the caller knows the cluster and the data.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if partitions is not None:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one ``spark.checkpoint.dir`` names.

    Where it is unset, a local session gets a temporary folder; on a cluster each
    executor would write to its own disk, so there it is an error.
    """
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="crmweave-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
