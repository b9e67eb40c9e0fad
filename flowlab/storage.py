"""Shared scratch space and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be unreadable for the other executors, so it is refused.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        if not context.getCheckpointDir():
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="flowlab-")
    context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that no other run uses."""
    return f"{scratch_root(spark).rstrip('/')}/flowlab-{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder: partition ids and row order stay fixed."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def small_copy(df: DataFrame) -> DataFrame:
    """The rows of a table whose size was checked, held by the driver.

    Plans that use the table several times then start from its rows instead of deriving them
    from the source again.
    """
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
