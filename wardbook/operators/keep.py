"""Work a frame out once when several sections are made from it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only where neither the session nor its context names one (a local run) is a
    temporary one made; a cluster without it gets an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_CONF, None)
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="wardbook-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def keep(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder.

    Its files outlive the executors that wrote them, so a lost executor costs a
    read and not the whole lineage.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def keep_table(df: DataFrame) -> DataFrame:
    """Like `keep`, as a Parquet table: smaller on disk, and later reads take only the columns they use."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
