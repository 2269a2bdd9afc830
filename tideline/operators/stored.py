"""Frames computed once and kept where every executor can read them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. One of our own only where that is unset, in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tideline-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The frame computed now and read from the shared folder by all that follows, so that lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
