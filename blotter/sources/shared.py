"""Rows kept in the folder all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    A temporary folder is set only where the session names none and runs in local mode,
    as in tests: on a cluster, one machine's folder is no other's.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="blotter-checkpoint-"))
        current = context._jsc.sc().getCheckpointDir()
    return named or current.get()


def stored(df: DataFrame) -> DataFrame:
    """The rows of `df`, kept in the cluster's checkpoint folder.

    Later steps read the stored rows: nothing is computed twice, and a lost
    executor costs no more than the tasks it was running.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
