"""Intermediate tables that are read more than once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """df cut from its lineage by a checkpoint in the folder that spark.checkpoint.dir names; every executor can read it again.

    A folder of its own is set only where the setting is missing and the session is local, as in tests. A cluster session without
    the setting is an error: operators rely on the table being made once.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()
