"""Rows that stay what they are, however often they are read and whichever executor is lost."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """The same rows, in the same partitions and order, from a reliable checkpoint in the folder that the cluster shares
    (spark.checkpoint.dir); a local one only where it names none and all of the session runs on this machine."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="lakeforge-"))
    return df.checkpoint(eager=True)
