"""Results that are read more than once, kept in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """Computed once; in ``spark.checkpoint.dir``, or on one machine without that setting in a folder of our own."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not given and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="caseloom-checkpoint-"))
    return df.checkpoint(eager=True)
