"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read by Spark alone so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. On one machine without that setting a folder of our own; on a cluster such a folder would be the driver's alone."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not given and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="caseloom-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the shared folder.

    For iterations: a checkpoint hands the optimizer's constraints on to the next
    round, where they multiply; a table starts without any.
    """
    spark = df.sparkSession
    path = f"{shared(spark)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    table_ = spark.read.schema(df.schema).parquet(path)
    table_._written = path
    return table_


def removed(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no other DataFrame in use reads any more."""
    for t in tables:
        jvm, sc = t.sparkSession._jvm, t.sparkSession.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of text that a task turns into Python strings at a time, unless one text has more.
BLOCK_BYTES = 1 << 18


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts, in the column of this number, have at most this many bytes together, or that are one row."""
    for batch in batches:
        sizes = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def one_column(values: pa.Array) -> Iterator[pa.RecordBatch]:
    """An array, as an Arrow function gets it, as the batches that ``slices`` takes."""
    yield pa.RecordBatch.from_arrays([values], names=["value"])


def crc_fold(key: Column) -> Column:
    """crc32 of a key written as text, modulo 5; fold 0 is held out. A null key falls in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(0))


def trained(sample: DataFrame, train: Callable[[list[dict]], Any]) -> Any:
    """What ``train`` makes of the rows of a bounded sample, or None if there are none.

    The sample meets in one task and only the model comes to the driver. A task's
    Python has one thread for matrix products, whatever the driver's settings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None
