"""The corpus pipeline: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return rows of documents, whole and unchanged, whatever
their columns. An empty input passes through every stage as no rows; a very long
text is read whole by every stage, in one task each, with memory for its bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import language, neardup, packing, quality
from caseloom.llm.common import checkpointed, table


ROW = "_row"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold go; without labels all score 0.5 and stay."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go: no letters, a null text, or no language ahead of the others."""
    return language.accepted(docs, language.fit(docs))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicate rows one stays: the row of least id, one without an id only if none has one."""
    rows = checkpointed(docs.withColumn(ROW, F.monotonically_increasing_id()))
    # The number of a row stands for it, so that rows of one id or of none are told apart.
    found = neardup.linked_components(rows, id_col=ROW).where("n_shingles > 0").select(F.col("doc_id").alias(ROW), "component_id")
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col(ROW).alias("r"))
    member = checkpointed(found.join(rows.select(ROW, "doc_id"), ROW).select("component_id", ROW, first.alias("first")))
    kept = checkpointed(member.groupBy("component_id").agg(F.min("first").alias("kept"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    small = kept.count() <= neardup.BROADCAST_IDS
    gone = checkpointed(member.join(kept.hint("broadcast") if small else kept, "component_id").where(f"{ROW} <> kept.r").select(ROW))
    few = gone.count() <= neardup.BROADCAST_IDS
    return rows.join(gone.hint("broadcast") if few else gone, ROW, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("language", language_stage), ("neardup", neardup_stage), ("packing", packing_stage)]
#: SQL has neither the models nor the packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages, in order, to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
