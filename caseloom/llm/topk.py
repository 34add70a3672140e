"""Exact top-k search by tiled matrix products.

Queries go in passes of bounded size (``PASS_COMPONENTS``). A pass reads every shard
of the table once: tiles of its rows are multiplied with tiles of the pass's
queries, the best k of each product are kept by a partial selection, and a task's
products fold into one list per query. The lists of the tasks are then merged in a
tree of fixed fan-in, so no task ever reads more than ``FAN_IN * k`` entries of a
query. The plan of a pass is the same for any number of queries; where there are
several passes, each appends its lists to one table, and the driver never holds the
queries of more than one.

Defined results:

* null ids, null vectors and vectors with a null, NaN or infinite component take
  no part, neither as query nor as candidate; an empty table gives no rows;
* a candidate is never compared with a query of the same id or of another
  length;
* rows that repeat a query's id give one query, with the least of their vectors;
  other repeated rows are candidates of their own;
* scaled components and products are whole numbers of any size, also where doubles
  overflow; a score beyond 64 bits is the nearest that a long can hold;
* equal scores rank by the smaller id;
* columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import checkpointed, shared, table

TILE = 1024
FAN_IN = 16
#: Components of the queries of one pass; as doubles they take eight times as many bytes, on the driver and in each task.
PASS_COMPONENTS = 1 << 21
#: Products up to here are exact in doubles.
EXACT = float(2**53)

_LISTS = "query_id long, part int, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)


def _whole(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers."""
    return np.vectorize(lambda x: math.floor(scale * x) if abs(x) < 1e300 else scale * int(x), otypes=[object])(rows) if rows.size else rows.astype(object)


def _products(queries: np.ndarray, tile: np.ndarray, scale: int) -> np.ndarray:
    """Inner products of the scaled rows as int64: in doubles where they are exact there, else in integers, limited to 64 bits."""
    with np.errstate(over="ignore"):
        a, b = np.floor(scale * queries), np.floor(scale * tile)
    limit = math.sqrt(EXACT / max(1, queries.shape[1]))
    small_a, small_b = np.abs(a).max(1, initial=0) < limit, np.abs(b).max(1, initial=0) < limit
    if small_a.all() and small_b.all():
        return (a @ b.T).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    out[np.ix_(small_a, small_b)] = (a[small_a] @ b[small_b].T).astype(np.int64)
    cut = np.vectorize(lambda x: min(max(x, -(2**63)), 2**63 - 1), otypes=[np.int64])
    for rows, columns in ((~small_a, slice(None)), (small_a, ~small_b)):
        left, right = _whole(queries[rows], scale), _whole(tile[columns], scale)
        if len(left) and len(right):
            out[np.ix_(rows, np.arange(len(b))[columns])] = cut(left @ right.T)
    return out


def _best(scores: np.ndarray, ids: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the k highest by score, then by smaller id; invalid entries last."""
    order = np.lexsort((ids, ~scores, ~valid), axis=-1)[:, :k]
    return tuple(np.take_along_axis(a, order, 1) for a in (scores, ids, valid))


def _tile_best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Partial selection in one tile, whose ids ascend: score and position packed into one integer."""
    n = scores.shape[1]
    wide = np.broadcast_to(ids, scores.shape)
    if n <= k:
        return scores, wide, ~own
    if np.abs(scores).max(initial=0) >= 2**50:
        return _best(scores, wide, ~own, k)
    key = scores * n + (n - 1 - np.arange(n))
    key[own] = np.iinfo(np.int64).min
    pick = np.argpartition(key, n - k, axis=1)[:, n - k :]
    return tuple(np.take_along_axis(a, pick, 1) for a in (scores, wide, ~own))


def _search(asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int, scale: int):
    """A task: fold its products into one list per query of the pass (by vector length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[tuple[int, int], tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            column = batch.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            flat, first = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            for size in map(int, np.unique(sizes)):
                if size not in asked:
                    continue
                q_ids, q = asked[size]
                rows = np.flatnonzero(sizes == size)
                rows = rows[np.argsort(all_ids[rows], kind="stable")]
                for at in range(0, len(rows), TILE):
                    part = rows[at : at + TILE]
                    tile = flat[first[part][:, None] + np.arange(size)] if size else np.zeros((len(part), 0))
                    ids = all_ids[part]
                    for of in range(0, len(q_ids), TILE):
                        mine = q_ids[of : of + TILE]
                        got = _tile_best(_products(q[of : of + TILE], tile, scale), ids, mine[:, None] == ids[None, :], k)
                        had = lists.get((size, of))
                        lists[size, of] = _best(*(np.concatenate(x, 1) for x in zip(had, got, strict=True)), k) if had else _best(*got, k)
        where = TaskContext.get().partitionId()
        for (size, of), (scores, ids, valid) in lists.items():
            row, col = np.nonzero(valid)
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked[size][0][of + row]), pa.array(np.full(len(row), where, np.int32)), pa.array(ids[row, col]), pa.array(scores[row, col])],
                names=["query_id", "part", "vec_id", "score"],
            )

    return run


def _collected(asked: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The queries of one pass on the driver: ids and matrix by vector length."""
    t = asked.select("vec_id", "v").toArrow().combine_chunks()
    if not t.num_rows:
        return {}
    ids, column = t.column(0).to_numpy(), t.column(1).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    first, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(first)
    return {int(d): (ids[r := np.flatnonzero(sizes == d)], flat[first[r][:, None] + np.arange(d)] if d else np.zeros((len(r), 0))) for d in np.unique(sizes)}


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """The k best candidates of every row for which ``is_query`` (over column vec_id) holds.

    Returns query_id long, rank int from 1, vec_id long, score long.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    asked = checkpointed(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))
    components = asked.agg(F.coalesce(F.sum(F.size("v") + 1), F.lit(0)).alias("n")).first()["n"]
    passes = max(1, math.ceil(components / PASS_COMPONENTS))
    parts = rows.rdd.getNumPartitions()
    best = (F.desc("score"), F.asc("vec_id"))

    def one_pass(number: int) -> DataFrame:
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number) if passes > 1 else asked
        out = rows.mapInArrow(_search(_collected(mine), k, scale), _LISTS)
        step = FAN_IN
        while step < parts:
            out = out.withColumn("node", F.floor(F.col("part") / step)).withColumn("place", F.row_number().over(W.partitionBy("query_id", "node").orderBy(*best))).where(F.col("place") <= k).drop("node", "place")
            step *= FAN_IN
        ranked = out.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*best)))
        return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    if passes == 1:
        return one_pass(0)
    path = f"{shared(spark)}/{uuid.uuid4().hex}.parquet"
    for number in range(passes):
        one_pass(number).write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100, against all others."""
    return exact_topk(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
