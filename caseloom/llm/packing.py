"""Packing of documents into sequences by cutting-stock column generation.

A document's ids are cut every ``SEQUENCE`` tokens; the pieces are what is packed.
Piece lengths, rounded up to ``GRAIN`` tokens, form a histogram of at most
``SEQUENCE / GRAIN`` bins, which is all that reaches the driver. A linear program
over patterns (how many pieces of each bin share a sequence) is solved by column
generation: the revised simplex method gives prices of the bins, a knapsack dynamic
program finds the pattern of highest price, and the pattern enters while it is
worth more than one sequence. The solution is rounded down; the few pieces left per
bin are placed first-fit, longest first. Pieces are then ranked within their bin by
two counts (inside a chunk, over chunks), and the rank alone names the sequence, so
that no task needs more than its own pieces.

Defined results:

* a null or empty text is the closing id alone, one piece of length 1;
* repeated rows and repeated ids are packed each on their own; a null id is kept;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import checkpointed, slices, table
from .tokens import json_encoder

SEQUENCE, GRAIN, END_ID = 2048, 8, 1
BINS = SEQUENCE // GRAIN
#: Rows of a ranking chunk, at least; beyond a million rows the square root of their number.
CHUNK = 1024
#: Column generation ends when no pattern is worth this much more than a sequence; by Farley's bound the
#: solution is then within the same share of the least number of sequences.
GAP = 1e-3
_ROUNDS = 4000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cutter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = json_encoder(path)
        for batch in slices(batches, 1):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encoder.encode(text or ""), END_ID], "<u4").tobytes()
                n = len(ids) // 4
                for at in range(0, n, SEQUENCE):
                    part = ids[4 * at : 4 * (at + SEQUENCE)]
                    rows.append((doc, at, len(part) // 4, zlib.crc32(part), n))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the counts per size (1..len(prices)) of highest price within the capacity."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        m = min(c, len(prices))
        gain = prices[:m] + best[c - m : c][::-1]
        i = int(gain.argmax())
        best[c], took[c] = (gain[i], i + 1) if gain[i] > best[c - 1] + 1e-15 else (best[c - 1], 0)
    counts, c = np.zeros(len(prices), np.int64), capacity
    while c > 0:
        if took[c]:
            counts[took[c] - 1] += 1
            c -= took[c]
        else:
            c -= 1
    return float(best[capacity]), counts


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """A product by plain vector operations: threaded BLAS and LAPACK may not return beside a started JVM."""
    return (matrix * vector).sum(1)


def _inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination with the largest pivot, by plain vector operations."""
    m = len(matrix)
    a = np.hstack((matrix, np.eye(m)))
    for i in range(m):
        top = i + int(np.abs(a[i:, i]).argmax())
        if top != i:
            a[[i, top]] = a[[top, i]]
        a[i] /= a[i, i]
        factor = a[:, i].copy()
        factor[i] = 0
        a -= np.outer(factor, a[i])
    return a[:, m:]


def solve_patterns(demand: np.ndarray, capacity: int = BINS) -> list[tuple[np.ndarray, float]]:
    """The linear program: patterns and how often each is cut, covering the demand per size with least sequences."""
    sizes = np.flatnonzero(demand)
    if not len(sizes):
        return []
    need = demand[sizes].astype(float)
    m = len(sizes)
    columns = np.zeros((m, m))
    for i, s in enumerate(sizes):
        columns[i, i] = capacity // (s + 1)
    inverse = np.diag(1 / np.diag(columns))
    x = _times(inverse, need)
    material = float((need * (sizes + 1)).sum()) / capacity  # no packing needs less
    for step in range(1, _ROUNDS):
        if float(x.sum()) <= material * (1 + GAP):
            break
        prices = inverse.sum(0)
        full = np.zeros(capacity)
        full[sizes] = np.maximum(prices, 0)
        value, counts = best_pattern(full, capacity)
        if value <= 1 + GAP:
            break
        column = counts[sizes].astype(float)
        d = _times(inverse, column)
        ratio = np.full(m, np.inf)
        ratio[d > 1e-9] = x[d > 1e-9] / d[d > 1e-9]
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        theta = ratio[out]
        x = x - theta * d
        x[out] = theta
        columns[:, out] = column
        if step % 128:
            inverse[out] /= d[out]
            rest = np.arange(m) != out
            inverse[rest] -= np.outer(d[rest], inverse[out])
        else:
            inverse = _inverted(columns)
            x = np.maximum(_times(inverse, need), 0)
    out_patterns = []
    for j in range(m):
        if x[j] > 1e-9:
            counts = np.zeros(capacity, np.int64)
            counts[sizes] = np.rint(columns[:, j]).astype(np.int64)
            out_patterns.append((counts, float(x[j])))
    return out_patterns


def plan(demand: np.ndarray, capacity: int = BINS) -> dict[int, np.ndarray]:
    """Per size, runs of ranks as rows (first rank, first sequence, pieces of the size per sequence, slot)."""
    left = demand.astype(np.int64).copy()
    runs: dict[int, list] = {}
    seq = 0
    done = np.zeros(capacity, np.int64)

    def put(counts: np.ndarray, times: int) -> None:
        nonlocal seq
        for s in np.flatnonzero(counts):
            runs.setdefault(int(s), []).append((int(done[s]), seq, int(counts[s])))
            done[s] += counts[s] * times
        seq += times

    for counts, often in sorted(solve_patterns(demand, capacity), key=lambda p: -p[1]):
        used = counts > 0
        times = min(math.floor(often + 1e-9), int((left[used] // counts[used]).min()))
        if times > 0:
            left -= counts * times
            put(counts, times)
    open_: list[list] = []  # what rounding left: first fit, longest first
    for s in range(capacity - 1, -1, -1):
        for _ in range(int(left[s])):
            for o in open_:
                if o[0] >= s + 1:
                    break
            else:
                open_.append(o := [capacity, np.zeros(capacity, np.int64)])
            o[0] -= s + 1
            o[1][s] += 1
    for _, counts in open_:
        put(counts, 1)
    return {s: np.array(r, np.int64) for s, r in runs.items()}


def _placer(runs: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column(batch.schema.get_field_index("size")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            seq = np.zeros(len(rank), np.int64)
            for s in np.unique(size):
                rows, table_ = np.flatnonzero(size == s), runs[int(s)]
                i = np.searchsorted(table_[:, 0], rank[rows], "right") - 1
                seq[rows] = table_[i, 1] + (rank[rows] - table_[i, 0]) // table_[i, 2]
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"])

    return run


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its place: the columns of the pieces, sequence_id, offset."""
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_cutter(path), _PIECES)
    pieces = checkpointed(pieces).withColumn("row", F.monotonically_increasing_id())  # of rows that are written down, so that it stays
    size = F.floor((F.col("length") - 1) / GRAIN).cast("int")
    counts = pieces.groupBy(size.alias("size")).count().collect()  # at most BINS rows
    demand = np.zeros(BINS, np.int64)
    for r in counts:
        demand[r["size"]] = r["count"]
    total = int(demand.sum())
    chunk_count = max(1, math.ceil(total / max(CHUNK, math.isqrt(total))))
    ranked = pieces.withColumn("size", size).withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunk_count)))
    before = ranked.groupBy("size", "chunk").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("size").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    before = before.select("size", "chunk", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    inside = W.partitionBy("size", "chunk").orderBy(F.desc("length"), "row")
    ranked = ranked.withColumn("inside", F.row_number().over(inside)).join(before, ["size", "chunk"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside") - 1).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "size", "rank")
    placed = ranked.mapInArrow(_placer(plan(demand)), _PIECES + ", sequence_id long")
    along = W.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed."""
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
