"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded from
the shares of its bytes by kind, of pairs of kinds, and of its repeated lines; a
dense layer gives its representation h. Gated attention, softmax over
w . (tanh(V h) * sigmoid(U h)), weighs the passages, and a logistic unit scores the
weighted representation. All weights are learned from document labels alone, by
Adam on the log loss, in numpy in one task.

Training reads at most ``SAMPLE`` labelled documents (those of least id hash), of
rows that share an id one, and at most ``SAMPLE_PASSAGES`` evenly spaced passages of
each; that is the documented bound of the sample. Scoring reads every passage of
every text; a very long text takes memory for its features, about the size of its
bytes, and no more.

Defined results: a null or empty text is one empty passage and gets a score;
repeated rows and ids each give a row, a null id is in the held-out fold; labels
other than 0 and 1 are not learned from, and of several labels of one id the
greatest counts; without any label all scores are 0.5; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, crc_fold, one_column, slices, table, trained

PASSAGE = 768
#: Passages whose bytes are counted at a time.
SLICE = 256
#: Shares in passages of fewer bytes are taken of this many, so that a few words say little.
SHORT = 64
SAMPLE, SAMPLE_PASSAGES = 4000, 24
HIDDEN, ATTENTION, EPOCHS, SEED = 24, 16, 30, 7
THRESHOLD = 0.3


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Per byte its fine kind (each ASCII mark its own) and its coarse kind."""
    fine, coarse = np.zeros(256, np.int32), np.zeros(256, np.int32)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        if b >= 128:
            fine[b], coarse[b] = 0, 0
        elif c.islower():
            fine[b], coarse[b] = 1, 1
        elif c.isupper():
            fine[b], coarse[b] = 2, 2
        elif c.isdigit():
            fine[b], coarse[b] = 3, 3
        elif c == " ":
            fine[b], coarse[b] = 4, 4
        elif c == "\n":
            fine[b], coarse[b] = 5, 5
        elif b in marks:
            fine[b], coarse[b] = 7 + marks.index(b), 7 if c in ".,;:" else 8 if c in "!?" else 9
        else:
            fine[b], coarse[b] = 6, 6
    return fine, coarse


FINE, COARSE = _kinds()
N_FINE, N_COARSE = int(FINE.max()) + 1, int(COARSE.max()) + 1
#: Pairs of kinds, kinds, share of repeated lines, length, whether the text is empty, share of repeated words.
N_FEATURES = N_COARSE * N_COARSE + N_FINE + 4


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages and the number of passages of each text."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(b) for b in data], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    first = np.cumsum(counts) - counts
    total = int(counts.sum())
    out = np.zeros((total, N_FEATURES), np.float32)
    place = np.arange(total) - np.repeat(first, counts)
    length = np.minimum(PASSAGE, np.repeat(sizes, counts) - place * PASSAGE)
    pairs, fine = N_COARSE * N_COARSE, N_FINE
    a = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum(length)
    for lo in range(0, total, SLICE):
        hi = min(total, lo + SLICE)
        start = int(ends[lo] - length[lo])
        part = a[start : int(ends[hi - 1])]
        p = np.repeat(np.arange(hi - lo, dtype=np.int32), length[lo:hi])
        kind = COARSE[part]
        prev = np.empty_like(kind)
        prev[1:] = kind[:-1]
        heads = ends[lo:hi] - length[lo:hi] - start
        whole = length[lo:hi] > 0
        prev[heads[whole]] = np.where(place[lo:hi][whole] > 0, COARSE[a[ends[lo:hi][whole] - length[lo:hi][whole] - 1]], 5)
        out[lo:hi, :pairs] = np.bincount(p * pairs + prev * N_COARSE + kind, minlength=(hi - lo) * pairs).reshape(hi - lo, pairs)
        out[lo:hi, pairs : pairs + fine] = np.bincount(p * fine + FINE[part], minlength=(hi - lo) * fine).reshape(hi - lo, fine)
    out[:, : pairs + fine] = np.sqrt(out[:, : pairs + fine] / np.maximum(length, SHORT).astype(np.float32)[:, None])
    out[:, pairs + fine + 1] = length / PASSAGE
    out[:, pairs + fine + 2] = length == 0
    for i, b in enumerate(data):
        for j in range(int(counts[i])):
            words = b[j * PASSAGE : (j + 1) * PASSAGE].split()
            if len(words) > 8:
                out[first[i] + j, pairs + fine + 3] = 1 - len(set(words)) / len(words)
    for i, b in enumerate(data):  # bytes in lines that stood before in the text, by passage
        if b.count(b"\n") > 1:
            seen: set[bytes] = set()
            pos = 0
            for line in b.split(b"\n"):
                if len(line) > 3:
                    if line in seen:
                        out[first[i] + pos // PASSAGE, pairs + fine] += len(line) / PASSAGE
                    else:
                        seen.add(line)
                pos += len(line) + 1
    np.minimum(out[:, pairs + fine], 4, out=out[:, pairs + fine])
    return out, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(m: dict, x: np.ndarray, counts: np.ndarray) -> dict:
    bag = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    x = (x - m["mean"]) * m["scale"]
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (t * g) @ m["w"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    att = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(att[:, None] * h, first, axis=0)
    return {"bag": bag, "first": first, "x": x, "h": h, "t": t, "g": g, "a": att, "z": z, "p": _sigmoid(z @ m["o"] + m["c"])}


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict:
    """Weights fitted to bags of passages with labels 0 or 1; passages may be in half precision and become single by batches."""
    rng = np.random.default_rng(SEED)
    f = x.shape[1]
    mean = x.mean(0, dtype=np.float64)
    square = sum((((x[i : i + 4096].astype(np.float32) - mean) ** 2).sum(0) for i in range(0, len(x), 4096)), np.zeros(f))
    m = {
        "mean": mean, "scale": 1 / (np.sqrt(square / max(1, len(x))) + 0.02), "W": rng.normal(0, f**-0.5, (f, HIDDEN)), "b": np.zeros(HIDDEN),
        "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)), "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)), "w": rng.normal(0, 0.1, ATTENTION),
        "o": np.zeros(HIDDEN), "c": np.zeros(1),
    }
    m = {k: v.astype(np.float32) for k, v in m.items()}
    names = ["W", "b", "V", "U", "w", "o", "c"]
    moment = {k: (np.zeros_like(m[k]), np.zeros_like(m[k])) for k in names}
    starts = np.cumsum(counts) - counts
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            rows = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in pick])
            c = counts[pick]
            r = _forward(m, x[rows].astype(np.float32), c)
            dz_p = ((r["p"] - y[pick]) / len(pick)).astype(np.float32)
            grad = {"o": r["z"].T @ dz_p, "c": dz_p.sum(keepdims=True)}
            dz = dz_p[:, None] * m["o"]
            dzr = dz[r["bag"]]
            dh = r["a"][:, None] * dzr
            da = (dzr * r["h"]).sum(1)
            de = r["a"] * (da - np.add.reduceat(r["a"] * da, r["first"])[r["bag"]])
            grad["w"] = (r["t"] * r["g"]).T @ de
            dtg = de[:, None] * m["w"]
            dt, dg = dtg * r["g"] * (1 - r["t"] ** 2), dtg * r["t"] * r["g"] * (1 - r["g"])
            grad["V"], grad["U"] = r["h"].T @ dt, r["h"].T @ dg
            dh += dt @ m["V"].T + dg @ m["U"].T
            dx = dh * (1 - r["h"] ** 2)
            grad["W"], grad["b"] = r["x"].T @ dx, dx.sum(0)
            step += 1
            rate = 0.004 * (1 - epoch / EPOCHS) + 0.0003
            for k in names:
                g = grad[k] + (1e-4 * m[k] if m[k].ndim == 2 else 0)
                a, b = moment[k]
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                m[k] -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m


def score(model: dict | None, texts: list[str | None]) -> np.ndarray:
    """Scores of whole texts."""
    out = np.full(len(texts), 0.5)
    if model is None:
        return out
    sizes = [len(t or "") for t in texts]
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + sizes[to] <= BLOCK_BYTES):
            size += sizes[to]
            to += 1
        x, counts = passages([t or "" for t in texts[at:to]])
        out[at:to] = _forward(model, x, counts)["p"]
        at = to
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = []
        for doc, text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x, _ = passages([text or ""])
            if len(x) > SAMPLE_PASSAGES:
                x = x[np.linspace(0, len(x) - 1, SAMPLE_PASSAGES).astype(int)]
            rows.append((doc, y, x.astype(np.float16).tobytes()))
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], names=["doc_id", "y", "x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """A model from the labels outside the held-out fold; None if there are none."""
    known = labels.where((crc_fold(F.col("doc_id")) != 0) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = src.join(F.broadcast(known), "doc_id").select("doc_id", "text", "y").mapInArrow(_featured, "doc_id long, y int, x binary")
    return trained(rows.groupBy("doc_id", "y").agg(F.min("x").alias("x")), _fitted)


def _fitted(rows: list[dict]) -> dict:
    rows.sort(key=lambda r: r["doc_id"])
    counts = np.array([len(r["x"]) // (2 * N_FEATURES) for r in rows])
    y = np.array([r["y"] for r in rows], np.float32)
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float16).reshape(-1, N_FEATURES)
    rows.clear()
    return train(x, counts, y)


def _scorer(model: dict | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            s = score(model, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())], names=["doc_id", "held_out", "score"])

    return run


def scored(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc_fold(F.col(id_col)) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    found = src.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """The rows, whole and unchanged, whose text scores at least the threshold."""

    @F.arrow_udf("double")
    def scorer(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(score(model, part.column(0).to_pylist()) for part in slices(one_column(texts), 0))]), pa.float64())

    return docs.where(scorer(F.col(text_col).cast("string")) >= THRESHOLD)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by a model of the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))
