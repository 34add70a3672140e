"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads a text byte by byte in both directions, across words, and labels
every position with a distribution over languages. Texts are read in windows of
``OWN`` positions with ``EDGE`` more bytes of context on either side, so that many
windows go through the network side by side; every position is labelled once. A
document's distribution is the softmax of the mean log-probability of its
positions, sharpened by the length of the text (``EVIDENCE`` bytes count in full).
Trained in numpy by backpropagation through time, in one task.

Training reads at most ``SAMPLE`` documents with a language (those of least id
hash), of rows that share an id one, and of each at most ``SAMPLE_WINDOWS`` evenly
spaced windows; that is the documented bound of the sample. Prediction reads whole
texts; a very long one takes memory for its bytes and one group of windows.

Defined results: ``und`` with score 0 if the text is null or has no letter (no
character of a Unicode category L), or if nothing could be learned; repeated rows
and ids each give a row, a null id is in the held-out fold; ties go to the first
language in alphabetic order; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, crc_fold, one_column, slices, table, trained

SAMPLE, SAMPLE_WINDOWS, SAMPLE_BYTES = 2000, 3, 96
HIDDEN, EMBED, EPOCHS, BATCH, SEED = 10, 12, 5, 128, 11
#: Positions that a window labels, and bytes of context on either side.
OWN, EDGE = 224, 16
#: Windows that go through the network side by side.
GROUP = 1024
#: Bytes that count as one observation, and observations from which on the pooled evidence counts in full.
GRAIN, EVIDENCE = 8, 8
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is of a Unicode category L (``\\w`` takes in other numerals as well)."""
    return any(m[0].isalpha() for m in _WORD.finditer(text))


def _padded(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of whole windows as rows, and their lengths; padding is byte 0."""
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    wide = np.zeros((len(data), int(lengths.max(initial=1))), np.uint8)
    wide[np.arange(wide.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(data), np.uint8)
    return wide, lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run_gru(m: dict, d: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction; x holds bytes (n, t) in the order of reading, padding last. States per step, and what the way back needs."""
    H = HIDDEN
    table_ = m["E"] @ m["Wx" + d] + m["bx" + d]
    weights = m["Wh" + d]
    steps = np.ascontiguousarray(x.T)
    n = x.shape[0]
    h = np.zeros((n, H), table_.dtype)
    out, back = np.zeros((len(steps), n, H), table_.dtype), []
    for t, at in enumerate(steps):
        xi = table_[at]
        hh = h @ weights
        gates = xi[:, : 2 * H] + hh[:, : 2 * H]
        np.negative(gates, out=gates)
        np.minimum(gates, 30, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:, :H], gates[:, H:]
        c = r * hh[:, 2 * H :]
        c += xi[:, 2 * H :]
        np.tanh(c, out=c)
        if keep:
            back.append((h, z, r, c, hh[:, 2 * H :]))
        new = c - h
        new *= 1 - z
        new += h
        out[t] = h = new
    return out, back


def _back_gru(m: dict, d: str, x: np.ndarray, dout: np.ndarray, back: list, grad: dict) -> None:
    """Gradients of one direction, given those of its states (0 at padding)."""
    H = HIDDEN
    dx_all = np.zeros((x.shape[1], x.shape[0], 3 * H), dout.dtype)
    dh = np.zeros_like(dout[0])
    dWh = np.zeros_like(m["Wh" + d])
    for t in range(x.shape[1] - 1, -1, -1):
        h, z, r, c, hc = back[t]
        dh = dh + dout[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * hc * r * (1 - r)
        dx_all[t] = np.concatenate((dz, dr, dc), 1)
        dhh = np.concatenate((dz, dr, dc * r), 1)
        dWh += h.T @ dhh
        dh = dh * z + dhh @ m["Wh" + d].T
    flat, seen = dx_all.reshape(-1, 3 * H), x.T.ravel()
    order = np.argsort(seen, kind="stable")
    first = np.flatnonzero(np.diff(seen[order].astype(np.int64), prepend=-1))
    dtable = np.zeros((256, 3 * H), dout.dtype)
    dtable[seen[order][first]] = np.add.reduceat(flat[order], first, axis=0)
    grad["Wh" + d] = dWh
    grad["Wx" + d] = m["E"].T @ dtable
    grad["bx" + d] = dtable.sum(0)
    grad["E"] = grad.get("E", 0) + dtable @ m["Wx" + d].T


def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row's first ``length`` entries in reverse; an involution."""
    at = lengths[:, None] - 1 - np.arange(x.shape[1])
    return np.where(at >= 0, np.take_along_axis(x, np.maximum(at, 0), 1), 0)


def _states(m: dict, x: np.ndarray, lengths: np.ndarray, keep: bool):
    y = _turned(x, lengths)
    f, bf = _run_gru(m, "f", x, keep)
    b, bb = _run_gru(m, "b", y, keep)
    at = np.maximum(lengths[:, None] - 1 - np.arange(x.shape[1]), 0).T
    both = np.concatenate((f, b[at, np.arange(len(x))]), 2)
    mask = (np.arange(x.shape[1])[:, None] < lengths).astype(f.dtype)  # by step and window
    return both, mask, y, bf, bb, at


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def _gradients(m: dict, x: np.ndarray, lengths: np.ndarray, langs: np.ndarray) -> dict:
    """Of the mean log loss over all positions."""
    H, n = HIDDEN, len(x)
    both, mask, y, bf, bb, at = _states(m, x, lengths, True)
    p = np.exp(_log_softmax(both @ m["O"] + m["o"]))
    p[:, np.arange(n), langs] -= 1
    p *= (mask / mask.sum())[:, :, None]
    grad = {"O": both.reshape(-1, 2 * H).T @ p.reshape(-1, p.shape[2]), "o": p.sum((0, 1))}
    dboth = p @ m["O"].T
    turned = np.zeros_like(dboth[:, :, H:])
    live = mask > 0
    turned[at[live], np.nonzero(live)[1]] = dboth[:, :, H:][live]
    _back_gru(m, "f", x, dboth[:, :, :H], bf, grad)
    _back_gru(m, "b", y, turned, bb, grad)
    return grad


def train(data: list[bytes], langs: np.ndarray, names: list[str]) -> dict:
    """Weights fitted to windows with the language (an index) of their documents."""
    rng = np.random.default_rng(SEED)
    H = HIDDEN
    m: dict = {"E": rng.normal(0, 0.3, (256, EMBED)), "O": rng.normal(0, 0.1, (2 * H, len(names))), "o": np.zeros(len(names))}
    for d in "fb":
        m |= {"Wx" + d: rng.normal(0, EMBED**-0.5, (EMBED, 3 * H)), "bx" + d: np.zeros(3 * H), "Wh" + d: rng.normal(0, H**-0.5, (H, 3 * H))}
    m = {k: v.astype(np.float32) for k, v in m.items()}
    keys = list(m)
    moment = {k: (np.zeros_like(m[k]), np.zeros_like(m[k])) for k in keys}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(data))
        for b in range(0, len(order), BATCH):
            pick = order[b : b + BATCH]
            x, lengths = _padded([data[i] for i in pick])
            grad = _gradients(m, x, lengths, langs[pick])
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS) + 0.001
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k in keys:
                g = grad[k] / max(1.0, norm)
                a, v = moment[k]
                a *= 0.9
                a += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                m[k] -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    m["langs"] = names
    return m


def _logits(m: dict, d: str, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One direction's part of the logits (t, language, n) of bytes (t, n), padding last: as ``_run_gru``, with units as rows, which numpy runs faster."""
    H, n = HIDDEN, x.shape[1]
    flip = np.where(np.arange(3 * H) < 2 * H, np.float32(-1), np.float32(1))
    table_ = np.ascontiguousarray((m["E"] @ m["Wx" + d] + m["bx" + d]).T * flip[:, None], np.float32)
    weights = np.ascontiguousarray(m["Wh" + d].T * flip[:, None], np.float32)
    out = np.empty((len(x), H, n), np.float32)
    h, hh, xi, c = np.zeros((H, n), np.float32), np.empty((3 * H, n), np.float32), np.empty((3 * H, n), np.float32), np.empty((H, n), np.float32)
    shortest = int(lengths.min())
    with np.errstate(over="ignore"):
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            np.take(table_, x[t], axis=1, out=xi, mode="clip")
            np.dot(weights, h, out=hh)
            gates = hh[: 2 * H]
            gates += xi[: 2 * H]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.multiply(hh[2 * H :], gates[H:], out=c)
            c += xi[2 * H :]
            np.tanh(c, out=c)
            new = np.subtract(h, c, out=out[t])
            new *= gates[:H]
            new += c
            if d == "b" and t >= shortest:
                new *= t < lengths  # these windows have not begun
            h = new
    return np.matmul(np.ascontiguousarray(m["O"][:H].T if d == "f" else m["O"][H:].T, np.float32), out)


def position_sums(m: dict, texts: list[bytes]) -> np.ndarray:
    """Per text the sum of the log-probabilities of all its positions."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // OWN)
    doc = np.repeat(np.arange(len(texts)), counts)
    own = (np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)) * OWN
    start, end = np.maximum(own - EDGE, 0), np.minimum(own + OWN + EDGE, sizes[doc])
    base = (np.cumsum(sizes) - sizes)[doc]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros((len(texts), len(m["langs"])))
    order = np.argsort(end - start, kind="stable")
    for at in range(0, len(order), GROUP):
        w = order[at : at + GROUP]
        lengths = (end - start)[w]
        along = np.arange(int(lengths.max()))[:, None]
        inside = along < lengths
        x = np.where(inside, flat[np.minimum((base + start)[w] + along, len(flat) - 1)], 0).astype(np.intp)
        logits = _logits(m, "f", x, lengths)
        logits += _logits(m, "b", x, lengths)
        logits += m["o"][:, None].astype(np.float32)
        logits -= logits.max(1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        place = along + (start - own)[w]
        logits *= ((place >= 0) & (place < OWN) & inside)[:, None]
        np.add.at(out, doc[w], logits.sum(0).T)
    return out


def predict(model: dict | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of whole texts."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    live = [i for i, t in enumerate(texts) if t and has_letter(t)] if model is not None else []
    at = 0
    while at < len(live):
        block, size = [], 0
        while at + len(block) < len(live) and (not block or size < BLOCK_BYTES):
            block.append(texts[live[at + len(block)]].encode("utf-8", "surrogatepass"))
            size += len(block[-1])
        n = np.fromiter(map(len, block), np.int64, len(block))
        mean = position_sums(model, block) / n[:, None]
        p = np.exp(_log_softmax(mean * np.clip(n / GRAIN, 1, EVIDENCE)[:, None]))
        for i, b, s in zip(live[at : at + len(block)], p.argmax(1), p.max(1), strict=True):
            names[i], scores[i] = model["langs"][b], s
        at += len(block)
    return names, scores


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        rows = []
        for doc, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            starts = np.linspace(0, max(0, len(data) - SAMPLE_BYTES), SAMPLE_WINDOWS).astype(int)
            rows.append((doc, lang, [data[i : i + SAMPLE_BYTES] for i in sorted(set(starts.tolist())) if data]))
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.list_(pa.binary()))], names=["doc_id", "lang", "windows"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """A model from the documents with a language outside the held-out fold; None if there are none."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    src = src.where((crc_fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = src.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = src.join(F.broadcast(ids), "doc_id").mapInArrow(_sampled, "doc_id long, lang string, windows array<binary>").where(F.size("windows") > 0)
    return trained(rows.groupBy("doc_id").agg(F.min(F.struct("lang", "windows")).alias("r")).select("doc_id", "r.lang", "r.windows"), _fitted)


def _fitted(rows: list[dict]) -> dict:
    rows = sorted(rows, key=lambda r: r["doc_id"])
    names = sorted({r["lang"] for r in rows})
    return train([w for r in rows for w in r["windows"]], np.repeat([names.index(r["lang"]) for r in rows], [len(r["windows"]) for r in rows]), names)


def _predicted(model: dict | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            names, scores = predict(model, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identified(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc_fold(F.col(id_col)) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_predicted(model), "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: dict | None, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows, whole and unchanged, in a known language with at least this score."""

    @F.arrow_udf("double")
    def certain(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(one_column(texts), 0):
            names, scores = predict(model, part.column(0).to_pylist())
            out += [0.0 if n == UNKNOWN else float(x) for n, x in zip(names, scores, strict=True)]
        return pa.array(out, pa.float64())

    return docs.where(certain(F.col(text_col).cast("string")) >= least)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by a model of the languages outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return identified(docs, fit(docs))
