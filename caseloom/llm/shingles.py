"""Hashed word shingles of whole texts, vectorized over blocks of documents."""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes hashed at a time; a longer word is hashed in one piece.
BLOCK = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of splitmix64)."""
    x = x.astype(_U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEP, _BACK = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTER = mix(np.arange(1, 257, dtype=_U))
_PLACE = mix(np.arange(1001, 1009, dtype=_U)) | _U(1)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for i, base in enumerate((_STEP, _BACK)):
                p = np.full(n, base, _U)
                p[0] = 1
                _powers[i] = np.multiply.accumulate(p)
    return _powers


def _hash_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one block."""
    a = np.frombuffer(data, np.uint8)
    blank = _SPACE[a]
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(len(a) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(_LETTER[a] * up[: len(a)], dtype=_U)))
        return first, mix((sums[last] - sums[first]) * down[first] + (last - first).astype(_U))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, cut at ASCII white space; and per text their number."""
    counts = np.zeros(len(texts), np.int64)
    found: list[np.ndarray] = []
    block: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if block:
            data = b"\n".join(block)
            first, hashes = _hash_block(data)
            ends = np.cumsum([len(b) + 1 for b in block])
            np.add.at(counts, np.array(owner)[np.searchsorted(ends, first, "right")], 1)
            found.append(hashes)
            block.clear()
            owner.clear()
            size = 0

    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass").lower()
        at = 0
        while len(data) - at > BLOCK:
            cut = at + BLOCK
            while cut < len(data) and not _SPACE[data[cut]]:
                cut += 1
            flush()
            block.append(data[at:cut])
            owner.append(i)
            flush()
            at = cut
        if at < len(data):
            block.append(data[at:] if at else data)
            owner.append(i)
            size += len(data) - at
            if size > BLOCK:
                flush()
    flush()
    return np.concatenate(found) if found else np.zeros(0, _U), counts


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Per text the ascending distinct hashes of its runs of ``width`` words; of all its words if it has fewer."""
    words, counts = word_hashes(texts)
    out, at = [], 0
    with np.errstate(over="ignore"):
        for n in counts.tolist():
            w = words[at : at + n]
            at += n
            if n == 0:
                out.append(np.zeros(0, _U))
                continue
            k = min(n, width)
            total = np.full(n - k + 1, k, _U)
            for j in range(k):
                total = total + w[j : n - k + 1 + j] * _PLACE[j]
            out.append(np.unique(mix(total)))
    return out


def set_key(s: np.ndarray) -> bytes:
    """A 128-bit digest of a set."""
    return hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest()
