"""Byte-level BPE over a global dictionary of distinct words.

1. Texts are cut into pre-tokens, in blocks of documents, in one pass. A block gives
   its pre-tokens in order as codes into its own word list (the positions), and deals
   its word list to buckets by word hash.
2. A bucket brings together the words of all blocks, encodes each distinct word
   once, and sends every block the ids of its words.
3. A block's codes and ids meet again: ids are put back by position, document by
   document, and joined with the table of token bytes, whose rows stand at their ids.

What is shuffled is the distinct words of each block and the codes, packed and
compressed, in place of one row per pre-token. Words go to their buckets and codes
to their blocks in one shuffle, which both steps read. There are buckets in proportion
to the input's partitions, so that a bucket gets about the words of half a partition
whatever the size of the table. A block is named by its place and a checksum of its
words and codes; should a task that is run again get its rows in another order, the
names differ and the query fails rather than mixing the two (checkpoint a source
whose order can change).

Defined results: a null text is an empty text (no ids); repeated rows and ids
each give a row; a null id is kept; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table
from .tokens import _BEYOND_LATIN, SPACES, ranks

#: Characters of text in one block, unless one document has more.
BLOCK_CHARS = 8_000_000
#: Buckets per input partition, and at least.
BUCKETS_PER_PART, LEAST_BUCKETS = 2, 24

_DEALT = "route string, block string, bucket int, part binary, docs binary"
_IDS = "route string, part binary"
_OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Cutter:
    """Matches of the splitting pattern, with the letters and digits that tiktoken knows.

    The regex module knows more characters as letters or digits than tiktoken's
    engine. Where a text has any, they are masked by a character that both take
    for neither, the matches are found there and read from the text.
    """

    def __init__(self, pattern: str):
        import regex

        self.pattern = regex.compile(pattern.replace(r"\s", f"[{SPACES}]").replace(f"[^[{SPACES}]", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]"))
        self.more = None

    def _masks(self) -> dict[int, str]:
        if self.more is None:
            import regex
            import tiktoken

            every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
            more: set[str] = set()
            for kind in (r"\p{L}", r"\p{N}"):
                known = tiktoken.Encoding("one", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
                more |= set(regex.findall(kind, every)) - set(bytes(known.encode_ordinary(every)).decode())
            self.more = {ord(c): "§" for c in more}
        return self.more

    def words(self, text: str) -> list[str]:
        if not text.isascii() and _BEYOND_LATIN.search(text):
            masked = text.translate(self._masks())
            if masked != text:
                return [text[m.start() : m.end()] for m in self.pattern.finditer(masked)]
        return self.pattern.findall(text)


class _Codes(dict):
    """Word to code, in order of appearance."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, by planes of bytes, compressed."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        planes = np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        used = 4 - next((i for i in range(4) if planes[3 - i].any()), 4)
        body = zlib.compress(planes[:used].tobytes(), 5)
        out += [len(a).to_bytes(8, "little"), used.to_bytes(1, "little"), len(body).to_bytes(8, "little"), body]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    n, at, found = int.from_bytes(data[:4], "little"), 4, []
    for _ in range(n):
        size, used, length = int.from_bytes(data[at : at + 8], "little"), data[at + 8], int.from_bytes(data[at + 9 : at + 17], "little")
        at += 17
        planes = np.zeros((4, size), np.uint8)
        planes[:used] = np.frombuffer(zlib.decompress(data[at : at + length]), np.uint8).reshape(used, size)
        found.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += length
    return found


def _pack_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), np.uint32, len(words))
    head = _pack(lengths)
    return len(head).to_bytes(8, "little") + head + zlib.compress(b"".join(words), 5)


def _unpack_words(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:8], "little")
    (lengths,) = _unpack(data[8 : 8 + size])
    body, ends = zlib.decompress(data[8 + size :]), np.cumsum(lengths, dtype=np.int64).tolist()
    return [body[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _bucketed(words: list[bytes], buckets: int) -> dict[int, tuple[np.ndarray, list[bytes]]]:
    """Per bucket the codes of its words and the words, sorted."""
    of = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    found = {}
    for codes in np.split(order, cuts) if len(words) else []:
        mine = sorted(codes.tolist(), key=words.__getitem__)
        found[int(of[mine[0]])] = (np.array(mine, np.uint32), [words[c] for c in mine])
    return found


def _deal(pattern: str, buckets: int):
    """Blocks: one row with the documents' codes (bucket -1), and one per bucket with its words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, part = Cutter(pattern), TaskContext.get().partitionId()
        number, ids, lengths, stream, codes, size = 0, [], [], array("I"), _Codes(), 0

        def flush() -> pd.DataFrame:
            nonlocal number, ids, lengths, stream, codes, size
            words = [w.encode("utf-8", "surrogatepass") for w in codes]
            known = np.array([i is not None for i in ids], np.uint32)
            keys = np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)
            docs = _pack(np.frombuffer(stream, np.uint32), np.array(lengths, np.uint32), known, (keys & 0xFFFFFFFF).astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint32))
            name = f"{part}-{number}-{zlib.crc32(b' '.join(words))}-{zlib.crc32(docs)}"
            rows = [(name, name, -1, None, docs)] + [(str(b), name, b, _pack(mine), _pack_words(list_)) for b, (mine, list_) in _bucketed(words, buckets).items()]
            number, ids, lengths, stream, codes, size = number + 1, [], [], array("I"), _Codes(), 0
            return pd.DataFrame(rows, columns=["route", "block", "bucket", "part", "docs"])

        for frame in frames:
            for key, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = cutter.words(text) if isinstance(text, str) else []
                ids.append(None if pd.isna(key) else int(key))
                lengths.append(len(words))
                stream.extend(map(codes.__getitem__, words))
                size += len(text) if isinstance(text, str) else 0
                if size >= BLOCK_CHARS:
                    yield flush()
        if ids:
            yield flush()

    return run


def _encode(path: str):
    """A bucket: encode each distinct word once; per block the ids of its words."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        piece, known, rows = _encoding(path)._core_bpe.encode_single_piece, {}, []
        for block, bucket, part, docs in zip(frame["block"], frame["bucket"], frame["part"], frame["docs"], strict=True):
            if bucket < 0:
                continue
            found = []
            for w in _unpack_words(docs):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = piece(w)
                found.append(ids)
            counts = np.fromiter(map(len, found), np.uint32, len(found))
            flat = np.fromiter((i for f in found for i in f), np.uint32, int(counts.sum()))
            rows.append((block, _pack(_unpack(part)[0], counts, flat)))
        return pd.DataFrame(rows, columns=["route", "part"])

    return run


_MADE: dict = {}


def _encoding(path: str):
    """The encoder of a rank file, one per process."""
    if ("encoding", path) not in _MADE:
        import public_tokenizers
        import tiktoken

        _MADE["encoding", path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})
    return _MADE["encoding", path]


def token_bytes(path: str) -> list[bytes]:
    """The table of token bytes by id, one per process; ids that no token has are empty."""
    if ("bytes", path) not in _MADE:
        known = ranks(path)
        rows = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            rows[i] = token
        _MADE["bytes", path] = rows
    return _MADE["bytes", path]


def _gather(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs values[first : first + count], joined."""
    ends = np.cumsum(counts)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(first, counts)
    return values[at]


def _rejoin(path: str):
    """A block: its documents' codes with the ids of its words."""

    def run(dealt: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        docs = dealt.loc[dealt["bucket"] < 0, "docs"]
        if docs.empty and words.empty:  # a bucket
            return pd.DataFrame({"doc_id": np.zeros(0, np.int64), "n_tokens": np.zeros(0, np.int64), "ids_sha256": np.zeros(0, object), "decoded_sha256": np.zeros(0, object)})
        parts = [_unpack(p) for p in words["part"]]
        size = sum(len(p[0]) for p in parts)
        stream, lengths, known, low, high = _unpack(docs.iloc[0]) if len(docs) else [np.zeros(0, np.uint32)] * 5
        if docs.empty or size != (int(stream.max()) + 1 if len(stream) else 0):
            raise ValueError("a task that was run again got its rows in another order; checkpoint the source first")
        counts = np.zeros(size, np.int64)
        first = np.zeros(size, np.int64)
        at = 0
        for codes, n, flat in parts:
            counts[codes] = n
            first[codes] = at + np.cumsum(n, dtype=np.int64) - n
            at += len(flat)
        flat = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint32)
        table_ = token_bytes(path)
        keys = (low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)).view(np.int64)
        rows, ends = [], np.cumsum(lengths, dtype=np.int64)
        for i, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
            mine = stream[a:b]
            ids = _gather(flat, first[mine], counts[mine])
            decoded = b"".join(map(table_.__getitem__, ids.tolist()))
            rows.append((int(keys[i]) if known[i] else None, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})

    return run


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = max(LEAST_BUCKETS, BUCKETS_PER_PART * src.rdd.getNumPartitions())
    dealt = src.mapInPandas(_deal(pattern, buckets), _DEALT).repartition("route")
    ids = dealt.groupBy("route").applyInPandas(_encode(path), _IDS)
    return dealt.groupBy("route").cogroup(ids.groupBy("route")).applyInPandas(_rejoin(path), _OUT)


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows of ids back to bytes (the ids column becomes ``bytes``) by a join with the token-byte table; for tables of any ids.

    The table has a row per token of the file and is broadcast. Repeated rows and
    null ids of documents are kept apart by a number of their own; null or empty id
    lists give empty bytes; an id that no token has gives none.
    """
    spark = tokens.sparkSession
    rows = checkpointed(tokens.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("_ids"), F.monotonically_increasing_id().alias("_row")))
    table_ = F.broadcast(spark.createDataFrame(list(enumerate(token_bytes(path))), "_id int, _bytes binary"))
    at = rows.select("_row", F.posexplode("_ids").alias("_at", "_id")).join(table_, "_id")
    joined = at.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", F.hex("_bytes").alias("h")))).alias("p"))
    text = F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), ""))
    return rows.join(joined, "_row", "left").select(id_col, F.coalesce(text, F.lit(b"")).alias("bytes"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by the ranks for many languages."""
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
