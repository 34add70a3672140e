"""Matching-block similarity and best matches in a small vocabulary.

The ratio depends on the order of its arguments and has no built-in counterpart, so
it runs in Arrow batches, on distinct values only; matches come back by a join.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def best(value: str | None, vocabulary: tuple[str, ...], least: float, margin: float, fold=None) -> str | None:
    """The entry of highest ratio, if it is high enough and far enough ahead of the next.

    An entry whose ratio cannot come within the margin of the least neither wins nor
    stands in the way, so only the others are compared in full.
    """
    if value is None:
        return None
    fold = fold or (lambda x: x)
    own, floor, scores = fold(value), least - margin - 1e-9, []
    for c in vocabulary:
        m = SequenceMatcher(None, own, fold(c))
        if m.real_quick_ratio() >= floor and m.quick_ratio() >= floor:
            scores.append((m.ratio(), c))
    scores.sort(reverse=True)
    if not scores or scores[0][0] < least or len(scores) > 1 and scores[0][0] - scores[1][0] < margin:
        return None
    return scores[0][1]


def _counts(texts: list[str]) -> np.ndarray:
    """Per text how many characters fall in each of 64 bins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) & 63
    row = np.repeat(np.arange(len(texts)), sizes)
    return np.bincount(row * 64 + codes, minlength=64 * len(texts)).reshape(-1, 64)


def best_many(values: list[str | None], vocabulary: tuple[str, ...], least: float, margin: float, fold=None) -> list[str | None]:
    """``best`` of many values: equal ones once, and only those that share enough characters with some entry to come near it."""
    fold = fold or (lambda x: x)
    own = {v: fold(v) for v in set(values) if v is not None}
    names, terms = list(own), [fold(c) for c in vocabulary]
    found: dict[str, str | None] = dict.fromkeys(names)
    if names and terms:
        a, b = _counts([own[v] for v in names]), _counts(terms)
        size_a, size_b = a.sum(1), b.sum(1)
        near = np.zeros(len(names), bool)
        for term, size in zip(b, size_b, strict=True):
            both = size_a + size
            near |= 2 * np.minimum(a, term).sum(1) >= (least - 1e-9) * np.maximum(both, 1)
        for i in np.flatnonzero(near):
            found[names[i]] = best(names[i], vocabulary, least, margin, fold)
    return [None if v is None else found[v] for v in values]


def compare_text(value: str) -> str:
    """Casefolded, separators as spaces, nothing but a-z, 0-9 and spaces."""
    import re

    return re.sub(r" +", " ", re.sub(r"[^a-z0-9 ]", "", re.sub(r"[\s_-]+", " ", value.casefold()))).strip()


def unaccented(value: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))


@F.pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


#: From this ratio on two readings are one value; or from this share of a case's value that a page's longer one holds.
SAME, COVERED = 0.85, 0.80


def alike(case_value: str, page_value: str) -> bool:
    """Whether a page's value is the case's value read badly, in any case of letters."""
    a, b = case_value.casefold().strip(), page_value.casefold().strip()
    if not a or not b:
        return False
    m = SequenceMatcher(None, a, b)
    return m.ratio() >= SAME or sum(x.size for x in m.get_matching_blocks()) / len(a) >= COVERED


#: Pairs of names that a worker remembers.
REMEMBERED = 1_000_000
_alike: dict[str, dict[str, bool]] = {}
_remembered = 0


def alike_among(case_values: list[str], page_value: str) -> list[bool]:
    """``alike`` of each case value and the page's: of pairs not seen before, only those that share enough characters are compared."""
    global _remembered
    if _remembered > REMEMBERED:
        _alike.clear()
        _remembered = 0
    known = _alike.setdefault(page_value, {})
    new = [c for c in case_values if c not in known]
    if new:
        own, counts = _counts([page_value.casefold().strip()])[0], _counts([c.casefold().strip() for c in new])
        common, size = np.minimum(counts, own).sum(1), counts.sum(1)
        near = (2 * common >= (SAME - 1e-9) * (size + own.sum())) | (common >= (COVERED - 1e-9) * size)
        known |= {c: bool(n) and alike(c, page_value) for c, n in zip(new, near, strict=True)}
        _remembered += len(new)
    return [known[c] for c in case_values]


@F.pandas_udf(StringType())
def without_accents(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unaccented(x))


def with_best_match(df: DataFrame, column: str, vocabulary: tuple[str, ...], least: float = 0.72, margin: float = 0.08, out: str = "matched") -> DataFrame:
    """The frame with its column's best match, computed once per distinct value that is not in the vocabulary."""

    @F.pandas_udf("string")
    def match(s: pd.Series) -> pd.Series:
        return pd.Series(best_many(s.tolist(), vocabulary, least, margin, compare_text), dtype="object")

    near = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*vocabulary)).select(F.col(column).alias("_value")).distinct().withColumn("_match", match("_value"))
    joined = df.join(near, df[column] == near["_value"], "left")
    return joined.withColumn(out, F.when(F.col(column).isin(*vocabulary), F.col(column)).otherwise(F.col("_match"))).drop("_value", "_match")
