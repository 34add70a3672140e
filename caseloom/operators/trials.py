"""Trials of reading configurations: the grid, recovery of expected values, ranks; and regions of a page."""

from __future__ import annotations

from difflib import SequenceMatcher
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.text import collapsed, stripped

# The grid of configurations.
GRID = {"dpi": (200, 300, 400), "grayscale": (True,), "clahe": (False, True), "denoise": (False,), "upscale": (1.0, 1.5, 2.0), "sharpen_method": ("none", "unsharp", "laplacian"), "threshold_method": ("none",), "invert": (False,), "psm": (3, 6, 11, 12)}
#: Similarity from which on a value counts as recovered in part.
FUZZY = 0.72


def grid(spark: SparkSession, values: dict[str, tuple] = GRID) -> DataFrame:
    """Every combination of the values, a row each."""
    return spark.createDataFrame([dict(zip(values, row, strict=True)) for row in product(*values.values())]).select(*values)


def prose(text: Column) -> Column:
    """Lower case, everything but a-z, 0-9 and white space as spaces, collapsed."""
    return collapsed(F.regexp_replace(F.lower(text), r"(?U)[^a-z0-9\s]", " "))


def compact(text: Column) -> Column:
    """The letters and digits of a value alone."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def phrases_found(text: Column, phrases: Column) -> Column:
    """Struct of the share of an array's phrases that a text holds, and those phrases."""
    found = F.filter(phrases, lambda p: F.contains(prose(text), prose(p)))
    return F.struct(F.coalesce(F.try_divide(F.size(found), F.size(phrases)), F.lit(0.0)).alias("share"), found.alias("found"))


def best_window(expected: str, text: str) -> tuple[float, str]:
    """Similarity and words of the run of a text's words that reads most like the expected ones; the shortest and first of equals. Both are prose already."""
    wanted, words = expected.split(), text.split()
    top = (0.0, "")
    if not wanted:
        return top
    for n in range(max(1, len(wanted) - 1), min(len(wanted) + 2, len(words)) + 1):
        for i in range(len(words) - n + 1):
            piece = " ".join(words[i : i + n])
            m = SequenceMatcher(None, expected, piece)
            if m.real_quick_ratio() > top[0] and m.quick_ratio() > top[0] and (score := m.ratio()) > top[0]:
                top = (score, piece)
    return top


@F.pandas_udf(StructType([StructField("score", DoubleType()), StructField("piece", StringType())]))
def _windows(expected: pd.Series, texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([best_window(e or "", t or "") for e, t in zip(expected, texts, strict=True)], columns=["score", "piece"])


def values_found(rows: DataFrame, least: float = FUZZY) -> DataFrame:
    """(text_id, field, value) of a text's expected values, each with outcome exact, fuzzy or miss, its credit and the words found.

    ``rows`` is (text_id, text, field, value). Only values that do not stand in their
    text are searched for by similarity, once per distinct pair.
    """
    exact = F.contains(prose(F.col("text")), prose(F.col("value"))) | F.contains(compact(F.col("text")), compact(F.col("value")))
    r = rows.withColumn("_exact", exact).withColumn("_e", prose(F.col("value"))).withColumn("_t", prose(F.col("text")))
    near = r.where("NOT _exact").select("_e", "_t").distinct().withColumn("_w", _windows("_e", "_t"))
    r = r.join(near, ["_e", "_t"], "left")
    score = F.coalesce(F.col("_w.score"), F.lit(0.0))
    outcome = F.when(F.col("_exact"), "exact").when(score >= least, "fuzzy").otherwise("miss")
    return r.select("text_id", "field", "value", outcome.alias("outcome"), F.when(F.col("_exact"), 1.0).when(score >= least, score).otherwise(0.0).alias("credit"), F.when(F.col("_exact"), F.col("value")).otherwise(F.coalesce("_w.piece", F.lit(""))).alias("found"))


def recovery(found: DataFrame) -> DataFrame:
    """Per text the mean credit of its values, and how many were exact and fuzzy."""
    return found.groupBy("text_id").agg(F.avg("credit").alias("value_score"), F.count_if(F.col("outcome") == "exact").alias("exact"), F.count_if(F.col("outcome") == "fuzzy").alias("fuzzy"))


def ranked(results: DataFrame, top: int = 10) -> DataFrame:
    """The best trials, ranked: by combined score, value score, exact values, then least time."""
    order = (F.desc("combined_score"), F.desc("value_score"), F.desc("exact"), F.asc("seconds"))
    return results.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(W.orderBy(*order)))


# Regions -------------------------------------------------------------------------------------


def pixels(region: Column, width: Column, height: Column, padding: int = 0) -> Column:
    """A region in shares of the page (x1, y1, x2, y2) as pixels, padded and kept on the page. A region that is none fails."""
    inside = F.lit(True)
    for k in ("x1", "y1", "x2", "y2"):
        inside = inside & F.coalesce(region[k].between(0, 1), F.lit(False))
    fine = inside & (region["x2"] > region["x1"]) & (region["y2"] > region["y1"])
    at = lambda k, size: F.floor(region[k] * size).cast("int")
    box = F.struct(
        F.greatest(F.lit(0), at("x1", width) - padding).alias("x1"), F.greatest(F.lit(0), at("y1", height) - padding).alias("y1"),
        F.least(width.cast("int"), at("x2", width) + padding).alias("x2"), F.least(height.cast("int"), at("y2", height) + padding).alias("y2"),
    )
    return F.when(fine, box).otherwise(F.raise_error(F.concat(F.lit("no region: "), F.to_json(region))).cast("struct<x1:int,y1:int,x2:int,y2:int>"))


def valid_region(region: Column) -> Column:
    """Whether coordinates are shares of the page, in order."""
    inside = F.lit(True)
    for k in ("x1", "y1", "x2", "y2"):
        inside = inside & F.coalesce(region[k].between(0, 1), F.lit(False))
    return inside & (region["x2"] > region["x1"]) & (region["y2"] > region["y1"])


def _identifier(x: Column) -> Column:
    return F.upper(F.regexp_replace(x, r"(?U)\s+", ""))


def _date(x: Column) -> Column:
    written = r"\b(20\d{2})[\s./-]+(\d{1,2})[\s./-]+(\d{1,2})\b"
    digits = F.regexp_replace(x, r"\D", "")
    iso = lambda t, p: F.concat_ws("-", F.regexp_extract(t, p, 1), F.lpad(F.regexp_extract(t, p, 2), 2, "0"), F.lpad(F.regexp_extract(t, p, 3), 2, "0"))
    run = r"^(20\d{2})(\d{2})(\d{2})$"
    return F.when(x.rlike(written), iso(x, written)).when(digits.rlike(run), iso(digits, run)).otherwise(collapsed(x))


def _first_word(x: Column, words: dict[str, str], fold) -> Column:
    letters = F.regexp_replace(F.lower(x), "[^a-z]", "")
    out = None
    for word, value in words.items():
        out = F.when(letters.contains(word), value) if out is None else out.when(letters.contains(word), value)
    return out.otherwise(fold(collapsed(x)))


def region_value(field: Column, text: Column) -> Column:
    """What a region's reading says, by the field that the region holds."""
    decision = _first_word(text, {"denied": "DENIED", "approved": "APPROVED", "pending": "PENDING"}, F.upper)
    fee = _first_word(text, {"unpaid": "unpaid", "paid": "paid", "waived": "waived"}, F.lower)
    return (
        F.when(field.isin("case_id", "species_code", "home_world", "visa_class", "sponsor_id"), _identifier(stripped(text))).when(field == "arrival_date", _date(stripped(text)))
        .when(field == "decision", decision).when(field == "fee_status", fee).otherwise(collapsed(text))
    )
