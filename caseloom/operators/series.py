"""Ordered analytics: outliers, bands, tracks, cascades from an anchor, robust medians and fits, page quality, recall of phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def absorbed(rows: DataFrame, keys: list[str], order: str, value: str, far: float) -> DataFrame:
    """A value that differs from both neighbours as they were read, which agree, takes theirs; ``without_outlier_bands`` looks at the cleaned neighbour."""
    w = W.partitionBy(*keys).orderBy(order)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    lone = (F.abs(before - after) <= far) & (F.abs(F.col(value) - before) > far) & (F.abs(F.col(value) - after) > far)
    return rows.withColumn("cleaned", F.when(F.coalesce(lone, F.lit(False)), before).otherwise(F.col(value)))


def cascaded(rows: DataFrame, keys: list[str], order: str, step: str, anchor: str) -> DataFrame:
    """Running sums of steps, zero at the anchor (the row of greatest ``anchor``, first of equals), in both directions."""
    w = W.partitionBy(*keys).orderBy(order)
    running = F.sum(step).over(w.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_run", running)
    at = F.max_by("_run", F.struct(F.col(anchor), -F.col(order))).over(W.partitionBy(*keys))
    return rows.withColumn("shift", F.col("_run") - at).drop("_run")


def trimmed_fit(rows: DataFrame, keys: list[str], x: str, y: str, share: float = 2.5, rounds: int = 4) -> DataFrame:
    """Slope and intercept per group, fitted again up to ``rounds`` times without the points whose residual is ``share`` times the spread or more.

    The spread is the standard deviation of the absolute residuals. A group is done
    when its points lie on a line, or when fewer than four or three tenths of the
    points of the round would stay.
    """
    left = rows.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), F.lit(False).alias("_done"))
    group = W.partitionBy(*keys)
    for _ in range(rounds):
        fit = left.withColumn("_s", F.regr_slope("_y", "_x").over(group)).withColumn("_i", F.regr_intercept("_y", "_x").over(group))
        r = fit.withColumn("_r", F.abs(F.col("_y") - (F.col("_s") * F.col("_x") + F.col("_i")))).withColumn("_d", F.stddev_pop("_r").over(group))
        r = r.withColumn("_k", F.col("_r") < share * F.col("_d")).withColumn("_n", F.count(F.lit(1)).over(group)).withColumn("_m", F.count_if("_k").over(group))
        r = r.withColumn("_done", F.col("_done") | F.coalesce(F.col("_d") < 1e-9, F.lit(True)) | (F.col("_m") < F.greatest(F.lit(4), F.floor(0.3 * F.col("_n")))))
        left = r.where("_done OR _k").select(*keys, "_x", "_y", "_done")
    return left.groupBy(*keys).agg(F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"), F.count(F.lit(1)).alias("n"))


def robust_median(rows: DataFrame, keys: list[str], value: str, k: float = 3.0) -> DataFrame:
    """The median of the values nearer to the median than k times the median distance from it; the plain median if none is."""
    v = F.col(value).cast("double")
    m = rows.groupBy(*keys).agg(F.median(v).alias("_m"))
    near = rows.join(m, keys).withColumn("_a", F.abs(v - F.col("_m")))
    mad = near.groupBy(*keys).agg((F.median("_a") + 1e-6).alias("_mad"))
    return near.join(mad, keys).groupBy(*keys, "_m").agg(F.median(F.when(F.col("_a") < k * F.col("_mad"), v)).alias("_kept")).select(*keys, F.coalesce("_kept", "_m").alias("median"))


def darkest(rows: DataFrame, keys: list[str], value: str, share: float = 0.55, least: int = 3) -> DataFrame:
    """The rows up to a group's percentile; all rows of a group where fewer than ``least`` are."""
    p = rows.groupBy(*keys).agg(F.percentile(value, share).alias("_p"))
    marked = rows.join(p, keys).withColumn("_dark", F.col(value) <= F.col("_p"))
    n = F.count_if("_dark").over(W.partitionBy(*keys))
    return marked.withColumn("_n", n).where((F.col("_n") < least) | F.col("_dark")).drop("_p", "_dark", "_n")


def continuous(rows: DataFrame, keys: list[str], order: str, value: str, near: int = 10, within: float = 6.0, share: float = 0.5) -> DataFrame:
    """Values without those that fewer than ``share`` of the values ``near`` rows around agree with; every position has a row, a missing value is null."""
    around = F.collect_list(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(-near, near))
    agree = F.size(F.filter("_near", lambda x: F.abs(x - F.col(value)) <= within))
    return rows.withColumn("_near", around).withColumn("kept", F.when(F.try_divide(agree, F.size("_near")) >= share, F.col(value))).drop("_near")


def tracked(values: Column, within: float) -> Column:
    """Per position of an array of candidate arrays the candidate nearest to the one taken before, if it is near enough; else null, and the one before stays."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.array().cast("array<double>").alias("path"))

    def step(acc: Column, candidates: Column) -> Column:
        last = acc["last"]
        ranked = F.array_sort(F.transform(candidates, lambda c, i: F.struct(F.coalesce(F.abs(c - last), F.lit(0.0)).alias("d"), i.alias("i"), c.cast("double").alias("c"))))
        best = F.get(ranked, 0)
        taken = F.when(best.isNotNull() & (last.isNull() | (best["d"] <= within)), best["c"])
        return F.struct(F.coalesce(taken, last).alias("last"), F.array_append(acc["path"], taken).alias("path"))

    return F.aggregate(values, start, step, lambda acc: acc["path"])


def without_outlier_bands(bands: Column, short: int = 40, agreeing: float = 10.0, deviating: float = 30.0) -> Column:
    """An array of bands (top, bottom, off), where a short band between two that agree, which it does not, goes to the band kept before."""
    def step(acc: Column, i: Column) -> Column:
        band, last, after = F.element_at(bands, i), F.element_at(acc, -1), F.get(bands, i)
        lone = (band["bottom"] - band["top"] <= short) & (F.abs(last["off"] - after["off"]) <= agreeing) & (F.abs(band["off"] - last["off"]) >= deviating) & (F.abs(band["off"] - after["off"]) >= deviating)
        longer = F.struct(last["top"].alias("top"), band["bottom"].alias("bottom"), last["off"].alias("off"))
        taken = F.coalesce(lone, F.lit(False))
        return F.when(taken, F.array_append(F.slice(acc, 1, F.size(acc) - 1), longer)).otherwise(F.array_append(acc, band))

    rest = F.when(F.size(bands) > 1, F.sequence(F.lit(2), F.size(bands))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rest, F.slice(bands, 1, 1), step)


def bands(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys, top, bottom, off): runs of rows around one value; a run ends where a value leaves the median of the run so far.

    The running median of a run is no window frame: each group is one Arrow frame,
    which is a page's rows. ``order`` counts a group's rows from 0 without gaps.
    """
    import pandas as pd

    from ..functions import raster

    schema = rows.select(*keys, F.col(order).cast("long").alias("top"), F.col(order).cast("long").alias("bottom"), F.col(value).cast("double").alias("off")).schema

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        found = raster.bands(frame[value].to_numpy(dtype=float, na_value=float("nan")))
        return pd.DataFrame([(*[frame[k].iloc[0] for k in keys], *b) for b in found], columns=[*keys, "top", "bottom", "off"])

    return rows.groupBy(*keys).applyInPandas(run, schema)


def page_quality(words: Column, characters: Column, scanned: Column, contrast: Column, sharpness: Column, least_words: int = 15, least_characters: int = 80, least_contrast: float = 25.0, least_sharpness: float = 20.0) -> Column:
    """The quality class of a page."""
    enough = (words >= least_words) & (characters >= least_characters)
    clear = (contrast >= least_contrast) & (sharpness >= least_sharpness)
    return F.when(enough & ~scanned, "digital_clean").when(scanned & clear, "scan_readable").when(scanned, "scan_degraded").when(enough, "mixed_content").otherwise("insufficient_evidence")


def phrase_recall(text: Column, phrases: list[str]) -> Column:
    """Share of the phrases that a text contains."""
    low = F.lower(text)
    return sum((F.when(low.contains(p.lower()), 1).otherwise(0) for p in phrases), F.lit(0)) / F.lit(float(len(phrases)))


def meaningful_share(text: Column) -> Column:
    """Share of the words that are three or more plain letters."""
    words = F.filter(F.split(F.trim(text), r"(?U)\s+"), lambda w: w != "")
    good = F.filter(words, lambda w: w.rlike("^[A-Za-z]{3,}$"))
    return F.coalesce(F.try_divide(F.size(good), F.size(words)), F.lit(0.0))


def combined_score(phrases: Column, values: Column, confidence: Column, meaningful: Column, seconds: Column) -> Column:
    """A configuration's score: recovered field values count most, time a little."""
    sure = F.least(F.greatest(confidence / 100.0, F.lit(0.0)), F.lit(1.0))
    return 0.55 * values + 0.20 * phrases + 0.15 * meaningful + 0.10 * sure - 0.05 * F.least(seconds / 3.0, F.lit(1.0))


def quality_summary(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per document the number of pages of each quality class, and the pages that need reading and those with a suspicious text layer."""
    listed = lambda test: F.array_sort(F.collect_list(F.when(test, F.col("page_number"))))
    lists = pages.groupBy(*keys).agg(listed(F.col("ocr_required")).alias("ocr_required_pages"), listed(F.col("suspicious_text_layer")).alias("suspicious_text_layer_pages"))
    counts = pages.groupBy(*keys, "quality_class").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("quality_class", "n")))).alias("quality_class_counts"))
    return counts.join(lists, keys)
