"""A page from its assessment to its fields: route, reading, other orientations, mended tears, set upright, lines read again.

Every way to read a page is a candidate with a score; a later candidate takes the
place of the one before only if it scores higher. An engine that reads images is a
function of the caller (see ``images``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import raster
from ..functions.stored import checkpointed
from . import images, observe, pages

# Fields that a page of each type should have, and how a single line is read again.
REQUIRED = {kind: tuple(fields) for kind, fields in pages.PATTERNS.items() if kind != "adjudicator_note"}
LINE_CONFIGS, LINE_PADDING = ("--oem 3 --psm 11", "--oem 3 --psm 7", "--oem 3 --psm 6"), 10
_CANDIDATE = ("reading", "document_type", "fields", "score")


def _judged(rows: DataFrame, reading: Column, out: str) -> DataFrame:
    """The rows with a struct of the candidate that a reading makes; null for no reading."""
    text = F.coalesce(F.col("_r.text"), F.lit(""))
    r = rows.withColumn("_r", reading)
    r = r.withColumn("_c", pages.classified(text)).withColumn("_f", pages.extracted(F.col("_c.document_type"), text))
    score = pages.candidate_score(text, F.col("_r.confidence"), F.col("_c.document_type") != "unknown", F.col("_c.score"), F.col("_c.confidence"), observe.field_count(F.col("_f")))
    made = F.struct(F.col("_r").alias("reading"), F.col("_c.document_type").alias("document_type"), F.col("_f").alias("fields"), score.alias("score"))
    return r.withColumn(out, F.when(F.col("_r").isNotNull(), made)).drop("_r", "_c", "_f")


def _read(image: Column, engine: images.Engine, config: str, clahe: Column, prepare=None) -> Column:
    """What the engine reads of an image prepared by its profile; null for a null image."""

    @F.pandas_udf("array<struct<text:string,confidence:double>>")
    def run(column: pd.DataFrame, spread: pd.Series) -> pd.Series:
        found = []
        for a, c in zip(images._rows(column), spread, strict=True):
            a = a if a is None or prepare is None else prepare(a)
            found.append(None if a is None else [{"text": t, "confidence": float(s)} for t, s in engine(images.prepared(a, bool(c)), config)])
        return pd.Series(found, dtype="object")

    words = run(image, clahe)
    return F.when(words.isNotNull(), images.words_read(words))


def torn_mended(a: np.ndarray) -> np.ndarray | None:
    out, moved = raster.repaired(a) if raster.torn(a) else (a, 0)
    return out if moved else None


def lines_aligned(a: np.ndarray) -> np.ndarray | None:
    out, moved = raster.aligned(a)
    return out if moved else None


def set_upright(a: np.ndarray) -> np.ndarray | None:
    """By its ruled lines, if they lean by two degrees or more."""
    found = raster.page_geometry(a)
    if found is None or max(map(abs, found)) < raster.LEAST_SKEW:
        return None
    return raster.straightened(a, *found)


def _better(rows: DataFrame, new: str) -> DataFrame:
    """The new candidate in place of the best one where it scores higher, and a column that tells so."""
    wins = F.coalesce(F.col(f"{new}.score") > F.col("best.score"), F.lit(False))
    return rows.withColumn(f"{new}_applied", wins).withColumn("best", F.when(wins, F.col(new)).otherwise(F.col("best")))


def lines_read_again(rows: DataFrame, engine: images.Engine, lines: str = "lines") -> DataFrame:
    """The rows with fields that stand in orphan lines filled in, each line cut out, cleaned by its own floor and read by itself.

    ``rows`` has image, document_type, fields and an array of lines (text, top,
    height); found values fill missing fields only.
    """
    known = F.filter(F.map_values("fields"), lambda v: F.coalesce(v, F.lit("")) != "")
    texts = observe.orphans(F.transform(lines, lambda x: x["text"]), known)
    r = rows.withColumn("_orphans", F.filter(lines, lambda x: F.array_contains(texts, x["text"])))

    @F.pandas_udf("array<array<string>>")
    def run(column: pd.DataFrame, orphans: pd.Series) -> pd.Series:
        found = []
        for a, lines_ in zip(images._rows(column), orphans, strict=True):
            read = []
            for line in lines_ if a is not None and lines_ is not None else []:
                part = a[max(0, line["top"] - LINE_PADDING) : line["top"] + line["height"] + LINE_PADDING]
                if part.size:
                    part = raster.equalized(raster.without_faint(part, raster.ink_floor(part)))
                    read.append([" ".join(t.strip() for t, _ in engine(part, c) if t.strip()) for c in LINE_CONFIGS])
            found.append(read)
        return pd.Series(found, dtype="object")

    r = checkpointed(r.withColumn("_read", run("image", "_orphans"))).withColumn("_texts", F.flatten("_read"))
    maps = F.transform("_texts", lambda x: pages.extracted(F.col("document_type"), x))
    # Of several readings the first that has a field counts.
    first = F.aggregate(maps, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(m, F.map_filter(x, lambda k, v: ~F.map_contains_key(m, k))))
    out = None
    for kind, wanted in REQUIRED.items():
        made = observe.filled(F.col("fields"), F.col("_new"), list(wanted))
        out = F.when(F.col("document_type") == kind, made) if out is None else out.when(F.col("document_type") == kind, made)
    r = r.withColumn("_new", first).withColumn("_filled", out.otherwise(F.col("fields")))
    return r.withColumn("line_retry_applied", ~F.map_entries("_filled").eqNullSafe(F.map_entries("fields"))).withColumn("fields", F.col("_filled")).drop("_orphans", "_read", "_texts", "_new", "_filled")


def processed(pages_: DataFrame, engine: images.Engine, config: str = "--oem 3 --psm 11") -> DataFrame:
    """Pages with their text, its source, type, fields, case id candidates and what was tried.

    ``pages_`` has native_text, native_text_usable, suspicious_text_layer,
    quality_class, low_contrast, low_sharpness, image and any keys. Each step is
    written down, since a reading is dear and decides what follows.
    """
    p = pages_.withColumn("route", pages.route(F.col("native_text_usable"), F.col("suspicious_text_layer"), F.col("quality_class"), F.col("low_contrast"), F.col("low_sharpness")))
    clahe, image = F.col("route.enhance_contrast"), F.col("image")
    reading = F.when(F.col("route.run_ocr"), image)
    r = checkpointed(_judged(p, _read(reading, engine, config, clahe), "best"))
    again = F.col("route.run_ocr") & observe.read_again(F.col("best.document_type"), F.col("best.fields"), F.col("best.reading.confidence"))
    r = r.withColumn("orientation_retry_attempted", F.coalesce(again, F.lit(False))).withColumn("selected_rotation", F.lit(0))
    for degrees in (90, 180, 270):
        asked = F.when(F.col("orientation_retry_attempted"), image)
        r = _judged(r, _read(asked, engine, config, clahe, lambda a, d=degrees: raster.rotated(a, d)), "turned")
        r = checkpointed(_better(r, "turned").withColumn("selected_rotation", F.when(F.col("turned_applied"), degrees).otherwise(F.col("selected_rotation"))).drop("turned", "turned_applied"))

    @F.pandas_udf(images.IMAGE)
    def set_right(column: pd.DataFrame, degrees: pd.Series) -> pd.DataFrame:
        return images._frame([None if a is None else raster.grey(raster.rotated(a, int(d))) for a, d in zip(images._rows(column), degrees, strict=True)])

    r = checkpointed(r.withColumn("_upright", F.when(F.col("route.run_ocr"), set_right("image", "selected_rotation"))))
    for name, f in (("mended", torn_mended), ("aligned", lines_aligned), ("straight", set_upright)):
        r = checkpointed(_better(_judged(r, _read(F.col("_upright"), engine, config, clahe, f), name), name))
    r = r.withColumn("tear_repair_attempted", F.col("mended").isNotNull() | F.col("aligned").isNotNull()).withColumn("tear_repair_applied", F.col("mended_applied") | F.col("aligned_applied"))
    r = r.withColumn("geometry_correction_attempted", F.col("straight").isNotNull()).withColumn("geometry_correction_applied", F.col("straight_applied")).drop("mended", "aligned", "straight", "mended_applied", "aligned_applied", "straight_applied")
    native = F.col("route.use_native_text")
    text = F.when(native, F.coalesce("native_text", F.lit(""))).otherwise(F.coalesce("best.reading.text", F.lit("")))
    r = r.withColumn("text", text).withColumn("text_source", F.when(native, "native_text").when(F.col("route.run_ocr"), "ocr").otherwise("none"))
    r = r.withColumn("document_type", pages.classified(F.col("text"))["document_type"]).withColumn("fields", pages.extracted(F.col("document_type"), F.col("text")))
    return r.withColumn("case_id_candidates", observe.id_candidates(F.col("text"))).drop("best", "_upright")
