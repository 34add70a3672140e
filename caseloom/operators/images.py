"""Page images in columns: a struct of height, width, channels and pixels, row by row.

Every operator is one Arrow pass over the images of a batch. Reading text needs an
engine that is not part of this library: ``read`` takes one as a function of an image.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import raster

IMAGE = "struct<height:int,width:int,channels:int,pixels:binary>"
#: An engine reads an image with a configuration: words with confidences, -1 where it has none.
Engine = Callable[[np.ndarray, str], list[tuple[str, float]]]
# Profiles of reading, by whether a route enhances contrast.
PROFILES = {False: ("standard", 200, "--oem 3 --psm 11", False), True: ("degraded_scan", 200, "--oem 3 --psm 11", True)}


def _array(row) -> np.ndarray | None:
    if row is None or row["pixels"] is None:
        return None
    a = np.frombuffer(row["pixels"], np.uint8)
    shape = (int(row["height"]), int(row["width"]))
    return a.reshape(shape if int(row["channels"]) == 1 else (*shape, int(row["channels"])))


def _struct(a: np.ndarray) -> dict:
    return {"height": a.shape[0], "width": a.shape[1], "channels": 1 if a.ndim == 2 else a.shape[2], "pixels": np.ascontiguousarray(a).tobytes()}


def _rows(column: pd.DataFrame) -> Iterator[np.ndarray | None]:
    return (_array(r) for r in column.to_dict("records"))


def _frame(images: list) -> pd.DataFrame:
    empty = {"height": None, "width": None, "channels": None, "pixels": None}
    return pd.DataFrame([empty if a is None else _struct(a) for a in images], columns=list(empty)).astype({k: "Int32" for k in ("height", "width", "channels")})


def changed(image: Column, f: Callable[..., np.ndarray], *settings) -> Column:
    """The image as ``f`` makes it; null stays null."""

    @F.pandas_udf(IMAGE)
    def run(column: pd.DataFrame) -> pd.DataFrame:
        return _frame([None if a is None else f(a, *settings) for a in _rows(column)])

    return run(image)


def measured(image: Column, f: Callable[..., object], kind: str, *settings) -> Column:
    """What ``f`` finds in the image, a value of this SQL type; null for null."""

    @F.pandas_udf(kind)
    def run(column: pd.DataFrame) -> pd.Series:
        return pd.Series([None if a is None else f(a, *settings) for a in _rows(column)], dtype="object")

    return run(image)


def rotated(image: Column, degrees: int) -> Column:
    return changed(image, raster.rotated, degrees)


def deskewed(image: Column) -> Column:
    """Turned back if the ink leans by two degrees or more."""
    return changed(image, _upright)


def _upright(a: np.ndarray) -> np.ndarray:
    angle = raster.skew_angle(a)
    return raster.turned(a, angle) if abs(angle) >= raster.LEAST_SKEW else a


def prepared(a: np.ndarray, clahe: bool, deskew: bool = True) -> np.ndarray:
    """An image before reading: upright, faint ink gone by a fixed floor, or by the page's own with contrast spread."""
    a = _upright(a) if deskew else a
    return raster.equalized(raster.without_faint(a, raster.ink_floor(a))) if clahe else raster.without_faint(a)


def configured(a: np.ndarray, setting: dict) -> np.ndarray:
    """An image by one configuration of a trial's grid, its steps in their order."""
    if setting.get("grayscale", True):
        a = raster.grey(a)
    a = raster.upscaled(a, setting.get("upscale", 1.0))
    a = raster.equalized(a) if setting.get("clahe") else a
    a = raster.denoised(a) if setting.get("denoise") else a
    a = {"none": lambda x: x, "unsharp": raster.sharpened, "laplacian": raster.edged}[setting.get("sharpen_method", "none")](a)
    a = raster.thresholded(a, setting.get("threshold_method", "none"))
    return raster.inverted(a) if setting.get("invert") else a


def cropped(a: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """Columns x1 to x2 of rows y1 to y2; a box without area fails."""
    x1, y1, x2, y2 = box
    part = a[y1:y2, x1:x2]
    if not part.size:
        raise ValueError(f"no pixels in {box}")
    return part


def outlined(a: np.ndarray, boxes: list[tuple[int, int, int, int]], level: int = 0) -> np.ndarray:
    """The page with the borders of boxes drawn on it, for looking at templates."""
    out = raster.grey(a).copy()
    for x1, y1, x2, y2 in boxes:
        out[y1:y2, [x1, x2 - 1]] = level
        out[[y1, y2 - 1], x1:x2] = level
    return out


def engine_config(psm: int, whitelist: str | None = None) -> str:
    """How a region's engine is configured: mode of segmentation and, if given, the characters it may find."""
    return f"--oem 3 --psm {psm}" + (f" -c tessedit_char_whitelist={whitelist}" if whitelist else "")


def profile(enhance_contrast: Column) -> Column:
    """The profile of reading that a route asks for."""
    made = lambda p: F.struct(*[F.lit(v).alias(k) for k, v in zip(("name", "render_dpi", "config", "use_clahe"), p, strict=True)])
    return F.when(enhance_contrast, made(PROFILES[True])).otherwise(made(PROFILES[False]))


def words_read(words: Column) -> Column:
    """Struct of text, mean confidence and number of an array of (text, confidence): blank words do not count, confidences under 0 not in the mean."""
    said = F.filter(words, lambda w: F.trim(w["text"]) != "")
    sure = F.filter(F.transform(said, lambda w: w["confidence"].try_cast("double")), lambda c: c >= 0)
    mean = F.try_divide(F.aggregate(sure, F.lit(0.0), lambda a, c: a + c), F.size(sure))
    return F.struct(F.array_join(F.transform(said, lambda w: F.trim(w["text"])), " ").alias("text"), mean.alias("confidence"), F.size(said).alias("words"))


def read(image: Column, engine: Engine, config: str, prepare: Callable[[np.ndarray], np.ndarray] | None = None) -> Column:
    """Text, mean confidence and word count that the engine finds in the image; null for null."""

    @F.pandas_udf("array<struct<text:string,confidence:double>>")
    def run(column: pd.DataFrame) -> pd.Series:
        found = [None if a is None else [{"text": t, "confidence": float(c)} for t, c in engine(prepare(a) if prepare else a, config)] for a in _rows(column)]
        return pd.Series(found, dtype="object")

    return words_read(run(image))


def ways_read(pages: DataFrame, engine: Engine, ways: dict[str, Callable[[np.ndarray], np.ndarray]], config: str) -> DataFrame:
    """Every page read in each of several ways (turned, mended, sharpened): its columns, ``way`` and ``reading``."""
    out = None
    for name, f in ways.items():
        one = pages.withColumn("way", F.lit(name)).withColumn("reading", read(F.col("image"), engine, config, f))
        out = one if out is None else out.unionByName(one)
    return out


def best_way(read_pages: DataFrame, keys: list[str]) -> DataFrame:
    """Per page the way whose reading scores highest, by type, fields and confidence; the first by name of equals."""
    from . import pages

    text = F.col("reading.text")
    c = read_pages.withColumn("_class", pages.classified(text))
    c = c.withColumn("fields", pages.extracted(F.col("_class.document_type"), text))
    known = F.col("_class.document_type") != "unknown"
    score = pages.candidate_score(text, F.col("reading.confidence"), known, F.col("_class.score"), F.col("_class.confidence"), F.size("fields"))
    c = c.withColumn("score", score)
    best = c.groupBy(*keys).agg(F.min_by(F.struct("way", "reading", F.col("_class.document_type").alias("document_type"), "fields", "score"), F.struct(-F.col("score"), "way")).alias("b"))
    return best.select(*keys, "b.*")


def regions_read(pages: DataFrame, templates: DataFrame, engine: Engine, padding: int = 10) -> DataFrame:
    """(page keys, field, box, reading, value) of every template region of a page's type.

    ``pages`` has image and document_type, ``templates`` (document_type, field, region,
    config), a small table that is broadcast.
    """
    from . import trials

    rows = pages.join(F.broadcast(templates), "document_type").withColumn("box", trials.pixels(F.col("region"), F.col("image.width"), F.col("image.height"), padding))

    @F.pandas_udf("array<struct<text:string,confidence:double>>")
    def run(images: pd.DataFrame, boxes: pd.DataFrame, configs: pd.Series) -> pd.Series:
        found = []
        for a, b, config in zip(_rows(images), boxes.to_dict("records"), configs, strict=True):
            found.append(None if a is None else [{"text": t, "confidence": float(c)} for t, c in engine(cropped(a, (b["x1"], b["y1"], b["x2"], b["y2"])), config)])
        return pd.Series(found, dtype="object")

    rows = rows.withColumn("reading", words_read(run("image", "box", "config"))).drop("image", "region")
    return rows.withColumn("value", trials.region_value(F.col("field"), F.col("reading.text")))


def trial_results(pages: DataFrame, settings: list[dict], engine: Engine, expected: DataFrame, phrases: Column, seconds: Column | None = None) -> DataFrame:
    """Every page by every setting: text, scores of recovery, and the combined score.

    ``pages`` is (page_id, image); ``expected`` (page_id, field, value). ``seconds`` is
    what a reading took, where the caller knows it.
    """
    from . import series, trials

    ways = {f"{i:04d}": (lambda s: lambda a: configured(a, s))(s) for i, s in enumerate(settings)}
    out = None
    for name, s in zip(ways, settings, strict=True):
        one = ways_read(pages, engine, {name: ways[name]}, engine_config(s.get("psm", 11)))
        out = one if out is None else out.unionByName(one)
    out = out.drop("image").withColumn("text_id", F.concat_ws("/", "page_id", "way")).withColumn("text", F.col("reading.text"))
    found = trials.recovery(trials.values_found(out.join(expected, "page_id").select("text_id", "text", "field", "value")))
    out = out.join(found, "text_id", "left").na.fill({"value_score": 0.0, "exact": 0, "fuzzy": 0})
    share = trials.phrases_found(F.col("text"), phrases)["share"]
    out = out.withColumn("seconds", seconds if seconds is not None else F.lit(0.0))
    return out.withColumn("combined_score", series.combined_score(share, F.col("value_score"), F.coalesce("reading.confidence", F.lit(0.0)), series.meaningful_share(F.col("text")), F.col("seconds")))


def rendered(spark: SparkSession, files: DataFrame, render: Callable[[bytes], list[np.ndarray]]) -> DataFrame:
    """(case_id, page_number, image) of the pages of files (case_id, content), by a renderer that is not part of this library."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for case, content in zip(frame["case_id"], frame["content"], strict=True):
                for number, a in enumerate(render(content) if content is not None else [], 1):
                    yield pd.DataFrame({"case_id": [case], "page_number": [number], "image": [_struct(a)]})

    return files.select("case_id", "content").mapInPandas(run, f"case_id string, page_number int, image {IMAGE}")


def image_coverage(placements: DataFrame, width: Column, height: Column, keys: list[str]) -> DataFrame:
    """Per page how many images it has, and the share of it that the largest placement covers, at most all of it.

    ``placements`` is (keys, image_id, x0, y0, x1, y1); placements equal to two places count once.
    """
    box = [F.round(c, 2).alias(c) for c in ("x0", "y0", "x1", "y1")]
    area = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")) * F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    share = F.when((width > 0) & (height > 0), F.least(F.lit(1.0), F.coalesce(F.try_divide(area, width * height), F.lit(0.0)))).otherwise(0.0)
    seen = placements.withColumn("_share", share).groupBy(*keys, "image_id", *box).agg(F.max("_share").alias("_share"))
    return seen.groupBy(*keys).agg(F.countDistinct("image_id").alias("images"), F.max("_share").alias("coverage"))


