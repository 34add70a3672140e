"""Image functions against plain loops, and on pages that were damaged on purpose."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.functions import raster
from caseloom.operators import flow, images, series, trials


def noise(seed=0, height=23, width=31):
    return np.random.default_rng(seed).integers(0, 256, (height, width)).astype(np.uint8)


def page(seed=1, height=400, width=300):
    """Border on the left, lines of text that begin at one column."""
    r = np.random.default_rng(seed)
    out = np.full((height, width), 255, np.uint8)
    out[:, 10:15] = 0
    strokes = np.where(r.random(160) < 0.5, 0, 255)
    for y in range(20, height - 20, 20):
        out[y : y + 9, 60:220] = strokes
        out[y : y + 9, 60:64] = 0
    return out


def mirrored(i, n):
    i = -i if i < 0 else i
    return 2 * (n - 1) - i if i >= n else i


def test_otsu_and_floors():
    for seed in range(5):
        g = np.random.default_rng(seed).choice([10, 40, 41, 180, 200, 255], (9, 9)).astype(np.uint8)
        spread = []
        for t in range(256):
            a, b = g[g <= t].astype(float), g[g > t].astype(float)
            spread.append(len(a) * len(b) * (a.mean() - b.mean()) ** 2 if len(a) and len(b) else -1)
        assert raster.otsu(g) == int(np.argmax(spread))
    assert raster.ink_floor(np.full((50, 50), 255, np.uint8)) == 195 and raster.ink_floor(page()) == 195
    faint = np.where(page() == 0, 205, 255).astype(np.uint8)
    faint[::2] = np.where(faint[::2] == 205, 228, 255)
    assert 195 < raster.ink_floor(faint) <= 230
    assert (raster.without_faint(np.array([[194, 195, 254]], np.uint8)) == [[194, 255, 255]]).all()


@pytest.mark.parametrize("method", ["adaptive_mean", "adaptive_gaussian"])
def test_thresholds(method):
    g, block = noise(), 7
    half = block // 2
    k = np.ones(block) / block if method == "adaptive_mean" else raster._gauss(0.3 * ((block - 1) * 0.5 - 1) + 0.8, block)
    want = np.zeros_like(g)
    for y in range(g.shape[0]):
        for x in range(g.shape[1]):
            mean = sum(k[dy] * k[dx] * float(g[min(max(y + dy - half, 0), g.shape[0] - 1), min(max(x + dx - half, 0), g.shape[1] - 1)]) for dy in range(block) for dx in range(block))
            want[y, x] = 255 if g[y, x] > round(mean + 1e-9) - 15 else 0
    assert (raster.thresholded(g, method, block) != want).mean() < 0.01  # means that end in a half may round either way
    assert (raster.thresholded(g, "otsu") == np.where(g > raster.otsu(g), 255, 0)).all()
    with pytest.raises(ValueError):
        raster.thresholded(g, "other")


def test_equalized_tile_by_tile():
    g = noise(3, 32, 48)
    high, wide, clip = 4, 6, max(1, int(2.0 * 24 / 256))
    maps = np.zeros((8, 8, 256))
    for a in range(8):
        for b in range(8):
            count = [0] * 256
            for v in g[a * high : (a + 1) * high, b * wide : (b + 1) * wide].ravel():
                count[v] += 1
            spare = sum(max(0, c - clip) for c in count)
            count = [min(c, clip) + spare // 256 for c in count]
            rest = spare % 256
            for i in range(0, 256, max(1, 256 // rest) if rest else 1):
                if rest <= 0:
                    break
                count[i] += 1
                rest -= 1
            maps[a, b] = np.minimum(255, np.rint(np.cumsum(count) * 255 / 24))
    want = np.zeros_like(g)
    for y in range(32):
        for x in range(48):
            v, fy, fx = g[y, x], y / high - 0.5, x / wide - 0.5
            a, b = math.floor(fy), math.floor(fx)
            at = lambda i, j: maps[min(max(i, 0), 7), min(max(j, 0), 7), v]  # noqa: B023, E731
            top, low = (at(i, b) * (1 - fx + b) + at(i, b + 1) * (fx - b) for i in (a, a + 1))
            want[y, x] = np.rint(top * (1 - fy + a) + low * (fy - a))
    assert np.abs(raster.equalized(g).astype(int) - want).max() <= 1
    assert raster.equalized(noise(1, 5, 3)).shape == (5, 3)


def test_denoised_and_sharpened():
    g = noise(2, 9, 8)
    n, m = g.shape
    value = lambda y, x: float(g[mirrored(y, n), mirrored(x, m)])
    want = np.zeros(g.shape)
    for y in range(n):
        for x in range(m):
            total = weight = 0.0
            for dy in range(-2, 3):
                for dx in range(-2, 3):
                    d = sum((value(y + i, x + j) - value(y + dy + i, x + dx + j)) ** 2 for i in (-1, 0, 1) for j in (-1, 0, 1)) / 9
                    w = math.exp(-d / 50.0**2)
                    total, weight = total + w * value(y + dy, x + dx), weight + w
            want[y, x] = total / weight
    assert np.abs(raster.denoised(g, 50.0, 3, 5) - want).max() <= 0.51
    k = raster._gauss(1.0, 7)
    for y in range(n):
        for x in range(m):
            soft = round(sum(k[i] * k[j] * value(y + i - 3, x + j - 3) for i in range(7) for j in range(7)))
            assert abs(int(raster.sharpened(g)[y, x]) - min(255, max(0, round(2.5 * value(y, x) - 1.5 * soft)))) <= 2
            lap = 2 * sum(value(y + i, x + j) for i in (-1, 1) for j in (-1, 1)) - 8 * value(y, x)
            assert raster.edged(g)[y, x] == int(min(255, max(0, value(y, x) - 0.5 * lap)))


def test_geometry():
    g = noise(4, 6, 5)
    assert (raster.rotated(g, 90) == [[g[5 - x, y] for x in range(6)] for y in range(5)]).all() and (raster.rotated(raster.rotated(g, 90), 270) == g).all()
    assert raster.upscaled(g, 2.0).shape == (12, 10) and (raster.upscaled(g, 1.0) == g).all()
    flat = np.full((8, 8), 77, np.uint8)
    assert (raster.upscaled(flat, 1.5) == 77).all() and (raster.turned(flat, 5.0) == 77).all()
    assert (raster.straightened(page(), 0.0, 0.0) == page()).all()
    for angle in (3.0, -4.0, 10.0):
        assert abs(raster.skew_angle(raster.turned(page(), angle)) + angle) < 0.3
    assert raster.skew_angle(page()) == 0 and raster.skew_angle(np.full((9, 9), 255, np.uint8)) == 0
    lean = raster.turned(page(), 2.0)  # counterclockwise: rows rise to the right
    apart = lambda a: np.abs(a[60:340, 60:200].astype(int) - page()[60:340, 60:200]).mean()
    assert apart(raster.straightened(lean, -2.0, 0.0)) < 0.4 * apart(lean)
    assert raster.contrast(np.array([[0, 2]], np.uint8)) == 1.0 and raster.sharpness(np.zeros((1, 1), np.uint8)) == 0


def test_tears_are_mended():
    whole = page()
    torn = whole.copy()
    torn[150:260] = raster._moved(whole[150:260], -35)
    assert raster.torn(torn) and not raster.torn(whole) and not raster.torn(np.full((50, 50), 255, np.uint8))
    assert raster.bands(raster.offsets(torn)) == [(0, 150, 0.0), (150, 260, 35.0), (260, 400, 0.0)]
    assert raster.text_shift(torn, 150) == 35 and raster.text_shift(np.full((50, 50), 255, np.uint8), 20) is None
    mended, moved = raster.repaired(torn)
    assert moved == 1 and (mended != whole)[:259].sum() == 0 and (mended != whole).any(1).sum() <= 1  # the border of a band moves off a line of text
    torn[:, :55] = 255  # without the border, which would join the lines between
    lines, moved = raster.aligned(torn)
    assert moved >= 5 and (lines[:, 60:220] != whole[:, 60:220]).mean() < 0.02
    assert raster.repaired(np.full((50, 50), 255, np.uint8))[1] == 0


def test_bands_and_edges():
    off = np.array([0.0] * 12 + [np.nan] * 3 + [40.0] * 15 + [1.0] * 5 + [2.0] * 15)
    assert raster.bands(off) == [(0, 15, 0.0), (15, 30, 40.0), (30, 50, 2.0)]
    assert raster.without_outliers([(0, 50, 0.0), (50, 80, 60.0), (80, 99, 4.0)]) == [(0, 80, 0.0), (80, 99, 4.0)]
    assert raster.without_outliers([(0, 50, 0.0), (50, 95, 60.0), (95, 99, 4.0)])[1] == (50, 95, 60.0)
    text = np.zeros(60, bool)
    text[28:33] = True
    assert raster.snapped([(0, 30, 0.0), (30, 60, 9.0)], text) == [(0, 27, 0.0), (27, 60, 9.0)]
    edges = [(5.0, 6.0), (0.0, 0.5), (8.0, 7.0), (3.0, 3.0)]
    want = [0.0] * 4
    want[0] = edges[1][0] + 0.0 - edges[0][1]
    want[2] = edges[1][1] - edges[2][0]
    want[3] = edges[2][1] + want[2] - edges[3][0]
    assert np.allclose(raster.cascade(edges), want) and raster.cascade([]) == []
    assert raster.edge_values(np.array([1.0, np.nan, 3.0, 9.0]), 0, 4) == (1.0, 6.0) and raster.edge_values(np.full(4, np.nan), 0, 4) == (0.0, 0.0)


def test_continuity_and_bands_as_frames(spark):
    r = np.random.default_rng(5)
    marks = np.where(r.random(120) < 0.2, np.nan, np.where(r.random(120) < 0.7, 50.0 + r.integers(0, 5, 120), r.integers(0, 200, 120)))
    rows = spark.createDataFrame([("p", y, None if np.isnan(v) else float(v)) for y, v in enumerate(marks)], "p string, y long, v double").repartition(3)
    got = [x.kept for x in series.continuous(rows, ["p"], "y", "v").orderBy("y").collect()]
    assert got == [None if np.isnan(v) else v for v in raster.continuous(marks)]
    assert [tuple(b)[1:] for b in series.bands(rows, ["p"], "y", "v").orderBy("top").collect()] == raster.bands(marks)
    found = [(0, 50, 0.0), (50, 80, 60.0), (80, 99, 4.0), (99, 110, -40.0), (110, 150, 5.0)]
    b = spark.createDataFrame([(found,), (found[:1],), ([],)], "b array<struct<top:int,bottom:int,off:double>>")
    assert [[tuple(x) for x in y.c] for y in b.select(series.without_outlier_bands(F.col("b")).alias("c")).collect()] == [raster.without_outliers(found), found[:1], []]


def as_row(a):
    return (a.shape[0], a.shape[1], 1, bytearray(a.tobytes()))


def made_engine():
    """A function that goes to the workers whole."""

    def toy_engine(a, config):
        """Reads an upright mark, a dark block in the top left corner; anything else is noise."""
        sure = float(100 - a[:4, :4].mean() / 255 * 90)
        words = "MIB Fee Receipt Case ID: MIB-000123 Fee Status: paid Amount: $120.00 Waiver Code: N/A".split() if a[:4, :4].max() < 128 else ["zzz"]
        return [(w, sure) for w in words] + [(" ", 50.0), ("", -1.0)]

    return toy_engine


def test_images_in_columns(spark):
    toy_engine = made_engine()
    upright = np.full((20, 30), 255, np.uint8)
    upright[:5, :5] = 0
    rows = [("a", as_row(upright)), ("b", as_row(raster.rotated(upright, 90))), ("c", None)]
    df = spark.createDataFrame(rows, f"page_id string, image {images.IMAGE}").repartition(2)
    r = {x.page_id: x for x in df.select("page_id", images.rotated(F.col("image"), 180).alias("i"), images.measured(F.col("image"), raster.contrast, "double").alias("c"), images.deskewed(F.col("image")).alias("d")).collect()}
    assert bytes(r["a"].i.pixels) == raster.rotated(upright, 180).tobytes() and (r["b"].i.height, r["b"].i.width) == (30, 20)
    assert r["c"].c is None and r["c"].i.pixels is None and abs(r["a"].c - upright.std()) < 1e-9
    ways = {str(d): (lambda d: lambda a: raster.rotated(a, d))(d) for d in (0, 90, 180, 270)}
    best = {x.page_id: x for x in images.best_way(images.ways_read(df, toy_engine, ways, "--psm 11"), ["page_id"]).collect()}
    assert (best["a"].way, best["b"].way) == ("0", "270") and best["b"].document_type == "fee_receipt" and best["b"].fields["fee_status"] == "paid"
    assert best["a"].reading.words == 14 and best["c"].reading.text is None
    regions = spark.createDataFrame([("x", "fee_status", (0.0, 0.0, 0.5, 0.5), images.engine_config(7, "ab"))], "document_type string, field string, region struct<x1:double,y1:double,x2:double,y2:double>, config string")
    got = images.regions_read(df.where("page_id = 'a'").withColumn("document_type", F.lit("x")), regions, toy_engine, 2).first()
    assert tuple(got.box) == (0, 0, 17, 12) and got.value == "paid" and got.config == "--oem 3 --psm 7 -c tessedit_char_whitelist=ab"
    expected = spark.createDataFrame([("a", "fee", "paid"), ("a", "id", "MIB-000124")], "page_id string, field string, value string")
    settings = [{"psm": 3, "clahe": False}, {"psm": 6, "invert": True}]
    res = images.trial_results(df.where("page_id <> 'c'"), settings, toy_engine, expected, F.array(F.lit("Fee status"), F.lit("nothing")))
    top = trials.ranked(res, 1).first()
    assert top.page_id == "a" and top.way == "0000" and top.exact == 1 and top.fuzzy == 1
    outlined = images.outlined(upright, [(10, 5, 15, 12)])
    assert (outlined[5, 10:15] == 0).all() and outlined[7, 12] == 255
    with pytest.raises(ValueError):
        images.cropped(upright, (5, 5, 5, 9))
    made = images.rendered(spark, spark.createDataFrame([("x", bytearray(b"ab")), ("y", None)], "case_id string, content binary"), lambda content: [upright] * len(content)).collect()
    assert [(x.case_id, x.page_number, x.image.width) for x in made] == [("x", 1, 30), ("x", 2, 30)]


def test_preparation():
    p = page()
    assert (images.prepared(p, False) == p).all() and images.prepared(p, True).shape == p.shape
    assert (images.configured(p[:40, :40], {"invert": True}) == 255 - p[:40, :40]).all()
    assert images.configured(p[:40, :40], {"upscale": 1.5, "clahe": True, "denoise": True, "sharpen_method": "unsharp", "threshold_method": "otsu"}).shape == (60, 60)


def ruled(height=300, width=400):
    out = np.full((height, width), 255, np.uint8)
    for y in (60, 110, 160, 210):
        out[y : y + 2, 60:340] = 0
    for x in (60, 200, 338):
        out[60:212, x : x + 2] = 0
    return out


def test_page_geometry():
    assert max(map(abs, raster.page_geometry(ruled()))) < 0.11 and raster.page_geometry(np.full((80, 80), 255, np.uint8)) is None
    for angle in (3.0, -4.0):
        rotation, shear = raster.page_geometry(raster.turned(ruled(), angle))
        assert abs(rotation + angle) < 0.3 and abs(shear) < 0.6
    values = np.array([1.0, 1.1, 0.9, 30.0])
    assert raster.robust_median(values) == 1.0


def page_engine():
    def engine(a, config):
        """Reads a page whose border stands in one column; a line by itself reads as its fee."""
        if a.shape[0] < 60:
            return [(w, 90.0) for w in "Fee Status: paid".split()] if a.min() < 128 else []
        dark = (a[:, 10:15] < 128).all(1).mean()
        if dark > 0.95:
            return [(w, 80.0) for w in "MIB Fee Receipt Case ID: MIB-000123 Amount: $120.00 Waiver Code: N/A Packet MIB-000123 / page 2".split()]
        return [("zzz", 20.0)]

    return engine


def test_flow_of_pages(spark):
    whole = page()
    torn = whole.copy()
    torn[150:260] = raster._moved(whole[150:260], -35)
    native = "MIB Fee Receipt Case ID: MIB-000009 Fee Status: paid"
    rows = [("native", native, True, as_row(whole)), ("plain", "junk", False, as_row(whole)), ("turned", None, False, as_row(raster.rotated(whole, 90))), ("torn", None, False, as_row(torn)), ("none", None, False, None)]
    df = spark.createDataFrame(rows, f"page string, native_text string, native_text_usable boolean, image {images.IMAGE}").withColumns({"suspicious_text_layer": F.lit(False), "quality_class": F.lit("scan_readable"), "low_contrast": F.lit(False), "low_sharpness": F.lit(False)})
    got = {r.page: r for r in flow.processed(df, page_engine()).collect()}
    assert {k: r.text_source for k, r in got.items()} == {"native": "native_text", "plain": "ocr", "turned": "ocr", "torn": "ocr", "none": "ocr"}
    assert got["native"].fields["fee_status"] == "paid" and not got["native"].orientation_retry_attempted
    assert got["plain"].selected_rotation == 0 and not got["plain"].orientation_retry_attempted and got["plain"].fields["amount"] == "120.00" and got["plain"].case_id_candidates.footer == "MIB-000123"
    assert got["turned"].selected_rotation == 270 and got["turned"].orientation_retry_attempted and got["turned"].document_type == "fee_receipt"
    assert got["torn"].tear_repair_attempted and got["torn"].tear_repair_applied and got["torn"].fields["amount"] == "120.00"
    assert got["none"].text == "" and got["none"].document_type == "unknown"
    lines = [("Amount: $120.00 page", 0, 9), ("Fec Stat", 20, 9), ("Packet 1", 40, 9)]
    one = spark.createDataFrame([(as_row(whole), "fee_receipt", {"amount": "120.00"}, lines)], f"image {images.IMAGE}, document_type string, fields map<string,string>, lines array<struct<text:string,top:int,height:int>>")
    r = flow.lines_read_again(one, page_engine()).first()
    assert r.fields == {"amount": "120.00", "fee_status": "paid"} and r.line_retry_applied
