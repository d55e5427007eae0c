"""Pixels of Spark's image source: quality, red stamps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.session import ship


def population_std(values: Column) -> Column:
    """Population standard deviation of an array; empty arrays have none."""
    n = F.size(values)
    mean = F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double")), n)
    return F.sqrt(F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + F.pow(x.cast("double") - mean, F.lit(2.0))), n))


def quality(images: DataFrame, image: str = "image") -> DataFrame:
    """Width, height, standard deviation of the grey values, and whether a page is small or of low contrast."""

    @F.pandas_udf("double")
    def contrast(data: pd.Series, channels: pd.Series) -> pd.Series:
        def one(raw: bytes, n: int) -> float:
            pixels = np.frombuffer(raw, np.uint8).reshape(-1, n).astype(np.float64)
            return float((pixels[:, :3] @ np.array([0.114, 0.587, 0.299]) if n >= 3 else pixels[:, 0]).std())

        return pd.Series([one(r, n) for r, n in zip(data, channels, strict=True)])

    p = F.col(image)
    out = images.withColumns({"width": p["width"], "height": p["height"], "contrast": contrast(p["data"], p["nChannels"])})
    return out.withColumns({"too_small": (F.col("width") < 900) | (F.col("height") < 1200), "low_contrast": F.col("contrast") < 18})


def whiten_red(images: DataFrame, image: str = "image", out: str = "data") -> DataFrame:
    """Pixel bytes (BGR) with red ones, over 120 and 1.25 times green and blue, made white."""

    @F.pandas_udf("binary")
    def run(data: pd.Series, channels: pd.Series) -> pd.Series:
        def one(raw: bytes, n: int) -> bytes:
            pixels = np.frombuffer(raw, np.uint8).reshape(-1, n).copy()
            if n >= 3:
                b, g, r = (pixels[:, k].astype(float) for k in range(3))
                pixels[(r > 120) & (r > 1.25 * g) & (r > 1.25 * b), :3] = 255
            return pixels.tobytes()

        return pd.Series([one(r, n) for r, n in zip(data, channels, strict=True)])

    return images.withColumn(out, run(F.col(image)["data"], F.col(image)["nChannels"]))


# Hue bands of red (half degrees), least saturation and value; angles that are turned; tiles, clip and median.
RED_HUES, RED_SATURATION, RED_VALUE = ((0, 12), (165, 180)), 55, 45
LEAST_ANGLE, MOST_ANGLE = 0.05, 15.0
TILES, CLIP, MEDIAN = 8, 2.0, 31


def hue_saturation_value(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue in half degrees from 0 to 180, saturation and value from 0 to 255, of pixels (..., 3) in the order B, G, R."""
    x = bgr.astype(np.float64)
    b, g, r = x[..., 0], x[..., 1], x[..., 2]
    top, low = x.max(axis=-1), x.min(axis=-1)
    span = np.where(top > low, top - low, 1.0)
    hue = np.where(top == r, (g - b) / span, np.where(top == g, 2 + (b - r) / span, 4 + (r - g) / span)) * 30
    return np.where(top > low, hue % 180, 0.0), np.where(top > 0, (top - low) / np.maximum(top, 1) * 255, 0.0), top


def red_mask(bgr: np.ndarray) -> np.ndarray:
    """Pixels of a red stamp, opened with a square of two pixels, so that single ones don't count."""
    hue, saturation, value = hue_saturation_value(bgr)
    red = np.logical_or.reduce([(hue >= a) & (hue <= b) for a, b in RED_HUES]) & (saturation >= RED_SATURATION) & (value >= RED_VALUE)
    square = red[:-1, :-1] & red[1:, :-1] & red[:-1, 1:] & red[1:, 1:]
    out = np.zeros_like(red)
    for dy in (0, 1):
        for dx in (0, 1):
            out[dy : dy + square.shape[0], dx : dx + square.shape[1]] |= square
    return out


def grey(pixels: np.ndarray) -> np.ndarray:
    return np.rint(pixels[..., :3] @ np.array([0.114, 0.587, 0.299])).astype(np.uint8) if pixels.shape[-1] >= 3 else pixels[..., 0]


def otsu(page: np.ndarray) -> int:
    """The threshold that parts grey values into two classes of greatest variance between them."""
    count = np.bincount(page.ravel(), minlength=256).astype(np.float64)
    low, weighted = np.cumsum(count), np.cumsum(count * np.arange(256))
    high = low[-1] - low
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.where((low > 0) & (high > 0), low * high * (weighted / low - (weighted[-1] - weighted) / high) ** 2, 0)
    return int(between.argmax())


def skew(page: np.ndarray) -> float:
    """Degrees by which the smallest rectangle around the dark pixels is turned, from -45 to 45."""
    y, x = np.nonzero(page <= otsu(page))
    if len(x) < 3:
        return 0.0
    points = sorted({(int(x[i]), int(y[i])) for row in np.unique(y) for i in (np.searchsorted(y, row), np.searchsorted(y, row, side="right") - 1)})
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    hull: list[tuple[int, int]] = []
    for side in (points, points[::-1]):
        base = len(hull)
        for p in side:
            while len(hull) - base >= 2 and cross(hull[-2], hull[-1], p) <= 0:
                hull.pop()
            hull.append(p)
        hull.pop()
    if len(hull) < 3:
        return 0.0
    h = np.array(hull, float)
    edge = np.roll(h, -1, axis=0) - h
    angle = np.unique((np.degrees(np.arctan2(edge[:, 1], edge[:, 0])) + 45) % 90 - 45)
    turn = np.radians(angle)[:, None]
    u, v = h[:, 0] * np.cos(turn) + h[:, 1] * np.sin(turn), h[:, 1] * np.cos(turn) - h[:, 0] * np.sin(turn)
    return float(angle[np.argmin(np.ptp(u, axis=1) * np.ptp(v, axis=1))])


def turned(page: np.ndarray, degrees: float) -> np.ndarray:
    """The page turned about its middle, the nearest pixel of each place, edges repeated."""
    height, width = page.shape
    y, x = np.mgrid[:height, :width]
    t, cy, cx = np.radians(degrees), (height - 1) / 2, (width - 1) / 2
    sx, sy = (x - cx) * np.cos(t) - (y - cy) * np.sin(t) + cx, (x - cx) * np.sin(t) + (y - cy) * np.cos(t) + cy
    return page[np.rint(sy).clip(0, height - 1).astype(int), np.rint(sx).clip(0, width - 1).astype(int)]


def spread_over(grid: np.ndarray, ys: np.ndarray, xs: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Values of a grid of places, linear between them."""
    rows = np.stack([np.interp(np.arange(shape[1]), xs, line) for line in grid])
    at = np.interp(np.arange(shape[0]), ys, np.arange(len(ys)))
    low = np.floor(at).astype(int).clip(0, max(0, len(ys) - 2))
    part = (at - low)[:, None]
    return rows[low] * (1 - part) + rows[np.minimum(low + 1, len(ys) - 1)] * part


def even_light(page: np.ndarray) -> np.ndarray:
    """Divided by the background: medians of squares of MEDIAN pixels at every eighth place, linear between."""
    half, (height, width) = MEDIAN // 2, page.shape
    ys, xs = np.arange(0, height, 8), np.arange(0, width, 8)
    grid = np.array([[np.median(page[max(0, y - half) : y + half + 1, max(0, x - half) : x + half + 1]) for x in xs] for y in ys])
    return np.clip(page * 255.0 / np.maximum(spread_over(grid, ys, xs, page.shape), 1), 0, 255).astype(np.uint8)


def local_contrast(page: np.ndarray) -> np.ndarray:
    """Histograms of TILES by TILES tiles equalised, no value counting more than CLIP times the mean; linear between tiles."""
    height, width = page.shape
    ys, xs = (np.linspace(0, n, TILES + 1).astype(int) for n in (height, width))
    maps = np.zeros((TILES, TILES, 256))
    for i in range(TILES):
        for j in range(TILES):
            tile = page[ys[i] : max(ys[i + 1], ys[i] + 1), xs[j] : max(xs[j + 1], xs[j] + 1)]
            count = np.bincount(tile.ravel(), minlength=256).astype(float)
            most = max(CLIP * tile.size / 256, 1.0)
            count = np.minimum(count, most) + np.maximum(count - most, 0).sum() / 256
            maps[i, j] = np.cumsum(count) * 255 / max(tile.size, 1)
    y, x = ((np.arange(n) * TILES / n - 0.5).clip(0, TILES - 1) for n in (height, width))
    i, j = np.floor(y).astype(int), np.floor(x).astype(int)
    i1, j1, wy, wx = np.minimum(i + 1, TILES - 1), np.minimum(j + 1, TILES - 1), (y - i)[:, None], (x - j)[None, :]
    of = lambda a, b: maps[a[:, None], b[None, :], page]
    out = (of(i, j) * (1 - wx) + of(i, j1) * wx) * (1 - wy) + (of(i1, j) * (1 - wx) + of(i1, j1) * wx) * wy
    return np.rint(out).clip(0, 255).astype(np.uint8)


def prepared(pixels: np.ndarray, stamps: bool) -> np.ndarray:
    if stamps and pixels.shape[-1] >= 3:
        pixels = pixels.copy()
        pixels[red_mask(pixels[..., :3]), :3] = 255
    page = grey(pixels)
    angle = skew(page)
    if LEAST_ANGLE <= abs(angle) <= MOST_ANGLE:
        page = turned(page, angle)
    return local_contrast(even_light(page))


def prepare_pages(images: DataFrame, image: str = "image", out: str = "page", stamps: bool = True) -> DataFrame:
    """``out`` as (ok, error, data: grey bytes of the same size): stamps whitened, straightened, evenly lit, with more
    contrast. A page that can't be worked on is an error in its own row."""
    ship(images.sparkSession)

    @F.pandas_udf("ok boolean, error string, data binary")
    def run(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.DataFrame:
        found = []
        for raw, h, w, n in zip(data, height, width, channels, strict=True):
            try:
                found.append((True, None, prepared(np.frombuffer(raw, np.uint8).reshape(h, w, n), stamps).tobytes()))
            except (ValueError, TypeError) as problem:
                found.append((False, f"{type(problem).__name__}: {problem}", None))
        return pd.DataFrame(found, columns=["ok", "error", "data"])

    p = F.col(image)
    return images.withColumn(out, run(p["data"], p["height"], p["width"], p["nChannels"]))
