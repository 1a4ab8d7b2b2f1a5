"""Pixel kernels in numpy, run in Arrow batches: turn, split, cut out.

Images are structs height, width, n_channels, mode, data with rows of BGR bytes.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..schema import IMAGE


def pixels(image: dict) -> np.ndarray:
    return np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["n_channels"])


def packed(array: np.ndarray) -> dict:
    h, w, c = array.shape
    return {"height": h, "width": w, "n_channels": c, "mode": {1: 0, 3: 16, 4: 24}[c], "data": np.ascontiguousarray(array, np.uint8).tobytes()}


def turned(array: np.ndarray, angle: int) -> np.ndarray:
    """Turned clockwise by a quarter, a half or three quarters; any other angle leaves it."""
    return np.rot90(array, {90: 3, 180: 2, 270: 1}.get(angle, 0))


def grey(array: np.ndarray) -> np.ndarray:
    return array[..., 0].astype(float) if array.shape[2] == 1 else array[..., :3] @ np.array([0.114, 0.587, 0.299])


def to_bgr(image, decode: Callable[[bytes], np.ndarray] | None = None) -> np.ndarray:
    """A copy of an image as rows of BGR: of an array, of an object that converts itself to RGB, or of a file by `decode`."""
    if isinstance(image, (str, os.PathLike)):
        if decode is None:
            raise TypeError("a file takes a decoder")
        with open(image, "rb") as file:
            return np.array(decode(file.read()))
    if isinstance(image, np.ndarray):
        return image.copy()
    if hasattr(image, "convert"):
        return np.ascontiguousarray(np.asarray(image.convert("RGB"))[..., ::-1])
    raise TypeError(f"no image: {type(image).__name__}")


def resized(array: np.ndarray, side: int) -> np.ndarray:
    """With its longer side at most `side`: each pixel is the mean of those it covers; smaller images keep their size."""
    h, w = array.shape[:2]
    if max(h, w) <= side:
        return array
    rows, columns = (np.unique(np.linspace(0, n, max(1, n * side // max(h, w)) + 1).astype(int)) for n in (h, w))
    sums = np.add.reduceat(np.add.reduceat(array.astype(np.int64), rows[:-1], 0), columns[:-1], 1)
    return (sums / (np.diff(rows)[:, None, None] * np.diff(columns)[None, :, None])).round().astype(np.uint8)


def dark(a: np.ndarray) -> np.ndarray:
    """Ink: the pixels up to the threshold that parts the grey values best (Otsu)."""
    counts = np.bincount(a.astype(np.uint8).ravel(), minlength=256).astype(float)
    below, mass = counts.cumsum(), (counts * np.arange(256)).cumsum()
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return a.astype(np.uint8) <= int(np.nan_to_num(spread).argmax())


def contrasted(array: np.ndarray, clip: float = 2.5, tiles: int = 8) -> np.ndarray:
    """Grey text made dark: brightness equalised by tiles, with clipped histograms and smooth passage between tiles.

    Colours keep their proportions, so black stays black.
    """
    light = grey(array).round().astype(int)
    h, w = light.shape
    rows, columns = np.linspace(0, h, tiles + 1).astype(int), np.linspace(0, w, tiles + 1).astype(int)
    curves = np.empty((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            tile = light[rows[i] : max(rows[i + 1], rows[i] + 1), columns[j] : max(columns[j + 1], columns[j] + 1)]
            counts = np.bincount(tile.ravel(), minlength=256).astype(float)
            most = max(1.0, clip * tile.size / 256)
            counts = np.minimum(counts, most) + np.maximum(counts - most, 0).sum() / 256
            curves[i, j] = counts.cumsum() * 255 / max(1, tile.size)
    # each pixel lies between the middles of four tiles
    y, x = ((np.arange(n) + 0.5) * tiles / n - 0.5 for n in (h, w))
    y0, x0 = np.clip(np.floor(y).astype(int), 0, tiles - 1), np.clip(np.floor(x).astype(int), 0, tiles - 1)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    v, u = np.clip(y - y0, 0, 1)[:, None], np.clip(x - x0, 0, 1)[None, :]
    told = [curves[a[:, None], b[None, :], light] for a in (y0, y1) for b in (x0, x1)]
    new = (1 - v) * ((1 - u) * told[0] + u * told[1]) + v * ((1 - u) * told[2] + u * told[3])
    return np.clip(array * (new / np.maximum(light, 1))[..., None], 0, 255).round().astype(np.uint8)


def _any(a: np.ndarray, before: int, after: int, axis: int) -> np.ndarray:
    """Whether any of the pixels from `before` ahead to `after` behind is set."""
    n = a.shape[axis]
    sums = np.concatenate([np.zeros_like(a.take([0], axis), dtype=int), a.cumsum(axis, dtype=int)], axis)
    at = np.arange(n)
    return (sums.take(np.minimum(at + after + 1, n), axis) - sums.take(np.maximum(at - before, 0), axis)) > 0


def closed(a: np.ndarray, columns: int, rows: int) -> np.ndarray:
    """Gaps narrower than a rectangle filled: spread by it and drawn back; the margin counts as neither."""
    left, up = columns // 2, rows // 2
    wide = _any(_any(a, left, columns - 1 - left, 1), up, rows - 1 - up, 0)
    return ~_any(_any(~wide, columns - 1 - left, left, 1), rows - 1 - up, up, 0)


def components(a: np.ndarray) -> list[tuple[tuple[int, int, int, int], int]]:
    """((x0, y0, x1, y1), size) of the connected parts, touching corners included; size counts each row from end to end."""
    above: list[int] = []

    def root(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    last: list[tuple[int, int, int]] = []
    runs: list[tuple[int, int, int, int]] = []
    for y, line in enumerate(a):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], line.astype(np.int8), [0]])))
        now = []
        for x0, x1 in zip(edges[::2].tolist(), edges[1::2].tolist()):
            k = len(above)
            above.append(k)
            for u0, u1, j in last:
                if u0 <= x1 and x0 <= u1:
                    above[root(k)] = root(j)
            now.append((x0, x1, k))
            runs.append((y, x0, x1, k))
        last = now
    ends: dict[tuple[int, int], tuple[int, int]] = {}
    for y, x0, x1, k in runs:
        x, z = ends.get((root(k), y), (x0, x1))
        ends[root(k), y] = min(x, x0), max(z, x1)
    parts: dict[int, list[int]] = {}
    for (k, y), (x0, x1) in ends.items():
        b = parts.setdefault(k, [x0, y, x1, y + 1, 0])
        b[:] = min(b[0], x0), min(b[1], y), max(b[2], x1), max(b[3], y + 1), b[4] + x1 - x0
    return sorted(((b[0], b[1], b[2], b[3]), b[4]) for b in parts.values())


def outlined(array: np.ndarray, boxes: list[tuple[int, int, int, int]], colour: tuple[int, int, int] = (0, 0, 255), width: int = 3) -> np.ndarray:
    """A copy with the boxes drawn on it."""
    out = np.repeat(array, 3, 2) if array.shape[2] == 1 else array[..., :3].copy()
    for x0, y0, x1, y1 in boxes:
        for part in (out[y0 : y0 + width, x0:x1], out[max(y0, y1 - width) : y1, x0:x1], out[y0:y1, x0 : x0 + width], out[y0:y1, max(x0, x1 - width) : x1]):
            part[:] = colour
    return out


def png(image: dict) -> bytes:
    """A lossless image file of an image struct."""
    a = pixels(image)
    kind = {1: 0, 3: 2, 4: 6}[a.shape[2]]
    a = a if a.shape[2] == 1 else a[..., [2, 1, 0, *range(3, a.shape[2])]]
    lines = np.concatenate([np.zeros((a.shape[0], 1), np.uint8), a.reshape(a.shape[0], -1)], 1)

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _convolved(a: np.ndarray, kernel: np.ndarray, axis: int) -> np.ndarray:
    half = len(kernel) // 2
    pad = [(half, half) if k == axis else (0, 0) for k in range(2)]
    wide = np.pad(a, pad, mode="reflect" if a.shape[axis] > half else "edge")
    return sum(w * np.take(wide, range(i, i + a.shape[axis]), axis) for i, w in enumerate(kernel))


def edges(a: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Edge map of a grey image: Gaussian blur over 5 x 5, Sobel gradients, thinning across the gradient, hysteresis."""
    if min(a.shape) < 3:
        return np.zeros(a.shape, bool)
    g = np.exp(-(np.arange(-2, 3) ** 2) / (2 * 1.1**2))
    a = _convolved(_convolved(a, g / g.sum(), 0), g / g.sum(), 1)
    smooth, slope = np.array([1, 2, 1.0]), np.array([-1, 0, 1.0])
    gx, gy = _convolved(_convolved(a, smooth, 0), slope, 1), _convolved(_convolved(a, smooth, 1), slope, 0)
    size = np.abs(gx) + np.abs(gy)
    wide = np.pad(size, 1)
    sector = np.round(np.arctan2(gy, gx) / (np.pi / 4)).astype(int) % 4
    thin = np.zeros(size.shape, bool)
    h, w = size.shape
    for s, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        one, two = wide[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w], wide[1 - dy : 1 - dy + h, 1 - dx : 1 - dx + w]
        thin |= (sector == s) & (size > one) & (size >= two)
    weak, strong = thin & (size > low), thin & (size > high)
    while True:
        grown = np.pad(strong, 1)
        around = np.zeros_like(strong)
        for dy in range(3):
            for dx in range(3):
                around |= grown[dy : dy + h, dx : dx + w]
        more = around & weak | strong
        if (more == strong).all():
            return strong
        strong = more


def gutter_of(array: np.ndarray, low: float = 0.40, high: float = 0.60) -> int:
    """The column with the fewest edges in the middle band, the leftmost of equals."""
    width = array.shape[1]
    first, end = int(width * low), max(int(width * high), int(width * low) + 1)
    return first + int(edges(grey(array[:, first:end])).sum(0).argmin())


def oriented(images: DataFrame) -> DataFrame:
    """(page_key, crop_idx, image, rotated) of (page_key, crop_idx, image, angle): rotated tells whether pixels moved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made, moved = [], []
            for image, angle in zip(batch.image, batch.angle):
                before = pixels(image)
                after = turned(before, int(angle))
                made.append(packed(after))
                moved.append(before.shape != after.shape or not np.array_equal(before, after))
            yield pd.DataFrame({"page_key": batch.page_key, "crop_idx": batch.crop_idx, "image": made, "rotated": moved})

    return images.select("page_key", "crop_idx", "image", "angle").mapInPandas(run, f"page_key string, crop_idx int, image {IMAGE}, rotated boolean")


def split(images: DataFrame) -> DataFrame:
    """(page_key, crop_idx, image) of (page_key, crop_idx, image, is_composite): a spread becomes its left and right page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, idx, image, composite in zip(batch.page_key, batch.crop_idx, batch.image, batch.is_composite):
                if composite and image["width"] > 1:
                    a = pixels(image)
                    cut = min(max(gutter_of(a), 1), a.shape[1] - 1)
                    rows += [(key, 2 * idx, packed(a[:, :cut])), (key, 2 * idx + 1, packed(a[:, cut:]))]
                else:
                    rows.append((key, 2 * idx, dict(image)))
            yield pd.DataFrame(rows, columns=["page_key", "crop_idx", "image"])

    return images.select("page_key", "crop_idx", "image", "is_composite").mapInPandas(run, f"page_key string, crop_idx int, image {IMAGE}")


def cut_out(regions: DataFrame) -> DataFrame:
    """(page_key, region_id, image) of (page_key, region_id, bbox, image); boxes are clipped, empty ones give no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, region, b, image in zip(batch.page_key, batch.region_id, batch.bbox, batch.image):
                part = pixels(image)[max(0, b["y0"]) : max(0, b["y1"]), max(0, b["x0"]) : max(0, b["x1"])]
                if part.size:
                    rows.append((key, region, packed(part)))
            yield pd.DataFrame(rows, columns=["page_key", "region_id", "image"])

    return regions.select("page_key", "region_id", "bbox", "image").mapInPandas(run, f"page_key string, region_id string, image {IMAGE}")
