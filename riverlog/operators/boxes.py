"""Box arithmetic as column expressions, suppression of overlapping boxes, and pixel operators on numpy arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def from_xywh(b: Column) -> Column:
    return F.struct(b["x"].alias("x1"), b["y"].alias("y1"), (b["x"] + b["w"]).alias("x2"), (b["y"] + b["h"]).alias("y2"), b["score"].alias("score"))


def rescaled(b: Column, sx: Column, sy: Column) -> Column:
    return F.struct((b["x1"] * sx).alias("x1"), (b["y1"] * sy).alias("y1"), (b["x2"] * sx).alias("x2"), (b["y2"] * sy).alias("y2"), b["score"].alias("score"))


def expanded(b: Column, factor: float, w: Column, h: Column) -> Column:
    """Grown about its centre and cut to the frame."""
    cx, cy = (b["x1"] + b["x2"]) / 2, (b["y1"] + b["y2"]) / 2
    rx, ry = (b["x2"] - b["x1"]) * factor / 2, (b["y2"] - b["y1"]) * factor / 2
    zero = F.lit(0.0)
    return F.struct(F.greatest(zero, cx - rx).alias("x1"), F.greatest(zero, cy - ry).alias("y1"), F.least(w.cast("double"), cx + rx).alias("x2"), F.least(h.cast("double"), cy + ry).alias("y2"), b["score"].alias("score"))


def large_enough(b: Column, least: float) -> Column:
    return F.least(b["x2"] - b["x1"], b["y2"] - b["y1"]) >= least


def top_k(boxes: Column, k: int = 200) -> Column:
    """The k boxes of the highest scores, best first, equal ones in their order."""
    ranked = F.sort_array(F.transform(boxes, lambda b, i: F.struct((-b["score"]).alias("s"), i.alias("i"), b.alias("b"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: x["b"])


def suppress(boxes: np.ndarray, iou: float, conf: float) -> np.ndarray:
    """Greedy suppression by falling score; then scores above conf, strictly."""
    order, keep = np.argsort(-boxes[:, 4], kind="stable"), []
    area = np.clip(boxes[:, 2] - boxes[:, 0], 0, None) * np.clip(boxes[:, 3] - boxes[:, 1], 0, None)
    while len(order):
        i, rest = order[0], order[1:]
        keep.append(i)
        wide = np.clip(np.minimum(boxes[i, 2], boxes[rest, 2]) - np.maximum(boxes[i, 0], boxes[rest, 0]), 0, None)
        high = np.clip(np.minimum(boxes[i, 3], boxes[rest, 3]) - np.maximum(boxes[i, 1], boxes[rest, 1]), 0, None)
        common = wide * high
        every = area[i] + area[rest] - common
        order = rest[np.divide(common, every, out=np.zeros_like(common), where=every > 0) <= iou]
    out = boxes[np.array(keep, int)] if keep else boxes[:0]
    return out[out[:, 4] > conf]


def paint(shape: tuple[int, int], boxes: np.ndarray, ellipse: bool = True) -> np.ndarray:
    mask = np.zeros(shape, np.uint8)
    yy, xx = np.mgrid[: shape[0], : shape[1]]
    for x1, y1, x2, y2 in np.asarray(boxes, int)[:, :4] if len(boxes) else ():
        if x2 <= x1 or y2 <= y1:
            continue
        if ellipse:
            mask[((xx - (x1 + x2) / 2) / ((x2 - x1) / 2)) ** 2 + ((yy - (y1 + y2) / 2) / ((y2 - y1) / 2)) ** 2 <= 1] = 1
        else:
            mask[max(0, y1) : max(0, y2), max(0, x1) : max(0, x2)] = 1
    return mask


#: Pixels of a tile's side when masks are grown at a quarter of the resolution, and from which radius on that is worth it.
QUARTER, COARSE_FROM = 4, 8


def dilate(mask: np.ndarray, radius: int, coarse: bool = False) -> np.ndarray:
    """Grown by a disc of radius, shrunk for a negative one: per row of the disc a run of that width, by running sums.

    With coarse, radii from COARSE_FROM on are worked on tiles of 4 x 4 pixels, of which any pixel counts when growing and all must when
    shrinking: sixteen times fewer pixels. What is grown is never smaller then, what is shrunk never larger, than at full resolution.
    """
    if radius == 0 or not mask.any():
        return mask.copy()
    if radius < 0:
        return (1 - dilate(1 - mask, -radius, coarse)).astype(np.uint8)
    h, w = mask.shape
    if coarse and radius >= COARSE_FROM:
        small = np.maximum.reduceat(np.maximum.reduceat(mask, np.arange(0, h, QUARTER), 0), np.arange(0, w, QUARTER), 1)
        # Pixels `radius` apart lie in tiles whose corners are up to three pixels further apart each way.
        grown = dilate(small, coarse_radius(radius))
        return np.repeat(np.repeat(grown, QUARTER, 0)[:h], QUARTER, 1)[:, :w]
    sums = np.concatenate([np.zeros((h, 1), np.int64), np.cumsum(mask, axis=1)], axis=1)
    out = np.zeros_like(mask)
    for dy in range(-min(radius, h - 1), min(radius, h - 1) + 1):
        half = int((radius * radius - dy * dy) ** 0.5)
        hit = sums[:, np.minimum(np.arange(w) + half + 1, w)] > sums[:, np.maximum(np.arange(w) - half, 0)]
        a, b = max(0, dy), min(h, h + dy)
        out[a:b] |= hit[a - dy : b - dy].astype(np.uint8)
    return out


def coarse_radius(radius: int) -> int:
    """In tiles, of a radius in pixels."""
    return int(np.ceil((radius + (QUARTER - 1) * 2**0.5) / QUARTER))


def resized(frame: np.ndarray, h: int, w: int) -> np.ndarray:
    """The mean of the area that each new pixel covers, as doubles, by two-dimensional running sums; areas may cut through pixels."""
    sums = np.zeros((frame.shape[0] + 1, frame.shape[1] + 1, *frame.shape[2:]))
    sums[1:, 1:] = frame.cumsum(0, dtype=float).cumsum(1)
    for axis, n in ((0, h), (1, w)):
        at = np.arange(n + 1) * frame.shape[axis] / n
        low = np.minimum(at.astype(int), frame.shape[axis] - 1)
        part = (at - low).reshape(-1, *[1] * (sums.ndim - 1))
        whole = np.moveaxis(sums, axis, 0)
        sums = np.moveaxis(whole[low] + part * (whole[low + 1] - whole[low]), 0, axis)
    return np.diff(np.diff(sums, axis=0), axis=1) / (frame.shape[0] / h * frame.shape[1] / w)


#: Weights of a blur, the range that brightness is stretched to, and those of blue, green and red in it, in 16384ths: fixed values.
KERNEL = np.array([1, 4, 6, 4, 1]) / 16
STRETCHED, LUMINANCE = (90.0, 235.0), np.array([1868, 9617, 4899])


def _blurred(x: np.ndarray) -> np.ndarray:
    """A separable Gaussian; beyond an edge the pixels come back, the edge's own not twice."""
    for axis in (0, 1):
        n = x.shape[axis]
        around = np.abs(np.arange(n)[:, None] + np.arange(-2, 3)) % max(1, 2 * (n - 1))
        near = np.moveaxis(x, axis, 0)[np.where(around < n, around, 2 * (n - 1) - around)]
        x = np.moveaxis(np.einsum("k,ik...->i...", KERNEL, near), 0, axis)
    return x


def _enlarged(x: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear between the centres of pixels."""
    for axis, n in ((0, h), (1, w)):
        at = np.clip((np.arange(n) + 0.5) * x.shape[axis] / n - 0.5, 0, x.shape[axis] - 1)
        low = at.astype(int)
        part = (at - low).reshape(-1, *[1] * (x.ndim - 1))
        whole = np.moveaxis(x, axis, 0)
        high = whole[np.minimum(low + 1, len(whole) - 1)]
        x = np.moveaxis(whole[low] * (1 - part) + high * part, 0, axis)
    return x


def fill(frame: np.ndarray, mask: np.ndarray, mode: str, grey: int = 128, block: int = 16, tint: tuple[int, int, int] = (128, 128, 128)) -> np.ndarray:
    """grey, pixelate, blur or anon under the mask; nothing else changes.

    blur: area means of about `block` pixels a side, smoothed and enlarged without steps. anon: their brightness alone, stretched to one
    range and in the tint (blue, green, red), so that shading stays and neither colour nor the level of light does.
    """
    out = frame.copy()
    m = mask.astype(bool)
    if mode == "grey":
        out[m] = grey
        return out
    if mode not in ("pixelate", "blur", "anon"):
        raise ValueError(f"unknown fill {mode!r}")
    h, w = mask.shape
    small = resized(frame, max(1, h // block), max(1, w // block))
    if mode == "pixelate":
        soft = small[np.arange(h) * len(small) // h][:, np.arange(w) * small.shape[1] // w]
    else:
        small = _blurred(small)
        if mode == "anon":
            light = small @ LUMINANCE / 16384
            low, high = light.min(), light.max()
            light = STRETCHED[0] + (light - low) * ((STRETCHED[1] - STRETCHED[0]) / (high - low) if high > low else 0.0)
            small = light[:, :, None] * np.array(tint) / 255
        soft = _enlarged(small, h, w)
    out[m] = np.floor(soft[m] + 0.5).astype(np.uint8)
    return out


def hsv(frame: np.ndarray) -> np.ndarray:
    """Hue in half degrees, 0 to 179, saturation and value to 255, of blue, green, red pixels."""
    b, g, r = (frame[..., i].astype(float) for i in range(3))
    most = np.maximum(np.maximum(b, g), r)
    spread = most - np.minimum(np.minimum(b, g), r)
    safe = np.where(spread > 0, spread, 1)
    turn = np.where(most == r, (g - b) / safe, np.where(most == g, 2 + (b - r) / safe, 4 + (r - g) / safe))
    hue = np.floor(np.where(spread > 0, turn, 0) * 30 + 180 + 0.5) % 180
    saturation = np.floor(255 * spread / np.where(most > 0, most, 1) + 0.5)
    return np.stack([hue, saturation, most], -1).astype(np.uint8)


def compose(tiles: list[np.ndarray | None], cols: int, h: int, w: int, blank: int = 24) -> np.ndarray:
    """Frames side by side in rows of `cols`, each resized to h x w; `blank` where a feed has none and beyond the last."""
    rows = max(1, -(-len(tiles) // cols))
    out = np.full((rows * h, cols * w, 3), blank, np.uint8)
    for k, tile in enumerate(tiles):
        if tile is not None:
            y, x = k // cols * h, k % cols * w
            out[y : y + h, x : x + w] = np.floor(resized(tile, h, w) + 0.5)
    return out


#: Hues that count, the saturation above which a pixel does, and the least values and pixels to tell by: fixed values.
HUES, SATURATED, LEAST_VALUES, LEAST_PIXELS = (95, 135), 60, 300, 50


def without_coloured(frame: np.ndarray, boxes: np.ndarray, most: float, low: int = HUES[0], high: int = HUES[1]) -> np.ndarray:
    """Boxes of a frame of blue, green, red pixels of whose saturated pixels no more than a share `most` are of hue low..high. Boxes are
    cut at the frame's edges; those with too few pixels to tell stay."""
    keep = []
    for k, box in enumerate(boxes):
        x1, y1, x2, y2 = (max(0, int(v)) for v in box[:4])
        crop = hsv(frame[y1:y2, x1:x2]).reshape(-1, 3)
        vivid = crop[crop[:, 1] > SATURATED] if len(crop) else crop
        if len(crop) * 3 < LEAST_VALUES or len(vivid) < LEAST_PIXELS or ((vivid[:, 0] >= low) & (vivid[:, 0] <= high)).mean() <= most:
            keep.append(k)
    return boxes[keep]
