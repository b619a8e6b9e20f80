"""Numpy kernels for one image. Rasters are H x W x C uint8 in R, G, B(, A) order."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Integer luma weights (16-bit for gray renders, 15-bit for edge maps).
GRAY_WEIGHTS, GRAY_SHIFT = (19595, 38470, 7471), 16
EDGE_WEIGHTS, EDGE_SHIFT = (9798, 19235, 3735), 15
# Resampling precision in bits and tan(22.5 degrees) in 15-bit fixed point.
RESAMPLE_BITS = 22
TAN_22 = 13573


def orient(img: np.ndarray, tag: int | None) -> np.ndarray:
    """Undo camera orientation ``tag`` (1-8); other values leave the image as it is."""
    if tag in (5, 6, 7, 8):
        img = img.transpose(1, 0, 2)
    if tag in (2, 3, 6, 7):
        img = img[:, ::-1]
    if tag in (3, 4, 7, 8):
        img = img[::-1]
    return img


def to_rgb(img: np.ndarray) -> np.ndarray:
    return np.repeat(img, 3, axis=2) if img.shape[2] == 1 else img[:, :, :3]


def luma(img: np.ndarray, weights=GRAY_WEIGHTS, shift=GRAY_SHIFT) -> np.ndarray:
    if img.shape[2] == 1:
        return img[:, :, 0]
    total = sum(w * img[:, :, c].astype(np.int32) for c, w in enumerate(weights))
    return ((total + (1 << (shift - 1))) >> shift).astype(np.uint8)


def grayscale(img: np.ndarray) -> np.ndarray:
    return np.repeat(luma(img)[:, :, None], 3, axis=2)


def snap(size: int, multiple: int = 16) -> int:
    return size // multiple * multiple


@lru_cache(maxsize=256)
def lanczos_taps(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Source indices and fixed-point weights, both (n_out, taps), of a 3-lobe Lanczos filter."""
    scale = n_in / n_out
    stretch = max(scale, 1.0)
    center = (np.arange(n_out) + 0.5) * scale
    first = np.maximum((center - 3 * stretch + 0.5).astype(np.int64), 0)
    last = np.minimum((center + 3 * stretch + 0.5).astype(np.int64), n_in)
    at = first[:, None] + np.arange(int((last - first).max()))
    t = (at - center[:, None] + 0.5) * (1.0 / stretch)
    raw = np.where((t >= -3) & (t < 3) & (at < last[:, None]), np.sinc(t) * np.sinc(t / 3), 0.0)
    share = raw / raw.sum(axis=1, keepdims=True) * (1 << RESAMPLE_BITS)
    fixed = np.trunc(share + np.where(share < 0, -0.5, 0.5)).astype(np.int32)
    return np.minimum(at, n_in - 1), fixed


def _resample_rows(img: np.ndarray, n_out: int) -> np.ndarray:
    index, weight = lanczos_taps(img.shape[0], n_out)
    rows = np.ascontiguousarray(img).reshape(img.shape[0], -1)
    out = np.empty((n_out, rows.shape[1]), dtype=np.uint8)
    for start in range(0, n_out, 64):
        part = slice(start, start + 64)
        total = np.full(out[part].shape, 1 << (RESAMPLE_BITS - 1), dtype=np.int32)
        product = np.empty_like(total)
        for tap in range(index.shape[1]):
            np.multiply(rows[index[part, tap]], weight[part, tap, None], out=product, dtype=np.int32)
            total += product
        out[part] = np.clip(total >> RESAMPLE_BITS, 0, 255)
    return out.reshape((n_out,) + img.shape[1:])


def resample(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """Separable Lanczos, across first and then down, each pass only if that size changes."""
    if height < 1 or width < 1:
        raise ValueError(f"too_small: target size {width}x{height}")
    if width != img.shape[1]:
        img = _resample_rows(img.transpose(1, 0, 2), width).transpose(1, 0, 2)
    if height != img.shape[0]:
        img = _resample_rows(img, height)
    return img


def nearest(img: np.ndarray, height: int, width: int) -> np.ndarray:
    rows = ((np.arange(height) + 0.5) * (img.shape[0] / height)).astype(np.int64)
    cols = ((np.arange(width) + 0.5) * (img.shape[1] / width)).astype(np.int64)
    return img[rows][:, cols]


def whiten(result: np.ndarray, original: np.ndarray, threshold: int = 245) -> np.ndarray:
    """White wherever all channels of the original lie above ``threshold``."""
    source = nearest(to_rgb(original), *result.shape[:2])
    return np.where((source > threshold).all(axis=2, keepdims=True), np.uint8(255), result)


def gradient(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """3 x 3 Sobel derivatives with replicated borders."""
    p = np.pad(gray.astype(np.int16), 1, mode="edge")
    across = p[:, 2:] - p[:, :-2]
    smooth = p[:, 2:] + 2 * p[:, 1:-1] + p[:, :-2]
    return across[:-2] + 2 * across[1:-1] + across[2:], smooth[2:] - smooth[:-2]


def edge_classes(gray: np.ndarray, low: int, high: int) -> np.ndarray:
    """Thin-edge classes: 0 none, 1 above ``low``, 2 above ``high`` (L1 magnitude).

    Only pixels above ``low`` are looked at; each is compared along its gradient with the pixel
    before and the one after.
    """
    dx, dy = gradient(gray)
    mag = np.abs(dx) + np.abs(dy)
    classes = np.zeros(mag.size, dtype=np.uint8)
    where = np.flatnonzero(mag > low)
    gx, gy = dx.ravel()[where].astype(np.int32), dy.ravel()[where].astype(np.int32)
    flat, rise = np.abs(gx) * TAN_22, np.abs(gy) << 15
    level, steep = rise < flat, rise > flat + (np.abs(gx) << 16)
    line = mag.shape[1] + 2
    ahead = np.select([level, steep, (gx ^ gy) < 0], [1, line, line - 1], line + 1)
    around = np.pad(mag, 1).ravel()
    at = where + 2 * (where // mag.shape[1]) + line + 1
    m, after = around[at], around[at + ahead]
    ridge = (m > around[at - ahead]) & ((m > after) | ((level | steep) & (m == after)))
    classes[where[ridge]] = 1 + (m[ridge] > high)
    return classes.reshape(mag.shape)


def link_edges(classes: np.ndarray) -> np.ndarray:
    """Keep strong pixels and weak ones 8-connected to them; each pixel is visited once."""
    width = classes.shape[1] + 2
    weak = np.pad(classes, 1).ravel().astype(bool)
    frontier = np.flatnonzero(np.pad(classes, 1).ravel() == 2)
    keep = np.zeros(weak.size, dtype=bool)
    keep[frontier] = True
    steps = np.array([-width - 1, -width, -width + 1, -1, 1, width - 1, width, width + 1])
    while frontier.size:
        near = (frontier[:, None] + steps).ravel()
        near = near[weak[near] & ~keep[near]]
        keep[near] = True
        frontier = np.unique(near)
    return keep.reshape(-1, width)[1:-1, 1:-1]


def edges(img: np.ndarray, low: int = 100, high: int = 200) -> np.ndarray:
    """Boolean edge mask."""
    return link_edges(edge_classes(luma(img, EDGE_WEIGHTS, EDGE_SHIFT), low, high))


def edge_map(img: np.ndarray, low: int = 100, high: int = 200) -> np.ndarray:
    mask = np.where(edges(img, low, high), np.uint8(255), np.uint8(0))
    return np.repeat(mask[:, :, None], 3, axis=2)


def laplacian_energy(img: np.ndarray) -> int:
    """Sum of squared 4-neighbour Laplacians of the luma over interior pixels."""
    g = luma(img).astype(np.int64)
    inner = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return int((inner * inner).sum())
