"""Small numpy kernels for pixels, used inside Arrow batches."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def horn_gradient(z: np.ndarray, res: float) -> tuple[np.ndarray, np.ndarray]:
    """Slopes along columns and rows (the last two axes) by Horn's 3x3 weights; edges
    repeat their nearest cells."""
    p = np.pad(z.astype(np.float64), [(0, 0)] * (z.ndim - 2) + [(1, 1)] * 2, mode="edge")
    up, mid, down = p[..., :-2, :], p[..., 1:-1, :], p[..., 2:, :]
    left, right = up[..., :-2] + 2 * mid[..., :-2] + down[..., :-2], up[..., 2:] + 2 * mid[..., 2:] + down[..., 2:]
    above, below = up[..., :-2] + 2 * up[..., 1:-1] + up[..., 2:], down[..., :-2] + 2 * down[..., 1:-1] + down[..., 2:]
    return (right - left) / (8 * res), (below - above) / (8 * res)


def overhead_shade(z: np.ndarray, res: float) -> np.ndarray:
    """Shade under a light from above, 255 times the cosine of the slope."""
    x, y = horn_gradient(z, res)
    return 255 / np.sqrt(1 + x**2 + y**2)


@lru_cache(maxsize=16)
def cubic_weights(scale: int, a: float = -0.5) -> tuple[int, np.ndarray]:
    """(first pixel, weights) of cubic convolution (Keys, 1981) for the cell 0
    that a band has once shrunk by a whole factor: the kernel is stretched by the
    factor, and the weights add up to 1."""
    first = -(3 * scale // 2) - 1
    t = np.abs(first + np.arange(4 * scale + 2) + 0.5 - scale / 2) / scale
    w = np.where(t < 1, (a + 2) * t**3 - (a + 3) * t**2 + 1, np.where(t < 2, a * t**3 - 5 * a * t**2 + 8 * a * t - 4 * a, 0))
    w = w / w.sum()
    w.setflags(write=False)
    return first, w


def shrink(band: np.ndarray, scale: int) -> np.ndarray:
    """A uint8 band (or many of one size: the last two axes count) shrunk by a whole
    factor, rounded and clipped."""
    first, w = cubic_weights(scale)
    out = band.astype(np.float64)
    for axis in (out.ndim - 2, out.ndim - 1):
        n = out.shape[axis] // scale
        take = np.arange(n)[:, None] * scale + first + np.arange(len(w))[None, :]
        windows = np.take(out, np.clip(take, 0, out.shape[axis] - 1), axis=axis)
        out = np.tensordot(windows, w, axes=([axis + 1], [0]))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def pca_fusion(rgb: np.ndarray, shade: np.ndarray) -> np.ndarray:
    """Four bands (3 of rgb, HWC, and the shade) on their three main components,
    stretched over all to 0..255 and cut to whole numbers. A component points to
    where its largest weight is positive."""
    flat = np.concatenate([rgb, shade[..., None]], axis=2).reshape(-1, 4).astype(np.float64)
    centred = flat - flat.mean(0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:3] * np.sign(axes[np.arange(3), np.abs(axes[:3]).argmax(1)])[:, None]
    out = centred @ axes.T
    low, high = out.min(), out.max()
    scaled = (out - low) / (high - low) * 255 if high > low else np.zeros_like(out)
    return scaled.astype(np.uint8).reshape(*rgb.shape[:2], 3)


def mosaic(centre: np.ndarray, strip: int, right: np.ndarray | None, bottom: np.ndarray | None, corner: np.ndarray | None) -> np.ndarray:
    """The tile with a strip of its right, bottom and corner neighbours (whole
    tiles of its size); what no tile covers is 0."""
    n, m = centre.shape[:2]
    out = np.zeros((n + strip, m + strip, *centre.shape[2:]), centre.dtype)
    out[:n, :m] = centre
    if right is not None:
        out[:n, m:] = right[:, :strip]
    if bottom is not None:
        out[n:, :m] = bottom[:strip]
    if corner is not None:
        out[n:, m:] = corner[:strip, :strip]
    return out


def patches(raster: np.ndarray, crop: int, stride: int) -> list[tuple[int, int, np.ndarray]]:
    """(row, col, patch) of all patches that lie inside."""
    h, w = raster.shape[:2]
    return [(r, c, raster[y : y + crop, x : x + crop]) for r, y in enumerate(range(0, h - crop + 1, stride)) for c, x in enumerate(range(0, w - crop + 1, stride))]
