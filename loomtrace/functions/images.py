"""Pictures and sounds as numpy arrays: statistics and likenesses for columns of decoded samples.

Decoding is left to whatever library a cluster has; these functions take arrays and
are called from Arrow functions over landed columns.
"""

from __future__ import annotations

import numpy as np


def brightness(pixels: np.ndarray) -> float:
    """The mean luminance of RGB pixels, 0 to 255."""
    return float((pixels.reshape(-1, 3) @ np.array([0.299, 0.587, 0.114])).mean())


def saturation(pixels: np.ndarray) -> float:
    """The mean saturation of RGB pixels, 0 to 255."""
    rows = pixels.reshape(-1, 3).astype(float)
    high, low = rows.max(axis=1), rows.min(axis=1)
    return float(np.where(high > 0, (high - low) / np.maximum(high, 1), 0).mean() * 255)


def contrast(pixels: np.ndarray) -> float:
    """The population deviation of all samples."""
    return float(pixels.std())


def sharpness(gray: np.ndarray) -> float:
    """The variance of the Laplacian of a grey picture."""
    x = np.pad(gray.astype(float), 1, mode="reflect")
    return float((x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]).var())


def mean_square_error(a: np.ndarray, b: np.ndarray) -> float:
    """The mean square difference of samples scaled to 0..1."""
    return float(np.mean((a.astype(float) / 255 - b.astype(float) / 255) ** 2))


def structural_similarity(a: np.ndarray, b: np.ndarray, window: int = 7) -> float:
    """Mean structural similarity of two grey pictures of one size, over square windows; 0 if sizes differ or are too small."""
    if a.shape != b.shape or min(a.shape) < window:
        return 0.0
    n = window * window

    def total(p: np.ndarray) -> np.ndarray:
        """The sums of all windows, from sums of the rectangles that begin at the corner."""
        sums = np.zeros((p.shape[0] + 1, p.shape[1] + 1))
        sums[1:, 1:] = p.cumsum(axis=0).cumsum(axis=1)
        return sums[window:, window:] - sums[:-window, window:] - sums[window:, :-window] + sums[:-window, :-window]

    x, y = a.astype(float), b.astype(float)
    mx, my = total(x) / n, total(y) / n
    spread = lambda p, q, mp, mq: (total(p * q) - n * mp * mq) / (n - 1)
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    top = (2 * mx * my + c1) * (2 * spread(x, y, mx, my) + c2)
    return float((top / ((mx**2 + my**2 + c1) * (spread(x, x, mx, mx) + spread(y, y, my, my) + c2))).mean())


def perceptual_hash(gray: np.ndarray) -> int:
    """64 bits: which of the lowest 8 x 8 cosine coefficients of a 32 x 32 picture lie above their median."""
    rows, cols = (np.linspace(0, n - 1, 32).astype(int) for n in gray.shape)
    small = gray[np.ix_(rows, cols)].astype(float)
    k = np.arange(32)
    basis = np.cos(np.pi / 32 * (k[None, :] + 0.5) * k[:, None])
    low = (basis @ small @ basis.T)[:8, :8]
    bits = (low > np.median(low)).ravel()
    return int("".join("1" if x else "0" for x in bits), 2) - (1 << 64 if bits[0] else 0)


def colour_distance(a: np.ndarray, b: tuple[float, float, float]) -> float:
    """The mean distance of RGB pixels from a colour, 0 to 1."""
    return float(np.sqrt(((a.reshape(-1, 3).astype(float) - np.array(b)) ** 2).sum(axis=1)).mean() / np.sqrt(3 * 255**2))


def warped_distance(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """(cost, length) of the best alignment of two series of feature rows by cosine distance."""
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    d = 1 - unit(a.astype(float)) @ unit(b.astype(float)).T
    n, m = d.shape
    cost, steps = np.full((n + 1, m + 1), np.inf), np.zeros((n + 1, m + 1), int)
    cost[0, 0] = 0
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            before = min((cost[i - 1, j - 1], steps[i - 1, j - 1]), (cost[i - 1, j], steps[i - 1, j]), (cost[i, j - 1], steps[i, j - 1]))
            cost[i, j], steps[i, j] = before[0] + d[i - 1, j - 1], before[1] + 1
    return float(cost[n, m]), int(steps[n, m])
