"""Pictures decoded to numpy arrays (PNG, BMP, XWD), resized and compared.

JPEG, WebP and video need a decoder that is not there; they raise ``NoDecoder``.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

from loomtrace.functions import images as I


class NoDecoder(ValueError):
    """The format needs a library."""


@dataclass
class Picture:
    """``samples`` are height x width x channels bytes: grey, grey with alpha, RGB or RGBA; ``palette`` marks those by numbers."""

    samples: np.ndarray
    palette: bool = False

    @property
    def size(self) -> tuple[int, int]:
        return self.samples.shape[1], self.samples.shape[0]

    @property
    def rgb(self) -> np.ndarray:
        n = self.samples.shape[2]
        return self.samples[:, :, :3] if n >= 3 else np.repeat(self.samples[:, :, :1], 3, axis=2)

    @property
    def alpha(self) -> np.ndarray | None:
        return self.samples[:, :, -1] if self.samples.shape[2] in (2, 4) else None

    @property
    def grey(self) -> np.ndarray:
        if self.samples.shape[2] < 3:
            return self.samples[:, :, 0]
        return ((self.rgb.astype(np.uint32) @ np.array([19595, 38470, 7471], np.uint32) + 0x8000) >> 16).astype(np.uint8)

    @property
    def hsv(self) -> np.ndarray:
        """Hue, saturation and value as bytes."""
        rgb = self.rgb.astype(float)
        high, low = rgb.max(axis=2), rgb.min(axis=2)
        spread = high - low
        with np.errstate(invalid="ignore", divide="ignore"):
            r, g, b = ((high - rgb[:, :, k]) / spread for k in range(3))
            hue = np.where(rgb[:, :, 0] == high, b - g, np.where(rgb[:, :, 1] == high, 2 + r - b, 4 + g - r)) / 6 % 1
            full = np.where(high > 0, spread / np.maximum(high, 1), 0)
        hue = np.where(spread > 0, hue, 0)
        return np.stack([hue * 255, full * 255, high], axis=2).astype(np.uint8)

    def content(self) -> Picture | None:
        """What is not wholly transparent; null if all is."""
        if self.alpha is None:
            return self
        rows, columns = np.flatnonzero(self.alpha.any(axis=1)), np.flatnonzero(self.alpha.any(axis=0))
        return None if not len(rows) else Picture(self.samples[rows[0] : rows[-1] + 1, columns[0] : columns[-1] + 1])


def decode(data: bytes) -> Picture:
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return _png(data)
    if data[:2] == b"BM":
        return _bmp(data)
    if len(data) > 24 and struct.unpack(">I", data[4:8])[0] == 7:
        return _xwd(data)
    raise NoDecoder("no decoder for this picture")


# The passes of interlaced pictures as first row, first column, and steps of each.
_PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))


def _png(data: bytes) -> Picture:
    at, body, palette, clear = 8, [], None, None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            clear = np.frombuffer(chunk, np.uint8)
        elif kind == b"IDAT":
            body.append(chunk)
        at += size + 12
    raw = zlib.decompress(b"".join(body))
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    out = np.zeros((height, width, channels), np.uint8)
    start = 0
    for r0, c0, dr, dc in _PASSES if interlaced else ((0, 0, 1, 1),):
        rows, columns = -(-(height - r0) // dr), -(-(width - c0) // dc)
        if rows > 0 and columns > 0:
            part, used = _scanlines(raw[start:], rows, columns, channels, depth)
            out[r0::dr, c0::dc] = part
            start += used
    if colour == 3:
        shown = palette[out[:, :, 0]]
        if clear is not None:
            table = np.full(len(palette), 255, np.uint8)
            table[: len(clear)] = clear
            shown = np.concatenate([shown, table[out[:, :, :1]]], axis=2)
        return Picture(shown, palette=True)
    if depth < 8 and colour == 0:
        out = (out.astype(int) * 255 // ((1 << depth) - 1)).astype(np.uint8)
    return Picture(out)


def _scanlines(raw: bytes, rows: int, columns: int, channels: int, depth: int) -> tuple[np.ndarray, int]:
    """(samples as bytes, bytes used) of filtered lines."""
    stride, step = -(-columns * channels * depth // 8), max(1, channels * depth // 8)
    lines = np.frombuffer(raw[: rows * (stride + 1)], np.uint8).reshape(rows, stride + 1)
    done = np.zeros((rows, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(rows):
        kind, line = lines[y, 0], lines[y, 1:]
        if kind == 0:
            now = line
        elif kind == 1:
            padded = np.zeros(-(-stride // step) * step, np.uint8)
            padded[:stride] = line
            now = np.cumsum(padded.reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:stride]
        elif kind == 2:
            now = line + above
        else:
            now = _left_dependent(line, above, step, kind == 4)
        done[y] = above = now
    if depth == 16:
        done = done[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(done, axis=1).reshape(rows, -1, depth)
        done = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2).astype(np.uint8)[:, : columns * channels]
    return done.reshape(rows, columns, channels), rows * (stride + 1)


def _left_dependent(line: np.ndarray, above: np.ndarray, step: int, paeth: bool) -> np.ndarray:
    """Lines filtered by the mean, or by the nearest of three neighbours."""
    out, up, own = bytearray(len(line)), above.tolist(), line.tolist()
    for i, x in enumerate(own):
        left, corner = (out[i - step], up[i - step]) if i >= step else (0, 0)
        if paeth:
            p = left + up[i] - corner
            a, b, c = abs(p - left), abs(p - up[i]), abs(p - corner)
            guess = left if a <= b and a <= c else up[i] if b <= c else corner
        else:
            guess = (left + up[i]) // 2
        out[i] = (x + guess) & 255
    return np.frombuffer(bytes(out), np.uint8)


def _bmp(data: bytes) -> Picture:
    offset, _, width, height, _, bits, packed = struct.unpack("<IIiiHHI", data[10:34])
    if bits not in (24, 32) or packed not in (0, 3):
        raise NoDecoder("a bitmap of another kind")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, abs(height) * stride, offset).reshape(abs(height), stride)[:, : width * bits // 8].reshape(abs(height), width, bits // 8)
    return Picture((rows[::-1] if height > 0 else rows)[:, :, [2, 1, 0]])


def _xwd(data: bytes) -> Picture:
    """A dump of a screen, whose pixels are blue, green, red and a byte more, or red, green and blue."""
    head, _, _, depth, width, height = struct.unpack(">6I", data[:24])
    n = {32: 4, 24: 3}.get(depth)
    if n is None:
        raise NoDecoder("a screen dump of another depth")
    pixels = np.frombuffer(data, np.uint8, width * height * n, head).reshape(height, width, n)
    return Picture(pixels[:, :, [2, 1, 0]] if n == 4 else pixels)


def resized(samples: np.ndarray, size: tuple[int, int], lobes: int = 3) -> np.ndarray:
    """Samples of another (width, height), by the Lanczos kernel of that many lobes, widened where it shrinks."""
    out = samples.astype(float)
    for axis, target in ((1, size[0]), (0, size[1])):
        source = out.shape[axis]
        if source == target:
            continue
        scale = source / target
        reach = lobes * max(scale, 1.0)
        centre = (np.arange(target) + 0.5) * scale
        first = np.maximum(np.floor(centre - reach + 0.5).astype(int), 0)
        last = np.minimum(np.floor(centre + reach + 0.5).astype(int), source)
        places = first[:, None] + np.arange(int((last - first).max()))
        x = (places + 0.5 - centre[:, None]) / max(scale, 1.0)
        weights = np.where((places < last[:, None]) & (np.abs(x) < lobes), np.sinc(x) * np.sinc(x / lobes), 0)
        weights /= weights.sum(axis=1, keepdims=True)
        moved = np.moveaxis(out, axis, 0)[np.minimum(places, source - 1)]
        out = np.moveaxis(np.einsum("tk,tk...->t...", weights, moved), 0, axis)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The structural similarity of two pictures of one size, the mean of their channels."""
    a, b = (x[:, :, None] if x.ndim == 2 else x for x in (a, b))
    return float(np.mean([I.structural_similarity(a[:, :, k], b[:, :, k]) for k in range(a.shape[2])]))


def same_structure(a: np.ndarray, b: np.ndarray, threshold: float = 0.9) -> bool:
    if a.shape[:2] != b.shape[:2] or min(a.shape[:2]) < 7:
        return False
    return similarity(a, b) >= threshold
