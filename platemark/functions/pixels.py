"""Pixels in NumPy: PNG files, masks, edges and the boxes of what they show.

An image is an array (height, width, 3) of bytes, red first; a mask one of
truth values. Everything works on whole rows and columns at once: windows by
running sums, components by the runs of a mask's rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
# Hue, saturation and value (0-179, 0-255, 0-255) from which to which a pixel is a sign's colour (fixed values).
COLOURS = [
    ((0, 40, 40), (12, 255, 255)),
    ((160, 40, 40), (179, 255, 255)),
    ((90, 40, 40), (140, 255, 255)),
    ((15, 70, 70), (40, 255, 255)),
    ((100, 4, 0), (179, 255, 255)),
]
# Sides of the windows of masks and of edges, and the thresholds of edges (fixed values).
MASK_WINDOW, EDGE_WINDOW, BLUR, WEAK, STRONG = 7, 5, 5, 50, 150


def encode_png(image: np.ndarray) -> bytes:
    """A PNG file of an image, or of a grey one (height, width)."""
    height, width = image.shape[:2]
    rows = np.ascontiguousarray(image, np.uint8).reshape(height, -1)
    raw = np.concatenate((np.zeros((height, 1), np.uint8), rows), axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def decode_png(content: bytes) -> np.ndarray:
    """The image of a PNG file of any kind but interlaced ones; transparency is dropped. ValueError if it is damaged."""
    if content[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    chunks: dict[bytes, bytes] = {}
    at = 8
    while at + 8 <= len(content):
        (size,), kind = struct.unpack(">I", content[at : at + 4]), content[at + 4 : at + 8]
        chunks[kind] = chunks.get(kind, b"") + content[at + 8 : at + 8 + size]
        at += size + 12
    try:
        width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", chunks[b"IHDR"])
        channels = CHANNELS[colour]
        data = zlib.decompress(chunks[b"IDAT"])
    except (KeyError, struct.error, zlib.error) as e:
        raise ValueError("damaged PNG file") from e
    stride = (width * channels * depth + 7) // 8
    if interlaced or len(data) < height * (stride + 1):
        raise ValueError("interlaced or incomplete PNG file")
    rows = _unfiltered(np.frombuffer(data, np.uint8, height * (stride + 1)).reshape(height, stride + 1), max(1, channels * depth // 8))
    if depth == 16:
        rows = rows[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(rows, axis=1)[:, : width * depth].reshape(height, width, depth)
        rows = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(2).astype(np.uint8)
        rows = rows * (255 // ((1 << depth) - 1)) if colour == 0 else rows
    pixels = rows.reshape(height, width, channels)
    if colour == 3:
        palette = np.frombuffer(chunks.get(b"PLTE", b""), np.uint8).reshape(-1, 3)
        if pixels.size and pixels.max() >= len(palette):
            raise ValueError("damaged PNG file")
        return palette[pixels[:, :, 0]]
    return np.ascontiguousarray(pixels[:, :, :3] if channels > 2 else np.repeat(pixels[:, :, :1], 3, axis=2))


def _unfiltered(lines: np.ndarray, step: int) -> np.ndarray:
    """Rows without their filters: 0 none, 1 left, 2 above, 3 mean of both, 4 the nearest of left, above and their corner."""
    kinds, out = lines[:, 0], lines[:, 1:].copy()
    before = np.zeros(out.shape[1], np.uint8)
    for row, kind in zip(out, kinds.tolist(), strict=True):
        if kind == 1:
            for c in range(step):
                row[c::step] = np.cumsum(row[c::step], dtype=np.uint64).astype(np.uint8)
        elif kind == 2:
            row += before
        elif kind in (3, 4):
            line, above = row.tolist(), before.tolist()
            for i, value in enumerate(line):
                a, b, c = (line[i - step], above[i], above[i - step]) if i >= step else (0, above[i], 0)
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
                line[i] = (value + guess) & 255
            row[:] = line
        elif kind:
            raise ValueError("damaged PNG file")
        before = row
    return out


def grey(image: np.ndarray) -> np.ndarray:
    return ((image.astype(np.uint32) @ np.array([299, 587, 114], np.uint32) + 500) // 1000).astype(np.uint8)


def otsu(values: np.ndarray) -> int:
    """The value up to which pixels are dark: it parts the two classes whose means are the most apart, weighed by their sizes."""
    count = np.bincount(values.ravel(), minlength=256).astype(float)
    dark, total = np.cumsum(count), count.sum()
    weight = np.cumsum(count * np.arange(256))
    with np.errstate(all="ignore"):
        apart = (weight * total - dark * weight[-1]) ** 2 / (dark * (total - dark))
    return int(np.argmax(np.nan_to_num(apart, nan=0.0, posinf=0.0)))


def ink(values: np.ndarray) -> np.ndarray:
    """Dark pixels by Otsu's threshold."""
    return values <= otsu(values) if values.size else np.zeros(values.shape, bool)


def hsv(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue (0-179), saturation and value (0-255)."""
    r, g, b = (image[:, :, i].astype(float) for i in range(3))
    top, low = image.max(2).astype(float), image.min(2).astype(float)
    apart = np.where(top > low, top - low, 1.0)
    hue = np.where(top == r, (g - b) / apart, np.where(top == g, 2 + (b - r) / apart, 4 + (r - g) / apart)) * 30
    hue = np.where(top > low, np.rint(np.where(hue < 0, hue + 180, hue)) % 180, 0)
    return hue, np.rint(np.where(top > 0, (top - low) * 255 / np.where(top > 0, top, 1), 0)), top


def coloured(image: np.ndarray) -> np.ndarray:
    channels = hsv(image)
    out = np.zeros(image.shape[:2], bool)
    for low, high in COLOURS:
        out |= np.logical_and.reduce([(c >= a) & (c <= b) for c, a, b in zip(channels, low, high, strict=True)])
    return out


def _in_window(mask: np.ndarray, side: int) -> np.ndarray:
    """How many pixels are set in the square of odd ``side`` around each."""
    half = side // 2
    out = mask.astype(np.int32)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (half + 1, half)
        total = np.cumsum(np.pad(out, pad), axis=axis)
        n = mask.shape[axis]
        out = np.take(total, np.arange(side, side + n), axis=axis) - np.take(total, np.arange(n), axis=axis)
    return out


def dilated(mask: np.ndarray, side: int) -> np.ndarray:
    return _in_window(mask, side) > 0


def eroded(mask: np.ndarray, side: int) -> np.ndarray:
    """What is beyond the image doesn't take anything away."""
    return _in_window(~mask, side) == 0


def closed(mask: np.ndarray, side: int) -> np.ndarray:
    return eroded(dilated(mask, side), side)


def opened(mask: np.ndarray, side: int) -> np.ndarray:
    return dilated(eroded(mask, side), side)


class Runs:
    """Runs of set pixels of a mask's rows (row, first, stop), and the component each belongs to."""

    def __init__(self, mask: np.ndarray, corners: bool) -> None:
        turn = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        self.row, self.first = np.nonzero(turn == 1)
        self.stop = np.nonzero(turn == -1)[1]
        self.wide = np.int64(mask.shape[1] + 2)
        below = (self.row + 1) * self.wide
        reach = 0 if corners else 1  # whether runs that only meet at a corner are connected
        low = np.searchsorted(self.row * self.wide + self.stop, below + self.first + reach, "left")
        high = np.searchsorted(self.row * self.wide + self.first, below + self.stop - reach, "right")
        count = np.maximum(high - low, 0)
        upper = np.repeat(np.arange(len(self.row)), count)
        lower = np.repeat(low - np.concatenate(([0], np.cumsum(count)))[:-1], count) + np.arange(int(count.sum()))
        label = np.arange(len(self.row))
        while True:  # both ends of a link take the smaller label, and every label that of its own label
            least = np.minimum(label[upper], label[lower])
            new = label.copy()
            for end in (upper, lower):
                np.minimum.at(new, label[end], least)
            new = new[new]
            if (new == label).all():
                break
            label = new
        self.label = label

    def at(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The run that holds each of the pixels."""
        return np.searchsorted(self.row * self.wide + self.first, row * self.wide + column, "right") - 1


def outer_boxes(mask: np.ndarray) -> np.ndarray:
    """Boxes (x, y, w, h) of the components (corners connect) that don't lie in a hole of another, in order of their first pixel."""
    if not mask.any():
        return np.zeros((0, 4), np.int64)
    padded = np.pad(mask, 1)
    runs, ground = Runs(padded, True), Runs(~padded, False)
    heads, number = np.unique(runs.label, return_inverse=True)  # a component's label is its first run
    outside = ground.label[ground.at(runs.row[heads], runs.first[heads] - 1)] == ground.label[0]
    low = np.full((2, len(heads)), np.iinfo(np.int64).max)
    high = np.zeros((2, len(heads)), np.int64)
    for i, (a, b) in enumerate(((runs.first, runs.stop), (runs.row, runs.row + 1))):
        np.minimum.at(low[i], number, a)
        np.maximum.at(high[i], number, b)
    return np.stack((low[0] - 1, low[1] - 1, high[0] - low[0], high[1] - low[1]), axis=1)[outside]


def blurred(values: np.ndarray, side: int) -> np.ndarray:
    """Gaussian blur in a square of odd ``side``; the image is mirrored beyond its edge."""
    half = side // 2
    sigma = 0.3 * (half - 1) + 0.8
    kernel = np.exp(-((np.arange(side) - half) ** 2) / (2 * sigma * sigma))
    out = values.astype(float)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (half, half)
        wide = np.pad(out, pad, mode="reflect" if values.shape[axis] > half else "edge")
        out = sum(k * np.take(wide, np.arange(i, i + values.shape[axis]), axis=axis) for i, k in enumerate(kernel / kernel.sum()))
    return np.rint(out)


def edges(values: np.ndarray, weak: int, strong: int) -> np.ndarray:
    """Edges: ridges of the gradient above ``weak`` that hang together with one above ``strong``."""
    wide = np.pad(values.astype(float), 1, mode="edge")
    h, w = values.shape
    part = lambda di, dj: wide[1 + di : 1 + di + h, 1 + dj : 1 + dj + w]
    gx = part(-1, 1) + 2 * part(0, 1) + part(1, 1) - part(-1, -1) - 2 * part(0, -1) - part(1, -1)
    gy = part(1, -1) + 2 * part(1, 0) + part(1, 1) - part(-1, -1) - 2 * part(-1, 0) - part(-1, 1)
    size = np.abs(gx) + np.abs(gy)
    around = np.pad(size, 1)
    near = lambda di, dj: around[1 + di : 1 + di + h, 1 + dj : 1 + dj + w]
    flat, steep = np.abs(gy) < np.abs(gx) * np.tan(np.pi / 8), np.abs(gy) > np.abs(gx) * np.tan(3 * np.pi / 8)
    rising = gx * gy > 0
    before = np.where(flat, near(0, -1), np.where(steep, near(-1, 0), np.where(rising, near(-1, -1), near(-1, 1))))
    after = np.where(flat, near(0, 1), np.where(steep, near(1, 0), np.where(rising, near(1, 1), near(1, -1))))
    ridge = (size > weak) & (size > before) & (size >= after)
    if not ridge.any():
        return ridge
    runs = Runs(ridge, True)
    hit = np.concatenate((np.zeros((h, 1), np.int64), np.cumsum(ridge & (size > strong), axis=1)), axis=1)
    keep = np.zeros(len(runs.row), bool)
    keep[runs.label[hit[runs.row, runs.stop] > hit[runs.row, runs.first]]] = True
    out = ridge.copy()
    for i in np.flatnonzero(~keep[runs.label]).tolist():
        out[runs.row[i], runs.first[i] : runs.stop[i]] = False
    return out


def touches_edge(mask: np.ndarray) -> bool:
    """Is a pixel of the mask's border set? An empty mask touches."""
    return not mask.size or bool(mask[0].any() or mask[-1].any() or mask[:, 0].any() or mask[:, -1].any())


def mask_boxes(image: np.ndarray) -> np.ndarray:
    """Boxes of dark and coloured regions, closed and opened."""
    return outer_boxes(opened(closed(ink(grey(image)) | coloured(image), MASK_WINDOW), MASK_WINDOW))


def edge_boxes(image: np.ndarray) -> np.ndarray:
    """Boxes of closed edges."""
    return outer_boxes(closed(edges(blurred(grey(image), BLUR), WEAK, STRONG), EDGE_WINDOW))


def thumbnail(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """The image within (width, height), its proportions kept, on white; never enlarged. Each pixel is the nearest one."""
    out = np.full((height, width, 3), 255, np.uint8)
    if image.size:
        scale = min(1.0, width / image.shape[1], height / image.shape[0])
        h, w = max(1, int(image.shape[0] * scale)), max(1, int(image.shape[1] * scale))
        at = lambda n, size: np.minimum((np.arange(n) / scale).astype(int), size - 1)
        out[:h, :w] = image[at(h, image.shape[0])][:, at(w, image.shape[1])]
    return out
