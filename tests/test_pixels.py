import random
import struct
import zlib

import numpy as np
import pytest

from platemark.functions import pixels as px
from platemark.sources import images

rng = np.random.default_rng(4)


def png(raw, width, height, depth, colour, palette=None):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return px.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", zlib.compress(raw)[:9]) + chunk(b"IDAT", zlib.compress(raw)[9:]) + chunk(b"IEND", b"")


def filtered(image, kind):
    """Rows with a filter, by its definition."""
    h, w, c = image.shape
    flat = image.reshape(h, w * c).astype(int)
    out = bytearray()
    for y in range(h):
        out.append(kind)
        for i in range(w * c):
            a, b = (flat[y, i - c] if i >= c else 0), (flat[y - 1, i] if y else 0)
            d = flat[y - 1, i - c] if y and i >= c else 0
            p = a + b - d
            guess = [0, a, b, (a + b) // 2, min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]][kind]
            out.append((flat[y, i] - guess) % 256)
    return bytes(out)


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("channels,colour", [(1, 0), (3, 2), (2, 4), (4, 6)])
def test_png_files_of_all_filters(kind, channels, colour):
    image = rng.integers(0, 256, (7, 9, channels), dtype=np.uint8)
    seen = px.decode_png(png(filtered(image, kind), 9, 7, 8, colour))
    assert (seen == (image[:, :, :3] if channels > 2 else np.repeat(image[:, :, :1], 3, axis=2))).all()


def test_other_png_files():
    image = rng.integers(0, 256, (11, 5, 3), dtype=np.uint8)
    assert (px.decode_png(px.encode_png(image)) == image).all() and (px.decode_png(px.encode_png(image[:, :, 0])) == image[:, :, :1]).all()
    assert px.decode_png(png(bytes([0, 0b10110000]), 4, 1, 1, 0))[0, :, 0].tolist() == [255, 0, 255, 255]
    assert px.decode_png(png(bytes([0, 0b00011011]), 4, 1, 2, 3, bytes(range(12))))[0].tolist() == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9, 10, 11]]
    assert px.decode_png(png(bytes([0, 7, 9, 200, 1]), 2, 1, 16, 0))[0, :, 0].tolist() == [7, 200]
    for bad in (b"", b"GIF", px.SIGNATURE, px.encode_png(image)[:40], png(b"\x09abc", 1, 1, 8, 2), png(bytes([0, 9]), 1, 1, 8, 3, bytes(6))):
        with pytest.raises(ValueError):
            px.decode_png(bad)


def test_threshold_parts_two_classes():
    values = np.concatenate((rng.integers(20, 60, 300), rng.integers(180, 230, 700))).astype(np.uint8)
    best = max(range(256), key=lambda t: ((values <= t).mean() * (values > t).mean() * (values[values <= t].mean() - values[values > t].mean()) ** 2) if 0 < (values <= t).sum() < 1000 else 0)
    assert px.otsu(values) == best and px.otsu(np.full(9, 255, np.uint8)) == 0


@pytest.mark.parametrize("side", [3, 7])
def test_windows_equal_their_definition(side):
    mask, half = rng.random((17, 23)) < 0.3, side // 2
    around = lambda m, y, x: m[max(0, y - half) : y + half + 1, max(0, x - half) : x + half + 1]
    grown = np.array([[around(mask, y, x).any() for x in range(23)] for y in range(17)])
    assert (px.dilated(mask, side) == grown).all()
    assert (px.eroded(mask, side) == np.array([[around(mask, y, x).all() for x in range(23)] for y in range(17)])).all()
    assert (px.closed(mask, side) == np.array([[around(grown, y, x).all() for x in range(23)] for y in range(17)])).all()


def flood(mask, y, x, steps):
    seen, todo = {(y, x)}, [(y, x)]
    while todo:
        y, x = todo.pop()
        for dy, dx in steps:
            p = (y + dy, x + dx)
            if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and p not in seen:
                seen.add(p)
                todo.append(p)
    return seen


@pytest.mark.parametrize("seed", range(12))
def test_components_equal_flooding(seed):
    r = np.random.default_rng(seed)
    mask = r.random((r.integers(1, 25), r.integers(1, 25))) < r.choice([0.15, 0.4, 0.6])
    if seed % 3 == 0 and min(mask.shape) > 6:
        mask[:] = False
        mask[0:-1, 0] = mask[0:-1, -1] = mask[0, :] = mask[-2, :] = True
        mask[2:4, 2:4] = True  # lies in the frame's hole
    cross = [(0, 1), (1, 0), (0, -1), (-1, 0)]
    ground = flood(np.pad(~mask, 1, constant_values=True), 0, 0, cross)
    left, expected = {tuple(p) for p in np.argwhere(mask)}, []
    while left:
        y, x = min(left)
        part = flood(mask, y, x, [*cross, (1, 1), (1, -1), (-1, 1), (-1, -1)])
        left -= part
        if any((py + 1 + dy, px_ + 1 + dx) in ground for py, px_ in part for dy, dx in cross):
            ys, xs = [p[0] for p in part], [p[1] for p in part]
            expected.append([min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1])
    assert px.outer_boxes(mask).tolist() == expected


def test_colours():
    hues = {(255, 0, 0): 0, (0, 255, 0): 60, (0, 0, 255): 120, (255, 255, 0): 30, (255, 0, 255): 150, (9, 9, 9): 0}
    assert px.hsv(np.array([list(hues)], np.uint8))[0][0].tolist() == list(hues.values())
    assert px.coloured(np.array([[(220, 20, 20), (20, 60, 200), (240, 200, 20), (128, 128, 128), (30, 200, 30)]], np.uint8))[0].tolist() == [True, True, True, False, False]


def page():
    image = np.full((160, 200, 3), 255, np.uint8)
    image[20:60, 30:90] = (200, 20, 20)
    image[30:50, 40:80] = 255  # a ring: what lies in its hole is not a region of its own
    image[36:44, 50:60] = 0
    image[100:140, 120:170] = 0
    image[5, 5] = 0  # a speck
    return image


def test_regions_of_a_page():
    assert px.mask_boxes(page()).tolist() == [[30, 20, 60, 40], [120, 100, 50, 40]]
    found = px.edge_boxes(page()).tolist()
    for x, y, w, h in ([30, 20, 60, 40], [120, 100, 50, 40]):
        assert any(abs(x - a) <= 2 and abs(y - b) <= 2 and abs(w - c) <= 4 and abs(h - d) <= 4 for a, b, c, d in found)
    step = np.where(np.arange(40) < 20, 10, 200)[None, :].repeat(30, axis=0).astype(np.uint8)
    assert sorted(set(np.nonzero(px.edges(step, 50, 150))[1].tolist())) in ([19], [20]) and not px.edges(np.full((9, 9), 7), 50, 150).any()
    faint = np.where(np.arange(40) < 20, 100, 130)[None, :].repeat(30, axis=0)
    assert not px.edges(faint, 50, 150).any() and px.edges(faint, 50, 110).any()


@pytest.mark.parametrize("at,touches", [((0, 5), True), ((9, 5), True), ((5, 0), True), ((5, 9), True), ((5, 5), False)])
def test_touching_the_edge(at, touches):
    mask = np.zeros((10, 10), bool)
    mask[at] = True
    assert px.touches_edge(mask) is touches and px.touches_edge(np.zeros((0, 3), bool))


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.png").write_bytes(px.encode_png(page()))
    (tmp_path / "in" / "bad.png").write_bytes(b"no image")
    files = spark.read.format("binaryFile").load(str(tmp_path / "in"))
    got = images.detect_regions(files, with_edges=False).collect()
    assert sorted((r.path.split("/")[-1], r.source, r.x, r.y, r.w, r.h) for r in got) == [("bad.png", "unreadable", None, None, None, None), ("p.png", "mask", 30, 20, 60, 40), ("p.png", "mask", 120, 100, 50, 40)]
    path = next(r.path for r in got if r.source == "mask")
    boxes = spark.createDataFrame([(path, "a.png", 25, 15, 70, 50), (path, "b.png", 150, 120, 900, 900), (path, "c.png", 500, 500, 9, 9)], "path string, filename string, x int, y int, w int, h int")
    crops = {r.filename: r for r in images.crops(files, boxes).collect()}
    assert (px.decode_png(bytes(crops["a.png"].content)) == page()[15:65, 25:95]).all() and not crops["a.png"].touches_edge
    assert px.decode_png(bytes(crops["b.png"].content)).shape == (40, 50, 3) and crops["b.png"].touches_edge
    assert crops["c.png"].content is None and crops["c.png"].touches_edge
    out = tmp_path / "out"
    images.write_files(images.crops(files, boxes), f"file://{out}")
    images.write_files(images.crops(files, boxes), str(out))
    assert sorted(p.name for p in out.iterdir()) == ["a.png", "b.png"]
    with pytest.raises(ValueError, match="mounted"):
        images.write_files(images.crops(files, boxes), "s3://x")
    sheets = images.contact_sheets(images.crops(files, boxes), 2, 30, 20, 2).collect()
    assert [(r.sheet, r.n) for r in sheets] == [(0, 2)]
    sheet = px.decode_png(bytes(sheets[0].content))
    assert sheet.shape == (20, 60, 3) and (sheet[:20, :28] == px.thumbnail(page()[15:65, 25:95], 30, 20)[:, :28]).all()


def test_words(spark):
    words = spark.createDataFrame([(" R1.2 ", "91", 1), ("R1", "40", 2), ("R2", "-1", 3), ("R3", "x", 4), ("", "99", 5), ("street", "99", 6), (None, "99", 7)], "text string, conf string, left int")
    assert [(r.text, r.left) for r in images.code_words(words, r"[A-Z]{1,3}[0-9]{1,3}", 60).collect()] == [("R1.2", 1)]


def test_random_pages_are_found():
    r = random.Random(2)
    for _ in range(10):
        image = np.full((120, 120, 3), 250, np.uint8)
        boxes = [(r.randrange(10, 20) + 50 * i, r.randrange(10, 70), r.randrange(10, 30), r.randrange(10, 40)) for i in range(2)]
        for x, y, w, h in boxes:
            image[y : y + h, x : x + w] = r.choice([(0, 0, 0), (200, 10, 10), (10, 40, 220)])
        assert sorted(map(tuple, px.mask_boxes(image).tolist())) == sorted(boxes)
