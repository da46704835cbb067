"""Operators on image files: regions, crops, contact sheets. Bytes come from ``binaryFile`` tables, pixels from functions/pixels.py.

Text in images and pages of PDF files need engines of their own that aren't
part of this library; what is read by one enters as a table (``code_words``).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platemark.functions import pixels as px
from platemark.operators.sequence import with_ordinal
from platemark.session import local_view


def map_images(files: DataFrame, function: Callable[[str, bytes], list[dict]], schema: T.StructType | str) -> DataFrame:
    """Rows that ``function(path, content)`` gives for each file of a ``binaryFile`` table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for p, c in zip(batch["path"], batch["content"], strict=True) for r in function(p, bytes(c))]
            if rows:
                yield pd.DataFrame(rows)

    return files.select("path", "content").mapInPandas(run, schema)


def detect_regions(files: DataFrame, with_edges: bool = True) -> DataFrame:
    """(path, source, x, y, w, h): boxes of regions of PNG files by mask and, ``with_edges``, by edge; ``boxes.fits`` tells which are of use.

    A file that can't be read gives one row with source 'unreadable' and no box.
    """

    def regions(path: str, content: bytes) -> list[dict]:
        try:
            image = px.decode_png(content)
        except ValueError:
            return [{"path": path, "source": "unreadable", "x": None, "y": None, "w": None, "h": None}]
        found = [("mask", px.mask_boxes(image))] + ([("edge", px.edge_boxes(image))] if with_edges else [])
        return [{"path": path, "source": s, "x": x, "y": y, "w": w, "h": h} for s, boxes in found for x, y, w, h in boxes.tolist()]

    return map_images(files, regions, "path string, source string, x int, y int, w int, h int")


def crops(files: DataFrame, boxes: DataFrame) -> DataFrame:
    """(path, filename, content, touches_edge): PNG files of ``boxes`` (path, filename, x, y, w, h), held to the image, of the files of their path.

    ``touches_edge`` tells whether the crop's dark part reaches its border. A
    page's boxes travel with its file, so a page is read once.
    """
    of_page = boxes.groupBy("path").agg(F.collect_list(F.struct("filename", "x", "y", "w", "h")).alias("boxes"))
    joined = files.select("path", "content").join(of_page, "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content, of in zip(batch["path"], batch["content"], batch["boxes"], strict=True):
                image, out = px.decode_png(bytes(content)), []
                for b in of:
                    x, y = max(0, b["x"]), max(0, b["y"])
                    crop = image[y : max(y, b["y"] + b["h"]), x : max(x, b["x"] + b["w"])]
                    out.append((path, b["filename"], px.encode_png(crop) if crop.size else None, px.touches_edge(px.ink(px.grey(crop)))))
                yield pd.DataFrame(out, columns=["path", "filename", "content", "touches_edge"])

    return joined.mapInPandas(run, "path string, filename string, content binary, touches_edge boolean")


def write_files(df: DataFrame, folder: str) -> None:
    """One file for each row's (filename, content) in a folder that all executors share; a task that runs again writes the same."""
    if "://" in folder and not folder.startswith("file:"):
        raise ValueError("files are written through a mounted folder")
    target = os.path.dirname(local_view(f"{folder.rstrip('/')}/x"))

    def write(rows: Iterator) -> None:
        for r in rows:
            path = os.path.join(target, os.path.basename(r.filename))
            part = f"{path}.{os.getpid()}.part"
            with open(part, "wb") as out:
                out.write(r.content)
            os.replace(part, path)

    df.filter("content IS NOT NULL AND filename IS NOT NULL").select("filename", "content").foreachPartition(write)


def contact_sheets(images: DataFrame, columns: int, width: int, height: int, per_sheet: int) -> DataFrame:
    """(sheet, n, content): PNG files with ``per_sheet`` thumbnails each, in order of filename, row by row."""
    order = [F.col("filename")]
    numbered = with_ordinal(images.filter("content IS NOT NULL").select("filename", "content"), order, "place").withColumn("sheet", F.floor((F.col("place") - 1) / per_sheet).cast("int"))

    def draw(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = -(-len(frame) // columns)
        sheet = np.full((rows * height, columns * width, 3), 255, np.uint8)
        for i, content in enumerate(frame.sort_values("place")["content"]):
            top, left = i // columns * height, i % columns * width
            sheet[top : top + height, left : left + width] = px.thumbnail(px.decode_png(bytes(content)), width, height)
        return pd.DataFrame({"sheet": [key[0]], "n": [len(frame)], "content": [px.encode_png(sheet)]})

    return numbered.groupBy("sheet").applyInPandas(draw, "sheet int, n int, content binary")


def code_words(words: DataFrame, pattern: str, least: int) -> DataFrame:
    """Boxes (left, top, width, height) of words of a table (text, conf, left, top, width, height) that hold a code, read with a confidence of ``least`` or more."""
    sure = F.when(F.col("conf").rlike("^[0-9]+$"), F.col("conf").try_cast("int")).otherwise(-1)
    return words.withColumn("text", F.trim("text")).filter((F.col("text") != "") & (sure >= least) & F.col("text").rlike(pattern))


def ink_profile(pixels: DataFrame, keys: list[str], axis: str, threshold: int = 245) -> DataFrame:
    """(keys, axis, ink, density): dark pixels and their share along an axis, of rows (keys, axis, value)."""
    dark = F.when(F.col("value") < threshold, 1).otherwise(0)
    return pixels.groupBy(*keys, axis).agg(F.sum(dark).alias("ink"), F.avg(dark).alias("density"))


def sheet_slot(index: str, columns: int) -> tuple:
    """(column, row) of an item on a contact sheet."""
    return F.pmod(F.col(index), F.lit(columns)), F.floor(F.col(index) / columns)
