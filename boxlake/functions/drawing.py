"""Pictures as RGB arrays: decoding, boxes drawn on them, grids, PNG encoding; in Arrow batches over rows."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.functions.labels import label, label_colour
from boxlake.functions.pictures import rgb_pixels
from boxlake.operators.targets import drawable


def png_bytes(pixels: np.ndarray) -> bytes:
    """An RGB picture (rows, columns, 3) as PNG."""
    rows, columns, _ = pixels.shape
    body = np.zeros((rows, 1 + columns * 3), np.uint8)
    body[:, 1:] = pixels.reshape(rows, -1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", columns, rows, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body.tobytes(), 6)) + chunk(b"IEND", b"")


def draw_box(pixels: np.ndarray, box: tuple[float, float, float, float], colour: tuple[int, int, int], thick: int = 2) -> None:
    """Draws the outline of a box (x, y, w, h) in place; what lies outside the picture is not drawn."""
    rows, columns, _ = pixels.shape
    x1, y1, x2, y2 = (int(round(v)) for v in (box[0], box[1], box[0] + box[2], box[1] + box[3]))
    for a, b, c, d in ((x1, y1, x2, y1 + thick), (x1, y2 - thick, x2, y2), (x1, y1, x1 + thick, y2), (x2 - thick, y1, x2, y2)):
        pixels[max(0, b) : max(0, min(rows, d)), max(0, a) : max(0, min(columns, c))] = colour


def grid(pictures: list[np.ndarray], columns: int, cell: tuple[int, int] | None = None, fill: int = 0) -> np.ndarray:
    """Pictures side by side, row after row, each in the upper left of a cell of the largest one's size (or a given one)."""
    if columns <= 0:
        raise ValueError("a grid needs at least one column")
    if not pictures:
        return np.zeros((0, 0, 3), np.uint8)
    h, w = cell or (max(p.shape[0] for p in pictures), max(p.shape[1] for p in pictures))
    out = np.full((-(-len(pictures) // columns) * h, min(columns, len(pictures)) * w, 3), fill, np.uint8)
    for i, p in enumerate(pictures):
        y, x = i // columns * h, i % columns * w
        part = p[:h, :w]
        out[y : y + part.shape[0], x : x + part.shape[1]] = part
    return out


def drawn(rows: DataFrame, mode: str = "native", draw_ignored: bool = False, draw_crowd: bool = True) -> DataFrame:
    """(image_id, png): pictures with the outlines of their objects in their labels' colours; null if it cannot be read."""
    shown = F.filter(F.coalesce("objects", F.array()), lambda o: drawable(o, mode, draw_ignored, draw_crowd))
    boxes = F.transform(shown, lambda o: F.struct(F.transform(o["bbox"], lambda v: v.cast("double")).alias("b"), label_colour(label(o, mode)).alias("c")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pixels = rgb_pixels(data)
                if pixels is not None:
                    pixels = pixels.copy()
                    for o in held:
                        draw_box(pixels, o["b"], tuple(o["c"]))
                out.append(None if pixels is None else png_bytes(pixels))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["image_id", "png"])

    return rows.select("image_id", F.col("image.bytes").alias("bytes"), boxes.alias("boxes")).mapInArrow(run, "image_id string, png binary")
