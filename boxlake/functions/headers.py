"""Width and height of pictures from their headers, without decoding."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxlake.functions.pictures import _HEADER


def picture_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) of a PNG, JPEG, GIF, BMP, WebP or graymap; None for anything else or a cut-off header."""
    if not data:
        return None
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp(data)
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
    except struct.error:
        return None
    m = _HEADER.match(data)
    return (int(m[2]), int(m[3])) if m else None


def _webp(data: bytes) -> tuple[int, int] | None:
    kind = data[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
    if kind == b"VP8L":
        bits = struct.unpack("<I", data[21:25])[0]
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if kind == b"VP8 ":
        w, h = struct.unpack("<HH", data[26:30])
        return w & 0x3FFF, h & 0x3FFF
    return None


def _jpeg(data: bytes) -> tuple[int, int] | None:
    """The size in the first start-of-frame segment."""
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        marker = data[at + 1]
        if marker == 0xFF or 0xD0 <= marker <= 0xD9 or marker == 1:
            at += 1 if marker == 0xFF else 2
            continue
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", data[at + 5 : at + 9])
            return w, h
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def size_of(contents: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """struct<width, height> of a picture's bytes; nulls where the header cannot be read."""
    for c in contents:
        sizes = [picture_size(bytes(x)) if x is not None else None for x in c]
        yield pd.DataFrame({"width": pd.array([s[0] if s else None for s in sizes], "Int32"), "height": pd.array([s[1] if s else None for s in sizes], "Int32")})
