"""Pictures in the portable graymap format: content hashes, decoding and thumbnails."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Thumbnail size (rows, columns) to which pictures are brought before they are compared.
THUMB = (12, 16)

_GAP = rb"(?:[ \t\r\n\v\f]|#[^\n\r]*[\n\r])+"
_HEADER = re.compile(rb"P([25])" + _GAP + rb"(\d{1,6})" + _GAP + rb"(\d{1,6})" + _GAP + rb"(\d{1,5})[ \t\r\n\v\f]")


def decode_graymap(data: bytes | None) -> np.ndarray | None:
    """The pixels (rows, columns) of a plain or raw graymap of any depth, scaled to 0..1; None if it cannot be read."""
    m = _HEADER.match(data) if data else None
    if not m:
        return None
    width, height, top = int(m[2]), int(m[3]), int(m[4])
    n = width * height
    if not n or not 0 < top < 65536:
        return None
    try:
        if m[1] == b"5":
            a = np.frombuffer(data, ">u2" if top > 255 else "u1", n, m.end())
        else:
            a = np.array(re.sub(rb"#[^\n\r]*", b"", data[m.end() :]).split()[:n], dtype=np.float64)
            if a.size < n:
                return None
    except ValueError:
        return None
    return a.reshape(height, width).astype(np.float64) / top


def _png(data: bytes) -> np.ndarray | None:
    """The samples (rows, columns, channels) of a PNG as bytes; None if it is interlaced or damaged."""
    import struct
    import zlib

    at, body, palette, head = 8, b"", None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I", data[at : at + 4])[0], data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += part
        elif kind == b"IEND":
            break
    if head is None or head[6] or head[3] not in (0, 2, 3, 4, 6):
        return None
    width, height, depth, colour = head[:4]
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    line, step = -(-width * channels * depth // 8), max(1, channels * depth // 8)
    raw = np.frombuffer(zlib.decompress(body), np.uint8)
    if raw.size < height * (line + 1):
        return None
    raw = raw[: height * (line + 1)].reshape(height, line + 1)
    out = np.zeros((height, line), np.uint8)
    above = np.zeros(line, np.uint8)
    for y in range(height):
        how, row = int(raw[y, 0]), raw[y, 1:].copy()
        if how == 2:
            row += above
        elif how == 1:
            for k in range(step):  # a running sum per channel, modulo 256
                row[k::step] = np.cumsum(row[k::step], dtype=np.uint64).astype(np.uint8)
        elif how in (3, 4):
            held, up = row.tolist(), above.tolist()
            for i in range(line):
                left, corner = (held[i - step], up[i - step]) if i >= step else (0, 0)
                if how == 3:
                    guess = (left + up[i]) >> 1
                else:
                    p = left + up[i] - corner
                    a, b, c = abs(p - left), abs(p - up[i]), abs(p - corner)
                    guess = left if a <= b and a <= c else up[i] if b <= c else corner
                held[i] = (held[i] + guess) & 255
            row = np.array(held, np.uint8)
        elif how:
            return None
        out[y] = above = row
    if depth == 16:
        samples = out.reshape(height, width, channels, 2)[..., 0]
    elif depth == 8:
        samples = out.reshape(height, width, channels)
    else:
        bits = np.unpackbits(out, axis=1).reshape(height, -1, depth)[:, :width]
        values = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(-1)
        samples = (values if colour == 3 else values * 255 // ((1 << depth) - 1)).astype(np.uint8)[..., None]
    return palette[samples[..., 0]] if colour == 3 and palette is not None else None if colour == 3 else samples


_COLOUR_HEADER = re.compile(rb"P([36])" + _GAP + rb"(\d{1,6})" + _GAP + rb"(\d{1,6})" + _GAP + rb"(\d{1,5})[ \t\r\n\v\f]")


def _pixmap(data: bytes) -> np.ndarray | None:
    """The samples of a plain or raw pixmap as bytes."""
    m = _COLOUR_HEADER.match(data)
    if not m or not 0 < int(m[4]) < 65536:
        return None
    width, height, top = int(m[2]), int(m[3]), int(m[4])
    n = width * height * 3
    if m[1] == b"6":
        a = np.frombuffer(data, ">u2" if top > 255 else "u1", n, m.end())
    else:
        a = np.array(re.sub(rb"#[^\n\r]*", b"", data[m.end() :]).split()[:n], dtype=np.float64)
    return np.rint(a.reshape(height, width, 3).astype(np.float64) * 255 / top).clip(0, 255).astype(np.uint8) if a.size == n and n else None


def _bitmap(data: bytes) -> np.ndarray | None:
    """The samples of an uncompressed BMP of 24 or 32 bits."""
    import struct

    start, width, height, bits, packed = struct.unpack("<I", data[10:14])[0], *struct.unpack("<ii", data[18:26]), struct.unpack("<H", data[28:30])[0], struct.unpack("<I", data[30:34])[0]
    if bits not in (24, 32) or packed not in (0, 3) or width <= 0 or not height:
        return None
    step = bits // 8
    line = -(-width * step // 4) * 4
    a = np.frombuffer(data, np.uint8, abs(height) * line, start).reshape(abs(height), line)[:, : width * step].reshape(abs(height), width, step)
    return (a[::-1] if height > 0 else a)[..., 2::-1]


def rgb_pixels(data: bytes | None) -> np.ndarray | None:
    """A picture's pixels (rows, columns, 3) of 8 bits: PNG, graymap, pixmap or uncompressed BMP; None for what cannot be read.

    Grey becomes three equal channels, of more than three the first three remain.
    """
    if not data:
        return None
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            a = _png(data)
        elif data[:2] == b"BM":
            a = _bitmap(data)
        elif data[:2] in (b"P3", b"P6"):
            a = _pixmap(data)
        else:
            grey = decode_graymap(data)
            a = None if grey is None else np.rint(grey * 255).clip(0, 255).astype(np.uint8)[..., None]
    except Exception:  # whatever is wrong with a picture's bytes, it cannot be read
        return None
    if a is None or not a.size:
        return None
    return np.repeat(a[..., :1], 3, -1) if a.shape[-1] < 3 else np.ascontiguousarray(a[..., :3])


def grey_pixels(data: bytes | None) -> np.ndarray | None:
    """A picture's brightness (rows, columns) from 0 to 1; None for what cannot be read."""
    grey = decode_graymap(data)
    if grey is not None or not data or data[:1] == b"P" and data[1:2] in (b"2", b"5"):
        return grey
    rgb = rgb_pixels(data)
    return None if rgb is None else rgb @ np.array([0.299, 0.587, 0.114]) / 255


def _weights(n: int, m: int) -> np.ndarray:
    """(m, n) weights that average n pixels by area into m."""
    edges = np.linspace(0, n, m + 1)
    lo, hi = edges[:-1, None], edges[1:, None]
    at = np.arange(n)[None, :]
    w = np.clip(np.minimum(hi, at + 1) - np.maximum(lo, at), 0, None)
    return w / w.sum(1, keepdims=True)


_CACHE: dict[tuple[int, int], np.ndarray] = {}


def thumbnail(pixels: np.ndarray, size: tuple[int, int] = THUMB) -> np.ndarray:
    """The picture brought to one size by averaging areas."""
    if pixels.shape == size:
        return pixels
    sides = []
    for n, m in zip(pixels.shape, size, strict=True):
        if (n, m) not in _CACHE:
            if len(_CACHE) > 256:
                _CACHE.clear()
            _CACHE[n, m] = _weights(n, m)
        sides.append(_CACHE[n, m])
    return sides[0] @ pixels @ sides[1].T


def content_hash(data: bytes) -> bytes:
    """blake2b-32 of a picture's bytes."""
    return hashlib.blake2b(data, digest_size=32).digest()


def picture_hashes(image_rows: DataFrame) -> DataFrame:
    """(image_id, picture_hash) of every row that has bytes, hashed in Arrow batches; nothing else is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([content_hash(x) for x in b.column(1).to_pylist()], pa.binary())], ["image_id", "picture_hash"])

    rows = image_rows.select("image_id", F.col("image.bytes").alias("bytes")).filter("image_id is not null and bytes is not null")
    return rows.mapInArrow(run, "image_id string, picture_hash binary")


def valid_refs(row_refs: DataFrame, *columns: str) -> DataFrame:
    """The latest scan of every ref_id with its split cleaned and its content hash as 32 bytes (null if missing)."""
    from boxlake.functions.clean import hash_text, split_name
    from boxlake.operators.latest import latest_by

    keep = ["ref_id", "scanned_at", "image_id", "split", "content_hash", *[c for c in columns if c not in ("image_id", "split", "content_hash")]]
    refs = row_refs.select(*keep, split_name(F.col("split")).alias("__s"), F.unhex(hash_text(F.col("content_hash"))).alias("__h"))
    refs = refs.select(*[c for c in keep if c not in ("split", "content_hash")], F.col("__s").alias("split"), F.col("__h").alias("content_hash"))
    return latest_by(refs, "ref_id", "scanned_at").drop("scanned_at")
