"""Small picture files for tests."""

import struct
import zlib


def png(width: int, height: int, shade: int = 0) -> bytes:
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + bytes([shade]) * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def pgm(pixels, top: int = 255, plain: bool = False, comment: str = "") -> bytes:
    h, w = len(pixels), len(pixels[0])
    head = f"{'P2' if plain else 'P5'}\n{comment}{w} {h}\n{top}\n".encode()
    if plain:
        return head + "\n".join(" ".join(map(str, r)) for r in pixels).encode()
    return head + b"".join(bytes(r) if top < 256 else b"".join(struct.pack(">H", v) for v in r) for r in pixels)
