"""Decoding of images to RGB bytes without an image library: PNG (eight bits a sample, not interlaced) and binary PPM."""

from __future__ import annotations

import io
import re
import zlib

import numpy as np

_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}  # of the PNG colour types


def decode(content: bytes | None) -> tuple[int, int, bytes] | None:
    """(height, width, RGB bytes in rows), or None."""
    try:
        if not content:
            return None
        if content[:8] == b"\x89PNG\r\n\x1a\n" and (image := _png(content)) is not None:
            return image
        if content[:2] == b"P6":
            return _ppm(content)
        return _library(content)
    except (ValueError, IndexError, KeyError, TypeError, OSError, zlib.error):
        return None


def _library(content: bytes) -> tuple[int, int, bytes] | None:
    try:
        from PIL import Image
    except ImportError:
        return None
    image = Image.open(io.BytesIO(content)).convert("RGB")
    return image.height, image.width, image.tobytes()


def _ppm(content: bytes) -> tuple[int, int, bytes] | None:
    m = re.match(rb"P6\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+255\s", content)
    if not m:
        return None
    w, h = int(m[1]), int(m[2])
    data = content[m.end() : m.end() + 3 * w * h]
    return (h, w, data) if len(data) == 3 * w * h else None


def _png(content: bytes) -> tuple[int, int, bytes] | None:
    at, data, palette, head = 8, [], None, None
    while at + 8 <= len(content):
        n, kind = int.from_bytes(content[at : at + 4]), content[at + 4 : at + 8]
        body = content[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            head = int.from_bytes(body[:4]), int.from_bytes(body[4:8]), body[8], body[9], body[12]
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
    if head is None or not data:
        return None
    w, h, depth, colour, interlaced = head
    if depth != 8 or interlaced:
        return _library(content)
    c = _CHANNELS[colour]
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, 1 + w * c)
    pixels = _unfiltered(rows[:, 0], rows[:, 1:].astype(np.int64), c).reshape(h, w, c).astype(np.uint8)
    if colour == 3:
        pixels = palette[pixels[:, :, 0]]
    elif c < 3:
        pixels = np.repeat(pixels[:, :, :1], 3, axis=2)
    return h, w, np.ascontiguousarray(pixels[:, :, :3]).tobytes()


def _unfiltered(filters: np.ndarray, rows: np.ndarray, c: int) -> np.ndarray:
    out = np.zeros_like(rows)
    above = np.zeros(rows.shape[1], np.int64)
    for y, kind in enumerate(filters.tolist()):
        row = rows[y]
        if kind == 0:
            line = row
        elif kind == 1:
            line = np.cumsum(row.reshape(-1, c), axis=0).ravel()
        elif kind == 2:
            line = row + above
        else:
            line = row.copy()
            for x in range(len(line)):
                left, corner = (line[x - c], above[x - c]) if x >= c else (0, 0)
                line[x] = (line[x] + ((left + above[x]) >> 1 if kind == 3 else _paeth(left, above[x], corner))) & 255
        above = out[y] = line & 255
    return out


def _paeth(left: int, up: int, corner: int) -> int:
    p = left + up - corner
    return min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
