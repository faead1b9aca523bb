"""Georeferenced TIFF in numpy: what the rasters of this engine need of it.

Bytes of one image to an array, whole or a window of it, and back. Strips and
tiles of uint8, int16, uint16, float32 and float64 samples, plain or compressed by
deflate or LZW. JPEG inside TIFF is not decoded here.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

# Tags, field types and codes of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 284, 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS = 33550, 33922, 34735
PLAIN, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
_TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
_KINDS = {(8, 1): "u1", (16, 1): "u2", (16, 2): "i2", (32, 3): "f4", (64, 3): "f8"}
#: Projected coordinates of the code EPSG:2056, pixels as areas.
_LV95 = (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, 2056)


@dataclass
class Layout:
    """Size, samples and place of an image. a, c, e, f: x = c + a * column and
    y = f + e * row, of the upper left corner."""

    width: int
    height: int
    bands: int
    kind: np.dtype
    a: float
    c: float
    e: float
    f: float


def _fields(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF image")
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    found = {}
    for k in range(n):
        tag, kind, count, _ = struct.unpack_from(order + "HHII", data, at + 2 + 12 * k)
        if kind in _TYPES:
            fmt = f"{order}{count}{_TYPES[kind]}"
            place = at + 10 + 12 * k
            if struct.calcsize(fmt) > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            found[tag] = struct.unpack_from(fmt, data, place)
    return order, found


def layout(data: bytes) -> Layout:
    order, fields = _fields(data)
    return _layout(order, fields)


def _layout(order: str, fields: dict[int, tuple]) -> Layout:
    kind = _KINDS.get((fields.get(BITS, (1,))[0], fields.get(SAMPLE_FORMAT, (1,))[0]))
    if kind is None:
        raise ValueError("samples of this kind are not supported")
    scale, tie = fields.get(PIXEL_SCALE, (1.0, 1.0, 0.0)), fields.get(TIE_POINT, (0.0,) * 6)
    a, e = scale[0], -scale[1]
    return Layout(fields[WIDTH][0], fields[HEIGHT][0], fields.get(SAMPLES, (1,))[0], np.dtype(order + kind), a, tie[3] - a * tie[0], e, tie[4] - e * tie[1])


def _lzw(data: bytes) -> bytes:
    table = [bytes([k]) for k in range(256)] + [b"", b""]
    out, width, before, held, n = [], 9, None, 0, 0
    for byte in data:
        held, n = held << 8 | byte, n + 8
        if n < width:
            continue
        n -= width
        code = held >> n
        held &= (1 << n) - 1
        if code == 257:
            break
        if code == 256:
            del table[258:]
            width, before = 9, None
            continue
        entry = table[code] if code < len(table) else before + before[:1]
        out.append(entry)
        if before is not None:
            table.append(before + entry[:1])
        before = entry
        width = max(9, (len(table) + 1).bit_length())
    return b"".join(out)


def read(data: bytes, rows: tuple[int, int] | None = None, columns: tuple[int, int] | None = None) -> np.ndarray:
    """(h, w) or (h, w, bands) of an image, or of a window of it (from, to). Only the
    strips or tiles that the window touches are decompressed."""
    order, fields = _fields(data)
    at = _layout(order, fields)
    if fields.get(PLANAR, (1,))[0] != 1:
        raise ValueError("bands must be interleaved")
    codec, predictor = fields.get(COMPRESSION, (PLAIN,))[0], fields.get(PREDICTOR, (1,))[0]
    if predictor not in (1, 2) or codec not in (PLAIN, LZW, DEFLATE, OLD_DEFLATE):
        raise ValueError(f"compression {codec} with predictor {predictor} is not supported")
    top, bottom = rows or (0, at.height)
    left, right = columns or (0, at.width)
    # a window beyond the image is cut to it
    top, left = min(top, at.height), min(left, at.width)
    bottom, right = max(top, min(bottom, at.height)), max(left, min(right, at.width))
    tiled = TILE_OFFSETS in fields
    w = fields[TILE_WIDTH][0] if tiled else at.width
    h = fields[TILE_HEIGHT][0] if tiled else min(at.height, fields.get(ROWS_PER_STRIP, (at.height,))[0])
    offsets, sizes = (fields[TILE_OFFSETS], fields[TILE_BYTES]) if tiled else (fields[STRIP_OFFSETS], fields[STRIP_BYTES])
    across = -(-at.width // w)
    out = np.zeros((bottom - top, right - left, at.bands), at.kind.newbyteorder("="))
    for r in range(top // h, -(-bottom // h)):
        for c in range(left // w, -(-right // w)):
            k = r * across + c
            raw = data[offsets[k] : offsets[k] + sizes[k]]
            raw = raw if codec == PLAIN else _lzw(raw) if codec == LZW else zlib.decompress(raw)
            high = h if tiled else min(h, at.height - r * h)
            part = np.frombuffer(raw, at.kind, high * w * at.bands).reshape(high, w, at.bands)
            if predictor == 2:
                part = np.cumsum(part, axis=1, dtype=part.dtype)
            y0, y1, x0, x1 = max(top, r * h), min(bottom, r * h + high), max(left, c * w), min(right, c * w + w)
            out[y0 - top : y1 - top, x0 - left : x1 - left] = part[y0 - r * h : y1 - r * h, x0 - c * w : x1 - c * w]
    return out if at.bands > 1 else out[..., 0]


def write(image: np.ndarray, a: float = 1.0, c: float = 0.0, e: float = -1.0, f: float = 0.0, strip_rows: int = 64) -> bytes:
    """The image as little-endian TIFF in strips compressed by deflate."""
    image = image if image.ndim == 3 else image[..., None]
    h, w, bands = image.shape
    bits, form = next(k for k, v in _KINDS.items() if np.dtype(v) == image.dtype.newbyteorder("="))
    strips = [zlib.compress(np.ascontiguousarray(image[r : r + strip_rows], image.dtype.newbyteorder("<")).tobytes()) for r in range(0, h, strip_rows)]
    starts, at = [], 8
    for s in strips:
        starts.append(at)
        at += len(s)
    fields = [
        (WIDTH, 4, (w,)), (HEIGHT, 4, (h,)), (BITS, 3, (bits,) * bands), (COMPRESSION, 3, (DEFLATE,)), (PHOTOMETRIC, 3, (2 if bands == 3 else 1,)),
        (STRIP_OFFSETS, 4, starts), (SAMPLES, 3, (bands,)), (ROWS_PER_STRIP, 4, (strip_rows,)), (STRIP_BYTES, 4, [len(s) for s in strips]), (SAMPLE_FORMAT, 3, (form,) * bands),
        (PIXEL_SCALE, 12, (a, -e, 0.0)), (TIE_POINT, 12, (0.0, 0.0, 0.0, c, f, 0.0)), (GEO_KEYS, 3, _LV95),
    ]
    body, more = b"", b""
    far = at + 2 + 12 * len(fields) + 4
    for tag, kind, values in fields:
        packed = struct.pack(f"<{len(values)}{_TYPES[kind]}", *values)
        body += struct.pack("<HHI", tag, kind, len(values)) + (packed.ljust(4, b"\0") if len(packed) <= 4 else struct.pack("<I", far + len(more)))
        more += packed if len(packed) > 4 else b""
    return struct.pack("<2sHI", b"II", 42, at) + b"".join(strips) + struct.pack("<H", len(fields)) + body + struct.pack("<I", 0) + more
