"""Slices as bytes: PNG, TIFF, BMP, JPEG and NPY, in numpy and zlib."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

from . import jpeg, tiff

# The signature, the channels of PNG's colour types, and its seven passes.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
ADAM7 = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))  # first row, column; steps


def png_encode(a: np.ndarray) -> bytes:
    """A grey (8 or 16 bit) or RGB (8 bit) slice."""
    colour = 2 if a.ndim == 3 else 0
    if a.dtype not in (np.uint8, np.uint16) or a.ndim == 3 and a.shape[2] != 3:
        raise TypeError(f"cannot write {a.dtype} {a.shape} as PNG")
    depth = 8 * a.dtype.itemsize
    rows = np.ascontiguousarray(a, a.dtype.newbyteorder(">")).view(np.uint8).reshape(a.shape[0], -1)
    body = zlib.compress(np.pad(rows, ((0, 0), (1, 0))).tobytes(), 6)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], depth, colour, 0, 0, 0)
    return PNG_SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def _unfilter(rows: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """PNG's row filters undone; step is the bytes of a pixel."""
    out = np.zeros((rows.shape[0] + 1, rows.shape[1] + step), np.uint8)  # with a row above and a pixel to the left
    for y, kind in enumerate(kinds.tolist()):
        line, up = rows[y].astype(np.int64), out[y].astype(np.int64)
        if kind == 0:
            out[y + 1, step:] = line
        elif kind == 1:
            out[y + 1, step:] = line.reshape(-1, step).cumsum(axis=0).reshape(-1) & 255
        elif kind == 2:
            out[y + 1, step:] = (line + up[step:]) & 255
        elif kind in (3, 4):
            now = [0] * out.shape[1]
            above, given = up.tolist(), line.tolist()
            for i, v in enumerate(given):
                left, top, corner = now[i], above[i + step], above[i]
                if kind == 3:
                    guess = (left + top) // 2
                else:
                    by = left + top - corner
                    guess = min((left, top, corner), key=lambda q: abs(by - q))
                now[i + step] = (v + guess) & 255
            out[y + 1] = now
        else:
            raise ValueError(f"PNG filter {kind}")
    return out[1:, step:]


def png_decode(data: bytes) -> np.ndarray:
    """Grey as (height, width), others with a last axis of channels, palettes as RGB. Grey of less than 8 bits is spread over 0..255."""
    if data[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head, palette = 8, [], None, None
    while at + 8 <= len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", data, at + 8)
        elif kind == b"PLTE":
            palette = np.frombuffer(data, np.uint8, n, at + 8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    if head is None:
        raise ValueError("a PNG without a header")
    width, height, depth, colour, _, _, interlaced = head
    if depth not in (1, 2, 4, 8, 16) or colour not in PNG_CHANNELS or colour == 3 and palette is None:
        raise ValueError(f"unsupported PNG: {depth} bits, colour type {colour}")
    channels, raw = PNG_CHANNELS[colour], zlib.decompress(b"".join(body))
    out, used = np.zeros((height, width, channels), np.uint16 if depth == 16 else np.uint8), 0
    for top, left, down, across in ADAM7 if interlaced else ((0, 0, 1, 1),):
        h, w = -(-(height - top) // down), -(-(width - left) // across)
        if h <= 0 or w <= 0:
            continue
        line = -(-w * channels * depth // 8)
        part = np.frombuffer(raw, np.uint8, h * (1 + line), used).reshape(h, 1 + line)
        used += h * (1 + line)
        rows = np.ascontiguousarray(_unfilter(part[:, 1:], part[:, 0], max(1, channels * depth // 8)))
        if depth < 8:
            bits = np.unpackbits(rows, axis=1)[:, : w * depth].reshape(h, w, depth)
            values = (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8) * (1 if colour == 3 else 255 // (2**depth - 1))
        else:
            values = rows.view(">u2").astype(np.uint16) if depth == 16 else rows
        out[top::down, left::across] = values.reshape(h, w, channels)
    if colour == 3:
        return palette[out[:, :, 0]]
    return out[:, :, 0] if colour == 0 else out


def bmp_decode(data: bytes) -> np.ndarray:
    """An uncompressed BMP: palettes and 24 or 32 bits as RGB, a palette of greys as grey."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP")
    start, head, width, height, _, bits, how = struct.unpack_from("<IIiiHHI", data, 10)
    if how not in (0, 3) or bits not in (1, 4, 8, 24, 32):
        raise ValueError(f"unsupported BMP: {bits} bits, compression {how}")
    rows, line = abs(height), -(-width * bits // 32) * 4
    raw = np.frombuffer(data, np.uint8, rows * line, start).reshape(rows, line)[:: -1 if height > 0 else 1]
    if bits >= 24:
        return np.ascontiguousarray(raw[:, : width * bits // 8].reshape(rows, width, bits // 8)[:, :, 2::-1])
    (used,) = struct.unpack_from("<I", data, 46)
    palette = np.frombuffer(data, np.uint8, 4 * (used or 1 << bits), 14 + head).reshape(-1, 4)[:, 2::-1]
    parts = np.unpackbits(raw, axis=1).reshape(rows, -1, bits)[:, :width]
    index = (parts << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)
    rgb = palette[index]
    return np.ascontiguousarray(rgb[:, :, 0]) if (palette == palette[:, :1]).all() else rgb


def tiff_encode(pages: list[np.ndarray] | np.ndarray, compress: bool = True) -> bytes:
    """One grey page, or several as a multi-page file; 8 or 16 bit or 32-bit float."""
    return tiff.encode([pages] if isinstance(pages, np.ndarray) and pages.ndim == 2 else list(pages), compress)


def tiff_pages(data: bytes) -> list[np.ndarray]:
    """All pages of a TIFF that lies in memory."""
    return list(tiff.pages(tiff.bytes_of(data)))


def npy_encode(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a, allow_pickle=False)
    return out.getvalue()


def npy_decode(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def decode(data: bytes) -> np.ndarray:
    """A file's one image, or its whole volume (z, y, x), by content, whatever the file is called."""
    if data[:8] == PNG_SIGNATURE:
        return png_decode(data)
    if data[:6] == b"\x93NUMPY":
        return npy_decode(data)
    if data[:2] in (b"BM", b"\xff\xd8"):
        return slices(data)[0]
    pages = tiff_pages(data)
    return pages[0] if len(pages) == 1 else np.stack(pages)


def slices(data: bytes) -> list[np.ndarray]:
    """The slices that a file holds: one of a PNG, one for each page of a TIFF, and of a NPY array of three dimensions
    (z, y, x) one for each z."""
    if data[:6] == b"\x93NUMPY":
        a = npy_decode(data)
        return [*a] if a.ndim == 3 else [a]
    if data[:2] == b"BM":
        return [bmp_decode(data)]
    if data[:2] == b"\xff\xd8":
        return [jpeg.decode(data)]
    return [png_decode(data)] if data[:8] == PNG_SIGNATURE else tiff_pages(data)


def slice_count(data: bytes) -> int:
    """How many slices a file holds, from its headers alone; 1 for a file that is none of the kinds."""
    try:
        if data[:6] == b"\x93NUMPY":
            head = io.BytesIO(data)
            version = np.lib.format.read_magic(head)
            shape = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(head)[0]
            return shape[0] if len(shape) == 3 else 1
        return max(1, sum(1 for _ in tiff.directories(tiff.bytes_of(data))))
    except (ValueError, struct.error):
        return 1
