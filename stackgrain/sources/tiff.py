"""TIFF by random access: directories, then single pages, through any function that reads bytes at a place.

Classic and BigTIFF, both byte orders; strips and tiles, interleaved or by plane; plain, deflated, LZW and PackBits;
horizontal differencing; grey of 1, 8, 16 and 32 bits or 32 and 64-bit floats, several channels, palettes (as RGB).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np

Read = Callable[[int, int], bytes]  # (offset, length) to bytes

# The numbers that the format gives to tags, types, compressions and kinds of samples.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_SIZES, PLANAR, PREDICTOR, COLOUR_MAP, SAMPLE_FORMAT = (
    256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 320, 339)
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES = 322, 323, 324, 325
TYPES = {1: "B", 3: "H", 4: "I", 16: "Q"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
KINDS = {(1, 1): "u1", (8, 1): "u1", (16, 1): "u2", (32, 1): "u4", (32, 3): "f4", (64, 3): "f8"}


def bytes_of(data: bytes) -> Read:
    return lambda at, n: data[at : at + n]


def header(read: Read) -> tuple[str, bool, int]:
    """(byte order, whether it is a BigTIFF, place of the first directory)."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(order + "H", head, 2)[0] if order and len(head) >= 8 else 0
    if version == 42:
        return order, False, struct.unpack_from(order + "I", head, 4)[0]
    if version == 43 and len(head) == 16:
        return order, True, struct.unpack_from(order + "Q", head, 8)[0]
    raise ValueError("not a TIFF")


def directories(read: Read) -> Iterator[int]:
    """Places of the pages' directories; only their lengths and links are read."""
    order, big, at = header(read)
    count, entry, link = ("Q", 20, "Q") if big else ("H", 12, "I")
    size, seen = struct.calcsize(order + count), set()
    while at:
        if at in seen:
            raise ValueError("the TIFF's pages go in a circle")
        seen.add(at)
        yield at
        (n,) = struct.unpack(order + count, read(at, size))
        (at,) = struct.unpack(order + link, read(at + size + entry * n, struct.calcsize(order + link)))


def tags_at(read: Read, at: int, order: str, big: bool) -> dict[int, tuple]:
    """Whole-number tags of the directory at a place."""
    count, entry, inline = ("Q", 20, 8) if big else ("H", 12, 4)
    size = struct.calcsize(order + count)
    (n,) = struct.unpack(order + count, read(at, size))
    body, tags = read(at + size, entry * n), {}
    for k in range(n):
        tag, kind, many = struct.unpack_from(order + ("HHQ" if big else "HHI"), body, entry * k)
        if kind in TYPES:
            form = f"{order}{many}{TYPES[kind]}"
            own = body[entry * (k + 1) - inline : entry * (k + 1)]
            if struct.calcsize(form) > inline:
                own = read(struct.unpack(order + ("Q" if big else "I"), own)[0], struct.calcsize(form))
            tags[tag] = struct.unpack_from(form, own)
    return tags


def lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bits first, the width growing one code early."""
    out, table, held, bits, width, before = [], [], 0, 0, 9, None
    start = [bytes([i]) for i in range(256)] + [b"", b""]
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, before = start.copy(), 9, None
            continue
        if not table:
            raise ValueError("LZW data without a first clear code")
        if before is None:
            word = table[code]
        else:
            if code > len(table):
                raise ValueError("LZW code out of order")
            word = table[code] if code < len(table) else before + before[:1]
            table.append(before + word[:1])
        out.append(word)
        before = word
        width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9
    return b"".join(out)


def packbits(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            if n > 128:
                out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2 - (n == 128)
    return b"".join(out)


def page(read: Read, at: int, order: str, big: bool) -> np.ndarray:
    """The page whose directory is at a place: (height, width), or with a last axis of channels."""
    tags = tags_at(read, at, order, big)
    one = lambda tag, other=1: tags.get(tag, (other,))[0]
    how, samples, bits, plane = one(COMPRESSION), one(SAMPLES), one(BITS), one(PLANAR) == 2
    kind = KINDS.get((bits, one(SAMPLE_FORMAT)))
    undo = {NONE: bytes, LZW: lzw, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress, PACKBITS: packbits}.get(how)
    if kind is None or undo is None or set(tags.get(BITS, (1,))) != {bits}:
        raise ValueError(f"unsupported TIFF: {bits} bits, compression {how}")
    height, width = one(HEIGHT), one(WIDTH)
    tiled = TILE_OFFSETS in tags
    high, wide = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(ROWS_PER_STRIP, height), height), width)
    places, sizes = (tags[TILE_OFFSETS], tags[TILE_SIZES]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_SIZES])
    down, across = -(-height // high), -(-width // wide)
    depth = 1 if plane else samples  # samples that stand together
    out = np.zeros((height, width, samples), kind)
    for k, (place, size) in enumerate(zip(places, sizes, strict=True)):
        channel, cell = divmod(k, down * across) if plane else (0, k)
        top, left = high * (cell // across), wide * (cell % across)
        rows = high if tiled else min(high, height - top)
        raw = undo(read(place, size))
        if bits == 1:
            part = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(rows, -1), axis=1)[:, : wide * depth].reshape(rows, wide, depth)
        else:
            part = np.frombuffer(raw, np.dtype(kind).newbyteorder(order), rows * wide * depth).reshape(rows, wide, depth).astype(kind)
        if one(PREDICTOR) == 2:
            part = part.cumsum(axis=1, dtype=part.dtype)
        own = part[: height - top, : width - left]
        out[top : top + own.shape[0], left : left + own.shape[1], channel : channel + depth] = own
    if one(PHOTOMETRIC) == 3 and COLOUR_MAP in tags and samples == 1:
        shades = (np.array(tags[COLOUR_MAP]).reshape(3, -1).T >> 8).astype(np.uint8)
        return shades[out[:, :, 0]]
    if one(PHOTOMETRIC) == 0 and kind[0] == "u":  # white is zero
        out = (out ^ 1) if bits == 1 else out.max(initial=0).dtype.type(np.iinfo(kind).max) - out
    return out[:, :, 0] if samples == 1 else out


def pages(read: Read) -> Iterator[np.ndarray]:
    order, big, _ = header(read)
    for at in directories(read):
        yield page(read, at, order, big)


def directory(shape: tuple[int, int], kind: np.dtype, start: int, size: int, compress: bool, after: int, big: bool = False) -> bytes:
    """The directory of a grey page that is one strip of so many bytes from start on; after: place of the next one, or 0."""
    height, width = shape
    tags = {WIDTH: width, HEIGHT: height, BITS: 8 * kind.itemsize, COMPRESSION: DEFLATE if compress else NONE, PHOTOMETRIC: 1, STRIP_OFFSETS: start,
            SAMPLES: 1, ROWS_PER_STRIP: height, STRIP_SIZES: size, PLANAR: 1, SAMPLE_FORMAT: 3 if kind.kind == "f" else 1}
    count, entry, link = ("<Q", "<HHQQ", "<Q") if big else ("<H", "<HHII", "<I")
    body = b"".join(struct.pack(entry, tag, 16 if big else 4, 1, v) for tag, v in sorted(tags.items()))
    return struct.pack(count, len(tags)) + body + struct.pack(link, after)


def start_of_file(first: int, big: bool = False) -> bytes:
    """The header of a little-endian file whose first directory is at a place."""
    return struct.pack("<2sHHHQ", b"II", 43, 8, 0, first) if big else struct.pack("<2sHI", b"II", 42, first)


def strip_of(a: np.ndarray, compress: bool) -> bytes:
    """The bytes of a grey page as one strip."""
    if a.ndim != 2 or a.dtype not in (np.uint8, np.uint16, np.float32):
        raise TypeError(f"cannot write {a.dtype} {a.shape} as TIFF")
    raw = np.ascontiguousarray(a, a.dtype.newbyteorder("<")).tobytes()
    return zlib.compress(raw) if compress else raw


def encode(own: list[np.ndarray], compress: bool = True, big: bool = False) -> bytes:
    """A file of grey pages: each page's strip, then its directory."""
    strips = [strip_of(a, compress) for a in own]
    room = len(directory((0, 0), np.dtype("u1"), 0, 0, compress, 0, big))
    out, begin = bytearray(), len(start_of_file(0, big))
    starts, at = [], begin
    for s in strips:
        starts.append(at)
        at += len(s) + len(s) % 2 + room
    place = [a + len(s) + len(s) % 2 for a, s in zip(starts, strips, strict=True)]
    out += start_of_file(place[0] if place else 0, big)
    for k, (a, s) in enumerate(zip(own, strips, strict=True)):
        out += s + b"\0" * (len(s) % 2) + directory(a.shape, a.dtype, starts[k], len(s), compress, [*place, 0][k + 1], big)
    return bytes(out)
