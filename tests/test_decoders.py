"""Palette, low-depth and interlaced PNG, BMP and JPEG, each from a file made by hand."""

import struct
import zlib

import numpy as np
import pytest

from stackgrain.sources import codecs, jpeg


def png(height, width, depth, colour, rows, interlaced=0, palette=b""):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    body = zlib.compress(b"".join(b"\0" + bytes(r) for r in rows))
    head = struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, interlaced)
    return codecs.PNG_SIGNATURE + chunk(b"IHDR", head) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def packed(row, depth):
    bits = ((row[:, None] >> np.arange(depth - 1, -1, -1)) & 1).astype(np.uint8)
    return np.packbits(bits.ravel()).tobytes()


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_png_of_few_bits_and_palettes(depth):
    r = np.random.default_rng(depth)
    a = r.integers(0, 2**depth, (5, 11))
    rows = [packed(x, depth) for x in a]
    assert np.array_equal(codecs.decode(png(5, 11, depth, 0, rows)), a * (255 // (2**depth - 1)))
    palette = r.integers(0, 256, (2**depth, 3)).astype(np.uint8)
    assert np.array_equal(codecs.decode(png(5, 11, depth, 3, rows, palette=palette.tobytes())), palette[a])
    with pytest.raises(ValueError, match="unsupported"):
        codecs.decode(png(5, 11, depth, 3, rows))


@pytest.mark.parametrize("shape", [(1, 1), (3, 2), (8, 8), (9, 17), (5, 1)])
@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_interlaced_png(shape, kind):
    a = np.random.default_rng(1).integers(0, np.iinfo(kind).max, shape).astype(kind)
    rows = [x.astype(a.dtype.newbyteorder(">")).tobytes() for top, left, down, across in codecs.ADAM7 for x in a[top::down, left::across] if x.size]
    assert np.array_equal(codecs.decode(png(*shape, 8 * a.dtype.itemsize, 0, rows, 1)), a)


def bmp(a, bits, palette=None, upwards=True):
    height, width = a.shape[:2]
    table = b"" if palette is None else np.pad(palette[:, ::-1], ((0, 0), (0, 1))).astype(np.uint8).tobytes()
    lines = []
    for row in a[:: -1 if upwards else 1]:
        own = packed(row.astype(int), bits) if bits <= 8 else (row[:, ::-1] if bits == 24 else np.pad(row[:, ::-1], ((0, 0), (0, 1)))).astype(np.uint8).tobytes()
        lines.append(own + b"\0" * (-len(own) % 4))
    start = 54 + len(table)
    head = struct.pack("<IiiHHIIiiII", 40, width, height if upwards else -height, 1, bits, 0, 0, 0, 0, 0 if palette is None else len(palette), 0)
    return b"BM" + struct.pack("<IHHI", start + sum(map(len, lines)), 0, 0, start) + head + table + b"".join(lines)


@pytest.mark.parametrize("upwards", [True, False])
def test_bmp(upwards):
    r = np.random.default_rng(2)
    rgb = r.integers(0, 256, (6, 7, 3)).astype(np.uint8)
    for bits in (24, 32):
        assert np.array_equal(codecs.decode(bmp(rgb, bits, upwards=upwards)), rgb)
    for bits in (1, 4, 8):
        a = r.integers(0, 2**bits, (6, 7))
        colours = r.integers(0, 256, (2**bits, 3)).astype(np.uint8)
        assert np.array_equal(codecs.decode(bmp(a, bits, colours, upwards)), colours[a])
    grey = np.arange(256).repeat(3).reshape(256, 3)
    assert np.array_equal(codecs.decode(bmp(a, 8, grey, upwards)), a.astype(np.uint8))
    with pytest.raises(ValueError):
        codecs.decode(bmp(rgb, 24)[:40])


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, n):
        self.text += format(value, f"0{n}b") if n else ""

    def data(self):
        text = self.text + "1" * (-len(self.text) % 8)
        return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8)).replace(b"\xff", b"\xff\0")


def jpeg_of(planes, sampling, restart=0, shape=None):
    """A baseline JPEG of planes of levels, with steps of one: 4-bit codes for DC sizes, 8-bit codes for AC symbols."""
    height, width = shape or planes[0].shape
    dc = bytes(range(12))
    ac = [0, 0xF0] + [run << 4 | size for run in range(16) for size in range(1, 11)]
    code = {s: (i, 8) for i, s in enumerate(ac[:128])} | {s: (256 + i, 9) for i, s in enumerate(ac[128:])}
    counts = [0] * 7 + [128, len(ac) - 128] + [0] * 7
    blocks = []
    for p, (h, v) in zip(planes, sampling, strict=True):
        pad = np.pad(p, ((0, -len(p) % (8 * v)), (0, -p.shape[1] % (8 * h))), mode="edge").astype(float) - 128
        rows, cols = pad.shape[0] // 8, pad.shape[1] // 8
        cut = pad.reshape(rows, 8, cols, 8).transpose(0, 2, 1, 3)
        blocks.append(np.rint(jpeg.COSINE.T @ cut @ jpeg.COSINE).astype(int).reshape(rows, cols, 64)[:, :, jpeg.ZIGZAG])
    high, wide = max(v for _, v in sampling), max(h for h, _ in sampling)
    across, down = -(-width // (8 * wide)), -(-height // (8 * high))
    out, bits, before = b"", Bits(), [0] * len(planes)

    def put(v, n):
        bits.put(v if v >= 0 else v + (1 << n) - 1, n)

    for unit in range(across * down):
        if restart and unit and unit % restart == 0:
            out += bits.data() + bytes([0xFF, 0xD0 + (unit // restart - 1) % 8])
            bits, before = Bits(), [0] * len(planes)
        row, col = divmod(unit, across)
        for c, (h, v) in enumerate(sampling):
            for dy in range(v):
                for dx in range(h):
                    b = blocks[c][row * v + dy, col * h + dx].tolist()
                    step, before[c] = b[0] - before[c], b[0]
                    bits.put(abs(step).bit_length(), 4)
                    put(step, abs(step).bit_length())
                    run = 0
                    last = max([i for i in range(1, 64) if b[i]], default=0)
                    for x in b[1 : last + 1]:
                        if x == 0:
                            run += 1
                            continue
                        while run > 15:
                            bits.put(*code[0xF0])
                            run -= 16
                        n = abs(x).bit_length()
                        bits.put(*code[run << 4 | n])
                        put(x, n)
                        run = 0
                    if last < 63:
                        bits.put(*code[0])
    out += bits.data()
    seg = lambda m, d: bytes([0xFF, m]) + struct.pack(">H", len(d) + 2) + d
    frame = struct.pack(">BHHB", 8, height, width, len(planes)) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling))
    scan = bytes([len(planes)]) + b"".join(bytes([i + 1, 0]) for i in range(len(planes))) + bytes([0, 63, 0])
    huff = bytes([0]) + bytes([0, 0, 0, 12] + [0] * 12) + dc + bytes([16]) + bytes(counts) + bytes(ac)
    more = seg(0xDD, struct.pack(">H", restart)) if restart else b""
    return b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, b"\0" + b"\1" * 64) + seg(0xC0, frame) + seg(0xC4, huff) + more + seg(0xDA, scan) + out + b"\xff\xd9"


@pytest.mark.parametrize("shape", [(8, 8), (17, 30), (1, 1)])
@pytest.mark.parametrize("restart", [0, 2])
def test_grey_jpeg(shape, restart):
    y, x = np.indices(shape)
    a = np.clip(128 + 60 * np.sin(x / 5) + 50 * np.cos(y / 3) + np.random.default_rng(3).normal(0, 9, shape), 0, 255).astype(np.uint8)
    got = codecs.decode(jpeg_of([a], [(1, 1)], restart))
    assert got.shape == shape and np.abs(got.astype(int) - a).max() <= 2


@pytest.mark.parametrize("sampling", [(1, 1), (2, 2), (2, 1)])
def test_colour_jpeg(sampling):
    h, v = sampling
    y, x = np.indices((32, 48))
    lum, blue, red = 100 + y, 100 + x, 180 - y // 2
    small = lambda p: p[::v, ::h]
    got = codecs.decode(jpeg_of([lum, small(blue), small(red)], [(h, v), (1, 1), (1, 1)], shape=(32, 48))).astype(float)
    b, r = blue // h * h - 128 if h > 1 else blue - 128, red - 128
    assert got.shape == (32, 48, 3)
    want = np.stack([lum + 1.402 * r, lum - 0.344136 * b - 0.714136 * r, lum + 1.772 * b], axis=2)
    assert np.abs(got - np.clip(want, 0, 255)).max() <= 6


def test_other_jpegs_are_refused():
    good = jpeg_of([np.full((8, 8), 90)], [(1, 1)])
    for broken in (good.replace(b"\xff\xc0", b"\xff\xc2"), good[: len(good) // 2], b"\xff\xd8\xff\xd9"):
        with pytest.raises((ValueError, KeyError, IndexError, struct.error)):
            codecs.decode(broken)
