"""Baseline and extended sequential JPEG (8 bit, Huffman): grey, or colour as RGB.

Table lookups and sums run block by block; the inverse cosine transform and the colours are numpy over whole planes.
"""

from __future__ import annotations

import struct

import numpy as np

# The order in which the format lists the 64 coefficients of a block.
ZIGZAG = np.array([0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
                   35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63])
COSINE = np.array([[(0.5**0.5 if u == 0 else 1.0) / 2 * np.cos((2 * x + 1) * u * np.pi / 16) for u in range(8)] for x in range(8)])


def _codes(counts: bytes, values: bytes) -> list[tuple[int, int]]:
    """(length, symbol) by the next 16 bits; length 0 where no code begins."""
    out: list[tuple[int, int]] = []
    at = 0
    for length, n in enumerate(counts, 1):
        for v in values[at : at + n]:
            out += [(length, v)] * (1 << (16 - length))
        at += n
    return (out + [(0, 0)] * ((1 << 16) - len(out)))[: 1 << 16]


class _Bits:
    """Bits of one stretch of scan data, in which FF 00 stands for FF."""

    def __init__(self, data: bytes):
        self.data, self.at = data.replace(b"\xff\x00", b"\xff"), 0
        self.held, self.left, self.over = 0, 0, 0  # bits that are read ahead; made-up ones among them

    def _fill(self) -> None:
        part = self.data[self.at : self.at + 6]
        self.at += 6
        self.over += 8 * (6 - len(part))
        self.held = (self.held & ((1 << self.left) - 1)) << 48 | int.from_bytes(part.ljust(6, b"\0"), "big")
        self.left += 48

    def take(self, n: int) -> int:
        if self.left < n:
            self._fill()
        self.left -= n
        if self.left < self.over:
            raise ValueError("the JPEG's data end early")
        return self.held >> self.left & ((1 << n) - 1)

    def symbol(self, table: list[tuple[int, int]]) -> int:
        if self.left < 16:
            self._fill()
        length, value = table[self.held >> (self.left - 16) & 0xFFFF]
        if not length:
            raise ValueError("no such JPEG code")
        self.take(length)
        return value

    def signed(self, n: int) -> int:
        v = self.take(n) if n else 0
        return v if n == 0 or v >> (n - 1) else v - (1 << n) + 1


def _stretches(data: bytes, at: int) -> tuple[list[bytes], int]:
    """The scan's data between restart marks, and where it ends."""
    out, start = [], at
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            return [*out, data[start:]], len(data)
        mark = data[at + 1]
        if mark == 0:
            at += 2
        elif 0xD0 <= mark <= 0xD7:
            out.append(data[start:at])
            start = at = at + 2
        else:
            return [*out, data[start:at]], at


def decode(data: bytes) -> np.ndarray:
    """The image as (height, width) or (height, width, 3)."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, tables, quants, restart, parts, shape, planes = 2, {}, {}, 0, {}, None, {}
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("a JPEG marker is missing")
        mark = data[at + 1]
        if mark == 0xD9:
            break
        if mark == 0xFF:  # a fill byte
            at += 1
            continue
        (n,) = struct.unpack_from(">H", data, at + 2)
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                quants[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(np.float64)
                body = body[1 + 64 * (1 + wide) :]
        elif mark == 0xC4:
            while body:
                many = sum(body[1:17])
                tables[body[0]] = _codes(body[1:17], body[17 : 17 + many])
                body = body[17 + many :]
        elif mark in (0xC0, 0xC1):
            bits, height, width, k = struct.unpack_from(">BHHB", body)
            if bits != 8 or k not in (1, 3) or not height:
                raise ValueError("only 8-bit JPEGs of one or three channels")
            shape = height, width
            parts = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(k)}
        elif 0xC2 <= mark <= 0xCF and mark != 0xC8:
            raise ValueError("only sequential Huffman JPEGs")
        elif mark == 0xDD:
            (restart,) = struct.unpack(">H", body[:2])
        elif mark == 0xDA:
            stretches, at = _stretches(data, at)
            _scan(stretches, body, tables, restart, parts, shape, planes)
    if shape is None or planes.keys() != parts.keys():
        raise ValueError("the JPEG has no image")
    top = max(v for _, v, _ in parts.values()), max(h for h, _, _ in parts.values())
    out = []
    for name, (h, v, q) in parts.items():
        rows, cols = planes[name].shape[:2]
        block = np.zeros((rows, cols, 64))
        block[:, :, ZIGZAG] = planes[name] * quants[q]
        pixels = COSINE @ block.reshape(rows, cols, 8, 8) @ COSINE.T
        plane = pixels.transpose(0, 2, 1, 3).reshape(8 * rows, 8 * cols) + 128
        out.append(plane.repeat(top[0] // v, axis=0).repeat(top[1] // h, axis=1)[: shape[0], : shape[1]])
    if len(out) == 1:
        return np.clip(np.rint(out[0]), 0, 255).astype(np.uint8)
    y, b, r = out[0], out[1] - 128, out[2] - 128
    rgb = np.stack([y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b], axis=2)  # fixed values: the format's colours
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)


def _scan(stretches: list[bytes], head: bytes, tables: dict, restart: int, parts: dict, shape: tuple[int, int], planes: dict) -> None:
    """Adds the coefficients of one scan to planes: (rows of blocks, columns of blocks, 64) for each channel."""
    own = [(head[1 + 2 * i], tables[head[2 + 2 * i] >> 4], tables[16 + (head[2 + 2 * i] & 15)]) for i in range(head[0])]
    high, wide = max(v for _, v, _ in parts.values()), max(h for h, _, _ in parts.values())
    across, down = -(-shape[1] // (8 * wide)), -(-shape[0] // (8 * high))
    for name, _, _ in own:
        h, v, _ = parts[name]
        planes[name] = np.zeros((down * v, across * h, 64))
    if len(own) == 1:  # a channel alone is not interleaved: its blocks cover the image and no more
        h, v, _ = parts[own[0][0]]
        across, down = -(-(-(-shape[1] * h // wide)) // 8), -(-(-(-shape[0] * v // high)) // 8)
    units, step = across * down, restart or across * down
    for k, stretch in enumerate(stretches):
        bits, before = _Bits(stretch), dict.fromkeys(parts, 0)
        for unit in range(k * step, min(units, (k + 1) * step)):
            row, col = divmod(unit, across)
            for name, dc, ac in own:
                h, v, _ = parts[name] if len(own) > 1 else (1, 1, 0)
                for dy in range(v):
                    for dx in range(h):
                        block = planes[name][row * v + dy, col * h + dx]
                        before[name] += bits.signed(bits.symbol(dc))
                        block[0] = before[name]
                        i = 1
                        while i < 64:
                            s = bits.symbol(ac)
                            if s == 0:
                                break
                            i += s >> 4
                            if s & 15 and i < 64:
                                block[i] = bits.signed(s & 15)
                            i += 1
