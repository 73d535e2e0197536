"""FLAC media columns: bytes as 8-bit mono samples in FLAC streams, and back.

Streams hold STREAMINFO (with the MD5 of the samples), a seek table with a point for every frame, and frames of fixed
block size. Frames are coded as constant, verbatim, fixed or linear prediction with Rice residuals; the decoder reads all
of these, any partition order and escaped partitions, and verifies CRC-8, CRC-16 and MD5. Frames of many streams are
coded and decoded together, a sample of each at a time, so the work is in array operations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studygraph.llm import arrays

BLOCK = 1152
RATE = 8000
#: Bytes of samples, or of streams, that are worked on together.
TOGETHER = 1 << 20
_ORDER, _PRECISION = 8, 10


class Damaged(ValueError):
    """A stream that is not what was written."""


def crc_table(poly: int, width: int) -> np.ndarray:
    out = np.arange(256, dtype=np.uint32) << (width - 8)
    for _ in range(8):
        out = np.where(out >> (width - 1) & 1, (out << 1) ^ poly, out << 1) & ((1 << width) - 1)
    return out


_CRC8, _CRC16 = crc_table(0x07, 8), crc_table(0x8005, 16)
_weights: list[np.ndarray] = []


def crc_weights(n: int) -> np.ndarray:
    """weights[d, b]: what byte b adds to a CRC-16 when d bytes follow it."""
    if not _weights or len(_weights[0]) < n:
        rows = [_CRC16.astype(np.uint16)]
        for _ in range(max(n, 4096) - 1):
            x = rows[-1].astype(np.uint32)
            rows.append((_CRC16[x >> 8] ^ (x << 8) & 0xFFFF).astype(np.uint16))
        _weights[:] = [np.stack(rows)]
    return _weights[0]


def crc16(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-16 of spans of bytes."""
    out = np.zeros(len(start), np.uint16)
    if not len(start):
        return out
    order = np.argsort(end - start, kind="stable")
    for at in range(0, len(order), 512):
        some = order[at : at + 512]
        longest = int((end[some] - start[some]).max())
        follow = np.arange(longest)
        place = end[some][:, None] - 1 - follow
        inside = place >= start[some][:, None]
        values = np.where(inside, data[np.maximum(place, 0)], 0)
        out[some] = np.bitwise_xor.reduce(crc_weights(longest)[follow[None, :], values], axis=1)
    return out


def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = int(_CRC8[crc ^ b])
    return crc


def coded_number(n: int) -> bytes:
    """A frame number in the UTF-8 manner, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    lead = 0x3F
    while n > lead:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        lead >>= 1
    return bytes([0xFF & ~(lead << 1 | 1) | n, *tail[::-1]])


def frame_header(number: int, size: int) -> bytes:
    known = {192: 1, 576: 2, 1152: 3, 2304: 4, 4608: 5}
    code = known.get(size, 6 if size <= 256 else 7)
    head = bytes([0xFF, 0xF8, code << 4 | 4, 0 << 4 | 1 << 1]) + coded_number(number)
    head += (size - 1).to_bytes(1, "big") if code == 6 else (size - 1).to_bytes(2, "big") if code == 7 else b""
    return head + bytes([crc8(head)])


def linear_predictors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised predictor coefficients (frames, _ORDER) of samples (frames, size), and their shifts."""
    n, size = x.shape
    y = x - x.mean(1, keepdims=True)
    r = np.stack([(y[:, : size - k] * y[:, k:]).sum(1) for k in range(_ORDER + 1)], 1)
    a, error = np.zeros((n, _ORDER)), r[:, 0] + 1e-9
    for i in range(_ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / error
        k = np.clip(k, -0.999, 0.999)
        a[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a[:, i] = k
        error = error * (1 - k * k) + 1e-12
    most = np.abs(a).max(1) + 1e-9
    shift = np.clip(_PRECISION - 2 - np.ceil(np.log2(most)).astype(np.int64), 0, 15)
    return np.clip(np.rint(a * (1 << shift)[:, None]), -(1 << _PRECISION - 1), (1 << _PRECISION - 1) - 1).astype(np.int64), shift


def residuals(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Residuals (frames, size) of fixed orders 0 to 4 and of linear prediction, zero where a warm-up sample stands; and
    the predictors."""
    out = [x]
    for order in range(1, 5):  # each is the difference of the one before
        r = np.zeros_like(x)
        np.subtract(out[-1][:, order:], out[-1][:, order - 1 : -1], out=r[:, order:])
        out.append(r)
    coefficients, shift = linear_predictors(x)
    r = np.zeros_like(x)
    total = np.zeros((len(x), x.shape[1] - _ORDER), np.int32)
    narrow = coefficients.astype(np.int32)  # 10 bits by 8 bits, eight times
    for j in range(_ORDER):
        total += narrow[:, j : j + 1] * x[:, _ORDER - 1 - j : x.shape[1] - 1 - j]
    total >>= shift[:, None].astype(np.int32)
    np.subtract(x[:, _ORDER:], total, out=r[:, _ORDER:])
    return [*out, r], coefficients, shift


class BitWriter:
    """Fields of bits put into many frames at once; a frame is a row of a bit array."""

    def __init__(self, frames: int, bits: int) -> None:
        self.bits, self.at = np.zeros((frames, bits), np.uint8), np.zeros(frames, np.int64)

    def put(self, rows: np.ndarray, value: np.ndarray | int, n: int) -> None:
        value = np.broadcast_to(np.asarray(value, np.int64), rows.shape)
        for b in range(n):
            self.bits[rows, self.at[rows] + b] = value >> (n - 1 - b) & 1
        self.at[rows] += n


def encode_frames(x: np.ndarray) -> list[bytes]:
    """Subframes (byte-aligned, without header and CRC) of samples (frames, size) from -128 to 127."""
    frames, size = x.shape
    x = x.astype(np.int32)
    made, coefficients, shift = residuals(x)
    orders = [0, 1, 2, 3, 4, _ORDER]
    costs, params = [], []
    for order, r in zip(orders, made, strict=True):
        u = (r << 1) ^ (r >> 31)
        mean = u[:, order:].sum(1) / (size - order)
        guess = np.clip(np.floor(np.log2(np.maximum(mean * 0.6931, 1e-9))).astype(np.int64) + 1, 0, 14)
        best, param = None, guess
        for k in (np.maximum(guess - 1, 0), guess):
            bits = (u[:, order:] >> k[:, None].astype(np.int32)).sum(1) + (size - order) * (1 + k)
            param = k if best is None else np.where(bits < best, k, param)
            best = bits if best is None else np.minimum(best, bits)
        costs.append(8 + 8 * order + 10 + best + (9 + _PRECISION * _ORDER if order == _ORDER else 0))
        params.append(param)
    costs.append(np.full(frames, 8 + 8 * size))
    choice = np.argmin(np.stack(costs), axis=0)
    constant = (x == x[:, :1]).all(1)
    bits = np.min(np.stack(costs), axis=0)
    w = BitWriter(frames, int(bits.max()) + 8)
    everyone = np.arange(frames)
    kind = np.select([constant, choice == 6, choice == 5], [0, 1, 32 + _ORDER - 1], 8 + choice)
    w.put(everyone, kind << 1, 8)
    w.put(everyone[constant], x[constant, 0] & 255, 8)
    plain = everyone[~constant & (choice == 6)]
    for i in range(size if len(plain) else 0):
        w.put(plain, x[plain, i] & 255, 8)
    for c, order in enumerate(orders):
        rows = everyone[~constant & (choice == c)]
        if not len(rows):
            continue
        for i in range(order):
            w.put(rows, x[rows, i] & 255, 8)
        if c == 5:
            w.put(rows, _PRECISION - 1, 4)
            w.put(rows, shift[rows], 5)
            for j in range(_ORDER):
                w.put(rows, coefficients[rows, j] & ((1 << _PRECISION) - 1), _PRECISION)
        w.put(rows, 0, 6)
        k = params[c][rows]
        w.put(rows, k, 4)
        r = made[c][rows, order:]
        u = (r << 1) ^ (r >> 31)
        wide = k[:, None].astype(np.int32)
        ends = np.cumsum((u >> wide) + (1 + wide), axis=1, dtype=np.int64)
        ends += w.at[rows][:, None]
        flat = w.bits.reshape(-1)
        stop = ends + (rows * w.bits.shape[1] - k - 1)[:, None]
        flat[stop] = 1
        low = u & ((1 << wide) - 1)
        for b in range(int(k.max())):
            some = np.flatnonzero(k > b)
            if len(some) == len(rows):
                flat[stop + (1 + b)] = (low >> (wide - 1 - b)) & 1
            else:
                flat[stop[some] + (1 + b)] = (low[some] >> (wide[some] - 1 - b)) & 1
        w.at[rows] = ends[:, -1]
    packed = np.packbits(w.bits, axis=1)
    return [packed[i, : (n + 7) // 8].tobytes() for i, n in enumerate(w.at.tolist())]


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream of each payload, byte b as sample b - 128. An empty payload is a stream without frames."""
    sizes = [len(p) for p in payloads]
    flat = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int16) - 128
    first = np.concatenate(([0], np.cumsum(sizes)))
    frames = [(i, k, int(first[i]) + k * BLOCK, min(BLOCK, n - k * BLOCK)) for i, n in enumerate(sizes) for k in range(-(-n // BLOCK))]
    by_size: dict[int, list[int]] = {}
    for f, (_, _, _, n) in enumerate(frames):
        by_size.setdefault(n, []).append(f)
    body: list[bytes] = [b""] * len(frames)
    for n, group in by_size.items():
        starts = np.array([frames[f][2] for f in group])
        if n <= _ORDER:
            coded = [bytes([2]) + (flat[s : s + n] & 255).astype(np.uint8).tobytes() for s in starts]
        else:
            coded = encode_frames(flat[starts[:, None] + np.arange(n)])
        for f, c in zip(group, coded, strict=True):
            body[f] = frame_header(frames[f][1], n) + c
    lengths = np.array([len(b) for b in body], np.int64)
    ends = np.cumsum(lengths)
    checks = crc16(np.frombuffer(b"".join(body), np.uint8), ends - lengths, ends)
    parts: list[list[bytes]] = [[] for _ in payloads]
    for f, (i, _, _, _) in enumerate(frames):
        parts[i].append(body[f] + int(checks[f]).to_bytes(2, "big"))
    out = []
    for payload, mine in zip(payloads, parts, strict=True):
        n = len(payload)
        signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
        least, most = (min(map(len, mine)), max(map(len, mine))) if mine else (0, 0)
        block = min(BLOCK, max(n, 16)).to_bytes(2, "big") if n <= BLOCK else BLOCK.to_bytes(2, "big")
        info = block * 2 + least.to_bytes(3, "big") + most.to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | n).to_bytes(8, "big") + hashlib.md5(signed).digest()
        points, at = [], 0
        for k, f in enumerate(mine):
            points.append((k * BLOCK).to_bytes(8, "big") + at.to_bytes(8, "big") + min(BLOCK, n - k * BLOCK).to_bytes(2, "big"))
            at += len(f)
        points = points[: ((1 << 24) - 1) // 18]  # as many as a block's length can tell; frames behind them are walked
        table = b"".join(points)
        out.append(b"fLaC" + bytes([0]) + (34).to_bytes(3, "big") + info + bytes([0x83]) + len(table).to_bytes(3, "big") + table + b"".join(mine))
    return out


def stream_parts(data: bytes) -> tuple[int, bytes, list[tuple[int, int, int]], int]:
    """Samples, MD5, seek points (sample, byte after the metadata, samples) and where the frames start."""
    if data[:4] != b"fLaC":
        raise Damaged("no FLAC stream")
    at, last, points, info = 4, False, [], None
    while not last:
        last, kind, n = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        block = data[at + 4 : at + 4 + n]
        if kind == 0:
            info = block
        elif kind == 3:
            points = [(int.from_bytes(block[i : i + 8], "big"), int.from_bytes(block[i + 8 : i + 16], "big"), int.from_bytes(block[i + 16 : i + 18], "big")) for i in range(0, n, 18)]
        at += 4 + n
    if info is None:
        raise Damaged("no STREAMINFO")
    word = int.from_bytes(info[10:18], "big")
    if word >> 36 & 31 != 7 or word >> 41 & 7:
        raise Damaged("not 8-bit mono")
    return word & (1 << 36) - 1, info[18:34], points, at


def parse_header(data: bytes, at: int) -> tuple[int, int]:
    """Samples of the frame at a byte, and where its subframe starts; checks the header's CRC-8."""
    start = at
    if data[at : at + 2] not in (b"\xff\xf8", b"\xff\xf9"):
        raise Damaged("no frame")
    code, rate = data[at + 2] >> 4, data[at + 2] & 15
    at += 4
    lead = data[at]
    extra = 0
    while lead & 0x80 and lead << extra & 0x80:
        extra += 1
    at += max(1, extra)
    if code == 6:
        size, at = data[at] + 1, at + 1
    elif code == 7:
        size, at = int.from_bytes(data[at : at + 2], "big") + 1, at + 2
    else:
        size = 192 if code == 1 else 576 << code - 2 if code <= 5 else 256 << code - 8
    at += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[start:at]) != data[at]:
        raise Damaged("a frame header's CRC-8 differs")
    return size, at + 1


#: Zeros before the first bit that is set in 16 bits.
_ZEROS = np.full(1 << 16, 16, np.int64)
for _n in range(16):
    _ZEROS[1 << (15 - _n) : 1 << (16 - _n)] = _n


class BitReader:
    """Reads fields of bits at many places of one array of bytes at once."""

    def __init__(self, data: np.ndarray) -> None:
        self.size = 8 * len(data)
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        words = padded[:-7].astype(np.int64)
        for i in range(1, 5):
            words <<= 8
            words |= padded[i : len(padded) - 7 + i]
        self.words = words

    def window(self, at: np.ndarray) -> np.ndarray:
        """The 33 bits or more that follow bit places, from bit 39 down."""
        return (self.words[at >> 3] << (at & 7)) & ((1 << 40) - 1)

    def take(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Unsigned fields of n bits (up to 32) at bit places."""
        return self.window(at) >> (40 - n)

    def next(self, at: np.ndarray) -> np.ndarray:
        """The place of the first bit that is set from each place on. Raises Damaged where there is none."""
        out = at.copy()
        todo = np.arange(len(at))
        while len(todo):
            n = _ZEROS[self.window(out[todo]) >> 24]
            out[todo] += n
            todo = todo[n == 16]
            if len(todo) and int(out[todo].max()) > self.size:
                raise Damaged("a frame goes beyond its stream")
        return out

    def rice(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unsigned Rice codes with k low bits (up to 14 at once) at bit places, and where they end."""
        word = self.window(at)
        zeros = _ZEROS[word >> 24]
        value = zeros << k | (word >> (39 - zeros - k)) & ((1 << k) - 1)
        end = at + zeros + 1 + k
        long = np.flatnonzero((zeros == 16) | (k > 14))
        if len(long):
            stop = self.next(at[long])
            value[long] = (stop - at[long]) << k[long] | self.take(stop + 1, k[long])
            end[long] = stop + 1 + k[long]
        return value, end

    def signed(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = self.take(at, n)
        return np.where(n > 0, x - ((x >> np.maximum(n - 1, 0) & 1) << n), 0)


def decode_frames(read: BitReader, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Samples (frames, size) of subframes of 8-bit samples that start at bit places, and where they end."""
    frames = len(at)
    x = np.zeros((frames, size), np.int64)
    kind, at = read.take(at, np.full(frames, 8)), at + 8
    wasted = np.zeros(frames, np.int64)
    has = np.flatnonzero(kind & 1)
    if len(has):
        stop = read.next(at[has])
        wasted[has], at[has] = stop - at[has] + 1, stop + 1
    kind = kind >> 1
    depth = 8 - wasted
    linear, fixed = kind >= 32, (kind >= 8) & (kind <= 12)
    if not (linear | fixed | (kind <= 1)).all():
        raise Damaged("an unknown subframe")
    order = np.where(linear, (kind & 31) + 1, np.where(fixed, kind & 7, 0))
    rows = np.flatnonzero(kind == 0)
    x[rows] = read.signed(at[rows], depth[rows])[:, None]
    at[rows] += depth[rows]
    rows = np.flatnonzero(kind == 1)
    if len(rows):
        places = at[rows][:, None] + depth[rows][:, None] * np.arange(size)
        x[rows] = read.signed(places, np.broadcast_to(depth[rows][:, None], places.shape))
        at[rows] += depth[rows] * size
    for i in range(int(order.max(initial=0))):
        rows = np.flatnonzero(order > i)
        x[rows, i] = read.signed(at[rows], depth[rows])
        at[rows] += depth[rows]
    coefficients, shift = np.zeros((frames, 32), np.int64), np.zeros(frames, np.int64)
    rows = np.flatnonzero(linear)
    if len(rows):
        precision = read.take(at[rows], np.full(len(rows), 4)) + 1
        shift[rows] = read.signed(at[rows] + 4, np.full(len(rows), 5))
        at[rows] += 9
        for j in range(int(order[rows].max())):
            some = order[rows] > j
            coefficients[rows[some], j] = read.signed(at[rows[some]], precision[some])
            at[rows[some]] += precision[some]
    rows = np.flatnonzero(linear | fixed)
    if len(rows):
        x[rows], at[rows] = with_residuals(read, x[rows], at[rows], order[rows], size)
        restore(x, rows[fixed[rows]], order)
        predict(x, rows[linear[rows]], order, coefficients, shift)
    return x << wasted[:, None], at


def with_residuals(read: BitReader, x: np.ndarray, at: np.ndarray, order: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """x with residuals behind the warm-up samples, read one sample of every frame at a time."""
    n = len(x)
    wide = np.where(read.take(at, np.full(n, 2)) == 1, 5, 4)
    parts = read.take(at + 2, np.full(n, 4))
    at = at + 6
    each = size >> parts
    k, escaped = np.zeros(n, np.int64), np.zeros(n, np.int64)
    one = int(each[0]) if (each == each[0]).all() else 0
    warm = int(order.max())
    out = np.empty((size, n), np.int64)
    out[:] = x.T
    any_escape = False
    for i in range(int(order.min()), size):
        if one and i > warm and i % one and not any_escape:  # all frames are within a partition
            u, at = read.rice(at, k)
            out[i] = (u >> 1) ^ -(u & 1)
            continue
        some = np.flatnonzero(((i % each == 0) | (i == order)) & (i >= order))
        if len(some):
            k[some] = read.take(at[some], wide[some])
            at[some] += wide[some]
            escape = some[k[some] == (1 << wide[some]) - 1]
            escaped[some] = 0
            if len(escape):
                escaped[escape] = 1 + read.take(at[escape], np.full(len(escape), 5))
                at[escape] += 5
                k[escape] = 0
            any_escape = bool(escaped.any())
        live = np.flatnonzero((i >= order) & (escaped == 0))
        u, at[live] = read.rice(at[live], k[live])
        out[i, live] = (u >> 1) ^ -(u & 1)
        raw = np.flatnonzero((i >= order) & (escaped > 0))
        if len(raw):
            width = escaped[raw] - 1
            out[i, raw] = read.signed(at[raw], width)
            at[raw] += width
    return out.T, at


def restore(x: np.ndarray, rows: np.ndarray, order: np.ndarray) -> None:
    """Samples from fixed-prediction residuals, in place."""
    for o in range(1, 5):
        some = rows[order[rows] == o]
        if not len(some):
            continue
        y = x[some]
        warm = [np.diff(y[:, :o], d, axis=1)[:, -1:] for d in range(o)]  # last differences of the warm-up samples
        r = y[:, o:]
        for d in reversed(range(o)):
            r = warm[d] + np.cumsum(r, axis=1)
        x[some, o:] = r


def predict(x: np.ndarray, rows: np.ndarray, order: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> None:
    """Samples from linear-prediction residuals, in place."""
    for o in np.unique(order[rows]):
        some = rows[order[rows] == o]
        y = np.ascontiguousarray(x[some].T)
        c = np.ascontiguousarray(coefficients[some, :o].T[::-1])
        s = shift[some]
        for i in range(int(o), len(y)):
            y[i] += (y[i - o : i] * c).sum(0) >> s
        x[some] = y.T


def decode_streams(streams: list[bytes]) -> list[bytes]:
    """The payloads of streams. Raises Damaged where a checksum or the number of samples differs."""
    data = b"".join(streams)
    flat = np.frombuffer(data, np.uint8)
    read = BitReader(flat)
    base = np.concatenate(([0], np.cumsum([len(s) for s in streams])))
    heads = [stream_parts(s) for s in streams]
    frames: list[tuple[int, int, int, int, int]] = []  # stream, sample, start, subframe, samples
    walk = []
    for i, (n, _, points, body) in enumerate(heads):
        covered = 0
        for sample, _, many in points:
            covered = covered + many if sample == covered else -1
        if covered == n and points:
            for sample, at, many in points:
                begin = int(base[i]) + body + at
                size, sub = parse_header(data, begin)
                if size != many:
                    raise Damaged("a frame is not of the size in the seek table")
                frames.append((i, sample, begin, sub, size))
        elif n:
            walk.append(i)
    out = [bytearray(n) for n, _, _, _ in heads]
    by_size: dict[int, list[int]] = {}
    for f, x in enumerate(frames):
        by_size.setdefault(x[4], []).append(f)
    start, end = np.array([x[2] for x in frames], np.int64), np.zeros(len(frames), np.int64)
    for size, group in by_size.items():
        samples, stop = decode_frames(read, np.array([8 * frames[f][3] for f in group], np.int64), size)
        put(out, [frames[f][:2] for f in group], samples)
        end[group] = (stop + 7) // 8
    for i in walk:  # without a point for every frame, one frame after the other
        sample, at = 0, int(base[i]) + heads[i][3]
        while sample < heads[i][0]:
            size, sub = parse_header(data, at)
            samples, stop = decode_frames(read, np.array([8 * sub], np.int64), size)
            put(out, [(i, sample)], samples[:, : heads[i][0] - sample])
            start, end = np.append(start, at), np.append(end, (stop[0] + 7) // 8)
            sample, at = sample + size, int(end[-1]) + 2
    if (end + 2 > len(flat)).any():
        raise Damaged("a frame goes beyond its stream")
    if len(end) and (crc16(flat, start, end) != (flat[end].astype(np.uint16) << 8 | flat[end + 1])).any():
        raise Damaged("a frame's CRC-16 differs")
    for got, (_, digest, _, _) in zip(out, heads, strict=True):
        if digest != bytes(16) and hashlib.md5((np.frombuffer(bytes(got), np.uint8) ^ 0x80).tobytes()).digest() != digest:
            raise Damaged("the samples' MD5 differs")
    return [bytes(x) for x in out]


def put(out: list[bytearray], places: list[tuple[int, int]], samples: np.ndarray) -> None:
    raw = (samples + 128).astype(np.uint8)
    for (i, sample), row in zip(places, raw, strict=True):
        out[i][sample : sample + len(row)] = row.tobytes()


def read_samples(stream: bytes, start: int, n: int) -> bytes:
    """n samples of a stream from a sample on, decoding only the frames that the seek table names for them."""
    total, _, points, body = stream_parts(stream)
    stop, got, first = min(start + n, total), bytearray(), None
    for k, (sample, at, many) in enumerate(points):
        if sample + many <= start or sample >= stop:
            continue
        end = body + points[k + 1][1] if k + 1 < len(points) else len(stream)
        frame = stream[body + at : end]
        size, sub = parse_header(frame, 0)
        flat = np.frombuffer(frame, np.uint8)
        samples, done = decode_frames(BitReader(flat), np.array([8 * sub], np.int64), size)
        close = int((done[0] + 7) // 8)
        if crc16(flat, np.array([0]), np.array([close]))[0] != int.from_bytes(frame[close : close + 2], "big"):
            raise Damaged("a frame's CRC-16 differs")
        first = sample if first is None else first
        got += (samples[0] + 128).astype(np.uint8).tobytes()
    return bytes(got[start - (first or 0) : stop - (first or 0)]) if first is not None else b""


def feature(samples: np.ndarray) -> str:
    """Sum, energy, zero crossings and peak of samples."""
    x = samples.astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"n={len(x)};sum={int(x.sum())};energy={int((x * x).sum())};crossings={crossings};peak={int(np.abs(x).max(initial=0))}"


def groups(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    return arrays.slices(batch, column, TOGETHER)


def encode(df: DataFrame, payload_col: str, media_col: str = "media") -> DataFrame:
    """df with its binary column payload_col as a FLAC stream in media_col instead. Null stays null; an empty payload is a
    stream without frames; repeated rows are coded alike. Other columns are kept; a ValueError if media_col is one of
    them."""
    kept = [c for c in df.columns if c != payload_col]
    if media_col in kept:
        raise ValueError(f"there is a column {media_col} already")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, payload_col):
                values = part.column(payload_col).to_pylist()
                made = iter(encode_streams([v for v in values if v is not None]))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array([None if v is None else next(made) for v in values], pa.binary())], [*kept, media_col])

    schema = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept], f"`{media_col}` binary"])
    return df.select(*kept, payload_col).mapInArrow(coded, schema)


def decode(df: DataFrame, media_col: str = "media", pcm_col: str = "pcm") -> DataFrame:
    """df with pcm_col, the samples of the FLAC streams in media_col (unsigned 8-bit), and feature, a digest of them. Null
    stays null; a damaged stream fails the job, for its payload could not be whole; a ValueError if df has one of these
    columns already."""
    kept = list(df.columns)
    if clash := {pcm_col, "feature"} & set(kept):
        raise ValueError(f"there are columns {sorted(clash)} already")

    def played(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, media_col):
                values = part.column(media_col).to_pylist()
                made = decode_streams([v for v in values if v is not None])
                it, marks = iter(made), iter([feature(np.frombuffer(m, np.uint8)) for m in made])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([None if v is None else next(it) for v in values], pa.binary()), pa.array([None if v is None else next(marks) for v in values], pa.string())],
                    [*part.schema.names, pcm_col, "feature"],
                )

    schema = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept], f"`{pcm_col}` binary", "feature string"])
    return df.mapInArrow(played, schema)


def pcm_blocks(df: DataFrame, id_col: str, media_col: str = "media", samples: int = BLOCK) -> DataFrame:
    """The samples of streams in blocks: id, sample_offset (of the block's first sample, by which a block can be sought),
    n_samples and pcm. A stream without samples has no block."""
    played = decode(df.select(F.col(id_col).alias("_id"), F.col(media_col).alias("_media")), "_media", "_pcm")
    many = F.ceil(F.length("_pcm") / samples).cast("int")
    offsets = played.filter(F.length("_pcm") > 0).select("_id", "_pcm", F.explode(F.transform(F.sequence(F.lit(0), many - 1), lambda i: i * samples)).alias("sample_offset"))
    block = F.substring("_pcm", F.col("sample_offset") + 1, F.lit(samples))
    return offsets.select(F.col("_id").alias(id_col), "sample_offset", F.length(block).alias("n_samples"), block.alias("pcm"))
