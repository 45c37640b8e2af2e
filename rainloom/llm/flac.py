"""FLAC streams: an encoder, a vectorised decoder for the streams it makes, and a plain decoder for any others.

The vectorised pair works on all frames of a batch at once: Rice codes are found by following, in step for every
frame, links from each stop bit to the next, and predictors are undone in step as well. Frame headers (CRC-8), frames
(CRC-16) and the samples' MD5 are verified. A seek point for every frame gives its first sample and its byte offset."""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np

from .common import expand

BLOCK = 4096
#: Frames that are coded or decoded at a time: this bounds the memory, not the length of a stream.
FRAMES = 256
#: Taps of the linear predictor, bits of a tap and the shift of the prediction.
ORDER, PRECISION, SHIFT = 4, 14, 10
RATE = 8000
MONO8 = 0x02  # one channel, 8 bits a sample
_SIGN = bytes(b ^ 0x80 for b in range(256))


class FlacError(ValueError):
    """A stream that isn't FLAC or fails a checksum."""


# -- checksums ------------------------------------------------------------------------------------------------------


def _crc_rows(poly: int, bits: int, rows: int) -> np.ndarray:
    """Row d, column b: the checksum of byte b with d zero bytes after it. Checksums of longer data are xors of these."""
    kind, top, mask = (np.uint8 if bits == 8 else np.uint16), 1 << (bits - 1), (1 << bits) - 1
    first = []
    for b in range(256):
        c = b << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
        first.append(c)
    table = np.empty((rows, 256), kind)
    table[0] = base = np.array(first, kind)
    for d in range(1, rows):
        last = table[d - 1].astype(np.int64)
        table[d] = ((last << 8) & mask) ^ base[last >> (bits - 8)]
    return table


_tables: dict[int, np.ndarray] = {}


def crc(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """The CRC-8 or CRC-16 of data[starts[i] : starts[i] + sizes[i]], none of them empty."""
    most = int(sizes.max(initial=1))
    if bits not in _tables or len(_tables[bits]) < most:
        _tables[bits] = _crc_rows(0x07 if bits == 8 else 0x8005, bits, max(most, 32 if bits == 8 else BLOCK + 64))
    if not len(sizes):
        return np.zeros(0, np.uint16)
    ends = np.cumsum(sizes)
    offset = np.arange(ends[-1], dtype=np.int32)
    at = offset + np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)
    left = np.repeat((ends - 1).astype(np.int32), sizes) - offset
    return np.bitwise_xor.reduceat(_tables[bits].ravel()[left << 8 | data[at]], ends - sizes)


# -- encoder --------------------------------------------------------------------------------------------------------


def _coded_number(n: int) -> bytes:
    """A frame number as FLAC writes it: UTF-8's scheme, to 36 bits."""
    if n < 0x80:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    tail = [0x80 | (n >> (6 * k)) & 0x3F for k in range(size - 1)]
    return bytes([(0xFF00 >> size) & 0xFF | n >> (6 * (size - 1)), *reversed(tail)])


def _taps(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Quantised predictor taps of every frame, (ORDER, frames), by the autocorrelation method."""
    r = np.empty((ORDER + 1, len(starts)))
    for lag in range(ORDER + 1):
        product = np.zeros(len(x), np.int32)
        product[lag:] = x[lag:] * x[: len(x) - lag] if lag else x * x
        for j in range(lag):
            product[starts + j] = 0
        r[lag] = np.add.reduceat(product, starts, dtype=np.int64)
    error = r[0] * (1 + 1e-9) + 1e-9
    a = np.zeros((ORDER, len(starts)))
    for i in range(ORDER):
        k = (r[i + 1] - (a[:i] * r[i:0:-1]).sum(axis=0)) / error
        a[:i] -= k * a[:i][::-1].copy()
        a[i] = k
        error *= np.maximum(1 - k * k, 1e-9)
    most = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << SHIFT)), -most - 1, most).astype(np.int32)


def _encode_frames(data: np.ndarray, sizes: np.ndarray, number: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The frames of samples that lie in a row, and how many bytes each frame has. number: the frames' numbers."""
    x = data.astype(np.int32) - 128
    starts = np.cumsum(sizes) - sizes

    # residuals: nothing predicted, or by linear prediction; whichever is smaller
    taps = _taps(x, starts, sizes)
    predicted = np.zeros(len(x), np.int32)
    for i in range(ORDER):
        predicted[i + 1 :] += np.repeat(taps[i], sizes)[i + 1 :] * x[: len(x) - i - 1]
    residual = x - (predicted >> SHIFT)
    lpc = np.add.reduceat(np.abs(residual), starts) < np.add.reduceat(np.abs(x), starts)
    residual = np.where(np.repeat(lpc, sizes), residual, x)
    order = np.where(lpc, ORDER, 0)
    constant = np.maximum.reduceat(x, starts) == np.minimum.reduceat(x, starts)

    # Rice codes
    u = ((residual << 1) ^ (residual >> 31)).astype(np.uint32)
    coded = np.ones(len(x), bool)
    warm = starts[lpc][:, None] + np.arange(ORDER)
    coded[warm] = False
    u[warm] = 0
    n_codes = sizes - order
    mean = np.add.reduceat(u, starts, dtype=np.int64) / n_codes
    guess = np.floor(np.log2(np.maximum(mean * 0.7, 1))).astype(np.int64)
    best = np.full(len(starts), np.iinfo(np.int64).max)
    k = np.zeros(len(starts), np.int64)
    for shift in (-1, 0, 1):
        tried = np.clip(guess + shift, 0, 14)
        cost = np.add.reduceat(u >> np.repeat(tried.astype(np.uint32), sizes), starts, dtype=np.int64) + n_codes * (1 + tried)
        better = cost < best
        best, k = np.where(better, cost, best), np.where(better, tried, k)
    overhead = np.where(lpc, ORDER * 8 + 9 + ORDER * PRECISION, 0) + 10
    verbatim = ~constant & (best + overhead >= sizes * 8)
    rice = ~constant & ~verbatim
    body = 8 + np.where(constant, 8, np.where(verbatim, sizes * 8, best + overhead))
    coded_numbers = [_coded_number(n) for n in range(int(number.max()) + 1)]
    head = 7 + np.array([len(coded_numbers[n]) for n in number])
    total = head + -(-body // 8) + 2
    begin = np.cumsum(total) - total
    bits = np.zeros(int(total.sum()) * 8, np.uint8)

    def put(at: np.ndarray, value: np.ndarray | int, n: int) -> np.ndarray:
        shifts = np.arange(n - 1, -1, -1)
        bits[at[:, None] + np.arange(n)] = (np.broadcast_to(value, at.shape)[:, None] >> shifts) & 1
        return at + n

    at = (begin + head) * 8
    at = put(at, np.where(constant, 0, np.where(verbatim, 1, np.where(lpc, 31 + ORDER, 8))) << 1, 8)
    put(at[constant], data[starts[constant]].astype(np.int64) ^ 0x80, 8)
    own = rice & lpc
    pos = at[own]
    for j in range(ORDER):
        pos = put(pos, data[starts[own] + j].astype(np.int64) ^ 0x80, 8)
    pos = put(put(pos, PRECISION - 1, 4), SHIFT, 5)
    for i in range(ORDER):
        pos = put(pos, taps[i][own].astype(np.int64) & ((1 << PRECISION) - 1), PRECISION)
    at[own] = pos
    at[rice] = put(put(at[rice], 0, 6), k[rice], 4)
    use = np.repeat(rice, sizes) & coded
    kk = np.repeat(k, sizes)[use].astype(np.uint32)
    value = u[use]
    width = (value >> kk).astype(np.int64) + 1 + kk
    ends = np.cumsum(width)
    per = n_codes[rice]
    firsts = np.cumsum(per) - per
    stop = ends - 1 - kk + np.repeat(at[rice] - (ends - width)[firsts], per) if len(per) else ends
    bits[stop] = 1
    for j in range(int(k[rice].max(initial=0))):
        some = slice(None) if (k[rice] > j).all() else np.flatnonzero(kk > j)
        bits[stop[some] + kk[some] - j] = (value[some] >> np.uint32(j)) & 1
    out = np.packbits(bits)
    for f in np.flatnonzero(verbatim):
        out[begin[f] + head[f] + 1 : begin[f] + head[f] + 1 + sizes[f]] = data[starts[f] : starts[f] + sizes[f]] ^ 0x80

    # headers and checksums
    out[begin[:, None] + np.arange(4)] = np.array([0xFF, 0xF8, 0x70, MONO8], np.uint8)
    for n in np.unique(number).tolist():
        at_n = begin[number == n]
        out[at_n[:, None] + 4 + np.arange(len(coded_numbers[n]))] = np.frombuffer(coded_numbers[n], np.uint8)
    out[begin + head - 3], out[begin + head - 2] = (sizes - 1) >> 8, (sizes - 1) & 255
    out[begin + head - 1] = crc(out, begin, head - 1, 8)
    check = crc(out, begin, total - 2, 16)
    out[begin + total - 2], out[begin + total - 1] = check >> 8, check & 255

    return out.tobytes(), total


def encode(payloads: list[bytes]) -> list[bytes]:
    """Each payload, of a positive multiple of 16 bytes, as a FLAC stream of one channel with 8 bits a sample (byte less 128).

    FRAMES frames are coded at a time, whatever the length of a payload."""
    if not payloads:
        return []
    data = np.frombuffer(b"".join(payloads), np.uint8)
    lengths = np.fromiter(map(len, payloads), np.int64, len(payloads))
    if (lengths < 16).any() or (lengths % 16).any():
        raise FlacError("payloads have to be positive multiples of 16 bytes")
    n_frames = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(payloads)), n_frames)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n_frames) - n_frames, n_frames)
    sizes = np.minimum(BLOCK, lengths[owner] - number * BLOCK)
    ends = np.append(0, np.cumsum(sizes))
    parts, totals = [], []
    for a in range(0, len(owner), FRAMES):
        b = min(a + FRAMES, len(owner))
        part, total = _encode_frames(data[ends[a] : ends[b]], sizes[a:b], number[a:b])
        parts.append(part)
        totals.append(total)
    raw, total = b"".join(parts), np.concatenate(totals)
    begin = np.cumsum(total) - total
    streams, frame = [], 0
    for payload, count in zip(payloads, n_frames.tolist(), strict=True):
        own = slice(frame, frame + count)
        base, n = int(begin[frame]), len(payload)
        size = min(n, BLOCK)
        info = struct.pack(">HH", size, size) + int(total[own].min()).to_bytes(3) + int(total[own].max()).to_bytes(3)
        info += (RATE << 44 | 7 << 36 | n).to_bytes(8) + hashlib.md5(payload.translate(_SIGN)).digest()
        seek = np.empty(count, [("sample", ">u8"), ("offset", ">u8"), ("size", ">u2")])
        seek["sample"], seek["offset"], seek["size"] = number[own] * BLOCK, begin[own] - base, sizes[own]
        streams.append(b"fLaC\x00" + len(info).to_bytes(3) + info + b"\x83" + (18 * count).to_bytes(3) + seek.tobytes() + raw[base : base + int(total[own].sum())])
        frame += count
    return streams


# -- stream heads ---------------------------------------------------------------------------------------------------


@dataclass
class Head:
    rate: int
    channels: int
    bits: int
    samples: int
    block: int
    md5: bytes
    seek: np.ndarray  # (points, 3): first sample, byte offset, samples
    start: int  # of the first frame


def read_head(stream: bytes) -> Head:
    if stream[:4] != b"fLaC":
        raise FlacError("no FLAC stream")
    at, info, seek = 4, None, np.zeros((0, 3), np.int64)
    last = False
    while not last:
        if at + 4 > len(stream):
            raise FlacError("metadata is cut off")
        last, kind, size = stream[at] >> 7, stream[at] & 127, int.from_bytes(stream[at + 1 : at + 4])
        body = stream[at + 4 : at + 4 + size]
        if kind == 0:
            info = body
        elif kind == 3:
            points = np.frombuffer(body, [("sample", ">u8"), ("offset", ">u8"), ("size", ">u2")])
            points = points[points["sample"] != 2**64 - 1]
            seek = np.stack([points[c].astype(np.int64) for c in points.dtype.names], axis=1)
        at += 4 + size
    if info is None or len(info) < 34:
        raise FlacError("no stream information")
    packed = int.from_bytes(info[10:18])
    return Head(packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1, int.from_bytes(info[2:4]), info[18:34], seek, at)


# -- decoders -------------------------------------------------------------------------------------------------------

_FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def decode(streams: list[bytes]) -> list[bytes]:
    """The samples of each stream, 8-bit ones as signed bytes and others as little-endian integers, all checksums verified."""
    heads = [read_head(s) for s in streams]
    out: list[bytes | None] = [None] * len(streams)
    quick = [i for i, h in enumerate(heads) if h.channels == 1 and h.bits == 8 and len(h.seek) and h.seek[:, 2].sum() == h.samples]
    if quick and (found := _decode_frames([streams[i] for i in quick], [heads[i] for i in quick])) is not None:
        for i, pcm in zip(quick, found, strict=True):
            out[i] = pcm
    for i, pcm in enumerate(out):
        if pcm is None:
            out[i] = pcm = decode_plain(streams[i])
        if any(heads[i].md5) and hashlib.md5(pcm).digest() != heads[i].md5:
            raise FlacError("the samples' MD5 differs")
    return out


def _decode_frames(streams: list[bytes], heads: list[Head]) -> list[bytes] | None:
    """All frames, FRAMES at a time; None if a stream has frames of other kinds than encode() makes."""
    data = np.frombuffer(b"".join([s[h.start :] for s, h in zip(streams, heads, strict=True)]), np.uint8)
    room = np.array([len(s) - h.start for s, h in zip(streams, heads, strict=True)], np.int64)
    base = np.cumsum(room) - room
    points = np.array([len(h.seek) for h in heads])
    begin = np.concatenate([h.seek[:, 1] for h in heads]) + np.repeat(base, points)
    sizes = np.concatenate([h.seek[:, 2] for h in heads])
    total = np.diff(np.append(begin, base[-1] + room[-1]))
    sample = np.concatenate([h.seek[:, 0] for h in heads])
    before = np.cumsum(sizes) - sizes
    if (total < 10).any() or (sample != before - np.repeat(before[np.cumsum(points) - points], points)).any():
        raise FlacError("seek points out of order")
    parts = []
    for a in range(0, len(begin), FRAMES):
        own = slice(a, min(a + FRAMES, len(begin)))
        low, high = int(begin[a]), int(begin[own.stop - 1] + total[own.stop - 1])
        part = _decode_run(np.append(data[low:high], np.zeros(16, np.uint8)), begin[own] - low, total[own], sizes[own])
        if part is None:
            return None
        parts.append(part)
    raw = b"".join(parts)
    ends = np.cumsum([h.samples for h in heads]).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _decode_run(data: np.ndarray, begin: np.ndarray, total: np.ndarray, sizes: np.ndarray) -> bytes | None:
    """The samples of frames that lie in a row; data has 16 bytes more."""
    if (data[begin] != 0xFF).any() or (data[begin + 1] != 0xF8).any() or (data[begin + 2] != 0x70).any() or (data[begin + 3] != MONO8).any():
        return None
    lead = data[begin + 4]
    head = 8 + np.searchsorted([0xC0, 0xE0, 0xF0, 0xF8, 0xFC, 0xFE], lead, side="right")  # one byte more for each bound
    if (crc(data, begin, head - 1, 8) != data[begin + head - 1]).any():
        raise FlacError("a frame header's checksum differs")
    if (crc(data, begin, total - 2, 16) != (data[begin + total - 2].astype(np.uint16) << 8 | data[begin + total - 1])).any():
        raise FlacError("a frame's checksum differs")
    if ((data[begin + head - 3].astype(np.int64) << 8 | data[begin + head - 2]) + 1 != sizes).any():
        raise FlacError("a frame's size differs from its seek point")
    kind = data[begin + head] >> 1
    wide = data.astype(np.uint32)

    def get(at: np.ndarray, n: int) -> np.ndarray:
        """n bits, 17 at most, from each bit position."""
        byte = at >> 3
        three = wide[byte] << 16 | wide[byte + 1] << 8 | wide[byte + 2]
        return (three >> (24 - (at & 7) - n).astype(np.uint32)).astype(np.int64) & ((1 << n) - 1)

    order = np.where(kind >= 32, kind - 31, np.where(kind >= 8, kind - 8, 0)).astype(np.int64)
    rice = kind >= 8
    if ((kind > 1) & (kind < 8) | (kind > 12) & (kind < 32)).any() or (data[begin + head] & 0x81).any() or (order > ORDER).any():
        return None
    at = (begin + head + 1) * 8
    taps = np.zeros((ORDER, len(begin)), np.int32)
    shift = np.zeros(len(begin), np.int32)
    lpc = kind >= 32
    if lpc.any():
        if (order[lpc] != ORDER).any():
            return None
        pos = at[lpc] + 8 * ORDER
        if (get(pos, 4) + 1 != PRECISION).any():
            return None
        shift[lpc] = get(pos + 4, 5)
        for i in range(ORDER):
            raw = get(pos + 9 + PRECISION * i, PRECISION)
            taps[i, lpc] = raw - ((raw >> (PRECISION - 1)) << PRECISION)
    for n in range(1, 5):
        for i, tap in enumerate(_FIXED[n]):
            taps[i, kind == 8 + n] = tap
    at = at + 8 * order + np.where(lpc, 9 + PRECISION * ORDER, 0)
    if get(at[rice], 6).any():
        return None  # several partitions, or parameters of five bits
    k = np.where(rice, get(at, 10) & 15, 0)
    if (k == 15).any():
        return None

    samples = np.zeros(int(sizes.sum()), np.int8)
    first = np.cumsum(sizes) - sizes
    for f in np.flatnonzero(kind == 0):
        samples[first[f] : first[f] + sizes[f]] = data[begin[f] + head[f] + 1].view(np.int8)
    for f in np.flatnonzero(kind == 1):
        samples[first[f] : first[f] + sizes[f]] = data[begin[f] + head[f] + 1 : begin[f] + head[f] + 1 + sizes[f]].view(np.int8)

    lanes = np.flatnonzero(rice)
    lanes = lanes[np.argsort(order[lanes] - sizes[lanes], kind="stable")]  # the most codes first
    if len(lanes):
        n_codes = (sizes - order)[lanes]
        own_k = k[lanes]
        bits = np.unpackbits(data)
        ones = np.flatnonzero(bits).astype(np.int32)
        before = np.cumsum(bits, dtype=np.int32)  # ones up to and with each bit
        frame_k = np.repeat(k.astype(np.int32), np.diff(np.append(before[begin * 8] - bits[begin * 8], len(ones))))
        following = np.append(before[np.minimum(ones + frame_k, len(bits) - 1)], 0).astype(np.int32)
        code_at = at[lanes] + 10
        current = before[code_at - 1]
        most = int(n_codes[0])
        active = np.searchsorted(-n_codes, -np.arange(most), side="left")
        stops = np.zeros((most, len(lanes)), np.int32)
        for t, a in enumerate(active.tolist()):
            stops[t, :a] = current[:a]
            current[:a] = following[current[:a]]
        inside = (np.arange(most) < n_codes[:, None])
        stop = ones[stops.T[inside]]
        code_k = np.repeat(own_k.astype(np.int32), n_codes)
        start = np.empty_like(stop)
        start[1:] = stop[:-1] + 1 + code_k[:-1]
        start[np.cumsum(n_codes) - n_codes] = code_at
        last = stop + code_k  # the code's last bit, at which three bytes end that hold all of its low bits
        byte = last >> 3
        three = wide[byte - 2] << 16 | wide[byte - 1] << 8 | wide[byte]
        low = (three >> (7 - (last & 7)).astype(np.uint32)).astype(np.int32) & ((1 << code_k) - 1)
        u = (stop - start) << code_k | low
        residual = (u >> 1) ^ -(u & 1)
        own_order = order[lanes]
        where = np.repeat(first[lanes] + own_order - (np.cumsum(n_codes) - n_codes), n_codes) + np.arange(len(u))
        samples[where] = residual.astype(np.int8)
        some = np.flatnonzero(own_order)
        if len(some):
            part = np.zeros((ORDER + int(n_codes[some[0]]), len(some)), np.int32)
            part[ORDER:].T[inside[some, : int(n_codes[some[0]])]] = residual[np.repeat(own_order > 0, n_codes)]
            for j in range(1, ORDER + 1):  # warm-up samples stand just after the subframe's head
                has = own_order[some] >= j
                at_lane = lanes[some[has]]
                part[ORDER - j, has] = data[begin[at_lane] + head[at_lane] + 1 + order[at_lane] - j].view(np.int8)
            back = np.ascontiguousarray(taps[:, lanes[some]][::-1])
            by = shift[lanes[some]]
            active = np.searchsorted(-n_codes[some], -np.arange(int(n_codes[some[0]])), side="left")
            for t, a in enumerate(active.tolist()):
                part[ORDER + t, :a] += (part[t : t + ORDER, :a] * back[:, :a]).sum(axis=0, dtype=np.int32) >> by[:a]
            row = np.arange(len(part))
            chosen = (row >= ORDER - own_order[some, None]) & (row < ORDER + n_codes[some, None])
            samples[expand(first[lanes[some]], sizes[lanes[some]])] = part.T[chosen].astype(np.int8)
    return samples.tobytes()


class _Bits:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def take(self, n: int) -> int:
        a, b = self.at >> 3, (self.at + n + 7) >> 3
        if b > len(self.data):
            raise FlacError("a frame is cut off")
        self.at += n
        return int.from_bytes(self.data[a:b]) >> (b * 8 - self.at) & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (x >> (n - 1) << n) if n else 0

    def unary(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


def _crc_plain(data: bytes, poly: int, bits: int) -> int:
    c, top, mask = 0, 1 << (bits - 1), (1 << bits) - 1
    for b in data:
        c ^= b << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
    return c


def _subframe(bits: _Bits, n: int, depth: int) -> list[int]:
    if bits.take(1):
        raise FlacError("a subframe's padding bit is set")
    kind = bits.take(6)
    wasted = bits.unary() + 1 if bits.take(1) else 0
    depth -= wasted
    if kind == 0:
        out = [bits.signed(depth)] * n
    elif kind == 1:
        out = [bits.signed(depth) for _ in range(n)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 8 if kind < 32 else kind - 31
        out, taps, shift = [bits.signed(depth) for _ in range(order)], _FIXED[order] if kind < 32 else [], 0
        if kind >= 32:
            precision, shift = bits.take(4) + 1, bits.signed(5)
            taps = [bits.signed(precision) for _ in range(order)]
        method, partitions = bits.take(2), bits.take(4)
        if method > 1:
            raise FlacError("unknown residual coding")
        for p in range(1 << partitions):
            k, count = bits.take(4 + method), (n >> partitions) - (0 if p else order)
            raw = bits.take(5) if k == (15, 31)[method] else None
            for _ in range(count):
                if raw is None:
                    u = bits.unary() << k | bits.take(k)
                    residual = (u >> 1) ^ -(u & 1)
                else:
                    residual = bits.signed(raw)
                out.append(residual + (sum(c * out[-1 - i] for i, c in enumerate(taps)) >> shift))
    else:
        raise FlacError("a reserved subframe type")
    return [x << wasted for x in out]


def frames_plain(stream: bytes, head: Head, at: int | None = None):
    """(first sample, channels' samples) of every frame from byte `at` on, by the format alone."""
    at, done = head.start if at is None else at, None
    while at < len(stream):
        if at + 10 > len(stream) or stream[at] != 0xFF or stream[at + 1] & 0xFE != 0xF8:
            raise FlacError("no frame where one should start")
        bits = _Bits(stream, at + 2)
        size_code, rate_code, channel, depth_code = bits.take(4), bits.take(4), bits.take(4), bits.take(3)
        bits.take(1)
        number = bits.take(8)
        if number >= 0xC0:
            extra = next(k for k in range(1, 7) if not number >> (6 - k) & 1)
            number &= (1 << (6 - extra)) - 1
            for _ in range(extra):
                number = number << 6 | bits.take(8) & 63
        n = {1: 192, 6: None, 7: None}.get(size_code, 576 << (size_code - 2) if size_code < 6 else 256 << (size_code - 8) if size_code > 7 else 0)
        n = bits.take(8 if size_code == 6 else 16) + 1 if n is None else n
        if rate_code > 11:
            bits.take(8 if rate_code == 12 else 16)
        here = bits.at >> 3
        if _crc_plain(stream[at:here], 0x07, 8) != bits.take(8):
            raise FlacError("a frame header's checksum differs")
        depth = (head.bits, 8, 12, 0, 16, 20, 24, 32)[depth_code]
        count = channel + 1 if channel < 8 else 2
        side = {8: 1, 9: 0, 10: 1}.get(channel)
        parts = [_subframe(bits, n, depth + (c == side)) for c in range(count)]
        if channel == 8:
            parts[1] = [a - b for a, b in zip(*parts, strict=True)]
        elif channel == 9:
            parts[0] = [a + b for a, b in zip(*parts, strict=True)]
        elif channel == 10:
            mid = [m << 1 | s & 1 for m, s in zip(*parts, strict=True)]
            parts = [[(m + s) >> 1 for m, s in zip(mid, parts[1], strict=True)], [(m - s) >> 1 for m, s in zip(mid, parts[1], strict=True)]]
        end = (bits.at + 7) >> 3
        bits.at = end * 8
        if _crc_plain(stream[at:end], 0x8005, 16) != bits.take(16):
            raise FlacError("a frame's checksum differs")
        first = number if stream[at + 1] & 1 else number * head.block
        yield first, parts
        at = end + 2


def decode_plain(stream: bytes) -> bytes:
    head = read_head(stream)
    size = -(-head.bits // 8)
    out = bytearray()
    for _, parts in frames_plain(stream, head):
        for frame in zip(*parts, strict=True):
            for x in frame:
                out += x.to_bytes(size, "little", signed=True)
    return bytes(out)


def seek(stream: bytes, sample: int) -> tuple[int, bytes]:
    """The frame that holds a sample, by the seek table: its first sample and its 8-bit samples, decoded alone."""
    head = read_head(stream)
    if not 0 <= sample < head.samples:
        raise IndexError(sample)
    before = head.seek[head.seek[:, 0] <= sample]
    at = head.start + int(before[-1, 1]) if len(before) else head.start
    for first, parts in frames_plain(stream, head, at):
        if first + len(parts[0]) > sample:
            return first, b"".join(x.to_bytes(1, signed=True) for x in parts[0])
    raise FlacError("the stream ends before that sample")
