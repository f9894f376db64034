"""Media columns: mono 8-bit FLAC, written and read in whole batches of frames.

A column ``media`` holds FLAC streams: STREAMINFO with the MD5 of the samples, a
seek table with a point for every frame, and frames of ``BLOCK`` samples.  A
byte b is the sample b - 128.

The writer tries constant, verbatim, fixed predictors of order 0 to 4 and a
quantised linear predictor of order 4, and Rice codes the residuals.

The reader decodes any mono 8-bit stream of fixed block size: constant,
verbatim, fixed and linear predictors up to order 32, Rice codes of both
parameter sizes and escaped partitions.  It checks the header's CRC-8, the
frame's CRC-16 and the MD5, and raises ValueError on any mismatch.  All frames
of a batch advance together, sample by sample, so its inner steps are array
operations; where a stream has no complete seek table its frames are found one
after another.

Null media decode to null.  Null and empty texts are payloads of 64 zero bytes
(``payload``).  Rows with a null id and repeated rows are handled each.  Texts of
any length are stored whole, in as many frames as they need.  Of encodings of
equal size the first tried is taken, so equal texts give equal streams.  Columns
whose names clash with the results', in any case, are replaced.  An empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, as_bytes, texts
from .encoding import by_bytes

BLOCK = 1024
RATE = 16_000
LPC_ORDER = 4
LPC_BITS = 10
#: The fixed predictors of the format.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
BATCH_BYTES = 2_000_000
#: Frames that the writer works on at once.
WRITE_FRAMES = 256


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.zeros(256, np.uint32)
    for b in range(256):
        c = b << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ poly if c >> (bits - 1) & 1 else c << 1
        out[b] = c & ((1 << bits) - 1)
    return out


_CRC8 = _crc_table(0x07, 8).tolist()
_CRC16 = _crc_table(0x8005, 16)
_CLZ16 = np.array([16 - int(i).bit_length() for i in range(1 << 16)], np.int64)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def crc16(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-16 of the slices, all at once."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order].copy(), size[order]
    crc = np.zeros(len(at), np.uint32)
    active = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), "right")
    for n in active.tolist():
        c = crc[:n]
        crc[:n] = ((c << 8) & 0xFFFF) ^ _CRC16[(c >> 8) ^ buffer[at[:n]]]
        at[:n] += 1
    out = np.empty_like(crc)
    out[order] = crc
    return out


def payload(text: bytes) -> bytes:
    """The text and zero bytes up to a positive multiple of 64."""
    return text + bytes(-len(text) % 64 if text else 64)


# Writing


def _fold(r: np.ndarray) -> np.ndarray:
    return (r << 1) ^ (r >> 31)


def _rice(u: np.ndarray, first: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The best of the parameters about the mean for each partition, and the bits of all; u[:, :first] are warm-up samples and count nothing."""
    frames, n = u.shape
    each = n // parts
    count = np.full(parts, each)
    count[0] -= first
    body = u.copy()
    body[:, :first] = 0
    body = body.reshape(frames, parts, each)
    guess = np.floor(np.log2(np.maximum(body.sum(2) / np.maximum(count, 1), 1))).astype(np.int32)
    best = k_best = None
    for step in (-1, 0, 1):
        k = np.clip(guess + step, 0, 13)
        bits = (body >> k[:, :, None]).sum(2) + (1 + k) * count
        best, k_best = (bits, k) if best is None else (np.where(bits < best, bits, best), np.where(bits < best, k, k_best))
    return k_best.astype(np.int64), best.sum(1) + 4 * parts


def _lpc(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients of each frame and their shift, by Levinson and Durbin's recursion."""
    y = x.astype(np.float64) * np.hanning(x.shape[1] + 2)[1:-1]
    r = np.stack([(y[:, : y.shape[1] - i] * y[:, i:]).sum(1) for i in range(LPC_ORDER + 1)], 1)
    r[:, 0] = r[:, 0] * (1 + 1e-9) + 1e-9
    a, error = np.zeros((len(x), LPC_ORDER)), r[:, 0].copy()
    for i in range(LPC_ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / np.maximum(error, 1e-12)
        before = a[:, :i].copy()
        a[:, :i] = before - k[:, None] * before[:, ::-1]
        a[:, i] = k
        error *= np.maximum(1 - k * k, 1e-12)
    top = (1 << (LPC_BITS - 1)) - 1
    shift = np.clip(np.floor(np.log2(top / np.maximum(np.abs(a).max(1), 1e-9))), 0, 14).astype(np.int64)
    return np.clip(np.rint(a * (1 << shift)[:, None]), -top - 1, top).astype(np.int64), shift


def _residual(x: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> np.ndarray:
    p = coefficients.shape[1]
    out = x.copy()
    guess = coefficients[:, :1] * x[:, p - 1 : -1]
    for i in range(1, p):
        guess += coefficients[:, i : i + 1] * x[:, p - 1 - i : x.shape[1] - 1 - i]
    out[:, p:] -= guess >> shift[:, None]
    return out


class _Bits:
    """A bit string of known size."""

    def __init__(self, size: int):
        self.bits = np.zeros(size, np.uint8)

    def put(self, at: np.ndarray, value: np.ndarray, width: int) -> None:
        for i in range(width):
            self.bits[at + i] = (value >> (width - 1 - i)) & 1


def _bodies(x: np.ndarray) -> list[bytes]:
    """The subframe of each row of samples, padded to whole bytes."""
    frames, n = x.shape
    parts = 8 if n == BLOCK else 1
    x = x.astype(np.int32)
    sums, difference = [], x
    for p in range(5):
        sums.append(np.abs(difference).sum(1) + 128 * p)
        difference = np.diff(difference, axis=1)
    fixed = np.argmin(np.stack(sums), 0)
    coefficients, shift = _lpc(x)
    r4 = _residual(x, coefficients.astype(np.int32), shift.astype(np.int32))
    kind = fixed.copy()
    folded = x.copy()
    for p in range(5):
        rows = np.flatnonzero(fixed == p)
        if len(rows):
            folded[rows, p:] = _fold(np.diff(x[rows], p, axis=1))
    k = np.zeros((frames, parts), np.int64)
    size = np.zeros(frames, np.int64)
    for p in range(5):
        rows = np.flatnonzero(fixed == p)
        if len(rows):
            k[rows], bits = _rice(folded[rows], p, parts)
            size[rows] = bits + 8 + 8 * p + 6
    r4 = _fold(r4)
    k4, bits4 = _rice(r4, LPC_ORDER, parts)
    size4 = bits4 + 8 + 8 * LPC_ORDER + 6 + 9 + LPC_ORDER * LPC_BITS
    use = size4 < size
    kind[use], size[use], k[use] = 5, size4[use], k4[use]
    folded[use] = r4[use]
    same = (x == x[:, :1]).all(1)
    verbatim = size >= 8 + 8 * n
    kind[verbatim] = 6
    size[verbatim] = 8 + 8 * n
    kind[same] = 7
    size[same] = 16
    whole = (size + 7) // 8 * 8
    start = np.cumsum(whole) - whole
    out = _Bits(int(whole.sum()))
    heads = np.array([8, 9, 10, 11, 12, 31 + LPC_ORDER, 1, 0])
    out.put(start, heads[kind] << 1, 8)
    raw = x & 255
    for rows, stored in ((np.flatnonzero(kind == 6), n), (np.flatnonzero(kind == 7), 1)):
        at = (start[rows] + 8)[:, None] + np.arange(8 * stored)
        out.bits[at] = np.unpackbits(raw[rows, :stored].astype(np.uint8), axis=1)
    each = n // parts
    for c in range(6):
        rows = np.flatnonzero(kind == c)
        if not len(rows):
            continue
        p = c if c < 5 else LPC_ORDER
        at = start[rows] + 8
        for j in range(p):
            out.put(at + 8 * j, raw[rows, j], 8)
        at = at + 8 * p
        if c == 5:
            out.put(at, np.full(len(rows), LPC_BITS - 1), 4)
            out.put(at + 4, shift[rows], 5)
            for j in range(LPC_ORDER):
                out.put(at + 9 + LPC_BITS * j, coefficients[rows, j] & ((1 << LPC_BITS) - 1), LPC_BITS)
            at = at + 9 + LPC_BITS * LPC_ORDER
        out.put(at, np.full(len(rows), parts.bit_length() - 1), 6)
        kk = k[rows]
        u = folded[rows]
        ks = np.repeat(kk, each, 1)
        q = u >> ks
        length = q + 1 + ks
        length[:, :p] = 0
        before = np.cumsum(length, 1) - length + (at + 6)[:, None] + 4 * (1 + np.arange(n) // each)[None]
        for part in range(parts):
            j = part * each + (p if part == 0 else 0)
            out.put(before[:, min(j, n - 1)] - 4, kk[:, part], 4)
        live = np.zeros((len(rows), n), bool)
        live[:, p:] = True
        stop, low, ks = (before + q)[live], u[live], ks[live]
        out.bits[stop] = 1
        last = stop + ks
        for b in range(int(kk.max(initial=0))):
            has = np.flatnonzero((ks > b) & (low >> b & 1).astype(bool))
            out.bits[last[has] - b] = 1
    packed = np.packbits(out.bits).tobytes()
    ends = (start + whole) // 8
    return [packed[a:b] for a, b in zip((start // 8).tolist(), ends.tolist(), strict=True)]


def _utf8_number(n: int) -> bytes:
    if n < 128:
        return bytes([n])
    out = []
    limit = 63
    while n > limit:
        out.append(128 | n & 63)
        n >>= 6
        limit = limit >> 1 if out[1:] else 31
    return bytes([(0xFF << (7 - len(out))) & 0xFF | n, *out[::-1]])


def _header(number: int, n: int) -> bytes:
    head = bytes([0xFF, 0xF8, (10 if n == BLOCK else 7) << 4 | 5, 0x02]) + _utf8_number(number)
    if n != BLOCK:
        head += (n - 1).to_bytes(2, "big")
    return head + bytes([crc8(head)])


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream of each payload; a payload has at least one byte."""
    by_size: dict[int, list[tuple[int, int]]] = {}
    for i, data in enumerate(payloads):
        for at in range(0, len(data), BLOCK):
            by_size.setdefault(min(BLOCK, len(data) - at), []).append((i, at))
    bodies: dict[tuple[int, int], bytes] = {}
    for n, where in by_size.items():
        for j in range(0, len(where), WRITE_FRAMES):
            some = where[j : j + WRITE_FRAMES]
            x = np.frombuffer(b"".join([payloads[i][at : at + n] for i, at in some]), np.uint8).reshape(-1, n).astype(np.int32) - 128
            bodies.update(zip(some, _bodies(x), strict=True))
    frames: list[bytes] = []
    owner: list[int] = []
    for i, data in enumerate(payloads):
        for number, at in enumerate(range(0, len(data), BLOCK)):
            frames.append(_header(number, min(BLOCK, len(data) - at)) + bodies[i, at])
            owner.append(i)
    size = np.fromiter(map(len, frames), np.int64, len(frames))
    sums = crc16(np.frombuffer(b"".join(frames), np.uint8), np.cumsum(size) - size, size).tolist()
    grouped: list[list[bytes]] = [[] for _ in payloads]
    for i, f, c in zip(owner, frames, sums, strict=True):
        grouped[i].append(f + c.to_bytes(2, "big"))
    out = []
    for data, own in zip(payloads, grouped, strict=True):
        sizes = list(map(len, own))
        digest = hashlib.md5(np.bitwise_xor(np.frombuffer(data, np.uint8), 128).tobytes()).digest()
        info = BLOCK.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + (RATE << 44 | 7 << 36 | len(data)).to_bytes(8, "big") + digest
        points, offset = [], 0
        for j, s in enumerate(sizes):
            points.append((j * BLOCK).to_bytes(8, "big") + offset.to_bytes(8, "big") + min(BLOCK, len(data) - j * BLOCK).to_bytes(2, "big"))
            offset += s
        table = b"".join(points)
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(own))
    return out


# Reading


@dataclass
class Stream:
    block: int
    samples: int
    md5: bytes
    points: list[tuple[int, int, int]]
    first: int


def open_stream(data: bytes) -> Stream:
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, info, points = 4, False, None, []
    while not last:
        if at + 4 > len(data):
            raise ValueError("metadata is cut off")
        last, kind, size = bool(data[at] >> 7), data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        if len(body) < size:
            raise ValueError("metadata is cut off")
        if kind == 0:
            info = body
        elif kind == 3:
            for i in range(0, size, 18):
                n = int.from_bytes(body[i : i + 8], "big")
                if n != (1 << 64) - 1:
                    points.append((n, int.from_bytes(body[i + 8 : i + 16], "big"), int.from_bytes(body[i + 16 : i + 18], "big")))
        at += 4 + size
    if info is None or len(info) < 34:
        raise ValueError("no STREAMINFO")
    word = int.from_bytes(info[10:18], "big")
    if (word >> 41 & 7) != 0 or (word >> 36 & 31) != 7:
        raise ValueError("only mono 8-bit streams are read")
    return Stream(int.from_bytes(info[2:4], "big"), word & ((1 << 36) - 1), info[18:34], sorted(set(points)), at)


@dataclass
class _Frame:
    n: int
    sample: int
    kind: int  # 0 constant, 1 verbatim, 2 predicted
    order: int
    coefficients: tuple[int, ...]
    shift: int
    fixed: bool
    warm: list[int]
    bit: int  # of the residual's first partition, from the buffer's start
    parts: int
    wide: int  # bits of a Rice parameter


def _signed(value: int, bits: int) -> int:
    return value - (1 << bits) if value >> (bits - 1) & 1 else value


def _frame(data: bytes, at: int, block: int, base: int) -> _Frame:
    """Reads a frame up to its residual; base: where data begins in the batch's buffer."""
    if data[at : at + 2] != b"\xff\xf8":
        raise ValueError("no frame of fixed block size here")
    size, rate, last = data[at + 2] >> 4, data[at + 2] & 15, data[at + 3]
    if last not in (0x02, 0x00):
        raise ValueError("only mono 8-bit frames are read")
    j = at + 4
    lead = data[j]
    more = 0 if lead < 128 else 7 - (lead ^ 0xFF).bit_length()
    number = lead if not more else lead & ((1 << (6 - more)) - 1)
    for c in data[j + 1 : j + 1 + more]:
        number = number << 6 | c & 63
    j += 1 + more
    if size == 6:
        n, j = data[j] + 1, j + 1
    elif size == 7:
        n, j = int.from_bytes(data[j : j + 2], "big") + 1, j + 2
    else:
        n = 192 if size == 1 else 576 << (size - 2) if 2 <= size <= 5 else 256 << (size - 8)
    j += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[at:j]) != data[j]:
        raise ValueError("a frame header's CRC-8 does not match")
    j += 1
    head = data[j]
    kind = head >> 1 & 63
    if head & 129:
        raise ValueError("wasted bits are not read")
    j += 1
    if kind < 2:
        values = list(np.frombuffer(data, np.int8, n if kind else 1, j))
        return _Frame(n, number * block, kind, 0, (), 0, True, values, 8 * (base + j + len(values)), 0, 0)
    if 8 <= kind <= 12:
        order, fixed = kind - 8, True
    elif kind >= 32:
        order, fixed = kind - 31, False
    else:
        raise ValueError("a reserved subframe")
    warm = list(np.frombuffer(data, np.int8, order, j))
    j += order
    bits, coefficients, shift = 8 * j, FIXED[order] if fixed else (), 0
    window = int.from_bytes(data[j : j + 80].ljust(80, b"\0"), "big")
    used = 0

    def take(n: int) -> int:
        nonlocal used
        used += n
        return window >> (640 - used) & ((1 << n) - 1)

    if not fixed:
        precision = take(4) + 1
        shift = _signed(take(5), 5)
        coefficients = tuple(_signed(take(precision), precision) for _ in range(order))
        if precision == 16 or shift < 0:
            raise ValueError("a reserved linear predictor")
    method = take(2)
    if method > 1:
        raise ValueError("a reserved residual coding")
    parts = 1 << take(4)
    if n % parts or n // parts < order:
        raise ValueError("a partition order that does not fit")
    return _Frame(n, number * block, 2, order, coefficients, shift, fixed, warm, 8 * base + bits + used, parts, 4 + method)


def _residuals(frames: list[_Frame], buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residuals of predicted frames by sample, and the bit after each; frames come by falling size."""
    wide = np.concatenate([buffer, np.zeros(16, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(buffer) + 8, np.uint64)
    for i in range(8):
        words |= wide[i : i + len(words)] << np.uint64(56 - 8 * i)
    size = np.array([f.n for f in frames])
    order = np.array([f.order for f in frames])
    each = np.array([f.n // f.parts for f in frames])
    parameter = np.array([f.wide for f in frames])
    pos = np.array([f.bit for f in frames], np.int64)
    k = np.zeros(len(frames), np.int64)
    raw = np.full(len(frames), -1, np.int64)
    out = np.zeros((int(size[0]), len(frames)), np.int64)
    limit = 8 * len(buffer)
    starts: dict[int, list[int]] = {}
    for i, f in enumerate(frames):
        for p in range(f.parts):
            starts.setdefault(p * int(each[i]) if p else f.order, []).append(i)
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right")
    one, eight = np.uint64(1), np.int64(7)
    ragged = int(order.max(initial=0))
    any_raw = False

    def peek(at: np.ndarray) -> np.ndarray:
        if len(at) and int(at.max()) > limit:
            raise ValueError("a frame is cut off")
        return words[at >> 3] << (at & eight).astype(np.uint64)

    for j in range(int(size[0])):
        if j in starts:
            rows = np.array(starts[j])
            x = peek(pos[rows])
            k[rows] = (x >> (64 - parameter[rows]).astype(np.uint64)).astype(np.int64)
            pos[rows] += parameter[rows]
            escaped = k[rows] == (1 << parameter[rows]) - 1
            raw[rows] = -1
            if escaped.any():
                some = rows[escaped]
                raw[some] = (peek(pos[some]) >> np.uint64(59)).astype(np.int64)
                pos[some] += 5
            any_raw = bool((raw >= 0).any())
        n = int(active[j])
        if j < ragged or any_raw:
            live = np.flatnonzero((order[:n] <= j) & (raw[:n] < 0))
            plain = np.flatnonzero((order[:n] <= j) & (raw[:n] >= 0))
            if len(plain):
                width = raw[plain].astype(np.uint64)
                x = peek(pos[plain])
                value = ((x >> one) >> (np.uint64(63) - width)).astype(np.int64)
                out[j, plain] = np.where(raw[plain] > 0, value - ((value >> np.maximum(raw[plain] - 1, 0)) & 1) * (np.int64(1) << raw[plain]), 0)
                pos[plain] += raw[plain]
            at, kk = pos[live], k[live]
        else:
            live, at, kk = None, pos[:n], k[:n]
        x = peek(at)
        q = _CLZ16[x >> np.uint64(48)]
        if (q == 16).any():
            total = np.zeros_like(q)
            long = np.flatnonzero(q == 16)
            at = at.copy()
            while len(long):
                at[long] += 16
                total[long] += 16
                x[long] = peek(at[long])
                q[long] = _CLZ16[x[long] >> np.uint64(48)]
                long = long[q[long] == 16]
            full = total + q
        else:
            full = q
        x = x << (q + 1).astype(np.uint64)
        u = (full << kk) | ((x >> one) >> (63 - kk).astype(np.uint64)).astype(np.int64)
        value = (u >> 1) ^ -(u & 1)
        if live is None:
            out[j, :n] = value
            pos[:n] = at + (q + 1 + kk)
        else:
            out[j, live] = value
            pos[live] = at + (q + 1 + kk)
    return out, pos


def _restore(frames: list[_Frame], residual: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Samples by sample and frame of frames of one predictor's kind and order and one size."""
    p, n = frames[0].order, frames[0].n
    x = residual[:n, where]
    if not p:
        return x
    warm = np.array([f.warm for f in frames], np.int64).T
    x[:p] = warm
    if frames[0].fixed:
        body = x[p:]
        for level in range(p - 1, -1, -1):
            body = np.cumsum(body, 0) + np.diff(warm, level, 0)[-1]
        x[p:] = body
        return x
    c = np.array([f.coefficients for f in frames], np.int64).T
    shift = np.array([f.shift for f in frames], np.int64)
    for j in range(p, n):
        x[j] += (c * x[j - p : j][::-1]).sum(0) >> shift
    return x


def _decode_frames(data: list[tuple[bytes, int, int]]) -> list[tuple[int, bytes, int]]:
    """(stream, where its frame begins, block size) -> first sample, samples as bytes, where the frame ends."""
    base, bases = 0, {}
    parts = []
    for d, _, _ in data:
        if id(d) not in bases:
            bases[id(d)] = base
            parts.append(d)
            base += len(d)
    buffer = np.frombuffer(b"".join(parts), np.uint8)
    frames = [_frame(d, at, block, bases[id(d)]) for d, at, block in data]
    end = np.array([f.bit for f in frames], np.int64)
    samples: list[np.ndarray | None] = [None] * len(frames)
    predicted = sorted((i for i, f in enumerate(frames) if f.kind == 2), key=lambda i: -frames[i].n)
    if predicted:
        residual, stop = _residuals([frames[i] for i in predicted], buffer)
        end[predicted] = stop
        groups: dict[tuple, list[int]] = {}
        for column, i in enumerate(predicted):
            groups.setdefault((frames[i].n, frames[i].order, frames[i].fixed), []).append(column)
        for columns in groups.values():
            rows = [predicted[c] for c in columns]
            x = _restore([frames[i] for i in rows], residual, np.array(columns))
            if len(x) and (x.min() < -128 or x.max() > 127):
                raise ValueError("a sample of over 8 bits")
            for i, column in zip(rows, np.ascontiguousarray(x.T), strict=True):
                samples[i] = column
    for i, f in enumerate(frames):
        if f.kind < 2:
            samples[i] = np.array(f.warm if f.kind else f.warm * f.n, np.int64)
    begin = np.array([bases[id(d)] + at for d, at, _ in data], np.int64)
    stop = (end + 7) // 8
    if len(stop) and int(stop.max()) + 2 > len(buffer):
        raise ValueError("a frame is cut off")
    stored = buffer[stop].astype(np.int64) << 8 | buffer[stop + 1]
    if (crc16(buffer, begin, stop - begin) != stored).any():
        raise ValueError("a frame's CRC-16 does not match")
    pcm = [(s + 128).astype(np.uint8).tobytes() for s in samples]
    return [(f.sample, x, int(e) + 2 - bases[id(d)]) for f, x, e, (d, _, _) in zip(frames, pcm, stop, data, strict=True)]


def decode_blocks(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """The blocks (first sample, PCM bytes) of each stream, checked against frame CRCs and the MD5."""
    info = [open_stream(s) for s in streams]
    out: list[list[tuple[int, bytes]]] = [[] for _ in streams]
    ready, rest = [], []
    for i, s in enumerate(info):
        covered = 0
        for first, _, n in s.points:
            covered = covered + n if first == covered else -1
            if covered < 0:
                break
        if covered == s.samples:
            ready += [(i, s.first + offset) for _, offset, _ in s.points]
        elif s.samples:
            rest.append((i, s.first))
    for (i, _), (sample, pcm, _) in zip(ready, _decode_frames([(streams[i], at, info[i].block) for i, at in ready]), strict=True):
        out[i].append((sample, pcm))
    done = dict.fromkeys((i for i, _ in rest), 0)
    while rest:
        got = _decode_frames([(streams[i], at, info[i].block) for i, at in rest])
        after = []
        for (i, _), (sample, pcm, at) in zip(rest, got, strict=True):
            out[i].append((sample, pcm))
            done[i] += len(pcm)
            if done[i] < info[i].samples:
                after.append((i, at))
        rest = after
    for blocks, s in zip(out, info, strict=True):
        blocks.sort()
        digest = hashlib.md5(usedforsecurity=False)
        for _, pcm in blocks:
            digest.update(np.bitwise_xor(np.frombuffer(pcm, np.uint8), 128).tobytes())
        if sum(len(p) for _, p in blocks) != s.samples or s.md5 != bytes(16) and digest.digest() != s.md5:
            raise ValueError("the samples' MD5 does not match")
    return out


def read_range(stream: bytes, start: int, count: int) -> bytes:
    """PCM bytes of samples start to start + count, decoding only the frames that hold them."""
    s = open_stream(stream)
    points = [(first, offset, n) for first, offset, n in s.points if first < start + count and first + n > start]
    if s.points and sum(n for _, _, n in s.points) == s.samples:
        blocks = [(a, b) for a, b, _ in _decode_frames([(stream, s.first + offset, s.block) for _, offset, _ in points])]
    else:
        blocks = decode_blocks([stream])[0]
    return b"".join(pcm[max(0, start - first) : max(0, start + count - first)] for first, pcm in sorted(blocks))


def feature(pcm: bytes) -> str:
    """Mean, root mean square, peak and zero-crossing rate of the samples, as text."""
    x = np.frombuffer(pcm, np.uint8).astype(np.int32) - 128
    n, s, q = len(x), int(x.sum()), int((x * x).sum(dtype=np.int64))
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"mean={s / n:.6f};rms={(q / n) ** 0.5:.6f};peak={int(np.abs(x).max())};zcr={crossings / n:.6f}"


# Operators


def write_media(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends n_bytes and ``media``, the FLAC stream of the text's payload; columns of these names are replaced."""

    def kernel():
        def work(batch: pa.RecordBatch) -> list:
            data = texts(batch.column(0))
            media: list[bytes] = []
            for lo, hi in by_bytes(data, BATCH_BYTES):
                media += encode_streams([payload(x) for x in data[lo:hi]])
            return [pa.array(list(map(len, data)), pa.int64()), pa.array(media, pa.binary())]

        return work

    return append_columns(docs, kernel, [as_bytes(text_col)], "n_bytes long, media binary", docs.columns if keep is None else keep)


def read_media(rows: DataFrame, media_col: str = "media", keep: list[str] | None = None, with_pcm: bool = False) -> DataFrame:
    """Appends what the stored bytes hold: payload_bytes, payload_sha256, tail_crc32 (of the last 64 samples), media_bytes,
    media_sha256, feature and, if asked for, pcm.  All are null where media is."""

    def kernel():
        def work(batch: pa.RecordBatch) -> list:
            data = batch.column(0).to_pylist()
            out: list[tuple] = []
            for lo, hi in by_bytes([x or b"" for x in data], BATCH_BYTES):
                some = [x for x in data[lo:hi] if x is not None]
                pcm = iter([b"".join(p for _, p in blocks) for blocks in decode_blocks(some)])
                for x in data[lo:hi]:
                    if x is None:
                        out.append((None,) * 7)
                    else:
                        p = next(pcm)
                        out.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(x), hashlib.sha256(x).hexdigest(), feature(p) if p else "", p if with_pcm else None))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            return [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds[: 7 if with_pcm else 6])]

        return work

    ddl = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return append_columns(rows, kernel, [F.col(media_col)], ddl + (", pcm binary" if with_pcm else ""), rows.columns if keep is None else keep)


def pcm_blocks(rows: DataFrame, media_col: str = "media", keep: list[str] | None = None) -> DataFrame:
    """One row for each frame: block, sample_offset, n_samples and pcm.  Null media give none."""

    def kernel():
        def work(batch: pa.RecordBatch) -> list:
            data = [x or b"" for x in batch.column(0).to_pylist()]
            out = []
            for lo, hi in by_bytes(data, BATCH_BYTES):
                got = iter(decode_blocks([x for x in data[lo:hi] if x]))
                out += [[{"block": i, "sample_offset": s, "n_samples": len(p), "pcm": p} for i, (s, p) in enumerate(next(got))] if x else [] for x in data[lo:hi]]
            return [pa.array(out, pa.list_(pa.struct([("block", pa.int64()), ("sample_offset", pa.int64()), ("n_samples", pa.int64()), ("pcm", pa.binary())])))]

        return work

    columns = [c for c in (rows.columns if keep is None else keep) if c.lower() not in {media_col.lower(), "block", "sample_offset", "n_samples", "pcm"}]
    made = append_columns(rows, kernel, [F.col(media_col)], "__blocks array<struct<block: long, sample_offset: long, n_samples: long, pcm: binary>>", columns)
    return made.select(*columns, F.inline("__blocks"))
