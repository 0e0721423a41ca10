"""Static range asymmetric numeral system over interleaved lanes (numpy).

A payload holds ``n`` symbols. Symbol ``i`` belongs to lane ``i % lanes``; all lanes
take a step together. A lane's state stays in [2^31, 2^63) and gives or takes 32 bits at
a time, in lane order. Every ``stride`` steps a checkpoint holds the states of all lanes
and the place among the words, so that parts of a payload decode independently.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

PRECISION = 20
LANES = 1024
STRIDE = 256
LOW = np.uint64(1 << 31)
HEAD = "<QIIIQ"


class Corrupt(ValueError):
    """A checksum does not fit."""


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^PRECISION, at least 1 for each symbol that occurs."""
    whole = 1 << PRECISION
    used = np.flatnonzero(counts)
    if len(used) == 0 or len(used) > whole:
        raise ValueError(f"{len(used)} symbols do not fit a table")
    share = counts[used].astype(np.float64) * (whole / counts.sum())
    freq = np.maximum(1, np.floor(share)).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    excess = int(freq.sum()) - whole
    if excess < 0:
        freq[order[0]] -= excess
    for at in order:  # only where many rare symbols were lifted to 1
        if excess <= 0:
            break
        cut = min(excess, int(freq[at]) - 1)
        freq[at] -= cut
        excess -= cut
    out = np.zeros(len(counts), dtype=np.int64)
    out[used] = freq
    return out


def pack_table(freq: np.ndarray) -> bytes:
    used = np.flatnonzero(freq)
    steps = np.diff(used, prepend=0).astype("<u4").tobytes()
    return struct.pack("<II", len(freq), len(used)) + zlib.compress(
        steps + freq[used].astype("<u4").tobytes(), 6)


class Table:
    """A shared frequency table, ready for both directions."""

    def __init__(self, packed: bytes):
        size, used = struct.unpack_from("<II", packed)
        both = np.frombuffer(zlib.decompress(packed[8:]), dtype="<u4")
        symbols, freq = np.cumsum(both[:used], dtype=np.int64), both[used:].astype(np.uint64)
        if len(freq) != used or int(freq.sum()) != 1 << PRECISION:
            raise Corrupt("frequency table")
        self.freq = np.zeros(size, dtype=np.uint64)
        self.freq[symbols] = freq
        self.start = np.zeros(size, dtype=np.uint64)
        self.start[symbols] = np.cumsum(freq, dtype=np.uint64) - freq
        self._symbols, self._counts, self._slots = symbols, freq, None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(self._symbols.astype(np.uint32),
                                    self._counts.astype(np.int64))
        return self._slots


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, stride: int = STRIDE) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    room = np.uint64(63 - PRECISION)
    given: list[np.ndarray] = []
    out = 0
    points: list[tuple[int, np.ndarray]] = []
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes:(step + 1) * lanes]
        x, freq = state[: len(part)], table.freq[part]
        full = x >= (freq << room)
        if full.any():
            words = x[full].astype("<u4")
            given.append(words)
            out += len(words)
            x[full] >>= np.uint64(32)
        whole = x // freq
        state[: len(part)] = ((whole << np.uint64(PRECISION)) + (x - whole * freq)
                              + table.start[part])
        if step % stride == 0:
            points.append((out, state.copy()))
    points.reverse()
    words = np.concatenate(given[::-1]) if given else np.zeros(0, dtype="<u4")
    at = np.array([out - p for p, _ in points], dtype="<u8")
    states = np.concatenate([s for _, s in points]) if points else np.zeros(0, dtype=np.uint64)
    return (struct.pack(HEAD, n, lanes, stride, len(points), len(words))
            + at.tobytes() + states.astype("<u8").tobytes() + words.tobytes())


def segments(payload: bytes) -> int:
    return struct.unpack_from(HEAD, payload)[3]


def decode_segment(payload: bytes, table: Table, number: int) -> np.ndarray:
    """The symbols from one checkpoint to the next."""
    n, lanes, stride, points, n_words = struct.unpack_from(HEAD, payload)
    at = struct.calcsize(HEAD)
    places = np.frombuffer(payload, "<u8", points, at)
    at += 8 * points
    state = np.frombuffer(payload, "<u8", lanes, at + 8 * lanes * number).astype(np.uint64)
    words = np.frombuffer(payload, "<u4", n_words, at + 8 * lanes * points)
    first, last = number * stride * lanes, min(n, (number + 1) * stride * lanes)
    out = np.empty(last - first, dtype=np.uint32)
    mask, shift, pos = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION), int(places[number])
    for begin in range(0, last - first, lanes):
        width = min(lanes, last - first - begin)
        x = state[:width]
        slot = x & mask
        symbol = table.slots[slot]
        out[begin:begin + width] = symbol
        x = table.freq[symbol] * (x >> shift) + slot - table.start[symbol]
        empty = np.flatnonzero(x < LOW)
        if len(empty):
            x[empty] = (x[empty] << np.uint64(32)) | words[pos:pos + len(empty)]
            pos += len(empty)
        state[:width] = x
    return out


def decode(payload: bytes, table: Table) -> np.ndarray:
    parts = [decode_segment(payload, table, i) for i in range(segments(payload))]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
