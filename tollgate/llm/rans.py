"""Static range asymmetric numeral systems for token ids.

All blocks share one table of frequencies that sum to 2^BITS. A block is coded by LANES interleaved states of 64 bits that
give off words of 32 bits: id i belongs to lane i mod LANES, so one step codes LANES ids at once. Blocks know nothing
of each other. Inside a block, checkpoints keep all states and the place in the words at every `check` ids, so that a
reader may begin at any of them. A checksum over the ids is verified when a whole block is read; a part that ends with the
block must end in the states the encoder began with.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS, LANES, CHECK = 18, 2048, 1 << 17
LOW = np.uint64(1 << 31)  # least state
WORD, MASK = np.uint64(32), np.uint64((1 << 32) - 1)
SHIFT, SLOT = np.uint64(BITS), np.uint64((1 << BITS) - 1)
HEAD = struct.Struct("<4sIIIII")  # mark, ids, lanes, ids between checkpoints, words, checksum
MARK = b"rANS"


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^BITS, at least 1 for every id that occurs; by id."""
    counts = np.asarray(counts, dtype=np.float64)
    if not counts.sum():
        return np.zeros(len(counts), dtype=np.int64)
    if np.count_nonzero(counts) > 1 << (BITS - 1):
        raise ValueError(f"at most {1 << (BITS - 1)} different ids")
    frequency = np.where(counts > 0, np.maximum(1, np.floor(counts * (1 << BITS) / counts.sum())), 0).astype(np.int64)
    off = int(frequency.sum()) - (1 << BITS)
    order = np.argsort(-frequency, kind="stable")
    if off < 0:
        frequency[order[0]] -= off
    for i in order.tolist():
        if off <= 0:
            break
        taken = min(off, int(frequency[i]) // 2)
        frequency[i] -= taken
        off -= taken
    return frequency


class Table:
    """Frequencies and their running sums by id; by slot the id, its frequency and the slot's place in it."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = np.asarray(frequency, dtype=np.uint64)
        self.start = np.cumsum(self.frequency) - self.frequency
        self.ids = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))
        self.share = self.frequency[self.ids]
        self.place = np.arange(len(self.ids), dtype=np.uint64) - self.start[self.ids]


def checksum(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"), before)


def join_checksums(first: int, second: int, n_second: int) -> int:
    """Checksum of two runs of ids, the second of n_second ids, from the runs' own."""
    blank = bytes(4 * n_second)
    return zlib.crc32(blank, first) ^ zlib.crc32(blank) ^ second


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, check: int = CHECK) -> bytes:
    """A block; `check` is a multiple of `lanes`."""
    n = len(ids)
    share, start = table.frequency[ids], table.start[ids]
    limit = share << np.uint64(63 - BITS)
    states = np.full(lanes, LOW)
    words: list[np.ndarray] = []
    sent, marks = 0, []
    for at in range((n - 1) // lanes * lanes if n else -1, -1, -lanes):
        stop = min(at + lanes, n)
        x = states[: stop - at]
        full = x >= limit[at:stop]
        out = x[full]
        words.append((out & MASK).astype("<u4"))
        sent += len(out)
        x[full] = out >> WORD
        high, low = np.divmod(x, share[at:stop])
        x[:] = (high << SHIFT) + low + start[at:stop]
        if at and at % check == 0:
            marks.append((sent, states.astype("<u8").tobytes()))
    parts = [HEAD.pack(MARK, n, lanes, check, sent, checksum(ids)), states.astype("<u8").tobytes()]
    for before, kept in reversed(marks):
        parts += [struct.pack("<I", sent - before), kept]
    return b"".join([*parts, *(w.tobytes() for w in reversed(words))])


def n_ids(block: bytes) -> int:
    return HEAD.unpack_from(block)[1]


def decode(block: bytes, table: Table, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids `first` to `stop` (not included) of a block, read from the last checkpoint before them."""
    mark, n, lanes, check, n_words, crc = HEAD.unpack_from(block)
    if mark != MARK:
        raise ValueError("not a block")
    stop = n if stop is None else min(stop, n)
    if first >= stop:
        return np.zeros(0, dtype=np.uint32)
    n_marks, size = (n - 1) // check, 8 * lanes
    body = HEAD.size + size + n_marks * (4 + size)
    words = np.frombuffer(block, dtype="<u4", count=n_words, offset=body).astype(np.uint64)
    begin = first // check * check
    place, offset = 0, HEAD.size
    if begin:
        offset = HEAD.size + size + (begin // check - 1) * (4 + size)
        (place,) = struct.unpack_from("<I", block, offset)
        offset += 4
    states = np.frombuffer(block, dtype="<u8", count=lanes, offset=offset).astype(np.uint64)
    slots = np.empty(stop - begin, dtype=np.int64)
    for at in range(begin, stop, lanes):
        x = states[: min(lanes, n - at)]
        slot = (x & SLOT).view(np.int64)
        slots[at - begin : at - begin + lanes] = slot[: stop - at]
        x >>= SHIFT
        x *= table.share[slot]
        x += table.place[slot]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | words[place : place + len(low)]
        place += len(low)
    out = table.ids[slots]
    if stop == n and (place != n_words or (states != LOW).any()):
        raise ValueError("a block is damaged")
    if begin == 0 and stop == n and checksum(out) != crc:
        raise ValueError("a block's checksum is wrong")
    return out[first - begin :]
