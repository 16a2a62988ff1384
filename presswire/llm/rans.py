"""Static range asymmetric numeral system over token ids: one block at a time.

A block is independent. Its symbols are dealt over lanes that advance together, so
a step is a handful of array operations. Every ``EVERY`` steps the lanes' states
and the place in the word stream are kept as a checkpoint: a decoder may start at
any of them, and checks the block's crc32 first.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE = 20  # frequencies of a table sum to 2 ** SCALE
LANES = 1024
EVERY = 128  # steps from checkpoint to checkpoint
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sBxHIIIII")
MAGIC = b"PWR1"


class Frequencies:
    """A table shared by the blocks of a segment: every id that occurs has at least one slot."""

    def __init__(self, slots: np.ndarray) -> None:
        if int(slots.sum()) != 1 << SCALE:
            raise ValueError(f"slots do not sum to 2**{SCALE}")
        self.slots = slots.astype(np.uint64)
        self.below = np.concatenate([[0], np.cumsum(self.slots)[:-1]]).astype(np.uint64)
        self.owner = np.repeat(np.arange(len(slots), dtype=np.uint32), slots.astype(np.int64))
        self.mark = zlib.crc32(slots.astype("<u4").tobytes())

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Frequencies:
        """Slots in proportion to ``counts``; with nothing counted, id 0 has them all."""
        seen = counts > 0
        size = int(seen.sum())
        if size > 1 << (SCALE - 1):
            raise ValueError(f"{size} ids do not fit a table of 2**{SCALE} slots")
        if not size:
            return cls(np.array([1 << SCALE]))
        free = (1 << SCALE) - size
        exact = counts.astype(np.float64) * free / int(counts.sum())
        extra = np.floor(exact).astype(np.int64)
        # What rounding leaves goes to the largest remainders, lower ids first.
        order = np.argsort(np.where(seen, extra - exact, 1.0), kind="stable")[:size]
        whole, rest = divmod(free - int(extra.sum()), size)
        extra[order] += whole
        extra[order[:rest]] += 1
        return cls(extra + seen)

    def pack(self) -> bytes:
        """Ids with slots, as steps from one to the next, and their slots."""
        ids = np.flatnonzero(self.slots)
        steps = np.diff(ids, prepend=0)
        raw = struct.pack("<II", len(self.slots), len(ids)) + steps.astype("<u4").tobytes() + self.slots[ids].astype("<u4").tobytes()
        return zlib.compress(raw, 6)

    @classmethod
    def unpack(cls, packed: bytes) -> Frequencies:
        raw = zlib.decompress(packed)
        size, n = struct.unpack_from("<II", raw)
        slots = np.zeros(size, dtype=np.int64)
        slots[np.cumsum(np.frombuffer(raw, "<u4", n, 8), dtype=np.int64)] = np.frombuffer(raw, "<u4", n, 8 + 4 * n)
        return cls(slots)


def encode(ids: np.ndarray, table: Frequencies) -> bytes:
    """A block of ids; any number of them, none included."""
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    steps = -(-n // lanes)
    state = np.full(lanes, _LOW, dtype=np.uint64)
    f, c = table.slots[ids], table.below[ids]
    limit = f << np.uint64(63 - SCALE)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    for t in range(steps - 1, -1, -1):
        at = slice(t * lanes, min(n, (t + 1) * lanes))
        x = state[: at.stop - at.start]
        full = x >= limit[at]
        out = x[full]
        if len(out):
            words.append(out.astype("<u4"))
            written += len(out)
            x[full] = out >> np.uint64(32)
        q = x // f[at]
        x[:] = (q << np.uint64(SCALE)) + (x - q * f[at]) + c[at]
        if t % EVERY == 0:
            marks.append((written, state.copy()))
    words.reverse()
    marks.reverse()
    body = [_HEAD.pack(MAGIC, SCALE, lanes, n, table.mark, len(marks), written, EVERY)]
    for upto, kept in marks:
        body += [struct.pack("<I", written - upto), kept.astype("<u8").tobytes()]
    body += [w.tobytes() for w in words]
    block = b"".join(body)
    return block + struct.pack("<I", zlib.crc32(block))


def decode(block: bytes, table: Frequencies, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of a block, or those from checkpoint ``first`` up to checkpoint ``last``."""
    (crc,) = struct.unpack_from("<I", block, len(block) - 4)
    if zlib.crc32(memoryview(block)[:-4]) != crc:
        raise ValueError("block damaged: checksum differs")
    magic, scale, lanes, n, mark, n_marks, n_words, every = _HEAD.unpack_from(block)
    if magic != MAGIC or scale != SCALE or mark != table.mark:
        raise ValueError("block of another format or table")
    each = 4 + 8 * lanes
    stream = np.frombuffer(block, dtype="<u4", count=n_words, offset=_HEAD.size + n_marks * each)
    steps = -(-n // lanes)
    begin, end = first * every, steps if last is None else min(steps, last * every)
    if begin >= end:
        return np.empty(0, dtype=np.uint32)
    here = _HEAD.size + first * each
    (at,) = struct.unpack_from("<I", block, here)
    state = np.frombuffer(block, dtype="<u8", count=lanes, offset=here + 4).astype(np.uint64)
    out = np.empty(min(n, end * lanes) - begin * lanes, dtype=np.uint32)
    low = np.uint64((1 << SCALE) - 1)
    for t in range(begin, end):
        m = min(n, (t + 1) * lanes) - t * lanes
        x = state[:m]
        slot = x & low
        s = table.owner[slot]
        x = table.slots[s] * (x >> np.uint64(SCALE)) + slot - table.below[s]
        need = x < _LOW
        k = int(need.sum())
        if k:
            x[need] = (x[need] << np.uint64(32)) | stream[at : at + k]
            at += k
        state[:m] = x
        out[(t - begin) * lanes : (t - begin) * lanes + m] = s
    return out
