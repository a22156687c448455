"""Vectorised words and rolling hashes over Arrow text, shared by the operators.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return; all of these are single bytes in UTF-8, so the work is done
on bytes.  Everything here sees one slice of a batch at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_TABLE = _LOWER.tobytes()

_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers_of(base: int, count: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(-(-count // (1 << 20)) << 20, base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:count]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column; null rows are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows of about ``limit`` bytes of text (a longer row
    stands alone), each with its bytes and offsets.  At their end, memory that is free
    goes back to the system: workers wait for the next task beside a growing JVM."""
    for batch in batches:
        raw, off = text_bytes(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(off, off[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (
                batch.slice(first, last - first),
                raw[off[first] : off[last]],
                off[first : last + 1] - off[first],
            )
            first = last
        del batch, raw, off
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def lower(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inner = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    begins = inner.copy()
    begins[1:] &= ~inner[:-1] | edge[1:-1]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(off, starts, "right") - 1


def word_hashes(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE
) -> np.ndarray:
    """A 64-bit hash of each word; another odd ``base`` gives another hash."""
    if not len(raw):
        return mix(np.zeros(len(starts), np.uint64))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * _powers_of(base, len(raw)), out=sums[1:])
    inverse = _powers_of(pow(base, -1, 1 << 64), len(raw))
    return mix((sums[ends] - sums[starts]) * inverse[np.minimum(starts, len(raw) - 1)])


def window_hashes(words: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A 64-bit hash of ``size`` consecutive words from each position, row ends ignored."""
    count = max(len(words) - size + 1, 0)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * np.uint64(base) + words[i : i + count]
    return mix(total)


def places(rows: np.ndarray) -> np.ndarray:
    """Number of each word within its row; ``rows`` ascends."""
    if not len(rows):
        return np.zeros(0, np.int64)
    heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    return np.arange(len(rows)) - np.repeat(heads, np.diff(np.r_[heads, len(rows)]))


def lists_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Values gathered by key, one list for each key."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    offsets = np.r_[heads, len(keys)].astype(np.int32)
    return keys[heads], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
