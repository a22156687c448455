"""Bloom filters of a fixed number of bits, built and merged as Spark jobs.

Their size is a parameter and never grows with the data.  A fuller filter lets
more rows through to the exact step after it; it never loses one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

FILTER_BITS = 1 << 25
CHUNK_BITS = 1 << 19


def _bits_of(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash; ``bits`` is a power of two, 2^31 at most."""
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


class OnceTwice:
    """Hashes seen at least once, and hashes seen at least twice."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.once = np.zeros(bits, bool)
        self.twice = np.zeros(bits, bool)

    def add(self, hashes: np.ndarray) -> None:
        single, counts = np.unique(hashes, return_counts=True)
        a, b = _bits_of(single, self.bits)
        again = (counts > 1) | (self.once[a] & self.once[b])
        self.twice[a[again]] = self.twice[b[again]] = True
        self.once[a] = self.once[b] = True


def _merge(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """What two filters have both seen once has been seen twice."""
    once = twice = None
    for o, t in parts:
        if once is None:
            once, twice = o.copy(), t.copy()
        else:
            twice |= t | (once & o)
            once |= o
    return once, twice


def build(hashed: DataFrame, bits: int = FILTER_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Packed bits (seen once, seen twice) of a frame with the one column ``hashes``,
    array<bigint>.  At most ``bits / 4`` bytes reach the driver."""
    chunk = min(CHUNK_BITS, bits)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = OnceTwice(bits)
        for batch in batches:
            values = batch.column(0).flatten().drop_null()
            seen.add(values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        once = seen.once.reshape(-1, chunk)
        full = np.flatnonzero(once.any(axis=1))
        if len(full):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full.astype(np.int32)),
                    pa.array([np.packbits(once[i]).tobytes() for i in full], pa.binary()),
                    pa.array(
                        [np.packbits(seen.twice.reshape(-1, chunk)[i]).tobytes() for i in full],
                        pa.binary(),
                    ),
                ],
                names=["chunk", "once", "twice"],
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
                held[i] = _merge([held[i], part] if i in held else [part])
        for i, (o, t) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([o.tobytes()]), pa.array([t.tobytes()])],
                names=["chunk", "once", "twice"],
            )

    schema = "chunk int, once binary, twice binary"
    rows = (
        hashed.mapInArrow(local, schema)
        .repartition(max(bits // chunk, 1), "chunk")
        .mapInArrow(merged, schema)
        .collect()
    )
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for row in rows:
        at = slice(row["chunk"] * chunk // 8, (row["chunk"] + 1) * chunk // 8)
        once[at], twice[at] = np.frombuffer(row["once"], np.uint8), np.frombuffer(row["twice"], np.uint8)
    return once, twice


def holds(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in a packed filter."""

    def bit(at: np.ndarray) -> np.ndarray:
        return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1

    a, b = _bits_of(hashes, len(packed) * 8)
    return (bit(a) & bit(b)).astype(bool)


def share(frame: DataFrame, packed: np.ndarray) -> Broadcast:
    return frame.sparkSession.sparkContext.broadcast(packed)


def may_hold(shared: Broadcast) -> Callable:
    """A column function: whether a bigint hash may be in the shared filter."""
    @pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        return pd.Series(holds(shared.value, hashes.to_numpy(np.int64).view(np.uint64)))

    return test


def likely_among(frame: DataFrame, key: str, keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose ``key`` may occur in ``keys`` (one column): all that do, and few others.

    Narrows the wide side of a join to be made after it.  ``keys`` is scanned by
    few tasks, as each holds a whole filter.
    """
    hashed = keys.select(F.array(F.xxhash64(F.col(keys.columns[0]))).alias("hashes"))
    few = max(keys.sparkSession.sparkContext.defaultParallelism, 1)
    once, _ = build(hashed.coalesce(few), bits)
    return frame.filter(may_hold(share(frame, once))(F.xxhash64(F.col(key))))
