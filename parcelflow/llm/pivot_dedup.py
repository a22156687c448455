"""Near-duplicate documents by SimHash, with pivot distance tables.

A text's fingerprint has 64 bits: bit b is one if it is one in the hashes (XXH64, seed 42) of
more than half of its 3-word shingles, repeats included, A-Z lower-cased; a text of fewer words has one
shingle.  Texts link where at most two bits of their fingerprints differ.

Equal fingerprints are one node, however many rows have them.  Of the eight bytes of two linked
fingerprints six are equal at least, so nodes meet once for each choice of six bytes (28
choices).  Nodes that meet share 48 bits, so at most 2^16 of them ever do: that bounds what a
task holds, whatever the data.  Where nodes meet, their Hamming distances to reference
fingerprints, the pivots, are computed once a node.  A pair is discarded when its distances to some
pivot differ by more than two, as the triangle inequality tells; the others are verified bit by bit.
In larger meetings the distances to the first pivots are cells, and only cells near each
other are paired, so a big group of near copies is not compared all with all.  A
meeting hands on at most one link a node (to the smallest node it reaches there), and components
are joined from those.

Defined cases: null or empty text, or text without words, has fingerprint zero, linked like any
other; doc_id may have any ordered type; rows that share a doc_id are linked through any of their
texts only if those link; a row without a doc_id links texts as others do, names no component, and
has none where no reachable row has a doc_id; an empty table gives an empty result; columns
other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import words
from parcelflow.llm.components import components
from parcelflow.llm.kept import kept

SHINGLE = 3
SEED = 42
NEAR = 2
BYTES = 8
PIVOTS = 16
#: Pivots whose distances are cells, and the least meeting that is cut into cells.
CELL_PIVOTS = 4
CROWD = 64
#: Shingles hashed, and pairs compared, at a time.
AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 20

_pivots = np.random.default_rng(20260313).integers(0, 1 << 63, PIVOTS, dtype=np.uint64) << np.uint64(1)
#: Cell offsets a link can have.  Its two distances to a pivot differ by an even number if an
#: even number of bits differ, else by an odd one, for all pivots alike; one of each opposite pair.
_OFFSETS = [
    o for steps in ((-2, 0, 2), (-1, 1)) for o in product(steps, repeat=CELL_PIVOTS) if o >= (0,) * CELL_PIVOTS
]
_CELL_BASE = 72
_CELL_CODES = _CELL_BASE**CELL_PIVOTS


def fingerprint(text: bytes) -> int:
    """SimHash of one text in UTF-8."""
    parts = text.lower().split()  # bytes: A-Z alone change, and ASCII space alone parts
    if not parts:
        return 0
    joined = b" ".join(parts)
    count = max(len(parts) - SHINGLE + 1, 1)
    if count == 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1]
    ones = np.zeros(64, np.int64)
    for first in range(0, count, AT_ONCE):
        last = min(first + AT_ONCE, count)
        cut = zip(begins[first:last].tolist(), ends[first + SHINGLE - 1 : last + SHINGLE - 1].tolist(), strict=True)
        hashed = np.fromiter(
            (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cut), np.uint64, last - first
        )
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (the 64 bits as a bigint); a row for each row."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in words.slices(batches, "text"):
            data = raw.tobytes()
            found = [fingerprint(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], names=["doc_id", "fingerprint"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(hashed, f"doc_id {kind}, fingerprint bigint")


def meetings(nodes: DataFrame) -> DataFrame:
    """choice, shared, fingerprint: each node under each choice of six of its bytes."""
    held = []
    for n, apart in enumerate(combinations(range(BYTES), NEAR)):
        free = sum(0xFF << (8 * byte) for byte in apart)
        mask = ~free if free < 1 << 63 else (1 << 64) - 1 - free
        held.append(
            F.struct(
                F.lit(n).alias("choice"),
                F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("shared"),
                F.col("fingerprint"),
            )
        )
    return nodes.select(F.inline(F.array(*held)))


def _distances(values: np.ndarray, pivots: np.ndarray = _pivots) -> np.ndarray:
    """The pivot table: a row of distances for each fingerprint."""
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int8)


class _Groups:
    """Which nodes reach each other; every node knows the smallest place it reaches."""

    def __init__(self, count: int) -> None:
        self.least = np.arange(count)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low = np.minimum(self.least[a], self.least[b])
            odd = (self.least[a] != low) | (self.least[b] != low)
            if not odd.any():
                return
            a, b, low = a[odd], b[odd], low[odd]
            for side in (self.least[a], self.least[b]):
                np.minimum.at(self.least, side, low)
            while (self.least[self.least] != self.least).any():
                self.least = self.least[self.least]


def _verified(values: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs the pivots let through that differ in at most two bits."""
    for pivot in range(table.shape[1]):
        close = np.abs(table[a, pivot] - table[b, pivot]) <= NEAR
        a, b = a[close], b[close]
    near = np.bitwise_count(values[a] ^ values[b]) <= NEAR
    return a[near], b[near]


def _few(values: np.ndarray, meeting: np.ndarray, groups: _Groups, at: np.ndarray) -> None:
    """Join the links within small meetings; ``at`` are the places of their nodes, in order."""
    table = _distances(values[at])
    for step in range(1, CROWD):
        together = np.flatnonzero(meeting[at[step:]] == meeting[at[:-step]])
        if not len(together):
            return
        a, b = _verified(values[at], table, together, together + step)
        groups.join(at[a], at[b])


def _many(values: np.ndarray, groups: _Groups, first: int, last: int) -> None:
    """Join the links within one large meeting, cell by cell."""
    own = values[first:last]
    table = _distances(own)
    codes = np.zeros(len(own), np.int64)
    for pivot in range(CELL_PIVOTS):
        codes = codes * _CELL_BASE + table[:, pivot] + 2
    order = np.argsort(codes, kind="stable")
    cells, heads = np.unique(codes[order], return_index=True)
    sizes = np.diff(np.r_[heads, len(order)])
    for offset in _OFFSETS:
        move = 0
        for step in offset:
            move = move * _CELL_BASE + step
        spot = np.minimum(np.searchsorted(cells, cells + move), len(cells) - 1)
        here = np.flatnonzero(cells[spot] == cells + move)
        there = spot[here]
        pairs = sizes[here] * sizes[there]
        cuts = np.searchsorted(np.cumsum(pairs), np.arange(0, pairs.sum(), PAIRS_AT_ONCE)[1:])
        for some, others in zip(np.split(here, cuts), np.split(there, cuts), strict=True):
            count = sizes[some] * sizes[others]
            cell = np.repeat(np.arange(len(some)), count)
            rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            a = order[heads[some][cell] + rank // sizes[others][cell]]
            b = order[heads[others][cell] + rank % sizes[others][cell]]
            apart = a < b if move == 0 else np.ones(len(a), bool)
            a, b = _verified(own, table, a[apart], b[apart])
            groups.join(a + first, b + first)


def links_within(choice: np.ndarray, shared: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of whole meetings in order: each node that reaches a smaller place of its meeting, and
    the node there."""
    heads = np.flatnonzero(np.r_[True, (choice[1:] != choice[:-1]) | (shared[1:] != shared[:-1])])
    sizes = np.diff(np.r_[heads, len(values)])
    meeting = np.repeat(np.arange(len(heads)), sizes)
    groups = _Groups(len(values))
    small = np.flatnonzero(((sizes > 1) & (sizes <= CROWD))[meeting])
    if len(small):
        _few(values, meeting, groups, small)
    for large in np.flatnonzero(sizes > CROWD):
        _many(values, groups, int(heads[large]), int(heads[large] + sizes[large]))
    moved = np.flatnonzero(groups.least != np.arange(len(values)))
    return values[moved], values[groups.least[moved]]


def links(nodes: DataFrame) -> DataFrame:
    """a, b: links between fingerprints (one column, distinct) that join the components."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def linked(parts: list[np.ndarray]) -> pa.RecordBatch:
            a, b = links_within(parts[0], parts[1], parts[2].view(np.uint64))
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(pair) for pair in zip(held, new, strict=True)] if held else new
            if not len(held[0]):
                continue
            open_from = int(np.argmax((held[0] == held[0][-1]) & (held[1] == held[1][-1])))
            if open_from:  # the last meeting may go on in the next batch
                yield linked([part[:open_from] for part in held])
                held = [part[open_from:] for part in held]
        if held and len(held[0]):
            yield linked(held)

    dealt = meetings(nodes).repartition("choice", "shared").sortWithinPartitions("choice", "shared", "fingerprint")
    return dealt.mapInArrow(found, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id; a row for each row."""
    rows = kept(fingerprints(docs, text, doc_id), "fingerprints")
    nodes = kept(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(kept(links(nodes.select("fingerprint")), "links"))
    named = kept(
        nodes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
        ),
        "named",
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    places = kept(named.join(least, "component").select("fingerprint", "component_id"), "places")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(places, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
