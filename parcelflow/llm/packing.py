"""Packing documents into sequences, shortest pack first over the length histogram.

Documents are tokenized and cut into pieces of at most a sequence's length.  The
pieces' lengths form a histogram of at most that many entries, which is all the
driver sees: lengths are placed longest first, each into the pattern with the
most room, and a pattern is counted, not repeated.  Patterns are then joined back to the
pieces by their rank among the pieces of their length.

Defined cases: null or empty text is the closing token alone; each row is a
document of its own, with or without an id, also where ids repeat; an empty table
gives no pieces.  Only the columns named are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.kept import kept
from parcelflow.llm.tokens import encoder
from parcelflow.llm.words import slices

SEQUENCE_TOKENS = 4096

_CUT = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint, ids binary"
_CUT_NAMES = [field.split()[0] for field in _CUT.split(", ")]


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    limit: int = SEQUENCE_TOKENS,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces with the checksum of their ids (little-endian unsigned 32-bit) and, if
    asked for, the ids; and each piece's ``place`` among those of its length in its
    partition, ``part``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for rows, _, _ in slices(batches, "text"):
            flat, counts = ids_of.encode(rows.column(1))
            tokens = counts + 1
            ends = np.cumsum(tokens)
            whole = np.full(int(ends[-1]), end_id, np.uint32)
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = flat
            number = -(-tokens // limit)
            row = np.repeat(np.arange(len(tokens)), number)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * limit
            length = np.minimum(tokens[row] - start, limit)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            heads = np.searchsorted(ordered, ordered, "left")
            place = np.empty(len(row), np.int64)
            place[order] = seen[ordered] + np.arange(len(row)) - heads
            seen += np.bincount(length, minlength=limit + 1)
            data = whole.astype("<u4").tobytes()
            at = (ends - tokens)[row] + start
            ids = [data[4 * a : 4 * (a + n)] for a, n in zip(at, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(tokens[row]),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(ids if with_ids else [None] * len(ids), pa.binary()),
                    pa.array(np.full(len(row), part, np.int32)),
                    pa.array(place),
                ],
                names=[*_CUT_NAMES, "part", "place"],
            )

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, f"{_CUT}, part int, place bigint")


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used.

    Longest lengths come first; each goes to the packs with the most room, if it
    fits there.  A pattern of which only part is extended is split in two.
    """
    # By room left, ascending; each entry: patterns with that room and their counts.
    rooms: list[int] = []
    packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], count: int, room: int) -> None:
        if room not in packs:
            packs[room] = []
            bisect.insort(rooms, room)
        packs[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        added: list[tuple[tuple[int, ...], int, int]] = []
        while left:
            room = rooms[-1] if rooms else 0
            if room < length:
                # New packs are filled evenly, before they are offered again.
                each = limit // length
                if left >= each:
                    added.append(((length,) * each, left // each, limit - each * length))
                    left %= each
                else:
                    added.append(((length,) * left, 1, limit - left * length))
                    left = 0
                continue
            pattern, count = packs[room].pop()
            if not packs[room]:
                del packs[room]
                rooms.pop()
            used = min(count, left)
            if used < count:
                put(pattern, count - used, room)
            put((*pattern, length), used, room - length)
            left -= used
        for pattern, count, room in added:
            put(pattern, count, room)
    return [entry for room in rooms for entry in packs[room]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Runs of equal slots: pieces of ``length`` with ranks from ``rank`` on lie at
    ``offset`` of the sequences from ``sequence`` on.  Sorted by length and rank."""
    used: dict[int, int] = {}
    runs: list[tuple[int, int, int, int]] = []
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            runs.append((length, rank, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    limit: int = SEQUENCE_TOKENS,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: doc_id, start, length, doc_tokens, ids_crc32, ids (null
    unless asked for), sequence_id, offset.

    The histogram and the patterns, both bounded by ``limit``, are what the driver
    holds; the pieces are written once, so that ranks stay as they were counted.
    """
    pieces = kept(cut_pieces(docs, tokenizer_path, end_id, limit, text, doc_id, with_ids), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("pieces"))
    by_part = kept(by_part, "piece-counts")
    histogram = {
        r["length"]: r["pieces"]
        for r in by_part.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    }
    runs = slots(shortest_pack_first(histogram, limit))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(runs)
    # First rank of each (length, partition): a running sum within a length, whose
    # rows are partitions, not pieces.
    before = Window.partitionBy("length").orderBy("part")
    first = by_part.select(
        F.col("length").alias("__length"),
        F.col("part").alias("__part"),
        (F.sum("pieces").over(before) - F.col("pieces")).alias("__first"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        width = np.int64(1) << 40
        keys = table["length"] * width + table["rank"]
        for batch in batches:
            length, rank = (
                batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                for n in ("length", "rank")
            )
            at = np.searchsorted(keys, length * width + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(_CUT_NAMES)],
                    pa.array(table["sequence"][at] + rank - table["rank"][at]),
                    pa.array(table["offset"][at]),
                ],
                names=[*_CUT_NAMES, "sequence_id", "offset"],
            )

    # Never broadcast: it has a row for each length and partition.
    ranked = pieces.join(
        first.hint("merge"), (F.col("length") == F.col("__length")) & (F.col("part") == F.col("__part"))
    ).select(*_CUT_NAMES, (F.col("place") + F.col("__first")).alias("rank"))
    return ranked.mapInArrow(place, f"{_CUT}, sequence_id bigint, offset bigint")
