"""Substring dedup: words in passages that occur earlier, found by difference cover.

A window is 20 consecutive words.  The residues {0, 1, 3, 9} modulo 13 are a
difference cover: for any two places there is a shift under 13 that puts both on
the cover.  So two equal windows share an anchor, 8 words hashed at cover places
only, whatever their places; a window none of whose anchors recurs cannot recur.

1. Anchors are hashed and dealt out by hash; anchors that recur are marked.
2. Anchors extend: only windows around marked ones are hashed whole and dealt out
   by hash; all but the earliest of equal windows are marked.
3. Words under marked windows go.

Hashes travel as packed arrays, and what recurs within one slice of a table is
known there already: such rows are spread evenly, so a passage in a third of all
documents gives each hash one entry a slice.  Documents with the words of a smaller
doc_id are settled without step 2.  Only documents with marks are joined with
their text, after a Bloom filter of fixed size.

Equality of windows is that of a 64-bit hash and of the shard drawn from another.

Defined cases: null text has no words; a document with fewer words than a window
loses none; a null doc_id has no place in the order, so its row is neither judged
nor counted; of unequal rows with one doc_id, the one with the smallest
digest of words stands for it and the others pass unjudged; equal rows are judged
alike.  Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import bloom, words
from parcelflow.llm.kept import kept, shuffle_partitions

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
SLICE_BYTES = 4 << 20
_SHARD_BASE = 0xA0761D6478BD642F

_PACKED = "shard int, known boolean, hashes binary, docs binary, places binary"
_PACKED_NAMES = ["shard", "known", "hashes", "docs", "places"]


def _packed(
    shard: np.ndarray, known: bool, hashes: np.ndarray, docs: np.ndarray, places: np.ndarray
) -> pa.RecordBatch:
    """One row for each shard."""
    order = np.argsort(shard, kind="stable")
    shard, docs, places = shard[order], docs[order], places[order].astype(np.int32)
    hashes = hashes[order] if not known else hashes
    heads = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, int)
    cuts = list(zip(heads, np.r_[heads[1:], len(shard)], strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard[heads].astype(np.int32)),
            pa.array([known] * len(heads), pa.bool_()),
            pa.array([b"" if known else hashes[a:b].tobytes() for a, b in cuts], pa.binary()),
            pa.array([docs[a:b].tobytes() for a, b in cuts], pa.binary()),
            pa.array([places[a:b].tobytes() for a, b in cuts], pa.binary()),
        ],
        names=_PACKED_NAMES,
    )


def _deal(
    hashes: np.ndarray, shard: np.ndarray, docs: np.ndarray, places: np.ndarray, shards: int,
    first_too: bool,
) -> Iterator[pa.RecordBatch]:
    """Of equal hashes the first (smallest doc, place) asks the other slices; the rest
    are known to recur, and so is the first if ``first_too``."""
    order = np.lexsort((places, docs, hashes))
    hashes, shard, docs, places = hashes[order], shard[order], docs[order], places[order]
    head = np.r_[True, (hashes[1:] != hashes[:-1]) | (shard[1:] != shard[:-1])][: len(hashes)]
    # The same place met twice (a repeated row) is one place.
    again = np.r_[False, (docs[1:] == docs[:-1]) & (places[1:] == places[:-1])][: len(hashes)]
    again &= ~head
    late = ~head & ~again
    sure = late
    if first_too and len(hashes):
        run = np.cumsum(head) - 1
        sure = late | (head & (np.bincount(run, weights=late)[run] > 0))
    yield _packed(shard[head], False, hashes[head], docs[head], places[head])
    if sure.any():
        spread = words.mix(docs[sure].astype(np.uint64) * np.uint64(31) + places[sure].astype(np.uint64))
        at = (spread % np.uint64(shards)).astype(np.int64)
        yield _packed(at, True, hashes[sure], docs[sure], places[sure])


def _marked(packed: DataFrame, shards: int, first_too: bool, label: str) -> DataFrame:
    """(doc_id, places) of what recurs; the first of each hash only if ``first_too``.
    Marks are dealt out again by document, packed as the hashes were."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[tuple[np.ndarray, ...]]] = {}
        docs, places = [], []
        for batch in batches:
            for shard, known, h, d, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                d, p = np.frombuffer(d, np.int64), np.frombuffer(p, np.int32)
                if known:
                    docs.append(d)
                    places.append(p)
                else:
                    asked.setdefault(shard, []).append((np.frombuffer(h, np.uint64), d, p))
        for parts in asked.values():
            h, d, p = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((p, d, h))
            h, d, p = h[order], d[order], p[order]
            head = np.r_[True, h[1:] != h[:-1]]
            run = np.cumsum(head) - 1
            origin = np.flatnonzero(head)[run]
            late = (d != d[origin]) | (p != p[origin])
            if first_too:
                late = np.bincount(run, weights=late)[run] > 0
            docs.append(d[late])
            places.append(p[late])
        if docs and sum(map(len, docs)):
            found = np.concatenate(docs)
            home = (words.mix(found.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
            yield _packed(home, True, found[:0].astype(np.uint64), found, np.concatenate(places))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, places = [], []
        for batch in batches:
            docs += [np.frombuffer(x, np.int64) for x in batch.column(3).to_pylist()]
            places += [np.frombuffer(x, np.int32) for x in batch.column(4).to_pylist()]
        if docs:
            keys, lists = words.lists_by(np.concatenate(docs), np.concatenate(places))
            yield pa.RecordBatch.from_arrays([pa.array(keys), lists], names=["doc_id", "places"])

    settled = packed.repartitionById(shards, F.col("shard")).mapInArrow(settle, _PACKED)
    gathered = settled.repartitionById(shards, F.col("shard")).mapInArrow(
        gather, "doc_id bigint, places array<int>"
    )
    return kept(gathered, label)


def _anchors(docs: DataFrame, shards: int) -> DataFrame:
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def hash_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text", SLICE_BYTES):
            starts, ends, row = words.spans(raw, off)
            if len(row) < ANCHOR:
                continue
            place = words.places(row)
            total = np.bincount(row, minlength=rows.num_rows)
            anchors = words.window_hashes(words.word_hashes(raw, starts, ends), ANCHOR)
            row, place = row[: len(anchors)], place[: len(anchors)]
            take = cover[place % PERIOD] & (place + ANCHOR <= total[row]) & (total[row] >= WINDOW)
            h = anchors[take]
            ids = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            shard = ((h >> np.uint64(17)) % np.uint64(shards)).astype(np.int64)
            if len(h):
                yield from _deal(h, shard, ids[row[take]], place[take], shards, first_too=True)

    return docs.mapInArrow(hash_anchors, _PACKED)


def _digest(raw: bytes) -> tuple[int, bytes]:
    parts = raw.split()
    return len(parts), hashlib.sha256(b" ".join(parts)).digest()


def _whole(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, digest): the words of each row, counted and digested."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text", SLICE_BYTES):
            data = raw.tobytes()
            found = [_digest(data[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([d for _, d in found], pa.binary()),
                ],
                names=["doc_id", "n_words", "digest"],
            )

    return kept(docs.mapInArrow(measure, "doc_id bigint, n_words bigint, digest binary"), "words")


def _windows(suspects: DataFrame, shards: int) -> DataFrame:
    """Whole windows around marked anchors of (doc_id, text, digest, places)."""
    back = np.arange(PERIOD)

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text", SLICE_BYTES):
            starts, ends, row = words.spans(raw, off)
            data = raw.tobytes()
            stands = [
                _digest(data[a:b])[1] == d
                for a, b, d in zip(off[:-1], off[1:], rows.column(2).to_pylist(), strict=True)
            ]
            total = np.bincount(row, minlength=rows.num_rows)
            base = np.cumsum(total) - total
            marks = rows.column(3)
            mark_row = np.repeat(np.arange(rows.num_rows), np.diff(np.asarray(marks.offsets)))
            at = marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            mark_row, at = mark_row[np.array(stands, bool)[mark_row]], at[np.array(stands, bool)[mark_row]]
            at = (at[:, None] - back).ravel()
            mark_row = np.repeat(mark_row, PERIOD)
            good = (at >= 0) & (at + WINDOW <= total[mark_row])
            begin = np.unique(base[mark_row[good]] + at[good])
            if not len(begin):
                continue
            x = words.word_hashes(raw, starts, ends)
            h = words.window_hashes(x, WINDOW)[begin]
            other = words.window_hashes(words.mix(x), WINDOW, _SHARD_BASE)[begin]
            shard = (other % np.uint64(shards)).astype(np.int64)
            ids = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield from _deal(
                h, shard, ids[row[begin]], begin - base[row[begin]], shards, first_too=False
            )

    return suspects.mapInArrow(hash_windows, _PACKED)


def _cut(found: DataFrame) -> DataFrame:
    """(doc_id, digest, n_removed, text left) of (doc_id, text, digest, places)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, removed, left = [], [], [], []
            for doc, text, digest, places in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                parts = (text or "").encode().split()
                if hashlib.sha256(b" ".join(parts)).digest() != digest:
                    continue
                change = np.zeros(len(parts) + 1, np.int64)
                begin = np.unique(np.array(places, np.int64))
                np.add.at(change, begin, 1)
                np.add.at(change, begin + WINDOW, -1)
                gone = np.cumsum(change)[:-1] > 0
                ids.append(doc)
                digests.append(digest)
                removed.append(int(gone.sum()))
                left.append(b" ".join([w for w, g in zip(parts, gone, strict=True) if not g]).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(removed, pa.int64()),
                    pa.array(left, pa.string()),
                ],
                names=["doc_id", "digest", "n_removed", "text"],
            )

    return found.mapInArrow(cut, "doc_id bigint, digest binary, n_removed bigint, text string")


def dedup_substrings(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    filter_bits: int = bloom.FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Two tables.  A row for each row: doc_id, digest (SHA-256 of its words), n_words,
    n_removed, whole (nothing or everything removed: then no text is given).  And
    for the documents that lose a part: doc_id, digest, n_removed, text (what is left)."""
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    named = chosen.filter(F.col("doc_id").isNotNull())
    shards = shuffle_partitions(docs)
    rows = _whole(chosen)
    standing = rows.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    first = standing.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    origins = kept(first.select(F.col("first").alias("doc_id"), "digest"), "origins")
    marked = _marked(_anchors(named, shards), shards, True, "anchors")
    marked = kept(marked.join(origins, "doc_id").select("doc_id", "digest", "places"), "suspects")
    late = _marked(_windows(_with_text(named, marked, filter_bits), shards), shards, False, "windows")
    late = kept(late.join(origins, "doc_id").select("doc_id", "digest", "places"), "late-windows")
    parts = _cut(_with_text(named, late, filter_bits)).dropDuplicates(["doc_id", "digest"])
    return rows.join(first, "digest", "left").join(
        standing.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__stands")),
        F.col("doc_id") == F.col("__id"), "left",
    ).select(
        "doc_id", "digest", "n_words",
        F.when(
            (F.col("__stands") == F.col("digest"))
            & (F.col("doc_id") > F.col("first"))
            & (F.col("n_words") >= WINDOW),
            F.col("n_words"),
        ).otherwise(F.lit(0).cast("bigint")).alias("n_removed"),
    ), parts


def _with_text(docs: DataFrame, marked: DataFrame, filter_bits: int) -> DataFrame:
    """(doc_id, text, digest, places): the marked documents with their text."""
    likely = bloom.likely_among(docs, "doc_id", marked.select("doc_id"), filter_bits)
    return likely.join(marked, "doc_id").select("doc_id", "text", "digest", "places")


def removal_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: a row for each row."""
    rows, parts = dedup_substrings(docs, text, doc_id)
    cut = parts.select(
        F.col("doc_id").alias("__id"),
        F.col("digest").alias("__digest"),
        F.col("n_removed").alias("__removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("__sha"),
    )
    same = (F.col("doc_id") == F.col("__id")) & (F.col("digest") == F.col("__digest"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return rows.join(cut, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("__removed", "n_removed").alias("n_removed"),
        F.coalesce(
            "__sha", F.when(F.col("n_removed") > 0, nothing).otherwise(F.lower(F.hex("digest")))
        ).alias("kept_sha256"),
    )


ORACLE = r"""
WITH word AS (
  SELECT doc_id, unnest(parts) AS word, generate_subscripts(parts, 1) AS place
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS parts
        FROM documents)
), win AS (
  SELECT doc_id, place, string_agg(word, ' ') OVER w AS words, count(*) OVER w AS n
  FROM word
  WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), late AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY words ORDER BY doc_id, place) > 1 AS late
  FROM win WHERE n = 20
), judged AS (
  SELECT word.doc_id, word.place, word, coalesce(max(late::INT) OVER (
           PARTITION BY word.doc_id ORDER BY word.place
           ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM word LEFT JOIN late USING (doc_id, place)
), summed AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
         string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS left_over
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(left_over, '')) AS kept_sha256
FROM documents LEFT JOIN summed USING (doc_id)
"""
