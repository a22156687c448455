"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over a span of words that ignores some places, so a hash
under it agrees in spite of words substituted there.  Hashes of all spans of the benchmark
items and of all documents are joined: a Bloom filter of fixed size, built from the
benchmark's, lets through the documents' hashes worth joining.  A hit fixes the offset
of an item in a document; words are then compared along that diagonal, and the best
run (matches against substitutions) is the overlap.

An overlap counts if it has ``MIN_MATCHES`` matching words, or four fifths of a
shorter item, and at least four fifths of its words match.  Words are those between
white space, A-Z lower-cased.

The masks miss no overlap that counts.  A best run starts with more than ``MISMATCH``
matches, and so many that its score stays above 0.  Seven or more, or four or more and
then three or more behind one substitution, agree under the first mask; five or six, a
substitution and a match, under the second; there is no other start, as five matches must
be followed by two, and four by three.  Items of up to ``UNBROKEN`` words count
only as one run of matches, so that run is their mask.

Defined cases: null or empty text overlaps nothing, an item without words neither;
items with equal words are searched once and all
reported; rows that repeat a doc_id are one document; rows without a doc_id, and
items without an item_id, are not judged; an empty table on either side gives an
empty result.  Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import bloom, words
from parcelflow.llm.kept import kept

#: Places looked at (1) and ignored (0).
SEEDS = ("1110111", "1111101")
#: Items up to this many words count only as one run of matches.
UNBROKEN = 7
MIN_MATCHES = 12
FILTER_BITS = 1 << 24
MISMATCH = 3


def needed(item_words: int) -> int:
    """Matches an overlap with an item of so many words must have."""
    return min(MIN_MATCHES, -(-4 * item_words // 5))


def seeds_for(item_words: int) -> tuple[str, ...]:
    """The masks an item of so many words is searched with."""
    if item_words > UNBROKEN:
        return SEEDS
    return ("1" * needed(item_words),)


#: All masks; a hash's ``seed`` is a place in this list.
MASKS = tuple(dict.fromkeys(m for n in range(1, UNBROKEN + 2) for m in seeds_for(n)))


def seed_hashes(x: np.ndarray, seed: str) -> np.ndarray:
    """Hash under the seed from each word on, row ends ignored."""
    count = max(len(x) - len(seed) + 1, 0)
    total = np.full(count, int(seed, 2), np.uint64)  # no two masks are the same number
    for i, look in enumerate(seed):
        if look == "1":
            total = words.mix(total + x[i : i + count])
    return total


def _hashed(frame: DataFrame, shared=None, seeds: list[int] | None = None) -> DataFrame:
    """(id, hash, place, seed, n_words) for every span; with a filter, of documents: under
    all ``seeds``, only hashes the filter may hold.  Without, of items: under the masks
    for their length."""

    def hash_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text"):
            starts, ends, row = words.spans(words.lower(raw), off)
            x = words.word_hashes(words.lower(raw), starts, ends)
            place = words.places(row)
            length = np.bincount(row, minlength=len(off) - 1)[row]
            own = [seeds_for(n) for n in range(UNBROKEN + 2)]
            for seed, mask in enumerate(MASKS):
                if len(x) < len(mask) or (seeds is not None and seed not in seeds):
                    continue
                take = row[: len(x) - len(mask) + 1] == row[len(mask) - 1 :]
                h = seed_hashes(x, mask)
                if shared is not None:
                    take &= bloom.holds(shared.value, h)
                else:
                    searched = np.array([mask in masks for masks in own])
                    take &= searched[np.minimum(length[: len(h)], UNBROKEN + 1)]
                at = np.flatnonzero(take)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(row[at])),
                        pa.array(h[at].view(np.int64)),
                        pa.array(place[at]),
                        pa.array(np.full(len(at), seed, np.int32)),
                        pa.array(length[at]),
                    ],
                    names=["id", "hash", "place", "seed", "n_words"],
                )

    return frame.mapInArrow(
        hash_spans, "id bigint, hash bigint, place bigint, seed int, n_words bigint"
    )


def best_run(same: np.ndarray) -> tuple[int, int]:
    """Start and end of the run with the most matches less ``MISMATCH`` for each
    substitution; the first of equals, the shortest of those."""
    score = np.where(same, 1, -MISMATCH)
    total = np.r_[0, np.cumsum(score)]
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total[1:] - low[:-1])) + 1
    return int(np.flatnonzero(total[:end] == low[end - 1])[-1]), end


def overlap_run(same: np.ndarray, item_words: int) -> tuple[int, int, int] | None:
    """Start, end and matches of the best run, if it counts as an overlap."""
    a, b = best_run(same)
    matches = int(same[a:b].sum())
    if matches >= needed(item_words) and 5 * matches >= 4 * (b - a):
        return a, b, matches
    return None


def _verify(found: DataFrame) -> DataFrame:
    """Overlaps among (doc_id, item_id, offset, text, item)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            cut: dict[str, np.ndarray] = {}
            last_text, doc_words = None, None
            for doc, item_id, offset, text, item in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if text is not last_text and text != last_text:
                    last_text = text
                    doc_words = _split(text)
                if item not in cut:
                    cut[item] = _split(item)
                want = cut[item]
                first, last = max(0, -offset), min(len(want), len(doc_words) - offset)
                if last <= first:
                    continue
                same = want[first:last] == doc_words[first + offset : last + offset]
                run = overlap_run(same, len(want))
                if run is not None:
                    a, b, matches = run
                    out.append((doc, item_id, first + offset + a, first + a, b - a, matches, len(want)))
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_matches", "item_words"],
            )

    return found.mapInArrow(
        compare,
        "doc_id bigint, item_id bigint, doc_start bigint, item_start bigint, n_words bigint, "
        "n_matches bigint, item_words bigint",
    )


def _split(text: str | None) -> np.ndarray:
    return np.array((text or "").encode().translate(words.LOWER_TABLE).split() or [b""], object)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row for each document and item that overlap: the longest overlap, with its
    place in either, its words, its matches and the item's words."""
    named = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    named = named.filter("id IS NOT NULL")
    items = benchmark.select(
        F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("item")
    ).filter("item_id IS NOT NULL AND item IS NOT NULL")
    single = kept(items.groupBy("item").agg(F.min("item_id").alias("id")), "items")
    seeds = kept(_hashed(single.select("id", F.col("item").alias("text"))), "item-seeds")
    few = max(docs.sparkSession.sparkContext.defaultParallelism, 1)
    once, _ = bloom.build(seeds.select(F.array("hash").alias("hashes")).coalesce(few), filter_bits)
    occurring = [r["seed"] for r in seeds.select("seed").distinct().collect()]
    # A hit of an item that must match whole is an overlap; the first is the best.
    whole = [n for n in range(1, UNBROKEN + 1) if needed(n) == n]
    offset = F.col("place") - F.col("__place")
    hits = (
        _hashed(named, bloom.share(docs, once), occurring)
        .select("id", "hash", "place")
        .join(
            seeds.select("hash", F.col("id").alias("item_id"), F.col("place").alias("__place"), "n_words"),
            "hash",
        )
        .select("id", "item_id", offset.alias("offset"), F.col("n_words").isin(whole).alias("whole"))
        .groupBy("id", "item_id", F.when(~F.col("whole"), F.col("offset")).alias("__each"))
        .agg(F.min("offset").alias("offset"))
        .drop("__each")
    )
    hits = kept(hits.withColumnRenamed("id", "__id"), "seed-hits")
    likely = bloom.likely_among(named, "id", hits.select("__id").distinct(), filter_bits)
    found = (
        likely.join(hits, F.col("id") == F.col("__id"))
        .join(single.select(F.col("id").alias("item_id"), "item"), "item_id")
        .select(F.col("id").alias("doc_id"), "item_id", "offset", "text", "item")
    )
    order = F.struct("n_matches", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"),
                     (-F.col("n_words")).alias("n"), "item_words")
    best = (
        _verify(found)
        .groupBy("doc_id", F.col("item_id").alias("__first"))
        .agg(F.max(order).alias("best"))
    )
    # Items with equal words are named by the first of them until here.
    members = items.join(single, "item").select(F.col("id").alias("__first"), "item_id").distinct()
    return best.join(members, "__first").select(
        "doc_id",
        "item_id",
        (-F.col("best.d")).alias("doc_start"),
        (-F.col("best.i")).alias("item_start"),
        (-F.col("best.n")).alias("n_words"),
        F.col("best.n_matches").alias("n_matches"),
        F.col("best.item_words").alias("item_words"),
    )
