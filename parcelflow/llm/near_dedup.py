"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct 5-word shingles, A-Z lower-cased; a shorter
document's whole sequence is one shingle.  Documents with equal words are one node.
For each node 256 minima are taken; 42 bands of 6 full minima make candidates, and of every
minimum the low two bits are retained, packed into two planes of 256 bits.  A
candidate's similarity is estimated from the bits that agree, corrected for
agreement by chance; those far below the threshold go, the others are confirmed on full
sets.

Within a bucket, nodes are first compared with its smallest member only.  Once
confirmed links are joined into components, buckets whose members lie in more than
one component are compared across components, block against block; likely partners
stay in lists, one a node, and are confirmed on sets that each task holds once.  Links
are lost only where no band agrees (below 3e-9 at similarity 0.85, 3e-6 at 0.8) or an
estimate is 6 standard deviations off.

Defined cases: null or empty text has an empty set, linked with nothing; rows that
share a doc_id are one document, linked through any of their texts; a row without a
doc_id is linked with nothing, has no component and is kept; an empty table gives
an empty result.  Only the columns named are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import bloom, words
from parcelflow.llm.components import components
from parcelflow.llm.kept import kept, shuffle_partitions

SHINGLE = 5
MINIMA = 256
BANDS = 42
ROWS = 6
LOW_BITS = 2
BLOCK = 1024
#: Nodes that look for links side by side.
CELL = 256

_rng = np.random.default_rng(20240307)
_FACTORS = (_rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_BAND_BASE = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of lower-cased bytes."""
    starts, ends, row = words.spans(raw, off)
    x = words.word_hashes(raw, starts, ends)
    all_windows = words.window_hashes(x, SHINGLE)
    total = np.bincount(row, minlength=len(off) - 1)
    base = np.cumsum(total) - total
    sets = []
    for first, count in zip(base, total, strict=True):
        if count >= SHINGLE:
            sets.append(np.unique(all_windows[first : first + count - SHINGLE + 1]))
        elif count:
            sets.append(words.window_hashes(x[first : first + count], int(count)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each permutation."""
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    small = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(small), 2048):
        values = _FACTORS[:, None] * small[None, i : i + 2048] + _SHIFTS[:, None]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_hashes(least: np.ndarray) -> np.ndarray:
    """A hash for each band, different in each; ``least`` has a row for each set."""
    parts = least[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    total = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(least), 1), np.uint64)
    for i in range(ROWS):
        total = words.mix(total * _BAND_BASE + parts[:, :, i])
    return total


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima: four words of the lower bits, four of the upper."""
    planes = [
        np.packbits(((least >> np.uint32(k)) & np.uint32(1)).astype(np.uint8), axis=1).view(np.uint64)
        for k in range(LOW_BITS)
    ]
    return np.concatenate(planes, axis=1)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (null for empty sets), bands and bits of each row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text"):
            raw = words.lower(raw)
            data = raw.tobytes()
            sets = shingle_sets(raw, off)
            least = np.stack([minima(s) for s in sets])
            digests = [
                hashlib.sha256(b" ".join(data[a:b].split())).digest() if len(s) else None
                for a, b, s in zip(off[:-1], off[1:], sets, strict=True)
            ]
            bands, bits = band_hashes(least).view(np.int64), packed_bits(least).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(bands),
                    _lists(bits),
                ],
                names=["doc_id", "n_shingles", "digest", "bands", "bits"],
            )

    return docs.mapInArrow(
        sign,
        "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, bits array<bigint>",
    )


def _lists(table: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))


def estimate(bits_a: str, bits_b: str):
    """Similarity from the minima whose low bits agree, corrected for chance."""
    half = MINIMA // 64
    agree = sum(
        F.bit_count(
            F.bitwise_not(
                F.get(bits_a, F.lit(i)).bitwiseXOR(F.get(bits_b, F.lit(i))).bitwiseOR(
                    F.get(bits_a, F.lit(half + i)).bitwiseXOR(F.get(bits_b, F.lit(half + i)))
                )
            )
        )
        for i in range(half)
    )
    chance = 1.0 / (1 << LOW_BITS)
    return (agree / F.lit(float(MINIMA)) - chance) / (1.0 - chance)


def least_estimate(percent: int) -> float:
    """Estimates below this, 6 standard deviations (a hundredth rounded up) under the
    threshold, are not confirmed."""
    chance = 1.0 / (1 << LOW_BITS)
    agree = chance + (1.0 - chance) * percent / 100.0
    deviation = math.sqrt(agree * (1.0 - agree) / MINIMA) / (1.0 - chance)
    return percent / 100.0 - math.ceil(600 * deviation) / 100.0


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int, filter_bits: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""
    ids = pairs.select("a").union(pairs.select("b")).distinct()
    texts = kept(
        bloom.likely_among(docs, "doc_id", ids, filter_bits)
        .join(ids.withColumnRenamed("a", "__id"), F.col("doc_id") == F.col("__id"), "left_semi")
        .select("doc_id", "text"),
        "candidate-texts",
    )
    joined = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text_a"):
            left = shingle_sets(words.lower(raw), off)
            other, other_off = words.text_bytes(rows.column(3))
            right = shingle_sets(words.lower(other), other_off)
            linked = []
            for s, t in zip(left, right, strict=True):
                both = len(s) + len(t) - len(np.union1d(s, t))
                linked.append(100 * both >= percent * (len(s) + len(t) - both) and both > 0)
            hit = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).filter(hit), rows.column(1).filter(hit)], names=["a", "b"]
            )

    return joined.mapInArrow(measure, "a bigint, b bigint")


def _likely(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose estimate is near the threshold or above."""
    left = bits.select(F.col("node").alias("a"), F.col("bits").alias("bits_a"))
    right = bits.select(F.col("node").alias("b"), F.col("bits").alias("bits_b"))
    return (
        pairs.distinct()
        .join(left, "a")
        .join(right, "b")
        .filter(estimate("bits_a", "bits_b") >= least_estimate(percent))
        .select("a", "b")
        .distinct()
    )


def _across(members: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, partners): for nodes of mixed buckets, the likely partners that share a bucket
    with them and lie in another component.  Members (bucket, node, component) outside a
    bucket's first component face all its members, block against block, so that no
    task holds a whole bucket; pairs stay in lists."""
    mixed = (
        members.groupBy("bucket")
        .agg(
            F.min("component").alias("main"),
            F.max("component").alias("__other"),
            F.count(F.lit(1)).alias("__n"),
        )
        .filter("main <> __other")
        .select("bucket", "main", F.ceil(F.col("__n") / BLOCK).cast("int").alias("blocks"))
    )
    rows = kept(
        members.join(mixed, "bucket")
        .join(bits, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")),
        "mixed-buckets",
    )
    odd = rows.filter("component <> main").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("block").alias("cell"),
        F.lit(True).alias("odd"),
        "node", "component", "bits",
    )
    cells = odd.select("bucket", "block", "cell").distinct()
    rest = rows.join(cells, ["bucket", "block"]).select(
        "bucket", "block", "cell", F.lit(False).alias("odd"), "node", "component", "bits"
    )
    key = ["bucket", "block", "cell"]
    faced = (
        odd.unionByName(rest)
        .repartition(shuffle_partitions(members), *key)
        .sortWithinPartitions(*key, "odd")
        .mapInArrow(_faced(least_estimate(percent)), "a bigint, partners array<bigint>")
    )
    partners = F.array_distinct(F.flatten(F.collect_list("partners")))
    return faced.groupBy("a").agg(partners.alias("partners"))


def _faced(least: float):
    """Batches sorted by (bucket, block, cell), its members before its odd nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            key = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:3]], axis=1)
            odd = batch.column(3).to_numpy(zero_copy_only=False)
            node, component = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5)
            )
            bits = batch.column(6).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            bits = bits.view(np.uint64).reshape(batch.num_rows, -1)
            if not len(key):
                continue
            heads = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            for x, y in zip(heads, np.r_[heads[1:], len(key)], strict=True):
                if last is not None and not np.array_equal(last, key[x]):
                    yield from _face(held, least)
                    held = []
                last = key[x]
                held.append((odd[x:y], node[x:y], component[x:y], bits[x:y]))
        yield from _face(held, least)

    return run


def _face(parts: list[tuple], least: float) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    odd, node, component, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
    odd = odd.astype(bool)
    all_node, all_component, all_bits = node[~odd], component[~odd], bits[~odd]
    half = bits.shape[1] // 2
    names, lists = [], []
    for a, own, mine in zip(node[odd], component[odd], bits[odd], strict=True):
        differ = all_bits ^ mine
        agree = MINIMA - np.bitwise_count(differ[:, :half] | differ[:, half:]).sum(axis=1, dtype=np.int64)
        chance = 1.0 / (1 << LOW_BITS)
        likely = (agree / MINIMA - chance) / (1 - chance) >= least
        likely &= all_component != own
        if likely.any():
            names.append(a)
            lists.append(all_node[likely])
    if names:
        offsets = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(names, np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists))),
            ],
            names=["a", "partners"],
        )


def _confirm_lists(
    faced: DataFrame, placed: DataFrame, docs: DataFrame, percent: int, filter_bits: int
) -> DataFrame:
    """Confirmed links (a, b) of (a, partners): for each a, one link into each component
    it has a link with.  Nodes that name the same smallest partner work side by side,
    ``CELL`` at a time, with one copy of each set they need."""
    home = F.array_min("partners")
    tasks = shuffle_partitions(faced)
    sized = faced.withColumn("home", home).join(
        faced.groupBy(home.alias("home")).agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells")), "home"
    )
    work = kept(
        sized.select(
            F.pmod(F.xxhash64("home", F.pmod(F.xxhash64("a"), F.col("cells"))), F.lit(tasks))
            .cast("int")
            .alias("task"),
            "a", "partners",
        ),
        "cross-partners",
    )

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted: dict[int, list[np.ndarray]] = {}
            lists = batch.column(2)
            for task, a, x, y in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                lists.offsets.to_pylist()[:-1], lists.offsets.to_pylist()[1:], strict=True,
            ):
                part = lists.values[x:y].to_numpy(zero_copy_only=False)
                wanted.setdefault(task, []).append(np.append(part, a))
            for task, parts in wanted.items():
                ids = np.unique(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), task, np.int32)), pa.array(ids)], names=["task", "id"]
                )

    wanted = work.mapInArrow(needs, "task int, id bigint").distinct()
    ids = wanted.select("id").distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in words.slices(batches, "text"):
            found = shingle_sets(words.lower(raw), off)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([x.tobytes() for x in found], pa.binary())],
                names=["id", "component", "shingles"],
            )

    component = placed.select(F.col("node").alias("id"), "component").distinct()
    made = (
        bloom.likely_among(docs, "doc_id", ids, filter_bits)
        .join(component, F.col("doc_id") == F.col("id"))
        .select("id", "component", "text")
        .mapInArrow(sets, "id bigint, component bigint, shingles binary")
    )
    none = F.lit(None)
    given = wanted.join(made, "id").select(
        "task", "id", "component", "shingles", none.cast("array<bigint>").alias("partners")
    )
    asked = work.select(
        "task", F.col("a").alias("id"), none.cast("bigint").alias("component"),
        none.cast("binary").alias("shingles"), "partners",
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[np.ndarray]]] = {}
        questions: list[tuple[int, list[int]]] = []
        for batch in batches:
            for i, component, data, partners in zip(
                *(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True
            ):
                if partners is not None:
                    questions.append((i, partners))
                else:
                    found = np.frombuffer(data, np.uint64)
                    held.setdefault(i, (component, []))[1].append(found)
        left, right = [], []
        for a, partners in questions:
            reached: set[int] = set()
            rows = [(b, held[b][0], x) for b in partners if b in held for x in held[b][1] if len(x)]
            for mine in held[a][1] if a in held else []:
                if not rows or not len(mine):
                    continue
                other = np.concatenate([x for _, _, x in rows])
                sizes = np.array([len(x) for _, _, x in rows])
                at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                both = np.add.reduceat(mine[at] == other, np.cumsum(sizes) - sizes, dtype=np.int64)
                linked = 100 * both >= percent * (sizes + len(mine) - both)
                for k in np.flatnonzero(linked):
                    if rows[k][1] not in reached:
                        reached.add(rows[k][1])
                        left.append(a)
                        right.append(rows[k][0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
        )

    return (
        given.unionByName(asked).repartitionById(tasks, F.col("task"))
        .mapInArrow(confirm, "a bigint, b bigint")
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = 85,
    filter_bits: int = bloom.FILTER_BITS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, digest; a row for each row."""
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = kept(signed(chosen), "signatures")
    known = rows.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    nodes = known.groupBy("digest").agg(F.min("doc_id").alias("node"))
    copies = known.join(nodes, "digest").filter("doc_id <> node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")
    )
    own = nodes.withColumnRenamed("digest", "__digest")
    nodes_signed = known.join(
        own, (F.col("doc_id") == F.col("node")) & (F.col("digest") == F.col("__digest"))
    )
    banded = nodes_signed.select("node", F.explode("bands").alias("bucket"))
    shared = (
        banded.groupBy("bucket")
        .agg(F.min("node").alias("leader"), F.max("node").alias("__last"))
        .filter("leader <> __last")
        .select("bucket", "leader")
    )
    members = kept(banded.join(shared, "bucket").distinct(), "buckets")
    met = members.select("node").distinct()
    bits = kept(nodes_signed.join(met, "node", "left_semi").select("node", "bits"), "bits")
    named = chosen.filter("doc_id IS NOT NULL")

    stars = members.filter("node <> leader").select(
        F.col("node").alias("a"), F.col("leader").alias("b")
    )
    likely = kept(_likely(stars, bits, percent), "star-pairs")
    links = kept(_confirm(likely, named, percent, filter_bits), "star-links")

    found = components(links)
    component = F.coalesce("component", "node").alias("component")
    placed = members.join(found, "node", "left").select("bucket", "node", component)
    faced = kept(_across(placed, bits, percent), "cross-likely")
    more = _confirm_lists(faced, placed, named, percent, filter_bits)
    final = components(copies.unionByName(links).unionByName(more))

    same = F.col("doc_id") == F.col("node")
    name = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        rows.join(final, same, "left")
        .select("doc_id", "n_shingles", name.alias("component_id"), "digest")
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


ORACLE = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM word
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
  WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT documents.doc_id, coalesce(size.n, 0) AS n_shingles, component_id,
       documents.doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)
"""
