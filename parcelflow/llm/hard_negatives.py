"""Hard negatives from labelled vectors, by blocks and zone maps.

Vectors are whole numbers; a row's score is its inner product with an anchor.  An anchor's positives
are the first few rows of its label.  A positive's negatives are the first few rows of other
labels whose score lies between four fifths of the positive's score and that score.

Candidates are put in the order of a Hilbert curve through all their dimensions and written as
blocks, one Parquet row a block, each with the least and greatest value of every dimension (its zone map).
The least and greatest score a block can hold for an anchor follow from these by interval
arithmetic.  For positives, an anchor reads the blocks that can hold its label and reach the
score it is sure of from its own block; for negatives, the blocks that can hold a score of its windows.
So blocks are left out only where nothing in them can matter, and results are exact.

Anchors go in groups of bounded size, zone maps in chunks; a group meets a chunk in one task, and a block
meets a group that reads it in one task.  Neither a label nor a direction that holds a third of
all rows makes a task larger.  How many blocks an anchor can leave out depends on the data: with
directions spread evenly over many dimensions it is few, and the work is that of all
anchors against all rows, in blocks.

Defined cases: rows without an id, label or vector, or with a component that is null or not
finite, take no part; so do vectors with a component so great that a score might not fit in a
bigint (2^62 over the dimensions, square root).  Vectors of unequal length do not meet; empty ones all score 0.  Rows that share an
id are one: the one with the least label, then vector.  Ids are whole numbers.  Ties go to the smaller id.  No anchors,
positives or negatives give no rows.  Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.kept import kept, shuffle_partitions

SCALE = 256
ANCHOR_EACH = 100
POSITIVES = 5
NEGATIVES = 5
#: Rows of a block, anchors of a group, blocks whose zone maps are a chunk.
BLOCK = 512
GROUP = 1024
CHUNK = 2048
#: Groups that one task brings to a block.
TOGETHER = 64
#: Bits of a dimension that the curve follows.
CURVE_BITS = 3
EXACT = 1 << 53


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector: components as ``floor(256 * x)``, every seventh row moved to the next label."""
    parts = F.transform("embedding", lambda x: SCALE * x.cast("double"))
    limit = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size("embedding"), F.lit(1)))
    sound = F.forall("scaled", lambda x: F.coalesce(F.abs(x) < limit, F.lit(False)))
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return (
        rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .select("vec_id", moved.alias("label"), parts.alias("scaled"), limit.alias("limit"))
        .filter(sound)
        .select("vec_id", "label", F.transform("scaled", lambda x: F.floor(x)).alias("vector"))
    )


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> list[bytes]:
    """Place on the Hilbert curve of each row of cell numbers below ``2^bits``, as bytes that
    sort as the places do."""
    x = cells.T.astype(np.uint8).copy()
    size = len(x)
    if not size:
        return [b""] * len(cells)
    mask = 1 << (bits - 1)
    while mask > 1:  # undo the turns and mirrorings, coarse to fine
        low = np.uint8(mask - 1)
        for i in range(size):
            turned = (x[i] & mask) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low).astype(np.uint8)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        mask >>= 1
    for i in range(1, size):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint8)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << bit), np.uint8((1 << bit) - 1), np.uint8(0))
    x ^= flip
    planes = np.concatenate([(x >> bit) & 1 for bit in range(bits - 1, -1, -1)])
    return [row.tobytes() for row in np.packbits(planes, axis=0).T]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(len(column), dims)


def _by_length(batch: pa.RecordBatch, at: str = "vector") -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.array(pc.list_value_length(batch.column(batch.schema.get_field_index(at))))
    for dims in np.unique(lengths):
        yield int(dims), batch.filter(pa.array(lengths == dims))


def _extent(vectors: DataFrame) -> dict[int, tuple[int, int]]:
    """Least and greatest component of the vectors of each length; a row for each length."""
    found = vectors.groupBy(F.size("vector").alias("dims")).agg(
        F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")
    )
    return {r["dims"]: (r["low"] or 0, r["high"] or 0) for r in found.collect()}


def _dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles where every sum fits in one, else as whole numbers."""
    if left.size == 0 or right.size == 0:
        return np.zeros((len(left), len(right)), np.int64)
    bound = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    if bound < EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as they need, after one byte that says how many."""
    most = int(np.abs(x).max(initial=0))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def _unpack(packed: bytes, dims: int, count: int) -> np.ndarray:
    return np.frombuffer(packed, f"<i{packed[0]}", offset=1).reshape(count, dims).astype(np.int64)


_LIST = pa.list_(pa.int64())
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("dims", pa.int32()), ("ids", _LIST), ("labels", _LIST), ("vectors", pa.binary()),
     ("lows", _LIST), ("highs", _LIST), ("first_label", pa.int64()), ("last_label", pa.int64())]
)
_GROUPS = pa.schema(
    [("group", pa.string()), ("dims", pa.int32()), ("anchors", _LIST), ("anchor_labels", _LIST),
     ("anchor_vectors", pa.binary()), ("asked", _LIST), ("low", _LIST), ("high", _LIST), ("tag", _LIST)]
)
_CHOSEN = pa.schema([("block", pa.int64()), *_GROUPS])
_HITS = pa.schema(
    [("group", pa.string()), ("anchor_id", pa.int64()), ("tag", pa.int64()), ("high", pa.int64()),
     ("other", pa.int64()), ("score", pa.int64())]
)
_KINDS = {"int64": "bigint", "int32": "int", "string": "string", "binary": "binary", "list<item: int64>": "array<bigint>"}
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{field.name}` {_KINDS[str(field.type)]}" for field in schema)


def blocks(vectors: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of candidates along the Hilbert curve, with their zone maps (lows, highs, labels)."""
    extent = _extent(vectors)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, part in _by_length(batch):
                low, high = extent[dims]
                step = (high - low) // (1 << CURVE_BITS) + 1
                keys = hilbert_keys((_matrix(part.column(2), dims) - low) // step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), dims, np.int32)), pa.array(keys, pa.binary()), *part.columns],
                    names=["dims", "place", *part.schema.names],
                )

    def block(part: pa.Table, number: int) -> pa.RecordBatch:
        dims = part.column("dims")[0].as_py()
        labels = part.column("label").to_numpy()
        x = _matrix(part.column("vector").combine_chunks(), dims)
        row = {
            "block": number, "dims": dims, "ids": part.column("vec_id").to_pylist(), "labels": labels.tolist(),
            "vectors": _pack(x), "lows": x.min(axis=0).tolist(), "highs": x.max(axis=0).tolist(),
            "first_label": int(labels.min()), "last_label": int(labels.max()),
        }
        return pa.RecordBatch.from_pylist([row], _BLOCKS)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while len(held):
                lengths = held.column("dims").to_numpy()
                alike = int(np.searchsorted(lengths, lengths[0], "right"))
                if alike == len(held) < size:
                    break  # the next batch may go on with this block
                yield block(held.slice(0, min(alike, size)), number)
                held, number = held.slice(min(alike, size)), number + 1
        if held is not None and len(held):
            yield block(held, number)

    along = vectors.mapInArrow(placed, "dims int, place binary, vec_id bigint, label bigint, vector array<bigint>")
    ordered = along.repartitionByRange(shuffle_partitions(along), "dims", "place", "vec_id")
    return ordered.sortWithinPartitions("dims", "place", "vec_id").mapInArrow(packed, _ddl(_BLOCKS))


def anchor_groups(stored: DataFrame, each: int = ANCHOR_EACH, wanted: int = POSITIVES) -> DataFrame:
    """Anchors in groups along the curve.  Each asks for all rows with at least the score that
    as many rows of its label as are wanted reach in its own block."""

    def row_of(name: str, dims: int, held: list[tuple]) -> pa.RecordBatch:
        ids, labels, sure, vectors = zip(*held, strict=True)
        row = {
            "group": name, "dims": dims, "anchors": ids, "anchor_labels": labels,
            "anchor_vectors": _pack(np.array(vectors)), "asked": range(len(ids)), "low": sure,
            "high": [MOST] * len(ids), "tag": [0] * len(ids),
        }
        return pa.RecordBatch.from_pylist([row], _GROUPS)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dims, ids, labels = row["dims"], np.array(row["ids"]), np.array(row["labels"])
                x = _unpack(row["vectors"], dims, len(ids))
                at = np.flatnonzero(ids % each == 0)
                for i, line in zip(at.tolist(), _dot(x[at], x), strict=True):
                    same = line[(labels == labels[i]) & (ids != ids[i])]
                    sure = int(np.partition(same, -wanted)[-wanted]) if len(same) >= wanted else LEAST
                    held.setdefault(dims, []).append((int(ids[i]), int(labels[i]), sure, x[i]))
                    if len(held[dims]) == GROUP:
                        yield row_of(f"{row['block']}-{i}", dims, held.pop(dims))
        for dims, rest in held.items():
            yield row_of(f"{rest[0][0]}", dims, rest)

    return stored.select("block", "dims", "ids", "labels", "vectors").mapInArrow(grouped, _ddl(_GROUPS))


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each block (row of lows and highs) can hold for each anchor."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _dot(up, lows) + _dot(down, highs), _dot(up, highs) + _dot(down, lows)


def window_of(positive: int) -> tuple[int, int]:
    """Least and greatest score of a positive's negatives; none where the first is greater."""
    return -(-4 * positive // 5), positive


def _cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict], Iterator[dict]]]:
    """Runs of rows with equal keys: those of kind 0, which come first, and the others one by one."""
    rows = chain.from_iterable(batch.to_pylist() for batch in batches)
    for key, run in groupby(rows, key=lambda row: tuple(row[k] for k in keys)):
        kinds = groupby(run, key=lambda row: row["kind"])
        first: list[dict] = []
        for kind, part in kinds:
            if kind == 0:
                first = list(part)
            else:
                yield key, first, part


def choose(groups: DataFrame, stored: DataFrame, same: bool) -> DataFrame:
    """The asks of each group that each block must be read for, with the anchors that ask.  Asks are for
    rows of the anchor's label if ``same``, else for all others."""
    chunks, tasks = max(-(-stored.count() // CHUNK), 1), max(groups.count(), 1)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, zones, asking in _cells(batches, ["cell", "chunk"]):
            for row in asking:
                mine = [z for z in zones if z["dims"] == row["dims"]]
                if not mine:
                    continue
                x = _unpack(row["anchor_vectors"], row["dims"], len(row["anchors"]))
                lows, highs = (
                    np.array([z[c] for z in mine], np.int64).reshape(len(mine), row["dims"]) for c in ("lows", "highs")
                )
                least, most = bounds(x, lows, highs)
                ids, labels = np.array(row["anchors"]), np.array(row["anchor_labels"])
                asked, low, high, tag = (np.array(row[c], np.int64) for c in ("asked", "low", "high", "tag"))
                first, last = (np.array([z[c] for z in mine]) for c in ("first_label", "last_label"))
                label = labels[asked][:, None]
                able = (first <= label) & (label <= last) if same else (first != label) | (last != label)
                reach = (most[asked] >= low[:, None]) & (least[asked] <= high[:, None]) & able
                for n, zone in enumerate(mine):
                    which = np.flatnonzero(reach[:, n])
                    if len(which):
                        who, place = np.unique(asked[which], return_inverse=True)
                        answer = {
                            "block": zone["block"], "group": row["group"], "dims": row["dims"],
                            "anchors": ids[who], "anchor_labels": labels[who], "anchor_vectors": _pack(x[who]),
                            "asked": place, "low": low[which], "high": high[which], "tag": tag[which],
                        }
                        yield pa.RecordBatch.from_pylist([answer], _CHOSEN)

    zones = stored.select(
        F.lit(0).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("cell"),
        F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk"),
        "block", "dims", "lows", "highs", "first_label", "last_label",
    )
    asking = groups.select(
        F.lit(1).alias("kind"), F.pmod(F.xxhash64("group"), F.lit(tasks)).cast("int").alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), *_GROUPS.names,
    )
    together = zones.unionByName(asking, allowMissingColumns=True).repartition("cell", "chunk")
    return together.sortWithinPartitions("cell", "chunk", "kind").mapInArrow(chosen, _ddl(_CHOSEN))


def answers(chosen: DataFrame, stored: DataFrame, same: bool, most: int) -> DataFrame:
    """Of each block, the first ``most`` rows of each ask it was chosen for."""
    salt = F.pmod(F.xxhash64("group"), F.lit(max(-(-chosen.select("group").distinct().count() // TOGETHER), 1)))
    asking = chosen.withColumn("salt", salt)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (block,), rows in _cells(batches, ["block", "salt"]):
            ids, labels = np.array(block["ids"]), np.array(block["labels"])
            held = _unpack(block["vectors"], block["dims"], len(ids))
            order = np.argsort(ids, kind="stable")  # ties go to the smaller id
            ids, labels, held = ids[order], labels[order], held[order]
            for row in rows:
                mine = _unpack(row["anchor_vectors"], row["dims"], len(row["anchors"]))
                scores, found = _dot(mine, held), []
                fits = labels == np.array(row["anchor_labels"])[:, None]
                fits = fits & (ids != np.array(row["anchors"])[:, None]) if same else ~fits
                for i, low, high, tag in zip(row["asked"], row["low"], row["high"], row["tag"], strict=True):
                    line = scores[i]
                    at = np.flatnonzero(fits[i] & (line >= low) & (line <= high))
                    at = at[np.argsort(-line[at], kind="stable")[:most]]
                    anchor = row["anchors"][i]
                    found += [(anchor, tag, high, int(ids[k]), int(line[k])) for k in at]
                if found:
                    columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                    name = pa.array([row["group"]] * len(found))
                    yield pa.RecordBatch.from_arrays([name, *columns], schema=_HITS)

    needed = stored.select("block", "dims", "ids", "labels", "vectors").join(
        asking.select("block", "salt").distinct(), "block"
    )
    together = needed.withColumn("kind", F.lit(0)).unionByName(
        asking.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    dealt = together.repartition("block", "salt").sortWithinPartitions("block", "salt", "kind")
    return dealt.mapInArrow(read, _ddl(_HITS))


def first_of(hits: DataFrame, most: int) -> DataFrame:
    """The first rows of each ask over all blocks, ranked from 1."""
    ranked = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "other")
    return hits.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= most)


def with_windows(groups: DataFrame, positives: DataFrame) -> DataFrame:
    """Groups that ask for the negatives of each positive of their anchors."""

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = {anchor: i for i, anchor in enumerate(row["anchors"])}
                made = [
                    (place[p["anchor_id"]], *window_of(p["score"]), p["other"]) for p in row.pop("found")
                ]
                made = [ask for ask in made if ask[1] <= ask[2]]
                if made:
                    names = ("asked", "low", "high", "tag")
                    yield pa.RecordBatch.from_pylist([row | dict(zip(names, zip(*made), strict=True))], _GROUPS)

    found = positives.groupBy("group").agg(F.collect_list(F.struct("anchor_id", "other", "score")).alias("found"))
    asked = groups.select("group", "dims", "anchors", "anchor_labels", "anchor_vectors").join(found, "group")
    return asked.mapInArrow(asks, _ddl(_GROUPS))


def hard_negatives(
    vectors: DataFrame, each: int = ANCHOR_EACH, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, from vec_id, label
    and vector (whole numbers, as of ``whole_vectors``)."""
    least = F.min(F.struct("label", "vector"))
    single = vectors.groupBy("vec_id").agg(least.alias("least")).select("vec_id", "least.label", "least.vector")
    stored = kept(blocks(kept(single, "vectors")), "blocks")
    groups = kept(anchor_groups(stored, each, positives), "anchors")

    near = answers(kept(choose(groups, stored, True), "positive-blocks"), stored, True, positives)
    found = kept(first_of(near, positives), "positives")
    asking = kept(with_windows(groups, found), "windows")
    hits = answers(kept(choose(asking, stored, False), "negative-blocks"), stored, False, negatives)
    return first_of(hits, negatives).select(
        "anchor_id", F.col("tag").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        F.col("high").alias("positive_score"), F.col("score").alias("negative_score"),
    )


ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM whole a JOIN whole r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
