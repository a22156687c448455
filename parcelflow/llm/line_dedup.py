"""Line dedup: lines that recur in many documents stay in one of them.

A line's key is the line without white space at its ends, A-Z lower-cased.  Two
Bloom filters of fixed size hold the hashes of keys seen once and seen twice;
only keys that the second may hold are shuffled, as 128-bit digests, to be
counted exactly and to choose the document that keeps them.

Defined cases: null or empty text is one empty line; a line that occurs several
times in the chosen document stays as often as it occurs; rows that repeat a
doc_id are one document; a null doc_id is a document that never keeps a line
others hold; an empty table gives an empty result.  A column of the table named
as a result column is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm import bloom
from parcelflow.llm.words import LOWER_TABLE

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 20
MIN_DOCUMENTS = 3


def line_keys(text: Column, min_chars: int) -> Column:
    """Distinct keys of a text that are long enough to count."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    keys = F.transform(lines, lambda x: F.translate(F.btrim(x, F.lit(WHITE)), UPPER, LOWER))
    return F.array_distinct(F.filter(keys, lambda x: F.char_length(x) >= min_chars))


def _key(line: str) -> bytes:
    return line.strip(WHITE).encode().translate(LOWER_TABLE)


def _suspects(keyed: DataFrame, twice) -> DataFrame:
    """(doc_id, digest) of the keys that the filter of repeats may hold."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes = batch.column(1), batch.column(2)
            rows = np.repeat(np.arange(len(keys)), np.diff(np.asarray(keys.offsets)))
            hit = bloom.holds(
                twice.value,
                hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64),
            )
            lines = keys.flatten().filter(pa.array(hit)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows[hit])),
                    pa.array([hashlib.md5(x.encode()).digest() for x in lines], pa.binary()),
                ],
                names=["doc_id", "digest"],
            )

    return keyed.mapInArrow(pick, "doc_id bigint, digest binary").distinct()


def dropped_keys(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    filter_bits: int = bloom.FILTER_BITS,
) -> DataFrame:
    """(doc_id, digest) for each key that a document loses."""
    keyed = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), line_keys(F.col(text), min_chars).alias("keys")
    ).select("doc_id", "keys", F.transform("keys", lambda x: F.xxhash64(x)).alias("hashes"))
    _, twice = bloom.build(keyed.select("hashes"), filter_bits)
    suspects = _suspects(keyed, bloom.share(docs, twice))
    losing = (
        suspects.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("keeper"))
        .filter(F.col("documents") >= min_documents)
        .select("digest", "keeper")
    )
    return (
        suspects.join(losing, "digest")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .select("doc_id", "digest")
    )


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    filter_bits: int = bloom.FILTER_BITS,
) -> DataFrame:
    """The table with the lines left joined by line feeds in ``text``, and the
    columns ``n_lines`` (before) and ``n_dropped``."""
    dropped = (
        dropped_keys(docs, text, doc_id, min_chars, min_documents, filter_bits)
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.collect_list("digest").alias("__digests"))
    )
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    schema = T.StructType(
        [docs.schema[c] for c in columns]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    at = columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, lines_before, lines_dropped = [], [], []
            digests = batch.column(len(columns)).to_pylist()
            for whole, gone in zip(batch.column(at).to_pylist(), digests, strict=True):
                whole = whole or ""
                if gone:
                    gone = set(gone)
                    lines = whole.split("\n")
                    stay = [x for x in lines if hashlib.md5(_key(x)).digest() not in gone]
                    left.append("\n".join(stay))
                    lines_before.append(len(lines))
                    lines_dropped.append(len(lines) - len(stay))
                else:
                    left.append(whole)
                    lines_before.append(whole.count("\n") + 1)
                    lines_dropped.append(0)
            arrays = list(batch.columns[: len(columns)])
            arrays[at] = pa.array(left, batch.schema.field(at).type)
            arrays += [pa.array(lines_before, pa.int64()), pa.array(lines_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_lines", "n_dropped"])

    joined = docs.select(*columns).join(
        dropped, F.col(doc_id).cast("bigint").eqNullSafe(F.col("__doc")), "left"
    )
    return joined.select(*[F.col(c) for c in columns], "__digests").mapInArrow(cut, schema)


ORACLE = r"""
WITH line AS (
  SELECT doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents)
), losing AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
              FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM line LEFT JOIN losing USING (key)
GROUP BY doc_id
"""
