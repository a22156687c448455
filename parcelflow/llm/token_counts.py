"""Tokens of each document, counted in flat token files that have no index.

A file is a run of blocks of ids, documents end to end, each closed by a separator
id; documents cross blocks freely.  Every block is searched for separators on its
own, vectorised; a prefix scan over the blocks' short summaries then carries the
open document, and the number of documents closed, from block to block.

Defined cases: a document without ids counts 0; ids after a file's last separator
are a document that is not closed; blocks without a separator only carry; an
empty table has no documents.  Null text is empty.  Rows that repeat a doc_id, or have
none, are counted apart.  Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.kept import kept
from parcelflow.llm.tokens import encoder
from parcelflow.llm.words import slices

BLOCK_IDS = 1 << 18
FILE_ROWS = "file int, block bigint, payload binary, first bigint, doc_ids array<bigint>"
_NAMES = ["file", "block", "payload", "first", "doc_ids"]


def token_files(
    docs: DataFrame,
    tokenizer_path: str,
    separator: int,
    text: str = "text",
    doc_id: str = "doc_id",
    block_ids: int = BLOCK_IDS,
    dtype: str = "<u2",
) -> tuple[DataFrame, DataFrame]:
    """Write a token file for each partition; return its blocks (file, block,
    payload) and, as the files name nothing, the ids in file order (file, first,
    doc_ids)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_path, literal_specials=True)
        file = TaskContext.get().partitionId()
        open_ids, block, first = np.zeros(0, dtype), 0, 0

        def row(block=None, payload=None, first=None, names=None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([payload], pa.binary()),
                    pa.array([first], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                ],
                names=_NAMES,
            )

        for rows, _, _ in slices(batches, "text"):
            flat, counts = ids_of.encode(rows.column(1))
            ends = np.cumsum(counts + 1)
            ids = np.full(int(ends[-1]), separator, dtype)
            inner = np.ones(len(ids), bool)
            inner[ends - 1] = False
            ids[inner] = flat
            open_ids = np.concatenate([open_ids, ids])
            while len(open_ids) >= block_ids:
                yield row(block, open_ids[:block_ids].tobytes())
                open_ids, block = open_ids[block_ids:], block + 1
            yield row(first=first, names=rows.column(0).to_pylist())
            first += rows.num_rows
        if len(open_ids):
            yield row(block, open_ids.tobytes())

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    written = kept(chosen.mapInArrow(write, FILE_ROWS), "token-files")
    blocks = written.filter(F.col("payload").isNotNull()).select("file", "block", "payload")
    names = written.filter(F.col("payload").isNull()).select("file", "first", "doc_ids")
    return blocks, names


def scan(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """(file, ordinal, n_tokens, closed) of every document in the files."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("size", "head", "tail", "inner")}
            for payload in batch.column(2).to_pylist():
                ids = np.frombuffer(payload or b"", dtype)
                at = np.flatnonzero(ids == separator)
                out["size"].append(len(ids))
                out["head"].append(int(at[0]) if len(at) else None)
                out["tail"].append(len(ids) - int(at[-1]) - 1 if len(at) else None)
                out["inner"].append(np.diff(at) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *(pa.array(out[k], pa.int64()) for k in ("size", "head", "tail")),
                    pa.array(out["inner"], pa.list_(pa.int64())),
                ],
                names=["file", "block", "size", "head", "tail", "inner"],
            )

    found = blocks.select("file", "block", "payload").mapInArrow(
        search, "file int, block bigint, size bigint, head bigint, tail bigint, inner array<bigint>"
    )
    whole = Window.partitionBy("file").orderBy("block")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    closes = F.col("head").isNotNull()
    number = F.when(closes, F.size("inner") + 1).otherwise(0).cast("bigint")
    zero = F.lit(0).cast("bigint")
    stitched = (
        found.withColumn("start", F.coalesce(F.sum("size").over(before), zero))
        .withColumn("open", F.col("start") + F.col("size") - F.col("tail"))
        .withColumn("first", F.coalesce(F.sum(number).over(before), zero))
        .withColumn("carry", F.col("start") - F.coalesce(F.max("open").over(before), zero))
        .withColumn("last", F.lead("block").over(whole).isNull())
    )
    done = F.when(closes, F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner")))
    rest = F.coalesce(F.col("tail"), F.col("carry") + F.col("size"))
    closed = stitched.filter(closes).select(
        "file", "first", F.posexplode(done).alias("place", "n_tokens")
    ).select("file", (F.col("first") + F.col("place")).alias("ordinal"), "n_tokens",
             F.lit(True).alias("closed"))
    unclosed = stitched.filter(F.col("last") & (rest > 0)).select(
        "file", (F.col("first") + number).alias("ordinal"), rest.alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(unclosed)


def count_tokens(blocks: DataFrame, names: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """(doc_id, n_tokens) from the files and the ids in their order."""
    ids = names.select(
        F.col("file").alias("__file"), "first", F.posexplode("doc_ids").alias("place", "doc_id")
    ).select("__file", (F.col("first") + F.col("place")).alias("__ordinal"), "doc_id")
    counted = scan(blocks, separator, dtype)
    same = (F.col("file") == F.col("__file")) & (F.col("ordinal") == F.col("__ordinal"))
    return counted.join(ids, same).select("doc_id", "n_tokens")
