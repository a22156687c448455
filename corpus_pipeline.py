"""The corpus pipeline: documents to training sequences, a stage at a time.

Every stage takes what its predecessor kept, whole, and all but the last return the
columns of ``documents``.

Defined cases: ``doc_id`` is a whole number or null.  Null and empty texts fail the base
rules of the first stage; later stages keep them, as empty texts.  Rows that share a
doc_id are judged one by one by the first stage and are one document to the others, so
equal rows stay or go together.  A row without a doc_id is never a near-duplicate, never
contaminated, and never the one that keeps a line.  An empty table gives an empty result
at every stage.  Other columns, whatever their names, pass through as they are but for
``n_chars``, which follows the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import decontamination, line_dedup, near_dedup, packing, quality
from parcelflow.llm.kept import kept
from parcelflow.llm.queries import PACK_END_ID, tokenizer_path, trusted_ids
from parcelflow.llm.shipping import ship

#: Least similarity of near-duplicates; 85 is the contract of ``op1_near_dedup`` alone.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return work(ship(spark), docs, sf_dir)

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio.  A verdict is
    that of a text, so rows that share a doc_id are judged one by one."""
    verdicts = quality.judge(docs, trusted_ids(spark, sf_dir)).filter(~F.col("kept"))
    failed = verdicts.select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).distinct()
    same_text = F.xxhash64(docs["text"]) == failed["__hash"]
    return docs.join(failed, docs["doc_id"].eqNullSafe(failed["__id"]) & same_text, "left_anti")


@_stage
def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents keep."""
    names = docs.columns
    aside = [name if name in ("doc_id", "text") else f"c{i}" for i, name in enumerate(names)]
    left = line_dedup.dedup_lines(docs.toDF(*aside)).select(*aside).toDF(*names)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.char_length("text").cast(kind))
    return left


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    dropped = near_dedup.near_duplicates(docs, percent=NEAR_PERCENT).filter(~F.col("kept"))
    dropped = kept(dropped.select(F.col("doc_id").alias("__id")).distinct(), "near-copies")
    return docs.join(dropped, docs["doc_id"].cast("bigint") == dropped["__id"], "left_anti")


@_stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontamination.overlaps(docs, benchmark).select(F.col("doc_id").alias("__id"))
    leaks = kept(leaks.distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"].cast("bigint") == leaks["__id"], "left_anti")


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, placed in sequences."""
    return packing.pack(docs, tokenizer_path(), PACK_END_ID, with_ids=False).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines_once),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: The likelihood ratio hashes n-grams, and packing takes a tokenizer, for which DuckDB
#: has no functions: no SQL gives the rows.  tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name, codec="snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
