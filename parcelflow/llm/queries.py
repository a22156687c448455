"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (
    decontamination,
    hard_negatives,
    language_id,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    periodic_runs,
    pivot_dedup,
    quality,
    substring_dedup,
    token_counts,
    url_filter,
)
from parcelflow.llm.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_near_dedup": near_dedup.ORACLE,
    "op2_url_filter": url_filter.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op5_license_scan": license_scan.oracle(),
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_periodic_runs": periodic_runs.ORACLE,
}

TOKENIZER = "word_bpe_49k.json"
PACK_END_ID = 2
SEPARATOR_ID = 49407


def tokenizer_path() -> str:
    """Where the vocabulary file lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _query(name: str):
    def register(query: Callable[[SparkSession, str], DataFrame]):
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(ship(spark), sf_dir)

        QUERIES[name] = run
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


@_query("op1_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85).drop("digest")


@_query("op2_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.RULES)


@_query("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@_query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digests(_table(spark, sf_dir, "documents"))


@_query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


@_query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


@_query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out("doc_id")))
    found = language_id.identify(docs, model, with_spans=False)
    return found.select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


@_query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path(), PACK_END_ID, with_ids=False).drop("ids")


@_query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    blocks, names = token_counts.token_files(docs, tokenizer_path(), SEPARATOR_ID)
    return token_counts.count_tokens(blocks, names, SEPARATOR_ID)


@_query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, trusted_ids(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("score", 6).alias("score"),
    )


@_query("op11_hard_negatives")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.whole_vectors(_table(spark, sf_dir, "embeddings")))


@_query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(_table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


@_query("op13_simhash_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
