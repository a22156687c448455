"""Quality rules: plain counts, and a likelihood ratio of hashed n-grams.

Two multinomials over hash buckets are counted on whole texts: trusted-target
documents and the raw corpus.  A document's score is the mean over its single words
and word pairs of log(p_target / p_raw); those under a fixed threshold are rejected.
Everything is built-in Spark expressions; no Python sees a row.

The model has a bucket for each ``TEXT_BYTES`` bytes of text, so it grows with the
corpus and buckets stay as full at every size.  Up to ``2 ** BROADCAST_BITS`` buckets
(four bytes each) it is broadcast, packed in blocks; a larger one is joined by bucket,
after each document's n-grams have been combined.  Both ways give the same scores.
The trusted ids, which grow with the corpus too, are joined without a hint.

Defined cases: null text has no words; a document without words fails the base
rules and has score 0; a text of one word has no pair; an n-gram whose bucket the
model does not hold weighs 0; no trusted documents, or an empty table: every score
is 0; rows that repeat are judged alike; ids may be of any type.  Only the columns
named are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from parcelflow.llm.kept import kept

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ORDERS = (1, 2)
TEXT_BYTES = 2048
LEAST_BITS = 16
BROADCAST_BITS = 24
BLOCK_BITS = 10
#: Tasks a core that count the model, at most.
COUNT_WAVES = 3
PRIOR = 2.0
THRESHOLD = -0.15


def words_of(text: Column) -> Column:
    """The words of a text without white space at its ends; of an empty one, one empty word."""
    return F.split(text, "[ \\t-\\r]+", -1)


def symbol_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    removed = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    found = F.when(text.rlike("[" + SYMBOLS + "]"), removed).otherwise(F.lit(0))
    return found.cast("bigint")


def repeated_lines(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    lines = F.filter(lines, lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def window_hashes(hashes: Column, size: int) -> Column:
    """Hash of each window of ``size`` hashed words; none where there are fewer."""
    windows = F.transform(
        hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, size)])
    )
    return F.slice(windows, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))


def with_covered_words(frame: DataFrame, windows: str, size: int, name: str) -> DataFrame:
    """Words in windows that occur twice or more: where a text has such windows, sort
    them by hash, keep the places of those equal to a neighbour, and measure the
    union of their spans.  One column a step, so each is computed once."""
    tail = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    frame = frame.withColumn("__sorted", F.when(repeats, F.sort_array(pairs)))
    same = F.zip_with(
        "__sorted",
        tail(F.col("__sorted")),
        lambda a, b: F.struct(a["i"].alias("i"), a["h"].eqNullSafe(b["h"]).alias("same")),
    )
    frame = frame.withColumn("__same", same)
    hits = F.zip_with(
        "__same",
        F.concat(F.array(F.lit(False)), F.transform("__same", lambda x: x["same"])),
        lambda x, before: F.struct(x["i"].alias("i"), (x["same"] | before).alias("hit")),
    )
    places = F.sort_array(F.transform(F.filter(hits, lambda x: x["hit"]), lambda x: x["i"]))
    frame = frame.withColumn("__places", places)
    gaps = F.zip_with(
        "__places",
        tail(F.col("__places")),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(size)), F.lit(size)),
    )
    total = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return frame.withColumn(name, F.coalesce(total, F.lit(0).cast("bigint"))).drop(
        "__sorted", "__same", "__places"
    )


def base_rules(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text, and the counts of the base rules."""
    whole = F.col("text")
    counted = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .withColumn("trimmed", F.btrim(F.coalesce(whole, F.lit("")), F.lit(WHITE)))
        .withColumn("words", words_of(F.col("trimmed")))
        .select(
            "doc_id",
            "text",
            F.when(F.col("trimmed") == "", 0).otherwise(F.size("words")).cast("bigint").alias("n_words"),
            F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
            symbol_count(whole).alias("n_symbols"),
            repeated_lines(whole).alias("n_dup_lines"),
            F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        )
    )
    counted = counted.withColumn("windows", window_hashes(F.col("hashes"), 5)).drop("hashes")
    counted = with_covered_words(counted, "windows", 5, "n_repeat_words").drop("windows")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def bucket_bits(docs: DataFrame, text: str = "text", text_bytes: int = TEXT_BYTES) -> int:
    """The model's size for a corpus: two to this power is at least its number of bytes
    over ``text_bytes``."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)).cast("bigint"))).first()[0] or 0
    return max(LEAST_BITS, (-(-size // text_bytes) - 1).bit_length())


def gram_buckets(
    docs: DataFrame, text: str, orders: tuple[int, ...], bits: int, keep: list[Column]
) -> DataFrame:
    """A row for each n-gram of each order: the kept columns and its bucket.

    One explode over numbers that hold a place and, in their low bits, an order; the words
    they name are hashed in the rows made, so that all of it is generated code.  A row takes
    its words from copies of the list that start later: checked sums would cost more than
    the hashes."""
    found = docs.select(*keep, F.btrim(F.col(text), F.lit(WHITE)).alias("__text"))
    found = found.filter(F.col("__text") != "")
    names = found.columns[:-1]
    found = found.select(*names, words_of(F.col("__text")).alias("__words"))
    later = [F.slice("__words", k + 1, F.size("__words")).alias(f"__words{k}") for k in range(max(orders))]
    width = (len(orders) - 1).bit_length()
    last = F.shiftleft(F.size("__words"), width) - 1
    found = found.select(*names, *later, last.alias("__last"))
    lists = [f"__words{k}" for k in range(max(orders))]
    numbers = F.explode(F.sequence(F.lit(0), F.col("__last")))
    found = found.select(*names, *lists, numbers.alias("__number"))
    place = F.shiftright("__number", width)
    order = F.col("__number").bitwiseAND((1 << width) - 1)
    whole, hashed = F.lit(False), F.lit(None).cast("bigint")
    for turn, n in reversed(list(enumerate(orders))):
        words = [F.get(name, place) for name in lists[:n]]
        whole = F.when(order == turn, words[-1].isNotNull()).otherwise(whole)
        hashed = F.when(order == turn, F.xxhash64(*words)).otherwise(hashed)
    found = found.filter(whole)
    return found.select(*names, hashed.bitwiseAND((1 << bits) - 1).cast("int").alias("bucket"))


WHOLE_TYPES = (ByteType, ShortType, IntegerType, LongType)


def mark_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with ``__t``: 1 where ``__id`` is among the ids of ``trusted``, else 0.

    Whole ids are joined as words of 64 bits, so that dense ones take few rows; others
    as they are.  Sizes are known when the join is planned: without a broadcast it
    shuffles the texts."""
    key = trusted.select(F.col(trusted.columns[0]).alias("__trusted_id"))
    kinds = docs.schema["__id"].dataType, key.schema["__trusted_id"].dataType
    if all(isinstance(k, WHOLE_TYPES) for k in kinds):
        bit = "shiftleft(1L, cast(cast(__trusted_id AS bigint) & 63L AS int))"
        packed = key.groupBy(F.shiftright(F.col("__trusted_id").cast("bigint"), 6).alias("__word"))
        marks = kept(packed.agg(F.expr(f"bit_or({bit})").alias("__bits")), "trusted")
        word = F.shiftright(F.col("__id").cast("bigint"), 6)
        held = F.expr("getbit(__bits, cast(cast(__id AS bigint) & 63L AS int))")
        joined = docs.join(marks, word == F.col("__word"), "left")
    else:
        marks = kept(key.distinct(), "trusted")
        held = F.col("__trusted_id").isNotNull()
        joined = docs.join(marks, F.col("__id") == F.col("__trusted_id"), "left")
    return joined.select(*docs.columns, F.coalesce(held.cast("bigint"), F.lit(0)).alias("__t"))


def ratio_model(
    docs: DataFrame,
    trusted: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    orders: tuple[int, ...] = ORDERS,
    bits: int | None = None,
    prior: float = PRIOR,
) -> DataFrame:
    """(bucket, weight): log of target over raw probability.

    The raw corpus is every text; the target, the texts whose id is in ``trusted``
    (one column).  ``bits`` is that of the corpus (``bucket_bits``) unless given.
    Each count has ``prior`` added, the target's scaled, so that a bucket without
    evidence weighs 0.
    """
    bits = bucket_bits(docs, text) if bits is None else bits
    named = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    # Every counting task shuffles a row for each bucket that it meets, nearly all there are,
    # so what is shuffled grows with the tasks: some waves of them read all splits.
    tasks = COUNT_WAVES * docs.sparkSession.sparkContext.defaultParallelism
    marked = mark_trusted(named, trusted).coalesce(tasks)
    counts = (
        gram_buckets(marked, "text", orders, bits, [F.col("__t")])
        .groupBy("bucket")
        .agg(F.sum("__t").alias("target"), F.count(F.lit(1)).alias("raw"))
    )
    counts = kept(counts, "ratio-counts")
    targets, raws = counts.agg(F.sum("target"), F.sum("raw")).first()
    share = (targets or 0) / (raws or 1)
    weight = F.log((F.col("target") + prior * share) / F.lit(targets or 1)) - F.log(
        (F.col("raw") + prior) / F.lit(raws or 1)
    )
    return counts.filter(F.lit(bool(targets))).select("bucket", weight.alias("weight"))


def _blocks(fixed: DataFrame, bits: int) -> DataFrame:
    """(block, weights): the weights of neighbouring buckets, in order, 0 where there is none."""
    size = 1 << min(BLOCK_BITS, bits)
    every = fixed.sparkSession.range(1 << bits).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("weight")
    )
    filled = fixed.unionByName(every).groupBy("bucket").agg(F.sum("weight").cast("int").alias("weight"))
    block = F.shiftright("bucket", size.bit_length() - 1).alias("block")
    rows = filled.groupBy(block).agg(F.array_sort(F.collect_list(F.struct("bucket", "weight"))).alias("rows"))
    return rows.select("block", F.transform("rows", lambda r: r["weight"]).alias("weights"))


def ratio_scores(
    docs: DataFrame,
    model: DataFrame,
    bits: int,
    text: str = "text",
    doc_id: str = "doc_id",
    orders: tuple[int, ...] = ORDERS,
    broadcast_bits: int = BROADCAST_BITS,
) -> DataFrame:
    """(doc_id, text_hash, score): mean weight of a text's n-grams.  Sums run over
    integers, so the order of addition cannot change a verdict."""
    keys = [F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash")]
    fixed = model.select("bucket", F.round(F.col("weight") * 1e6).cast("bigint").alias("weight"))
    grams = gram_buckets(docs, text, orders, bits, keys)
    if bits <= broadcast_bits:
        shift = min(BLOCK_BITS, bits)
        blocks = F.broadcast(kept(_blocks(fixed, bits), "ratio-blocks"))
        weighed = grams.join(blocks, F.shiftright(grams["bucket"], shift) == blocks["block"]).select(
            "doc_id",
            "text_hash",
            F.lit(1).alias("times"),
            F.get("weights", F.col("bucket").bitwiseAND((1 << shift) - 1)).alias("weight"),
        )
    else:
        combined = grams.groupBy("doc_id", "text_hash", "bucket").agg(F.count(F.lit(1)).alias("times"))
        weighed = combined.join(fixed, "bucket", "left").select(
            "doc_id", "text_hash", "times",
            (F.col("times") * F.coalesce("weight", F.lit(0))).alias("weight"),
        )
    return weighed.groupBy("doc_id", "text_hash").agg(
        (F.sum("weight") / F.sum("times") / 1e6).alias("score")
    )


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = THRESHOLD,
    orders: tuple[int, ...] = ORDERS,
    bits: int | None = None,
    broadcast_bits: int = BROADCAST_BITS,
) -> DataFrame:
    """doc_id, text_hash, the base counts, score and kept; a row for each row."""
    bits = bucket_bits(docs, text) if bits is None else bits
    model = ratio_model(docs, trusted, text, doc_id, orders, bits)
    scores = ratio_scores(docs, model, bits, text, doc_id, orders, broadcast_bits).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "score"
    )
    base = (
        base_rules(docs, text, doc_id)
        .withColumn("text_hash", F.xxhash64("text"))
        .drop("text")
    )
    matched = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    score = F.coalesce("score", F.lit(0.0))
    return base.join(scores, matched, "left").select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed",
        score.alias("score"),
        (~F.col("base_failed") & (score >= threshold)).alias("kept"),
    )
