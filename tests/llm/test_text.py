"""Quality rules, license scans and language identification."""

import math
import random
import re
import time
from collections import Counter

import llm_cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parcelflow.llm import language_id, license_scan, quality

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    text = text or ""
    w = llm_cases.words(text)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, covered = Counter(wins), set()
    for i, x in enumerate(wins):
        if counts[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if llm_cases.words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
        len(w) < 10 or 100 * len(covered) > 20 * len(w),
    )


def test_base_rules_equal_brute_force(docs, texts):
    got = quality.base_rules(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    mine = sorted((repr(r["doc_id"]), r["text"] or "", *(r[c] for c in columns)) for r in got)
    assert mine == sorted((repr(r[0]), r[1] or "", *base(r[1])) for r in texts)


def buckets(text, orders, bits):
    """Buckets of a text's n-grams: a word's hash is the seed of the next one's."""
    w, found = llm_cases.words(text), []
    for n in orders:
        for i in range(len(w) - n + 1):
            h = 42
            for word in w[i : i + n]:
                h = xxhash.xxh64_intdigest(word.encode(), seed=h)
            found.append(h % (1 << bits))
    return found


@pytest.mark.parametrize("broadcast_bits", [quality.BROADCAST_BITS, 0])
@pytest.mark.parametrize("orders", [(1,), (1, 2), (3, 1)])
def test_ratio_equals_brute_force(spark, docs, texts, orders, broadcast_bits):
    trusted_ids = [r[0] for r in texts if r[0] is not None and r[0] % 2 == 0]
    trusted = spark.createDataFrame([(i,) for i in trusted_ids], "doc_id bigint")
    bits = quality.bucket_bits(docs)
    got = {
        (r["doc_id"], r["n_words"], r["word_chars"]): r
        for r in quality.judge(docs, trusted, orders=orders, broadcast_bits=broadcast_bits).collect()
    }
    raw, target = Counter(), Counter()
    for row in texts:
        found = buckets(row[1], orders, bits)
        raw.update(found)
        if row[0] in set(trusted_ids):
            target.update(found)
    n, m, prior = sum(raw.values()), sum(target.values()), quality.PRIOR

    def weight(b):
        return math.log((target[b] + prior * m / n) / m) - math.log((raw[b] + prior) / n)

    for row in texts:
        w, found = llm_cases.words(row[1]), buckets(row[1], orders, bits)
        want = sum(weight(b) for b in found) / len(found) if found else 0.0
        mine = got[row[0], len(w), sum(map(len, w))]
        assert abs(mine["score"] - want) < 1e-5
        assert mine["kept"] == (not base(row[1])[-1] and mine["score"] >= quality.THRESHOLD)


def test_word_order_counts(spark, texts):
    """A trusted text scores above the same words shuffled."""
    rng = random.Random(3)
    table = []
    for i, row in enumerate(r for r in texts if len(llm_cases.words(r[1])) > 30):
        w = llm_cases.words(row[1])
        table += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(rng.sample(w, len(w))))]
    table = [x for x in table if len(set(llm_cases.words(x[1]))) > 20]
    frame = spark.createDataFrame(table, "doc_id bigint, text string")
    trusted = frame.filter("doc_id % 2 = 0").select("doc_id")
    model = quality.ratio_model(frame, trusted, bits=20)
    score = {r.doc_id: r.score for r in quality.ratio_scores(frame, model, 20).collect()}
    assert len(table) > 20
    assert all(score[i] > score[i + 1] for i, _ in table if i % 2 == 0)


def test_model_grows_with_the_corpus(spark):
    sizes = {}
    for n in (0, 1, 16, 64):
        frame = spark.range(n).selectExpr("id AS doc_id", "repeat('ab ', 1 << 20) AS text")
        sizes[n] = quality.bucket_bits(frame, text_bytes=16)
    assert sizes == {0: 16, 1: 18, 16: 22, 64: 24}
    with_nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert quality.bucket_bits(with_nulls) == quality.LEAST_BITS


def test_grams_of_few_words(spark):
    frame = spark.createDataFrame([("a b c",), (" a\t",), ("",), (" \n ",), (None,)], "text string")
    grams = quality.gram_buckets(frame, "text", (1, 2, 3), 10, [F.col("text")])
    assert {r["text"]: r["count"] for r in grams.groupBy("text").count().collect()} == {"a b c": 6, " a\t": 1}


@pytest.mark.parametrize("orders", [(1,), (2,), (3, 1), (1, 2, 3)])
def test_grams_take_no_checked_sums_in_the_rows_made(spark, texts, orders):
    """Checked sums for each n-gram cost more than its hash; the buckets are those of brute force."""
    frame = spark.createDataFrame([(r[1],) for r in texts], "text string")
    grams = quality.gram_buckets(frame, "text", orders, 10, [])
    want = Counter(b for r in texts for b in buckets(r[1], orders, 10))
    assert Counter(r["bucket"] for r in grams.collect()) == want
    made = grams._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[0]
    assert "bucket" in made and not re.search(r" [+] | - ", made)


def test_splits_of_a_corpus_are_counted_by_few_tasks(spark):
    """Each counting task shuffles up to a row a bucket, so their number is bounded."""
    tasks = quality.COUNT_WAVES * spark.sparkContext.defaultParallelism
    docs = spark.range(400, numPartitions=4 * tasks).selectExpr("id AS doc_id", "concat('a b', id % 7) AS text")
    seen = []
    kept, quality.kept = quality.kept, lambda frame, label: (seen.append((label, frame)), kept(frame, label))[1]
    try:
        model = quality.ratio_model(docs, docs.filter("doc_id < 200").select("doc_id"))
    finally:
        quality.kept = kept
    plan = dict(seen)["ratio-counts"]._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {tasks}, false" in plan
    found = {b for r in docs.select("text").distinct().collect() for b in buckets(r[0], quality.ORDERS, 16)}
    assert {r["bucket"] for r in model.collect()} == found


def test_a_bucket_the_model_lacks_weighs_nothing(spark):
    model = spark.createDataFrame([(b, 1.0) for b in buckets("a", (1,), 16)], "bucket int, weight double")
    frame = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id bigint, text string")
    for bound in (24, 0):
        rows = quality.ratio_scores(frame, model, 16, orders=(1,), broadcast_bits=bound).collect()
        assert {r.doc_id: r.score for r in rows} == {1: 0.5, 2: 0.0}


def test_all_trusted_documents_count(spark):
    docs = spark.createDataFrame([(i, f"own{i} " * 20) for i in range(60)], "doc_id bigint, text string")
    trusted = spark.range(250_000).withColumnRenamed("id", "doc_id")
    marked = quality.ratio_model(docs, trusted).collect()
    # Every text is trusted, so target and raw counts are the same.
    assert len(marked) > 50 and all(abs(r["weight"]) < 1e-9 for r in marked)


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_trusted_ids_are_marked_whatever_their_type(spark, kind):
    ids = [-(1 << 31), -65, -64, -1, 0, 1, 62, 63, 64, 127, (1 << 31) - 1, None]
    frame = spark.createDataFrame([(i,) for i in ids], "id bigint").selectExpr(f"cast(id AS {kind}) AS __id")
    picked = [i for i in ids[::2] if i is not None]
    trusted = spark.createDataFrame([(i,) for i in [*picked, picked[0], 5, None]], "t bigint")
    trusted = trusted.selectExpr(f"cast(t AS {kind}) AS t")
    got = sorted((str(r["__id"]), r["__t"]) for r in quality.mark_trusted(frame, trusted).collect())
    assert got == sorted((str(i), int(i in picked)) for i in ids)


def test_no_trusted_documents_reject_nothing_more(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint")
    got = quality.judge(docs, none).collect()
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) for r in got)


def places(text):
    w = "".join(c if c > "\x7f" or c.isalnum() else " " for c in (text or "").translate(LOWER))
    w = w.split(" ")
    w = [x for x in w if x]
    found = []
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    return len(w), found


LICENSED = [
    (1, "All rights reserved. ALL RIGHTS  reserved"),
    (2, "words before CC-BY 4.0, GNU general public license\nafter"),
    (3, "released under  the MIT License."),
    (4, "Released kindly under the MIT license"),
    (5, "Licensed under the Apache License, Version 2.0."),
    (6, "licensed trees under an apache sky, version 2.0"),
    (7, None), (8, ""), (9, "cc"), (9, "cc"), (10, "general public"), (None, "cc by"),
    (11, "cc by cc by cc by " * 50), (12, "général public license über reserved"),
    (13, "x " * 5000 + "all rights reserved"),
]


def test_only_a_to_z_are_lower_cased(spark):
    """The Kelvin sign's small letter is k, but it is no letter of A-Z."""
    texts = [(1, "All RIGHTS reserved, W\u00dcRDE"), (2, "all rights reserved WOR\u212a")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    words = docs.select("doc_id", license_scan.words_of(F.col("text")).alias("w"))
    found = {r.doc_id: r.w for r in words.collect()}
    assert found[1] == ["all", "rights", "reserved", "w\u00dcrde"]
    assert found[2][-1] == "wor\u212a"
    assert {r.base_labels for r in license_scan.scan(docs).collect()} == {"reserved"}


def test_one_long_text_takes_time_in_proportion(spark):
    """Every place holds its gram's hashes, not the words of the text."""

    def seconds(count):
        docs = spark.range(1).select(
            F.lit(1).alias("doc_id"), F.repeat(F.lit("some plain words of a text "), count // 6).alias("text")
        )
        license_scan.scan(docs).collect()
        began = time.perf_counter()
        license_scan.scan(docs).collect()
        return time.perf_counter() - began

    seconds(20_000)
    small, large = seconds(160_000), seconds(320_000)
    assert large < 2.5 * max(small, 1.0), (small, large)


def test_license_phrases_equal_brute_force(spark):
    docs = spark.createDataFrame(LICENSED, "doc_id bigint, text string").withColumn("words", F.lit(1))
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert license_scan.scan(docs).count() == len(LICENSED)
    for i, text in LICENSED:
        n, found = places(text)
        row = got[i]
        at = [k for k, _ in found]
        assert (row["n_words"], row["n_base"]) == (n, len(found)), i
        assert (row["first_word"], row["last_word"]) == (min(at, default=None), max(at, default=None))
        assert row["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1
    assert got[3]["labels"] == "mit" and got[5]["labels"] == "apache-2.0"
    assert got[4]["labels"] == "mit"  # a word put in: two diagonals, merged
    assert got[6]["labels"] == ""


def test_language_on_held_out_rows(spark):
    rng = np.random.default_rng(3)
    parts = {"aa": ["ba", "ko", "lu", "mi"], "bb": ["sch", "ung", "ein", "ß"], "cc": ["при", "вет", "ой"]}

    def prose(lang, n):
        return " ".join("".join(rng.choice(parts[lang], rng.integers(1, 4))) for _ in range(n))

    table = [(i, prose(x, 30), x) for i in range(300) for x in [["aa", "bb", "cc"][i % 3]]]
    docs = spark.createDataFrame(table, "doc_id bigint, text string, lang string")
    model = language_id.train(docs.filter(~language_id.held_out("doc_id")))
    assert model.languages == ["aa", "bb", "cc"]
    got = language_id.identify(docs, model).join(docs, "doc_id")
    assert got.filter("lang_pred <> lang").count() == 0
    mixed = [(1, prose("aa", 40) + " " + prose("bb", 20), "x"), (2, None, "x"), (3, "12 !?", "x"),
             (4, "", "x"), (None, "при", "x"), (5, "½²", "x"), (6, prose("cc", 9000), "x")]
    frame = spark.createDataFrame(mixed, "doc_id bigint, text string, score string")
    rows = {r["doc_id"]: r for r in language_id.identify(frame, model).collect()}
    assert [(s["first_word"], s["lang"]) for s in rows[1]["spans"]] == [(0, "aa"), (40, "bb")]
    assert rows[1]["lang_pred"] == "aa" and 0.4 < rows[1]["score"] < 0.9
    assert {rows[i]["lang_pred"] for i in (2, 3, 4, 5)} == {"und"}
    assert rows[None]["lang_pred"] == "cc" and rows[6]["score"] == 1.0


def test_viterbi_equals_one_document_at_a_time():
    rng = np.random.default_rng(5)
    scores = rng.normal(size=(50, 3)) * 4
    sizes = np.array([0, 7, 1, 30, 7])
    which = rng.integers(0, 50, sizes.sum())
    starts = np.cumsum(sizes) - sizes
    together = language_id.viterbi(scores, which, starts, sizes, 5.0)
    for s, n in zip(starts, sizes, strict=True):
        best, paths = np.zeros(3), [[], [], []]
        for w in which[s : s + n]:
            new, kept = best.copy(), [None] * 3
            for k in range(3):
                j = int(best.argmax())
                source = j if best[j] - 5.0 > best[k] else k
                new[k] = (best[source] - (5.0 if source != k else 0)) + scores[w, k]
                kept[k] = [*paths[source], k]
            best, paths = new, kept
        assert together[s : s + n].tolist() == paths[int(best.argmax())]


def test_empty_tables(spark, empty):
    trusted = spark.createDataFrame([], "doc_id bigint")
    assert quality.judge(empty, trusted).count() == 0
    assert license_scan.scan(empty).count() == 0
    model = language_id.train(empty)
    assert language_id.identify(empty, model).count() == 0
    one = spark.createDataFrame([(1, "text")], "doc_id bigint, text string")
    assert language_id.identify(one, model).first()["lang_pred"] == "und"
