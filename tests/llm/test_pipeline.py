"""Every stage of the pipeline against plain Python, on rows that hold the awkward cases."""

import math
from collections import Counter

import corpus_pipeline
import llm_cases
import numpy as np
import pytest
from test_dedup import LOWER, brute_lines, groups, shingles
from test_text import base, buckets

from parcelflow.llm import decontamination, quality
from parcelflow.llm.kept import kept
from parcelflow.llm.queries import PACK_END_ID, tokenizer_path
from parcelflow.llm.tokens import load

#: Columns named as the stages' own, after doc_id and text.
COLUMNS = ("doc_id", "text", "n_lines", "n_dropped", "__text", "__id", "__hash", "kept", "n_chars")
SCHEMA = "doc_id bigint, text string, n_lines string, n_dropped string, " + ", ".join(
    f"`{c}` string" for c in COLUMNS[4:8]
) + ", n_chars int"
ITEM = [f"item{i}" for i in range(30)]


def table():
    rows = [(r[0], r[1]) for r in llm_cases.rows()]
    text = dict(rows)
    prose = [w for i in (0, 3, 6, 9, 12) for w in llm_cases.words(text[i])]
    leaked = [*ITEM[:14], "changed", *ITEM[15:]]
    rows += [(1000, " ".join(prose + ITEM)), (1001, " ".join(leaked + prose[5:])), (1002, " ".join(prose[9:] + ITEM[:9]))]
    toxic = [f"vile{i % 7}" for i in range(40)]
    rows += [(2000 + k, " ".join(toxic[k:] + [f"t{k}x{i}" for i in range(8)])) for k in range(12)]
    return [(i, t, "a", f"b{i}", "c", "d", "e", "f", len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(table(), SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(r[0] < 2000)) for r in table() if r[0] is not None and r[0] % 2 == 0]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    items = [(1, " ".join(ITEM)), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rules(rows):
    trusted = {r[0] for r in table() if r[0] is not None and r[0] % 2 == 0 and r[0] < 2000}
    raw, target = Counter(), Counter()
    grams = [buckets(r[1], quality.ORDERS, quality.LEAST_BITS) for r in rows]
    for row, found in zip(rows, grams, strict=True):
        raw.update(found)
        target.update(found if row[0] in trusted else [])
    n, m, prior = sum(raw.values()), sum(target.values()), quality.PRIOR

    def score(found):
        weights = [
            math.log((target[b] + prior * m / n) / m) - math.log((raw[b] + prior) / n) for b in found
        ]
        return sum(weights) / len(weights) if weights else 0.0

    judged = [(row, base(row[1])[-1], score(found)) for row, found in zip(rows, grams, strict=True)]
    return [row for row, failed, s in judged if not failed and s >= quality.THRESHOLD]


def lines(rows):
    left = [x[-1] for x in brute_lines(rows)]
    return [(r[0], text, *r[2:-1], len(text)) for r, text in zip(rows, left, strict=True)]


def near(rows):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    first = groups(links, ids)
    return [r for r in rows if r[0] is None or first[r[0]] == r[0]]


def overlaps(text):
    """Whether a text overlaps the item at any offset."""
    doc, n = llm_cases.words((text or "").translate(LOWER)), len(ITEM)
    for offset in range(1 - n, len(doc)):
        same = np.array([0 <= offset + k < len(doc) and doc[offset + k] == w for k, w in enumerate(ITEM)])
        if same.any() and decontamination.overlap_run(same, n):
            return True
    return False


def clean(rows):
    return [r for r in rows if r[0] is None or not overlaps(r[1])]


PLAIN = {"quality_rules": rules, "line_dedup": lines, "near_dedup": near, "decontamination": clean}


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", PLAIN)
def test_stage_on_all_rows_equals_plain_python(spark, folder, name):
    """Each on the whole table, so that null and empty texts reach every stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    after = kept(dict(corpus_pipeline.STAGES)[name](spark, docs, folder), name)
    want = PLAIN[name](table())
    assert after.columns == list(COLUMNS)
    assert ordered(after.collect()) == ordered(want)
    assert ordered(want) != ordered(table())


def test_run_is_the_chain_of_stages(spark, folder):
    rows = table()
    for plain in PLAIN.values():
        rows = plain(rows)
    pieces = corpus_pipeline.run(spark, folder).collect()
    tokenizer = load(tokenizer_path())
    tokens = Counter()
    for row in rows:
        tokens[row[0]] += len(tokenizer.encode(row[1] or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for p in pieces:
        got[p["doc_id"]] += p["length"]
    assert len(rows) > 20 and got == tokens and PACK_END_ID == 2
    filled = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(filled.values()) <= 4096


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        assert after.count() == 0
        assert name == "packing" or after.columns == docs.columns
