"""Near, line and substring dedup against brute force."""

import hashlib
from collections import defaultdict

import llm_cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import bloom, line_dedup, near_dedup, substring_dedup
from parcelflow.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    w = llm_cases.words((text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def groups(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(docs, texts):
    sets = {i: shingles(t) for i, t in llm_cases.by_id(texts).items()}
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    want = groups(links, ids)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(texts)
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert row["component_id"] == want[row["doc_id"]]
            assert row["n_shingles"] == len(sets[row["doc_id"]])
            assert row["kept"] == (row["doc_id"] == row["component_id"])
    assert len({c for c in want.values()}) < len(ids)


def test_a_chain_whose_ends_differ_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    chain = []
    for i in range(12):
        chain.append((100 - i, " ".join(words)))
        words = words[8:] + [f"n{i}_{k}" for k in range(8)]
    docs = spark.createDataFrame(chain, "doc_id bigint, text string")
    assert {r["component_id"] for r in near_dedup.near_duplicates(docs).collect()} == {89}


def test_members_across_components_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = [f"w{i}" for i in range(120)]
    table = []
    for i in range(40):  # 40 copies, each with a word of its own changed: a dense group
        copy = list(base)
        copy[3 * i] = f"own{i}"
        table.append((i, " ".join(copy)))
    sets = {i: shingles(t) for i, t in table}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == groups(links, list(sets))


def test_estimates_are_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:])
    bits = near_dedup.packed_bits(np.stack([near_dedup.minima(a), near_dedup.minima(b)]))
    frame = spark.createDataFrame(
        [(bits.view(np.int64)[0].tolist(), bits.view(np.int64)[1].tolist())],
        "x array<bigint>, y array<bigint>",
    )
    assert abs(frame.select(near_dedup.estimate("x", "y")).first()[0] - 0.5) < 0.16


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7), (300, 301)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100, 300: 300, 301: 300}


def brute_lines(texts):
    holders = defaultdict(set)
    for row in texts:
        for line in (row[1] or "").split("\n"):
            key = line.strip(WHITE).translate(LOWER)
            if len(key) >= 20:
                holders[key].add(row[0])
    keeper = {
        k: max((d for d in ids if d is not None), default=None)
        for k, ids in holders.items() if len(ids) >= 3
    }
    out = []
    for row in texts:
        lines = (row[1] or "").split("\n")
        stay = [
            x for x in lines
            if (k := x.strip(WHITE).translate(LOWER)) not in keeper or keeper[k] == row[0]
        ]
        out.append((row[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("bits", [1 << 8, 1 << 20])
def test_lines_equal_brute_force_however_full_the_filter(docs, texts, bits):
    got = line_dedup.dedup_lines(docs, filter_bits=bits)
    assert got.columns.count("n_lines") == 1
    rows = got.select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(brute_lines(texts), key=repr)
    assert sum(r["n_dropped"] for r in rows) > 0


def test_filters_lose_nothing(spark):
    once, twice = bloom.build(
        spark.createDataFrame([([i, i + 1],) for i in range(0, 4000, 1)], "hashes array<bigint>"),
        1 << 16,
    )
    keys = np.arange(1, 4000).astype(np.uint64)
    assert bloom.holds(once, keys).all() and bloom.holds(twice, keys).all()
    few = bloom.build(spark.range(10).select(F.array(F.xxhash64("id")).alias("h")), 1 << 16)[1]
    assert not few.any()


def brute_substrings(texts):
    window = substring_dedup.WINDOW
    parts = {i: llm_cases.words(t) for i, t in llm_cases.by_id(texts).items()}
    first = {}
    for i in sorted(parts):
        for k in range(len(parts[i]) - window + 1):
            first.setdefault(tuple(parts[i][k : k + window]), (i, k))
    out = {}
    for i, w in parts.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] != (i, k):
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_substrings_equal_brute_force(docs, texts):
    want = brute_substrings(texts)
    got = substring_dedup.removal_digests(docs).collect()
    assert len(got) == len(texts)
    for row in got:
        if row["doc_id"] is not None:
            assert tuple(row[1:]) == want[row["doc_id"]]
        else:
            assert row["n_removed"] == 0
    assert sum(0 < r["n_removed"] < r["n_words"] for r in got) > 5


def test_of_unequal_rows_with_one_id_one_stands(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, text), (1, "x " * 40), (2, text), (2, text)], "doc_id bigint, text string"
    )
    got = substring_dedup.removal_digests(docs).collect()
    assert len(got) == 4
    assert sorted(r["n_removed"] for r in got if r["doc_id"] == 2) in ([0, 0], [40, 40])


def test_cover_meets_every_pair_of_places():
    period, cover = substring_dedup.PERIOD, substring_dedup.COVER
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_empty_tables(empty):
    assert near_dedup.near_duplicates(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert substring_dedup.removal_digests(empty).count() == 0
