"""Periodic runs, pivot distance tables and hard negatives against brute force."""

import hashlib
import random
import zlib

import llm_cases
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm import hard_negatives, periodic_runs, pivot_dedup, words


def plain_runs(w):
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            part = w[s : s + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_runs(lists):
    x = np.array([v for w in lists for v in w], np.uint64)
    x = words.mix(x + np.uint64(5)) if len(x) else x
    sizes = [len(w) for w in lists]
    row, base = np.repeat(np.arange(len(lists)), sizes), np.cumsum([0, *sizes])
    got = [[] for _ in lists]
    for r, s, length, q in periodic_runs.find_runs(x, row).tolist():
        got[r].append((s - int(base[r]), length, q))
    return got


_piece = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 8), st.integers(0, 5))
_words = st.lists(_piece, max_size=5).map(lambda ps: [v for p, k, cut in ps for v in (p * k)[: len(p) * k - cut]])


@settings(max_examples=300, deadline=None)
@given(st.lists(_words, max_size=4))
def test_runs_equal_plain_search(lists):
    assert found_runs(lists) == [plain_runs(w) for w in lists]


def test_periods_within_periods():
    inner = ([1, 2, 3] * 5 + [9]) * 5  # runs of 3 inside one of 16
    lists = [inner, [7] * 50, [7] * 5, [7] * 6, [1, 2] * 4, [1, 2] * 3 + [1], list(range(40)) * 4, [1, 1, 2] * 9]
    got = found_runs(lists)
    assert got == [plain_runs(w) for w in lists]
    assert (0, 80, 16) in got[0] and got[1] == [(0, 50, 1)] and got[2] == [] and got[3] == [(0, 6, 1)]


def test_one_word_many_times_is_linear():
    assert found_runs([[3] * 200_000]) == [[(0, 200_000, 1)]]


def plain_planted(doc_id, text):
    w = llm_cases.words(text)
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_run_digests_equal_plain(spark, texts, docs):
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.planted(docs)))
    want = []
    for row in texts:
        w = plain_planted(row[0], row[1])
        runs = plain_runs(w)
        drop = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want.append((
            row[0], len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest(),
        ))
    assert sum(w[1] > 0 for w in want) > 5
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_runs_keep_ids_of_any_type(spark, empty):
    table = spark.createDataFrame([("x", "a a a a a a b"), (None, None), ("y", "")], "doc_id string, text string")
    rows = {r["doc_id"]: r for r in periodic_runs.periodic_runs(table).collect()}
    assert rows["x"]["collapsed"] == "a b" and [tuple(r) for r in rows["x"]["runs"]] == [(0, 6, 1)]
    assert rows[None]["n_words"] == 0 and rows[None]["runs"] == [] and rows["y"]["collapsed"] == ""
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(empty)).count() == 0


def plain_fingerprint(text):
    w = [p.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for p in llm_cases.words(text)]
    if not w:
        return 0
    parts = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values):
    """For each value, the smallest place it reaches by steps of two bits at most."""
    values = np.array(values, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    place = np.arange(len(values))
    while True:
        least = np.where(near, place[None, :], len(values)).min(axis=1)
        if (least == place).all():
            return place
        place = least


def linked(values):
    values = np.array(sorted(set(values)), np.uint64)
    place = {int(v): i for i, v in enumerate(values)}
    edges = []
    for n, apart in enumerate(pivot_dedup.combinations(range(8), 2)):
        free = np.uint64(sum(0xFF << (8 * b) for b in apart))
        order = np.lexsort((values, values & ~free))
        a, b = pivot_dedup.links_within(np.full(len(values), n), (values & ~free)[order], values[order])
        edges += [(place[int(i)], place[int(k)]) for i, k in zip(a, b, strict=True)]
    groups = pivot_dedup._Groups(len(values))
    if edges:
        groups.join(*map(np.array, zip(*edges, strict=True)))
    return values, groups.least


@pytest.mark.parametrize("seed", range(8))
def test_links_equal_all_pairs(seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(4)]
    values = []
    for _ in range(rng.choice([50, 400, 1200])):
        value = rng.choice(base)
        for _ in range(rng.randint(0, 4)):
            value ^= 1 << rng.randrange(rng.choice([10, 16, 64]))
        values.append(value)
    values, got = linked(values)
    assert (got == roots(values)).all()


def test_whole_meeting_of_a_byte_pair():
    values, got = linked([(i * 3) & 0xFFFF for i in range(3000)])
    assert (got == roots(values)).all()


def test_simhash_equals_plain(spark, texts, docs):
    got = pivot_dedup.near_duplicates(docs).collect()
    prints = [plain_fingerprint(row[1]) for row in texts]
    place = roots(prints)
    least = {}
    for row, p in zip(texts, place, strict=True):
        if row[0] is not None:
            least[p] = min(least.get(p, row[0]), row[0])
    want = [(row[0], f"{f:016x}", least.get(p)) for row, f, p in zip(texts, prints, place, strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert len({w[2] for w in want}) < len(want)


def test_simhash_of_nothing(spark, empty):
    assert pivot_dedup.near_duplicates(empty).count() == 0
    lone = spark.createDataFrame([(None, "x"), (None, None)], "doc_id string, text string")
    assert [r["component_id"] for r in pivot_dedup.near_duplicates(lone).collect()] == [None, None]


def test_hash_is_that_of_spark(spark):
    text = "un été à la mer"
    assert spark.range(1).selectExpr(f"xxhash64('{text}') AS h").first()["h"] == np.uint64(
        xxhash.xxh64_intdigest(text.encode(), pivot_dedup.SEED)
    ).astype(np.int64)


def plain_negatives(rows, each=100):
    whole = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        if any(abs(x) > 2 ** 29 for x in q):
            continue
        made = ((label + 1) % 10 if i % 7 == 0 else label, q)
        whole[i] = min(whole.get(i, made), made)
    out = []
    for a, (label, v) in whole.items():
        if a % each:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, l) for i, (l, w) in whole.items() if i != a and len(w) == len(v)
        )
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, p, n, r[1], -s, -r[0]) for n, r in enumerate(fit, 1)]
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<float>, label int, rank string, score string, block string"


def mined(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, "r", "s", "b") for i, label, v in rows], VECTORS).repartition(4)
    found = hard_negatives.hard_negatives(hard_negatives.whole_vectors(table), **options)
    return sorted(map(tuple, found.collect()))


def test_negatives_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "GROUP", 3)
    monkeypatch.setattr(hard_negatives, "CHUNK", 4)
    monkeypatch.setattr(hard_negatives, "TOGETHER", 1)
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 4)), rng.normal(0, 0.3, 8).tolist()) for i in range(500)]
    hot = rng.normal(0, 0.3, 8).tolist()
    rows += [(i, 2 + (i % 5 == 0), hot) for i in range(500, 900)]  # ties: one vector many times
    rows += [(i, i % 3, [0.0] * 8) for i in range(900, 930)]
    rows += [(i, i % 2, rng.normal(0, 1, 3).tolist()) for i in range(1000, 1030)]
    rows += [(i, i % 2, []) for i in range(1100, 1110)]
    rows += [
        (None, 1, hot), (1200, None, hot), (1300, 1, None), (1400, 1, [None] * 8), (1500, 1, [float("nan")] * 8),
        (1600, 1, [float("inf")] * 8), (1700, 1, [1e30] * 8), rows[0], rows[0], (100, 9, hot), (-100, 1, hot), (-7, -3, hot),
    ]
    got = mined(spark, rows)
    assert len(got) > 100 and got == plain_negatives(rows)
    blocks = hard_negatives.blocks(hard_negatives.whole_vectors(spark.createDataFrame(
        [(i, v, label, "r", "s", "b") for i, label, v in rows[:500]], VECTORS)), 64)
    assert blocks.selectExpr("max(size(ids)) AS n").first()["n"] <= 64


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5, 0.5])]) == []
    assert mined(spark, [(100, 1, [0.5, 0.5]), (200, 1, [0.5, 0.25])]) == []


def test_bounds_hold_every_score():
    rng = np.random.default_rng(9)
    rows, anchors = rng.integers(-90, 90, (200, 6)), rng.integers(-90, 90, (30, 6))
    least, most = hard_negatives.bounds(anchors, rows.min(axis=0)[None], rows.max(axis=0)[None])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()


def test_far_blocks_are_not_read(spark):
    """Two tight, distant clouds: the anchors of one read no block of the other for positives."""
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [1.0 + rng.normal(0, 0.01), 0.0]) for i in range(0, 1200, 2)]
    rows += [(i, i % 2, [-1.0 + rng.normal(0, 0.01), 0.0]) for i in range(1, 1200, 2)]
    table = spark.createDataFrame([(i, v, 1, "r", "s", "b") for i, _, v in rows], VECTORS)
    stored = hard_negatives.kept(hard_negatives.blocks(hard_negatives.whole_vectors(table), 32), "blocks")
    groups = hard_negatives.kept(hard_negatives.anchor_groups(stored), "anchors")
    chosen = hard_negatives.choose(groups, stored, True)
    asked = groups.selectExpr("sum(size(asked)) AS n").first()["n"] * stored.count()
    assert chosen.selectExpr("sum(size(asked)) AS n").first()["n"] < 0.6 * asked


def test_curve_is_a_path():
    for dims, bits in ((2, 3), (3, 2), (5, 1)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(side)] * dims)).reshape(dims, -1).T
        keys = hard_negatives.hilbert_keys(cells, bits)
        assert len(set(keys)) == side**dims
        path = cells[np.argsort(np.array([int.from_bytes(k) for k in keys]))]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
