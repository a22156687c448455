"""URL filters, decontamination, packing and token counts."""

import re
import zlib

import llm_cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm import decontamination, packing, token_counts, url_filter
from parcelflow.llm.queries import PACK_END_ID, SEPARATOR_ID, tokenizer_path
from parcelflow.llm.tokens import load


def fits(glob, text):
    pattern = "".join(
        ".*" if p == "**" else "[^/]*" if p == "*" else "[^/]" if p == "?" else re.escape(p)
        for p in re.findall(r"\*\*|\*|\?|[^*?]+", glob)
    )
    return re.fullmatch(pattern, text, re.S) is not None


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.text("ab./*?é", max_size=9), min_size=1, max_size=12),
    st.lists(st.text("abc./é", max_size=12), max_size=12),
)
def test_automaton_equals_regular_expressions(globs, texts):
    got = url_filter.Automaton(globs).match(texts)
    for t, row in zip(texts, got, strict=True):
        assert row.tolist() == [fits(g, t) for g in globs], (t, globs)


def test_many_rules_span_words():
    globs = [f"*.host{i}.example/path{i}/**" for i in range(40)]
    automaton = url_filter.Automaton(globs)
    assert automaton.words > 8
    got = automaton.match([".www.host7.example/path7/x", ".host39.example/path39/", ".host1.example/"])
    assert [np.flatnonzero(r).tolist() for r in got] == [[7], [39], []]


URLS = [
    (1, "https://Example.COM/en/x?q#f"), (2, "http://www.example.com/en/"), (3, "http://example.com"),
    (4, "http://a.net/es/1"), (5, "http://net/fr/"), (6, "http://notexample.com/en/"), (7, None),
    (8, "no scheme"), (9, ""), (10, "x://a.org/http://b.com/"), (11, "http://evil.org/a.example.com/en/"),
    (12, "http://exämple.com/é"), (13, "http://a.com/" + "y" * 5000), (1, "https://Example.COM/en/x?q#f"),
    (None, "http://b.com/"), (14, "://?x"),
]


def test_urls_equal_plain_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string").selectExpr("*", "1 AS rule", "2 AS host")
    got = sorted(map(tuple, url_filter.judge(pages, url_filter.RULES).collect()), key=repr)
    want = []
    for i, url in URLS:
        host, path = url_filter.canonical(url)
        fit = [
            r for r in url_filter.RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        best = max(fit, key=lambda r: len(r.name), default=None)
        want.append((i, host, path, best and best.name, best.verdict if best else "allow"))
    assert got == sorted(want, key=repr)
    assert url_filter.judge(pages.limit(0), url_filter.RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}


ITEM = [f"item{i}" for i in range(40)]


def leaks():
    other = [f"own{i}" for i in range(60)]
    changed = list(ITEM)
    for k in (5, 14, 23, 33):
        changed[k] = "else"
    scattered = [w if i % 3 else "else" for i, w in enumerate(ITEM)]
    return [
        (1, " ".join(other + ITEM + other)),
        (2, " ".join(w.upper() for w in ITEM[:20]) + " " + " ".join(other)),
        (3, " ".join(other + changed)),
        (4, " ".join(other)), (5, " ".join(ITEM[:9] + other)), (6, None), (7, ""),
        (8, " ".join(scattered)), (None, " ".join(ITEM)), (1, " ".join(other + ITEM + other)),
        (9, " ".join(other * 200 + ITEM)),
    ]


def test_decontamination_finds_exact_partial_and_changed_overlaps(spark):
    docs = spark.createDataFrame(leaks(), "doc_id bigint, text string").selectExpr("*", "1 AS item_id")
    items = [(1, " ".join(ITEM)), (2, " ".join(ITEM)), (3, "short item"), (4, None), (None, "x " * 30)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.overlaps(docs, benchmark).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert len(rows) == len(got)
    assert set(got) == {(d, i) for d in (1, 2, 3, 9) for i in (1, 2)}
    assert tuple(got[1, 1][2:]) == (60, 0, 40, 40, 40)
    assert got[2, 1]["n_matches"] == 20
    assert got[3, 1]["n_matches"] == 36 and got[9, 2]["doc_start"] == 12000
    assert decontamination.overlaps(docs.limit(0), benchmark).count() == 0
    assert decontamination.overlaps(docs, benchmark.limit(0)).count() == 0


def test_seeds_hit_whatever_single_word_is_changed():
    x = np.arange(1, 25, dtype=np.uint64)
    for k in range(24):
        y = x.copy()
        y[k] = 99
        assert any(
            (decontamination.seed_hashes(x, s) == decontamination.seed_hashes(y, s)).any()
            for s in decontamination.SEEDS
        )


def missed(length):
    """Patterns of matches over an item of this length that count but have no hit."""
    same = (np.arange(1 << length)[:, None] >> np.arange(length)) & 1 == 1
    hit = np.zeros(len(same), bool)
    for seed in decontamination.seeds_for(length):
        looked = [i for i, c in enumerate(seed) if c == "1"]
        for at in range(length - len(seed) + 1):
            hit |= same[:, [at + i for i in looked]].all(axis=1)
    return [p for p in same[~hit] if p.any() and decontamination.overlap_run(p, length)]


@pytest.mark.parametrize("length", range(1, 18))
def test_items_are_hit_wherever_the_verifier_accepts(length):
    assert missed(length) == []


def hit(same):
    return any(
        all(same[at + i] for i, c in enumerate(seed) if c == "1")
        for seed in decontamination.seeds_for(len(same))
        for at in range(len(same) - len(seed) + 1)
    )


@pytest.mark.parametrize("length", [20, 30, 40, 60])
def test_dense_patterns_are_hit(length):
    rng = np.random.default_rng(length)
    for phase in range(5):
        same = np.arange(length) % 5 != phase
        assert decontamination.overlap_run(same, length) and hit(same)
    accepted = 0
    for _ in range(4000):
        same = rng.permutation(np.arange(length) >= rng.integers(1, length // 4 + 1))
        if decontamination.overlap_run(same, length):
            accepted += 1
            assert hit(same)
    assert accepted > 500


def test_decontamination_finds_every_fifth_word_changed(spark):
    rows = [(p, " ".join("else" if i % 5 == p else w for i, w in enumerate(ITEM))) for p in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, " ".join(ITEM))], "item_id bigint, text string")
    found = {r["doc_id"]: r["n_matches"] for r in decontamination.overlaps(docs, benchmark).collect()}
    assert set(found) == set(range(5))


def test_decontamination_finds_short_items(spark):
    own = [f"own{i}" for i in range(30)]
    short = {n: [f"s{n}w{i}" for i in range(n)] for n in range(1, 12)}
    rows = [(n, " ".join(own + item + own + [w.upper() for w in item])) for n, item in short.items()]
    rows += [(20, " ".join([*short[11][:5], "else", *short[11][6:], *own]))]
    rows += [(21, " ".join([*own, *short[10][1:9]])), (22, " ".join([*short[5][:4], *own]))]
    rows += [(23, " ".join([*short[4][:3], *own])), (24, " ".join([*short[9][:6], *own])), (25, " ".join(own))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(
        [(n, " ".join(item)) for n, item in short.items()] + [(30, ""), (31, " ")], "item_id bigint, text string"
    )
    got = {(r[0], r[1]): tuple(r[2:]) for r in decontamination.overlaps(docs, benchmark).collect()}
    want = {(n, n): (30, 0, n, n, n) for n in short}
    want |= {(20, 11): (0, 0, 11, 10, 11), (21, 10): (30, 1, 8, 8, 10), (22, 5): (0, 0, 4, 4, 5)}
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    used = {}
    for pattern, count in patterns:
        assert count > 0 and sum(pattern) <= 64
        for length in pattern:
            used[length] = used.get(length, 0) + count
    assert used == histogram


@pytest.mark.parametrize("limit", [64, 4096])
def test_pieces_round_trip(docs, texts, limit):
    tokenizer = load(tokenizer_path())
    whole = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [PACK_END_ID]
             for i, t in llm_cases.by_id(texts).items()}
    rows = packing.pack(docs, tokenizer_path(), PACK_END_ID, limit).collect()
    sequences = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] <= limit and zlib.crc32(r["ids"]) == r["ids_crc32"]
        if r["doc_id"] is not None:
            assert ids.tolist() == whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(whole[r["doc_id"]])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["start"] == 0 for r in rows) == len(texts)
    assert sum(r["length"] for r in rows) == sum(
        len(tokenizer.encode(t[1] or "", add_special_tokens=False).ids) + 1 for t in texts
    )
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= limit


def test_piecewise_ids_are_the_tokenizer_s(spark):
    from parcelflow.llm.tokens import PieceEncoder
    import pyarrow as pa

    odd = ["a|b c", "it's  we'll\tX\x0bY", "|", " | ", "<|endoftext|> é\u0301 \u0301x", None, "", "\n\n",
           "日本語 text", "Σίσυφος ΣΑΣ", "x" * 3000, "a\u00a0b\u2003c", "<|startoftext|>|<|endoftext|>"]
    for literal in (False, True):
        tokenizer = load(tokenizer_path(), literal)
        flat, counts = PieceEncoder(tokenizer_path(), literal).encode(pa.array(odd))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in odd]
        assert counts.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("block_ids", [7, 1 << 18])
def test_token_counts_across_blocks(docs, texts, block_ids):
    tokenizer = load(tokenizer_path(), True)
    blocks, names = token_counts.token_files(
        docs, tokenizer_path(), SEPARATOR_ID, block_ids=block_ids
    )
    got = token_counts.count_tokens(blocks, names, SEPARATOR_ID).collect()
    want = [(r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in texts]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_scan_of_given_files(spark):
    def block(file, number, ids):
        return file, number, bytearray(np.array(ids, "<u2").tobytes())

    blocks = spark.createDataFrame(
        [block(0, 0, [1, 2, 9]), block(0, 1, [9, 9, 4]), block(0, 2, [4, 4, 4]), block(0, 3, [4, 9, 5]),
         block(1, 0, [7, 7]), block(2, 0, [9])],
        "file int, block bigint, payload binary",
    )
    got = sorted(map(tuple, token_counts.scan(blocks, 9).collect()))
    assert got == [
        (0, 0, 2, True), (0, 1, 0, True), (0, 2, 0, True), (0, 3, 5, True), (0, 4, 1, False),
        (1, 0, 2, False), (2, 0, 0, True),
    ]
    assert token_counts.scan(blocks.limit(0), 9).count() == 0


def test_empty_tables(empty):
    assert packing.pack(empty, tokenizer_path(), PACK_END_ID).count() == 0
    blocks, names = token_counts.token_files(empty, tokenizer_path(), SEPARATOR_ID)
    assert token_counts.count_tokens(blocks, names, SEPARATOR_ID).count() == 0
