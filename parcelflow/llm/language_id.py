"""Language of each document, and of each span of mixed-language text.

A word's script, by Unicode ranges, narrows the languages it may belong to; byte
n-grams inside the word score those.  Viterbi over the words, with a penalty for each
switch of language, labels spans; the language with most letters is the document's,
and its share of the letters the score.

The model is counted by Spark on a bounded sample of labelled rows: about
``TRAINING_DOCUMENTS`` of each language where there are more, taken by the hash of
doc_id.  It has 2^16 buckets a language, which is what reaches the driver.

Defined cases: ``und`` with score 0 where a text is null or has no letter, or where
nothing was learned; of equal languages the first by name wins; rows without a
doc_id are not learned from and count as not held out; rows that repeat are judged
alike; an empty table gives an empty result.  Only the columns named are read, and for a
prediction the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import words

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
PRIOR = 0.5
SWITCH = 12.0
TRAINING_DOCUMENTS = 10_000
UNKNOWN = "und"

#: First code points of Unicode ranges, and the script from there on.
SCRIPT_STARTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x005B, "other"), (0x0061, "latin"),
    (0x007B, "other"), (0x00C0, "latin"), (0x0250, "other"), (0x0370, "greek"),
    (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
)
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
_SCRIPT_AT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
#: A language uses a script if at least this share of its words is in it.
SCRIPT_SHARE = 0.001

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # bucket, language
    allowed: np.ndarray  # script, language


class _Words(NamedTuple):
    """Distinct words of a slice, and where they stand."""

    row: np.ndarray  # row of each word
    which: np.ndarray  # its distinct word
    letters: np.ndarray  # letters of each distinct word
    script: np.ndarray
    buckets: list[np.ndarray]  # by order: n-gram buckets, in order of words
    owners: list[np.ndarray]  # by order: the word of each n-gram


def _distinct_words(raw: np.ndarray, off: np.ndarray) -> _Words:
    starts, ends, row = words.spans(raw, off)
    _, first, which = np.unique(
        words.word_hashes(raw, starts, ends), return_index=True, return_inverse=True
    )
    starts, ends = starts[first], ends[first]
    # The distinct words side by side, a space before and after each.
    sizes = ends - starts + 2
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(int(sizes.sum())) - begin[owner]
    edge = (inside == 0) | (inside == sizes[owner] - 1)
    text = np.where(edge, 32, raw[np.clip(starts[owner] + inside - 1, 0, max(len(raw) - 1, 0))])
    text = words.lower(text.astype(np.uint8)) if len(text) else np.zeros(0, np.uint8)
    letter = _LETTER[text] if len(text) else np.zeros(0, bool)
    text = np.where(letter, text, 32).astype(np.uint64)
    head = letter & ((text & np.uint64(0xC0)) != 0x80)
    letters = np.bincount(owner[head], minlength=len(sizes))
    buckets, owners = [], []
    for n in ORDERS:
        count = max(len(text) - n + 1, 0)
        value = np.full(count, n, np.uint64)
        for k in range(n):
            value = (value << np.uint64(8)) | text[k : k + count]
        good = owner[:count] == owner[n - 1 :][:count]
        good &= letter[:count] | (letter[n - 1 :][:count] if n > 1 else letter[:count])
        buckets.append((words.mix(value[good]) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[:count][good])
    return _Words(row, which, letters, _scripts(text, head, owner, len(sizes)), buckets, owners)


def _scripts(text: np.ndarray, head: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Script of the first letter of each word."""
    at = np.flatnonzero(head)
    _, first = np.unique(owner[at], return_index=True)
    at = at[first]
    padded = np.append(text, np.zeros(3, np.uint64)).astype(np.int64)
    a, b, c = padded[at], padded[at + 1] & 0x3F, padded[at + 2] & 0x3F
    points = np.where(
        a < 0x80, a, np.where(a < 0xE0, (a & 0x1F) << 6 | b, (a & 0x0F) << 12 | b << 6 | c)
    )
    points = np.where(a >= 0xF0, 0x20000, points)
    found = np.full(count, SCRIPTS.index("other"))
    found[owner[at]] = _SCRIPT_AT[np.searchsorted(_STARTS, points, "right") - 1]
    return found


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = TRAINING_DOCUMENTS,
) -> Model:
    """Count n-grams and scripts of the labelled rows given, sampled to the bound."""
    rows = docs.select(
        F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).filter("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    steps = 1 << 20
    parts = {k: min(steps, per_language * steps // n) for k, n in totals.items()}
    if not parts:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool))
    part = F.create_map(*[x for k, v in parts.items() for x in (F.lit(k), F.lit(v))])
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(steps)) < part[F.col("lang")])
    width = BUCKETS + len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch, raw, off in words.slices(batches, "text"):
            found = _distinct_words(raw, off)
            langs = np.array(batch.column(0).to_pylist(), object)
            for name in dict.fromkeys(langs):
                mine = (langs == name)[found.row]
                times = np.bincount(found.which[mine], minlength=len(found.letters))
                total = held.setdefault(name, np.zeros(width))
                for b, o in zip(found.buckets, found.owners, strict=True):
                    total[:BUCKETS] += np.bincount(b, weights=times[o], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(
                    found.script, weights=times * (found.letters > 0), minlength=len(SCRIPTS)
                )
        yield from _rows_of(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[name] = held.get(name, 0) + np.frombuffer(data)
        yield from _rows_of(held)

    schema = "lang string, counts binary"
    merged = (
        sample.select("lang", "text")
        .mapInArrow(count, schema)
        .repartition(len(parts), "lang")
        .mapInArrow(add, schema)
        .collect()
    )
    counts = {r["lang"]: np.frombuffer(r["counts"]) for r in merged}
    languages = sorted(counts)
    table = np.stack([counts[k] for k in languages], axis=1)
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    weights = np.log(grams + PRIOR) - np.log(grams.sum(axis=0) + PRIOR * BUCKETS)
    weights -= weights.mean(axis=1, keepdims=True)
    return Model(languages, weights, scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))


def _rows_of(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, total in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([total.astype(np.float64).tobytes()], pa.binary())],
            names=["lang", "counts"],
        )


def word_scores(found: _Words, model: Model) -> np.ndarray:
    """Score of each distinct word (row) in each language (column)."""
    count, width = len(found.letters), len(model.languages)
    total = np.zeros((count, width))
    for b, o in zip(found.buckets, found.owners, strict=True):
        for k in range(width):
            total[:, k] += np.bincount(o, weights=model.weights[b, k], minlength=count)
    allowed = model.allowed[found.script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    total = np.where(allowed, total, total.min(axis=1, keepdims=True) - SWITCH)
    return np.where((found.letters > 0)[:, None], total, 0.0)


def viterbi(scores: np.ndarray, which: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
            penalty: float) -> np.ndarray:
    """Language of each word; all documents advance a word at a time together."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    width = scores.shape[1]
    state = np.zeros((len(sizes), width))
    own = np.arange(width, dtype=np.int16)
    back: list[np.ndarray] = []
    for t in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -t, "left"))
        now = state[:live]
        best = now.argmax(axis=1)
        top = now[np.arange(live), best][:, None] - penalty
        back.append(np.where(top > now, best[:, None].astype(np.int16), own))
        state[:live] = np.maximum(now, top) + scores[which[starts[:live] + t]]
    labels = np.zeros(len(which), np.int16)
    current = state.argmax(axis=1) if len(state) else np.zeros(0, int)
    for t in range(len(back) - 1, -1, -1):
        live = len(back[t])
        labels[starts[:live] + t] = current[:live]
        current[:live] = back[t][np.arange(live), current[:live]]
    return labels


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    doc_id: str = "doc_id",
    penalty: float = SWITCH,
    with_spans: bool = True,
) -> DataFrame:
    """doc_id, lang_pred, score, and the spans: first word and language of each (null
    unless asked for); a row for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("first_word", pa.int64()), ("lang", pa.string())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        width = len(model.languages)
        for rows, raw, off in words.slices(batches, "text"):
            found = _distinct_words(raw, off)
            count = rows.num_rows
            sizes = np.bincount(found.row, minlength=count)
            starts = np.cumsum(sizes) - sizes
            lettered = np.bincount(found.row, weights=found.letters[found.which], minlength=count) > 0
            for i in np.flatnonzero(lettered & ~_has_ascii_letter(raw, off)):
                lettered[i] = any(map(str.isalpha, rows.column(1)[int(i)].as_py()))
            best, score, spans = np.full(count, width), np.zeros(count), [None] * count
            if width and len(found.row):
                scores = word_scores(found, model)
                labels = viterbi(scores, found.which, starts, sizes, penalty)
                weight = np.zeros((count, width))
                np.add.at(weight, (found.row, labels), found.letters[found.which])
                best = np.where(lettered, weight.argmax(axis=1), width)
                score = np.where(
                    lettered, weight.max(axis=1) / np.maximum(weight.sum(axis=1), 1), 0.0
                )
                if with_spans:
                    change = np.r_[True, (labels[1:] != labels[:-1]) | (found.row[1:] != found.row[:-1])]
                    spans = [[] for _ in range(count)]
                    for at in np.flatnonzero(change):
                        r = found.row[at]
                        spans[r].append(
                            {"first_word": int(at - starts[r]), "lang": names[labels[at]]}
                        )
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(names[best], pa.string()),
                    pa.array(score),
                    pa.array(spans, span_type),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        label,
        f"doc_id {kind}, lang_pred string, score double, "
        "spans array<struct<first_word: bigint, lang: string>>",
    )


def _has_ascii_letter(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    sums = np.r_[0, np.cumsum(letter[raw])]
    return sums[off[1:]] > sums[off[:-1]]


def held_out(doc_id: str):
    """Whether a document is kept from learning: crc32 of its id modulo 4 is 2."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))
