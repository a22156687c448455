"""Periodic runs of words: stretches that repeat themselves four times or more.

A run is a stretch of consecutive words of one text with smallest period q (words q apart
are equal) and of at least ``max(6, 4 * q)`` words that no neighbouring word extends.  Along
the diagonal of lag q its words agree at ``max(6 - q, 3 * q)`` places in a row or more.

Lags fall into classes [2^j, 2^(j+1)).  The least overlap that a class guarantees is the
length of its seeds: 5 words for lag 1, 6 for lags 2 and 3, then ``3 * 2^j``.  A seed is a
pair of neighbouring occurrences of one k-gram in a text.  No more pairs are needed: a
seed is longer than every lag of its class, so were there an occurrence between two that lie one
smallest period apart, the run would have a smaller period (Fine and Wilf).  For the same
reason no seed has a lag that is not the smallest period of its stretch.  Each class looks only
at places whose shorter k-gram recurred in the class before, so most texts end after the first.  A seed
is extended both ways along its diagonal, once: a table of the furthest place covered under
each text and lag passes over the seeds of a stretch already known.

Work is n log n in the words of a text, which is one row; rows never meet, so there is no shuffle
and no hot key.  Words are compared by 64-bit hashes.

Defined cases: a null or empty text, or one without words, has no runs and collapses to the empty
text; doc_id may have any type, be null and repeat (each row is judged by itself); an empty table
gives an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import words

LEAST_LENGTH = 6
LEAST_REPEATS = 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"
_JOIN = np.uint64(0x9E6C63D0876A9A47)


def least_overlap(lag: int) -> int:
    """Agreeing places in a row that a run of this period has at least."""
    return max(LEAST_LENGTH - lag, (LEAST_REPEATS - 1) * lag)


def _grams(x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first lag, seed length, hash of the seed at each place) of each class of lags;
    places too near the end of ``x`` have none."""
    yield 1, least_overlap(1), words.window_hashes(x, least_overlap(1))
    lag, size = 2, least_overlap(2)
    grams = words.window_hashes(x, size)
    while len(grams):
        yield lag, size, grams
        lag *= 2
        longer = least_overlap(lag)  # twice the length before
        grams = words.mix(grams[:-size] * _JOIN + grams[size:]) if len(grams) > size else grams[:0]
        size = longer


def _extended(x: np.ndarray, at: int, lag: int, step: int, stop: int) -> int:
    """The last place from ``at`` on, going by ``step`` (1 or -1), up to which words agree with
    those ``lag`` further; ``stop`` is the first place not to be read."""
    width = 16
    while at != stop:
        reach = min(width, abs(stop - at))
        here = np.arange(at, at + step * reach, step)
        differ = np.flatnonzero(x[here] != x[here + lag])
        if len(differ):
            return at + step * int(differ[0])
        at += step * reach
        width *= 2
    return at


def find_runs(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Runs (row, start, length, period) in hashed words, by row, start and period.  ``row``
    ascends; starts count from the first word of all rows."""
    total = len(x)
    edges = np.flatnonzero(np.r_[True, row[1:] != row[:-1], True]) if total else np.zeros(1, int)
    sizes = np.diff(edges)
    first, last = np.repeat(edges[:-1], sizes), np.repeat(edges[1:], sizes)
    own = words.mix(row.astype(np.uint64) + np.uint64(1))
    alive = np.arange(total)
    found: list[tuple[int, int, int, int]] = []
    for least_lag, size, grams in _grams(x):
        alive = alive[alive + size <= last[alive]]
        if len(alive) < 2:
            break
        keys = grams[alive] ^ own[alive]
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], alive[order]
        again = (keys[1:] == keys[:-1]) & (row[at[1:]] == row[at[:-1]])
        lags = at[1:] - at[:-1]
        seeds = np.flatnonzero(again & (lags >= least_lag) & (lags < 2 * least_lag))
        found += _extend(x, row, first, last, at[seeds], lags[seeds], size)
        alive = np.sort(at[np.r_[again, False] | np.r_[False, again]])
    runs = np.array(found, np.int64).reshape(-1, 4)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _extend(
    x: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray,
    at: np.ndarray, lags: np.ndarray, size: int,
) -> list[tuple[int, int, int, int]]:
    """The runs that the seeds of a class lie in, each extended once."""
    if not len(at):
        return []
    order = np.lexsort((at, lags, row[at]))
    at, lags = at[order], lags[order]
    # Seeds side by side on a diagonal are one; only its first needs a look at the table.
    heads = np.flatnonzero(
        np.r_[True, (at[1:] != at[:-1] + 1) | (lags[1:] != lags[:-1]) | (row[at[1:]] != row[at[:-1]])]
    )
    tails = np.r_[heads[1:], len(at)] - 1
    furthest: dict[tuple[int, int], int] = {}
    runs = []
    for start, lag, end in zip(at[heads].tolist(), lags[heads].tolist(), at[tails].tolist(), strict=True):
        text = int(row[start])
        if start < furthest.get((text, lag), -1):
            continue
        right = _extended(x, end + size, lag, 1, int(last[start]) - lag)
        left = _extended(x, start - 1, lag, -1, int(first[start]) - 1) + 1
        furthest[text, lag] = right
        if right - left >= least_overlap(lag) and np.array_equal(x[left:right], x[left + lag : right + lag]):
            runs.append((text, left, right - left + lag, lag))
    return runs


def _collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words left, one space between them: of each run, its first period stays."""
    every = text.split()
    if not len(runs):
        return b" ".join(every)
    change = np.zeros(len(every) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    covered = np.cumsum(change[:-1])
    return b" ".join([every[i] for i in np.flatnonzero(covered == 0)])


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed: a row
    for each row.  Words are numbered from 0."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in words.slices(batches, "text"):
            starts, ends, row = words.spans(raw, off)
            runs = find_runs(words.word_hashes(raw, starts, ends), row)
            counts = np.bincount(row, minlength=part.num_rows)
            runs[:, 1] -= (np.cumsum(counts) - counts)[runs[:, 0]]
            bounds = np.searchsorted(runs[:, 0], np.arange(part.num_rows + 1))
            left = [
                _collapsed(raw[off[i] : off[i + 1]].tobytes(), runs[bounds[i] : bounds[i + 1], 1:])
                for i in range(part.num_rows)
            ]
            fields = [pa.array(runs[:, i]) for i in (1, 2, 3)]
            listed = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts.astype(np.int64)), listed, pa.array(left, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        judge, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
    )


def longest(runs: Column) -> Column:
    """The run with the greatest length; of equals that with the smallest start, then period."""
    ranked = F.array_min(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("rank"), r["start"], r["period"]))
    )
    return F.struct(
        ranked["start"].alias("start"), (-ranked["rank"]).alias("length"), ranked["period"].alias("period")
    )


def run_digests(found: DataFrame) -> DataFrame:
    """What ``periodic_runs`` found, as one line of numbers and digests a row."""
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    )
    listing = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("best")
    return found.withColumn("best", longest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Which texts are made periodic, from where and with what period.
PLANTED_EACH = 10


def planted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and text, where of every tenth text (by the checksum of its id) the words from some
    place on repeat a stretch.  Words of such texts are then parted by one space."""
    checksum = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    draw = F.floor(checksum / PLANTED_EACH)
    every = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), draw.alias("draw"),
        F.when(checksum % PLANTED_EACH == 0, every).alias("every"),
    )
    count = F.size("every")
    begin = (F.col("draw") % count).cast("int")
    period = (1 + F.floor((count - begin) / (3 + F.col("draw") % 8))).cast("int")
    copies = F.ceil((count - begin) / period).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("every", begin + 1, period), copies))
    made = F.slice(F.concat(F.slice("every", F.lit(1), begin), cycle), F.lit(1), count)
    return whole.select(
        "doc_id", F.when(F.coalesce(count, F.lit(0)) > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text")
    )


ORACLE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(b::BIGINT, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  )) AS step
), summed AS (
  SELECT doc_id, text, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda s, c: xor(s >> 8, step[(xor(s, c) & 255) + 1]))) AS h
  FROM documents, crc
), worded AS (
  SELECT doc_id, h, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM summed
), numbered AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made,
         CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS r
  FROM worded
), text_of AS (
  SELECT doc_id, n, CASE WHEN made THEN list_transform(range(n), lambda i:
           CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + r)) + 1] END)
         ELSE w END AS w
  FROM numbered
), word AS (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x,
         unnest(list_transform(range(n), lambda i: array_to_string(w[i+1:i+5], ' '))) AS gram
  FROM text_of
), lags AS (
  -- a run has at least five places in a row that agree, so its lag shows in a 5-gram
  SELECT DISTINCT p.doc_id, q.i - p.i AS q
  FROM word p JOIN word q ON p.doc_id = q.doc_id AND p.gram = q.gram AND p.i < q.i AND q.i + 5 <= p.n
  WHERE greatest(6, 4 * (q.i - p.i)) <= p.n
), agree AS (
  SELECT l.doc_id, l.q, a.i, a.i - row_number() OVER (PARTITION BY l.doc_id, l.q ORDER BY a.i) AS island
  FROM lags l JOIN word a ON a.doc_id = l.doc_id
  JOIN word b ON b.doc_id = l.doc_id AND b.i = a.i + l.q AND b.x = a.x
), stretch AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM agree GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), run AS (
  SELECT * FROM stretch r WHERE NOT EXISTS (
    SELECT 1 FROM stretch o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.len >= r.s + r.len)
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listing,
         first(struct_pack(s, len, q) ORDER BY len DESC, s, q) AS best
  FROM run GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run
), collapsed AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS left_over
  FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period,
       1000 * best.len // best.q AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM text_of t LEFT JOIN listed USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""
