"""URL filters: a bit-parallel automaton over all glob rules at once.

A url is made canonical as a dot, its host (A-Z lower-cased) and its path.  Every
rule is a glob over that; the places of all globs stand side by side as bits in a
few 64-bit words, and one Shift-And step for each character moves all rules of
all urls of a slice together.

In a glob, ``*`` stands for any run of characters without a slash, ``**`` for
any run, ``?`` for one character but a slash.  A rule (host, path) is the glob
``*.host`` + path + ``**``: the host and its subdomains, paths that start so.  Of the
rules that fit, the one with the most characters decides; of equally long ones, the
one with the longer host, then the first by name.

Defined cases: a null url, or one without ``://``, has an empty host and path; no
rule fits it and the verdict is the default; rows that repeat are judged
alike; an empty table gives an empty result.  Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.words import LOWER_TABLE

ANY, INNER, ONE = -1, -2, -3


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


def _symbols(glob: str) -> list[int]:
    found, i = [], 0
    while i < len(glob):
        if glob.startswith("**", i):
            found.append(ANY)
            i += 2
            continue
        found.append({"*": INNER, "?": ONE}.get(glob[i], ord(glob[i])))
        i += 1
    return found


class Automaton:
    """Masks of all globs.  A place is the state before or after a character; a
    state with a loop is a star.

    ``step[c]``: states entered on character class c; ``loop[c]``: states kept.
    """

    def __init__(self, globs: list[str]) -> None:
        patterns = [_symbols(g) for g in globs]
        letters = sorted({s for p in patterns for s in p if s >= 0} | {ord("/")})
        self.letters = np.array(letters, np.uint32)
        states = sum(1 + sum(s not in (ANY, INNER) for s in p) for p in patterns)
        self.words = -(-states // 64)
        classes = len(letters) + 1  # the last: any other character
        step = np.zeros((classes, states), bool)
        loop = np.zeros((classes, states), bool)
        first = np.zeros(states, bool)
        final, at = [], 0
        slash = letters.index(ord("/"))
        for pattern in patterns:
            first[at] = True
            for s in pattern:
                if s == ANY:
                    loop[:, at] = True
                elif s == INNER:
                    loop[:, at] = True
                    loop[slash, at] = False
                else:
                    at += 1
                    if s == ONE:
                        step[:, at] = True
                        step[slash, at] = False
                    else:
                        step[letters.index(s), at] = True
            final.append(at)
            at += 1
        self.step, self.loop = self._masks(step), self._masks(loop)
        self.first = self._masks(first[None, :])[0]
        self.final = [(f // 64, np.uint64(f % 64)) for f in final]

    def _masks(self, table: np.ndarray) -> np.ndarray:
        full = np.zeros((len(table), self.words * 64), np.uint8)
        full[:, : table.shape[1]] = table
        return np.packbits(full, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def classes(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, len(self.letters))

    def match(self, texts: list[str]) -> np.ndarray:
        """Which glob (column) fits which text (row), whole."""
        raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(t) for t in texts], np.int64)
        kinds = self.classes(raw.astype(np.uint32))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        state = np.tile(self.first, (len(texts), 1))
        one = np.uint64(1)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -t, "left"))  # texts longer than t
            kind = kinds[starts[:live] + t]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[kind]) | (now & self.loop[kind])
        fits = np.empty((len(texts), len(self.final)), bool)
        for i, (word, bit) in enumerate(self.final):
            fits[order, i] = (state[:, word] >> bit) & one
        return fits


def canonical(url: str | None) -> tuple[str, str]:
    """Host and path."""
    head, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return host.encode("utf-8", "surrogatepass").translate(LOWER_TABLE).decode("utf-8", "surrogatepass"), rest[:stop]


def judge(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    page_id: str = "page_id",
    default: str = "allow",
) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict; a row for each row."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([r.glob for r in ranked]) if ranked else None
        names = np.array([r.name for r in ranked] + [None], object)
        verdicts = np.array([r.verdict for r in ranked] + [default], object)
        for batch in batches:
            parts = [canonical(u) for u in batch.column(1).to_pylist()]
            texts = [f".{h}{p}" for h, p in parts]
            best = np.full(len(parts), len(ranked))
            if automaton is not None and texts:
                fits = automaton.match(texts)
                best = np.where(fits.any(axis=1), fits.argmax(axis=1), len(ranked))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array(names[best], pa.string()),
                    pa.array(verdicts[best], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    kind = chosen.schema["page_id"].dataType.simpleString()
    return chosen.mapInArrow(
        decide, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


#: The rules of the registered query.
RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]

ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), part AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)
), judged AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM part
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
