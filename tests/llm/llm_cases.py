"""Documents that hold the awkward cases: nulls, empty and long texts, ties, repeated
rows, copies, shared lines and passages, and columns named as results are."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_words string, kept string, "
    "component_id string, hash string, place string, label string, length string, n_lines string"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def rows(seed: int = 7) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [
        "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "ü", "é"]) for _ in range(rng.randint(1, 4)))
        for _ in range(400)
    ]

    def prose(n: int) -> str:
        parts = [rng.choice(vocabulary) for _ in range(n)]
        return " ".join(p.capitalize() if i % 9 == 0 else p for i, p in enumerate(parts))

    def lines(n: int) -> str:
        return "\n".join(prose(rng.randint(3, 14)) for _ in range(n))

    passage = prose(60)
    line = "A line that recurs in many documents, word for word."
    found = [lines(rng.randint(1, 9)) for _ in range(60)]
    found += [found[3]] * 4 + [found[5].upper(), found[6].replace(" ", "  ")]
    for text in found[8:14]:  # near copies: one word changed
        parts = text.split(" ")
        parts[len(parts) // 2] = "changed"
        found.append(" ".join(parts))
    found += [f"{prose(30)} {passage} {prose(k)}" for k in range(8)]
    found += [f"{prose(12)}\n  {line.upper()}\t\n{prose(7)}\n{line}" for _ in range(5)]
    found += [line, "", "   \n\t ", "one", "one two three", "ONE two three", "\n\n", "a\x0bb\x0cc\rd", None, None]
    found += [prose(6000), "word " * 300, " ".join(["ab cd ef gh ij"] * 40), "é" * 500]
    found += ["x " * 19, "x " * 20, "x " * 21]
    table = [(i * 3, text) for i, text in enumerate(found)]
    rng.shuffle(table)
    table += [table[0], table[1], (None, found[3]), (None, None), (None, "alone")]
    return [
        (i, t, rng.choice(["xx", "yy", None]), rng.choice(["s", None]), "1", None, "c", "h", "p", "l", "9", "2")
        for i, t in table
    ]


def documents(spark, table: list[tuple] | None = None):
    return spark.createDataFrame(table if table is not None else rows(), SCHEMA).repartition(5)


def by_id(table: list[tuple]) -> dict[int, str | None]:
    """Texts by doc_id; in these cases rows that share one are equal."""
    return {row[0]: row[1] for row in table if row[0] is not None}
