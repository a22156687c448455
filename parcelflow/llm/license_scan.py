"""License scans by diagonal voting, in built-in Spark expressions only.

All rolling word k-grams of every text are hashed and joined to the k-grams of the
templates, a table whose size the caller fixes, by two unlike hashes (of 64 and 32 bits). Each match
votes for its diagonal (place in the text less place in the template); diagonals close to
each other are merged, which bridges words put in or left out.  A template is found
where the merged votes cover enough of its k-grams, and found whole where one
diagonal has all of them.

Words are runs of characters other than ASCII ones that are no letter or digit,
A-Z lower-cased.

Defined cases: null or empty text has no words and no labels; templates shorter than
a k-gram are refused; rows that repeat are scanned alike; an empty table gives an
empty result.  Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 2
#: Diagonals this close are merged.
NEAR = 3
#: Share of a template's k-grams that must be found.
COVERAGE = 0.6

#: Phrases whose places are counted, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Opening words of public license notices.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        "gpl",
    ),
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mpl-2.0",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    given = F.coalesce(text, F.lit(""))
    # ``lower`` also knows letters beyond A-Z, of which a plain text has none; there it is the faster.
    plain = F.char_length(given) == F.octet_length(given)
    small = F.when(plain, F.lower(given)).otherwise(F.translate(given, UPPER, UPPER.lower()))
    parts = F.split(small, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", -1)
    return F.filter(parts, lambda x: x != "")


def gram_hashes(words: Column, size: int) -> Column:
    """Two unlike hashes of the k-gram at each place but the last ``size - 1``; ``words`` is a
    column, not an expression, which each place would work out again."""

    def hashes(word: Column, place: Column) -> Column:
        gram = [word, *[F.get(words, place + k) for k in range(1, size)]]
        return F.struct(F.xxhash64(*gram).alias("hash"), F.hash(*gram).alias("check"))

    return F.slice(F.transform(words, hashes), 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))


def template_grams(
    docs: DataFrame, templates: list[tuple[str, str]], size: int
) -> DataFrame:
    """(hash, check, template, at, grams) of the templates' k-grams."""
    for phrase, _ in templates:
        if len(phrase.split(" ")) < size:
            raise ValueError(f"a template needs {size} words: {phrase!r}")
    given = F.array(
        *[
            F.struct(F.lit(number).alias("template"), F.lit(phrase).alias("phrase"))
            for number, (phrase, _) in enumerate(templates)
        ]
    )
    phrases = docs.sparkSession.range(1).select(F.inline(given)).select(
        "template", F.split("phrase", " ").alias("words")
    )
    hashed = phrases.withColumn("hashes", gram_hashes(F.col("words"), size))
    return hashed.select(
        "template", F.size("hashes").alias("grams"), F.posexplode("hashes").alias("at", "gram")
    ).select("gram.hash", "gram.check", "template", "at", "grams")


def diagonals(
    docs: DataFrame,
    templates: list[tuple[str, str]],
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = GRAM,
) -> DataFrame:
    """(doc_id, text_hash, template, offset, grams, places): the votes of each diagonal,
    as the places of the template that have one."""
    grams = F.broadcast(template_grams(docs, templates, size).alias("t"))
    whole = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        words_of(F.col(text)).alias("words"),
    )
    # Beside a place lies its gram's two hashes alone, so the work is linear in a text's words.
    scanned = whole.select(
        "doc_id", "text_hash", F.posexplode(gram_hashes(F.col("words"), size)).alias("place", "gram")
    ).select("doc_id", "text_hash", "place", "gram.hash", "gram.check")
    hits = scanned.join(grams, ["hash", "check"])
    return (
        hits.groupBy("doc_id", "text_hash", "template", (F.col("place") - F.col("at")).alias("offset"))
        .agg(F.first("grams").alias("grams"), F.collect_set("at").alias("places"))
    )


def find(
    docs: DataFrame,
    templates: list[tuple[str, str]],
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = GRAM,
    near: int = NEAR,
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, text_hash, template, start, coverage, whole): the spans found.

    A diagonal with all votes is a span of its own; the rest are merged with
    neighbours at most ``near`` away."""
    votes = diagonals(docs, templates, text, doc_id, size)
    by_offset = Window.partitionBy("doc_id", "text_hash", "template").orderBy("offset")
    exact = F.size("places") == F.col("grams")
    apart = F.col("offset") - F.lag("offset").over(by_offset) > near
    begins = (F.coalesce(apart, F.lit(True)) | exact | F.lag(exact).over(by_offset)).cast("int")
    merged = (
        votes.withColumn("__begins", begins)
        .withColumn("__group", F.sum("__begins").over(by_offset))
        .groupBy("doc_id", "text_hash", "template", "__group")
        .agg(
            F.min("offset").alias("start"),
            F.first("grams").alias("grams"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"),
        )
    )
    share = F.col("votes") / F.col("grams")
    return merged.filter(share >= coverage).select(
        "doc_id", "text_hash", "template", "start", share.alias("coverage"),
        (F.col("votes") == F.col("grams")).alias("whole"),
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    notices: tuple[tuple[str, str], ...] = NOTICES,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; a row
    for each row."""
    templates = [*phrases, *notices]
    names = F.array(*[F.lit(label) for _, label in templates])
    spans = find(docs, templates, text, doc_id).withColumn("label", F.get(names, F.col("template")))
    base = (F.col("template") < len(phrases)) & F.col("whole")
    usable = base | (F.col("template") >= len(phrases))
    found = spans.filter(usable).groupBy(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.size(words_of(F.col(text))).cast("bigint").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    none = F.array().cast("array<string>")
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.coalesce("base_labels", none), ",").alias("base_labels"),
        F.array_join(F.coalesce("labels", none), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle(
    phrases: tuple[tuple[str, str], ...] = PHRASES, notices: tuple[tuple[str, str], ...] = NOTICES
) -> str:
    """The scan in SQL: the same votes by joining words, not hashes."""
    templates = ", ".join(
        f"({number}, {number < len(phrases)}, '{label}', '{phrase}')"
        for number, (phrase, label) in enumerate((*phrases, *notices))
    )
    return rf"""
WITH cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM cut
), gram AS (
  SELECT a.doc_id, a.place - 1 AS place, a.word AS w0, b.word AS w1
  FROM word a JOIN word b ON a.doc_id = b.doc_id AND b.place = a.place + 1
), template(number, base, label, phrase) AS (VALUES {templates}),
tword AS (
  SELECT number, unnest(string_split(phrase, ' ')) AS word,
         generate_subscripts(string_split(phrase, ' '), 1) AS place FROM template
), tgram AS (
  SELECT a.number, a.place - 1 AS spot, a.word AS w0, b.word AS w1,
         count(*) OVER (PARTITION BY a.number) AS grams
  FROM tword a JOIN tword b ON a.number = b.number AND b.place = a.place + 1
), vote AS (
  SELECT doc_id, number, place - spot AS start, grams, list(DISTINCT spot) AS ats
  FROM gram JOIN tgram USING (w0, w1) GROUP BY ALL
), marked AS (
  SELECT *, len(ats) = grams OR coalesce(lag(len(ats) = grams) OVER w, true)
            OR start - lag(start) OVER w > {NEAR} AS begins
  FROM vote WINDOW w AS (PARTITION BY doc_id, number ORDER BY start)
), numbered AS (
  SELECT *, sum(begins::INT) OVER (PARTITION BY doc_id, number ORDER BY start) AS part FROM marked
), merged AS (
  SELECT doc_id, number, min(start) AS start, any_value(grams) AS grams,
         len(list_distinct(flatten(list(ats)))) AS votes
  FROM numbered GROUP BY doc_id, number, part
), span AS (
  SELECT doc_id, label, start, base, CAST(votes AS DOUBLE) / grams AS coverage
  FROM merged JOIN template USING (number)
  WHERE CAST(votes AS DOUBLE) / grams >= {COVERAGE} AND (NOT base OR votes = grams)
), found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
         max(start) FILTER (base) AS last_word, max(coverage) AS score,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
  FROM span GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0) AS score
FROM cut LEFT JOIN found USING (doc_id)
"""
