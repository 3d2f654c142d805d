"""Licence scan by a positional index of rare words.

The corpus says how rare each word of the licence templates is. Every template is
indexed under its rarest words, with their places in it. A file's rare licence words
are looked up, each naming places where a template may start; a place that enough of
the template's indexed words agree on is verified against the template's mandatory
phrase. One pass counts the words, one scans; nothing but word counts is shuffled.
All of it is DataFrame functions.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.texts import lower_ascii

# What separates words: every ASCII character but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words a template is indexed under: its rarest by document frequency.
INDEXED_WORDS = 2


@dataclass(frozen=True)
class Template:
    """``words``: the text around and with the mandatory phrase, which starts at word ``at``."""

    label: str
    words: str
    phrase: str
    at: int = 0


# Labels, usual wording and mandatory phrases. The first three are the base phrases.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license"),
    Template("apache-2", "apache license version 2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
    Template("gpl", "this work is licensed under the gnu general public license version", "gnu general public license", 6),
    Template("lgpl", "licensed under the gnu lesser general public license version", "gnu lesser general public license", 3),
    Template("agpl", "licensed under the gnu affero general public license version", "gnu affero general public license", 3),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license", 6),
    Template("epl", "under the terms of the eclipse public license", "eclipse public license", 5),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa", 2),
    Template("cc-by-nd", "licensed under cc by nd", "cc by nd", 2),
    Template("cc0", "released under the cc0 public domain dedication", "cc0 public domain", 3),
    Template("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use in source and binary forms"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    Template("apache-2", "licensed under the apache license 2 0", "apache license 2 0", 3),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software", 2),
)
# End of fixed values.

BASE = 3


def words_of(text: Column) -> Column:
    """The words of a text in their own case, in order; null and wordless texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1)
    first = F.when(F.element_at(parts, 1) == "", F.lit(2)).otherwise(F.lit(1))
    last = F.when(F.element_at(parts, -1) == "", F.size(parts) - 1).otherwise(F.size(parts))
    return F.slice(parts, first, F.greatest(last - first + 1, F.lit(0)))


def document_frequencies(docs: DataFrame, text="text", templates=TEMPLATES) -> DataFrame:
    """(word, n_docs) over all documents, for the words of the templates that occur at all."""
    vocabulary = sorted({w for t in templates for w in t.words.split()})
    used = F.transform(words_of(F.col(text)), lambda w: F.lower(w))
    used = F.array_distinct(F.filter(used, lambda w: w.isin(vocabulary)))
    return docs.select(F.explode(used).alias("word")).groupBy("word").agg(F.count("*").alias("n_docs"))


def index(frequencies: DataFrame, templates=TEMPLATES):
    """For each template its rarest words as (word, place), rarest first; ties go to the earlier word.

    The counts of at most the templates' own words come to the driver.
    """
    known = {r["word"]: r["n_docs"] for r in frequencies.collect()}
    return tuple(
        tuple(sorted(((w, i) for i, w in enumerate(t.words.split()) if _mandatory(t, i)), key=lambda p: (known.get(p[0], 0), p[1]))[:INDEXED_WORDS])
        for t in templates
    )


def _mandatory(template, place):
    return template.at <= place < template.at + len(template.phrase.split())


def scan(docs: DataFrame, ids="doc_id", text="text", templates=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places) for every row; ``places``: array of (template, start, matched share), by template.

    ``start`` is the place in the file of the template's mandatory phrase, words from 0; the share is that of
    the template's words that stand around it. Null text counts as empty. Repeated and null ids stay as
    they are, other columns do not matter, and an empty table gives an empty table.
    """
    postings = index(document_frequencies(docs, text, templates), templates)
    rare = sorted({word for posting in postings for word, _ in posting})
    words = F.col("words")

    def lower_at(i):
        return F.lower(F.element_at(words, i + 1))

    def starts(number, template):
        """Where the template's mandatory phrase may stand: named by its rarest word, agreed on by the others."""
        (word, place), *others = postings[number]
        own = F.filter("hits", lambda i: lower_at(i) == word)
        start = F.transform(own, lambda i: i - F.lit(place - template.at))
        phrase = template.phrase.split()

        def agreed(s):
            checks = (s >= 0) & (s + len(phrase) <= F.size(words))
            for other, at in others:
                checks = checks & (F.lower(F.try_element_at(words, F.greatest(s, F.lit(0)) + (at - template.at + 1))) == other)
            exact = lower_ascii(F.array_join(F.slice(words, F.greatest(s, F.lit(0)) + 1, len(phrase)), " "))
            return checks & (exact == " ".join(phrase))

        return F.filter(start, lambda s: F.coalesce(agreed(s), F.lit(False)))

    def placed(number, template):
        wanted = template.words.split()

        def place(start):
            same = F.lit(0)
            for i, word in enumerate(wanted):
                at = start + F.lit(i - template.at)
                found = F.when(at >= 0, F.lower(F.try_element_at(words, F.greatest(at, F.lit(0)) + 1)))
                same = same + F.when(found == word, 1).otherwise(0)
            share = same / F.lit(len(wanted))
            return F.struct(F.lit(number).alias("template"), start.cast("long").alias("start"), share.alias("share"))

        return place

    hits = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: lower_at(i).isin(rare))
    rows = docs.select(F.col(ids).alias("doc_id"), words_of(F.col(text)).alias("words"))
    rows = rows.withColumn("hits", F.when(F.size(words) > 0, hits).otherwise(F.array().cast("array<int>")))
    found = F.concat(*[F.transform(starts(k, t), placed(k, t)) for k, t in enumerate(templates)])
    none = F.array().cast("array<struct<template:int,start:bigint,share:double>>")
    return rows.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.when(F.size("hits") > 0, found).otherwise(none).alias("places"),
    )


def digest(scanned: DataFrame, templates=TEMPLATES) -> DataFrame:
    """The columns of the registered query, from the operator's places."""
    labels = F.array(*[F.lit(t.label) for t in templates])
    base = F.filter("places", lambda p: p["template"] < BASE)
    starts = F.transform(base, lambda p: p["start"])

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: F.element_at(labels, p["template"] + 1)))), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )


def digest_sql(templates=TEMPLATES):
    """DuckDB SQL for the registered query: every place of every mandatory phrase, without an index."""
    found = []
    for k, t in enumerate(templates):
        phrase, words = t.phrase.split(), t.words.split()
        listed = ", ".join(f"'{w}'" for w in phrase)
        same = " + ".join(f"(CASE WHEN i + {j - t.at} >= 1 AND w[greatest(i + {j - t.at}, 1)] = '{x}' THEN 1 ELSE 0 END)" for j, x in enumerate(words))
        found.append(f"""
          SELECT doc_id, {k} AS template, '{t.label}' AS label, i - 1 AS start, ({same}) / {len(words)}.0::DOUBLE AS share
          FROM d, LATERAL (SELECT unnest(range(1, len(w) - {len(phrase) - 2})) AS i)
          WHERE w[i] = '{phrase[0]}' AND w[i:i + {len(phrase) - 1}] = [{listed}]""")
    places = " UNION ALL ".join(found)
    return rf"""
        WITH d AS (
          SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
        ), p AS ({places}), s AS (
          SELECT doc_id, count(*) FILTER (template < {BASE}) AS n_base, min(start) FILTER (template < {BASE}) AS first_word,
            max(start) FILTER (template < {BASE}) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (template < {BASE}) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
          FROM p GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
          coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM d LEFT JOIN s USING (doc_id)
    """
