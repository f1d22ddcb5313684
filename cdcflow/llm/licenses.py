"""Licence statements in documents, by a positional index of rare words.

Templates are short licence statements with key phrases that must stand in the text. The index keeps, for each
template, its RARE words of highest inverse document frequency over all documents, with their places. Where a document
has such a word, each of its places in a template says where the template would begin; beginnings that RARE words
agree on are compared word by word, and kept if enough of the template stands there and every key phrase stands within.
All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE, VOTES, SHARE, SLACK = 4, 2, 0.7, 2
# Phrases that give a label wherever they stand.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Label, statement, key phrases.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted", "free of charge"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms", "provided that the following conditions"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", ["general public license", "free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["lesser general public license"]),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", ["affero general public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4"]),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("reserved", "all rights reserved", ["all rights reserved"]),
]


def _words(phrases) -> list[str]:
    return sorted({w for p in phrases for w in p.split()})


PHRASES = [*BASE, *(p for _, _, keys in TEMPLATES for p in keys)]
VOCABULARY = _words([*PHRASES, *(text for _, text, _ in TEMPLATES)])


def _array(items: list) -> Column:
    return F.array(*(F.lit(x) for x in items))


def _starts(spots: Column, phrase: str) -> Column:
    """Where all words of ``phrase`` stand one after the other; ``spots`` are (word, position) in order of position."""
    words = phrase.split()

    def of(n: int) -> Column:
        return F.transform(F.filter(spots, lambda s: s["word"] == words[n]), lambda s: s["at"] - n)

    found = of(0)
    for n in range(1, len(words)):
        found = F.array_intersect(found, of(n))
    return found


def scanned(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_words, vocabulary, spots`` of each document, stored: which words of the templates it has, and
    where, if all words of any phrase are among them; without, no phrase can stand in it."""
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("words"))
    met = words.withColumn("vocabulary", F.array_intersect("words", _array(VOCABULARY)))
    able = F.lit(False)
    for phrase in {" ".join(sorted(set(p.split()))) for p in PHRASES}:
        able = able | (F.size(F.array_intersect("vocabulary", _array(phrase.split()))) == len(phrase.split()))
    spots = F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda s: s["word"].isin(VOCABULARY)
    )
    return stored(
        met.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("bigint").alias("n_words"),
            "vocabulary", F.when(able, spots).alias("spots"),
        ),
        "spots",
    )


def rare_index(rows: DataFrame) -> list[tuple[str, int, int]]:
    """(word, template, place) of each template's RARE words found in the fewest documents. Counts are over all
    documents; the vocabulary bounds what comes to the driver."""
    total = rows.count()
    counts = dict(map(tuple, rows.select(F.explode("vocabulary").alias("w")).groupBy("w").count().collect()))
    out = []
    for n, (_, text, _) in enumerate(TEMPLATES):
        words = text.split()
        weight = {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in words}
        rare = set(sorted(weight, key=lambda w: (-weight[w], w))[:RARE])
        out += [(w, n, at) for at, w in enumerate(words) if w in rare]
    return out


def template_matches(rows: DataFrame) -> DataFrame:
    """``row, label, score`` of each template found: the share of its words that stand at their place."""
    spark = rows.sparkSession
    index = spark.createDataFrame(rare_index(rows), "word STRING, template INT, place INT")
    able = rows.filter("spots IS NOT NULL").select("row", "spots")
    begins = (
        able.select("row", F.inline("spots"))
        .join(F.broadcast(index), "word")
        .withColumn("begin", F.col("at") - F.col("place"))
        .groupBy("row", "template", "begin").agg(F.count_distinct("place").alias("votes"))
    )
    texts = spark.createDataFrame(
        [(n, label, text.split(), keys, min(VOTES, len(text.split()))) for n, (label, text, keys) in enumerate(TEMPLATES)],
        "template INT, label STRING, words ARRAY<STRING>, keys ARRAY<STRING>, needed INT",
    )
    placed = begins.join(F.broadcast(texts), "template").filter("votes >= needed")
    near = able.join(placed, "row").withColumn(
        "near", F.expr(f"filter(spots, s -> s.at >= begin - {SLACK} AND s.at < begin + size(words) + {SLACK})")
    )
    stands = F.expr("size(filter(near, s -> s.at >= begin AND s.at < begin + size(words) AND get(words, s.at - begin) = s.word))")
    # The words of the stretch in order, a gap where a word is in no template, so that a phrase is a substring.
    stretch = F.expr(
        f"concat(' ', array_join(transform(sequence(begin - {SLACK}, begin + size(words) + {SLACK - 1}),"
        " p -> coalesce(get(filter(near, s -> s.at = p), 0).word, '|')), ' '), ' ')"
    )
    return (
        near.withColumn("score", stands / F.size("words"))
        .filter(F.col("score") >= SHARE)
        .withColumn("stretch", stretch)
        .filter(F.expr("forall(keys, k -> contains(stretch, concat(' ', k, ' ')))"))
        .select("row", "label", "score")
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, a row for each row of ``docs``.

    A null or empty text has no words, no places and empty labels; without a template the score is 0. Rows that repeat
    are scanned alike. Other columns are left out.
    """
    rows = scanned(docs)
    base = {p: F.when(F.col("spots").isNotNull(), _starts(F.col("spots"), p)).otherwise(F.array().cast("array<int>")) for p in BASE}
    found = rows.select("row", "doc_id", "n_words", *(v.alias(BASE[p]) for p, v in base.items()))
    columns = [F.col(f"`{label}`") for label in BASE.values()]
    places = F.concat(*columns)
    labels = F.array_compact(F.array(*(F.when(F.size(c) > 0, F.lit(name)) for c, name in zip(columns, BASE.values(), strict=True))))
    found = found.select(
        "row", "doc_id", "n_words", F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"), F.array_max(places).cast("bigint").alias("last_word"),
        F.array_sort(labels).alias("base"),
    )
    more = template_matches(rows).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    none = F.array().cast("array<string>")
    return found.join(more, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op9_license_scan(spark, sf_dir):
    return license_scan(documents(spark, sf_dir))
