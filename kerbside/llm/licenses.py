"""License scans with DataFrame functions only: fixed phrases, and a set-similarity join with templates.

A text block is any window of consecutive words, a quarter longer than the template. It
matches a template if it holds at least ``threshold`` of the template's distinct words. All
words of the templates are counted over all documents, and each template's words are ordered
from the rarest to the most frequent. A matching block must hold one of the first
m - ceil(threshold * m) + 1 of a template's m words (prefix filter); texts with fewer words than
a template needs are left out (length filter); only blocks that reach the prefix word's place
are compared (positional filter), each by its exact number of common words.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows are
scanned each; a phrase at several places counts each; an empty table gives no rows; a null id is kept; other columns
are ignored. Of templates with equal shares the score is the same, and all labels count. A long text is
one array of words; each place of a prefix word in it carries that array.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import two_columns

#: The phrases of the contract and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Usual license statements and their labels.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

THRESHOLD = 0.9
#: Templates that may be joined; with their words they are broadcast.
MOST_TEMPLATES = 1000

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, ASCII capitals made small."""
    return F.array_remove(F.split(F.translate(text, CAPITALS, SMALL), SEPARATORS), "")


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(CAPITALS, SMALL)))


def block_words(words: list[str]) -> int:
    """The length of the blocks compared with a template."""
    return math.ceil(len(words) * 5 / 4)


def needed_words(distinct: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * distinct, 9)))


def places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively; texts without all of its words are not searched."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    at = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: all_of([F.get(words, i + k) == part for k, part in enumerate(parts)]),
    )
    has_all = all_of([F.array_contains(words, part) for part in parts])
    return F.when(has_all & (last >= 0), at).otherwise(F.array().cast("array<int>"))


def all_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


def prefixes(words: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(token, label, tokens, block, needed) of every necessary prefix word of every template."""
    spark = words.sparkSession
    made = []
    for number, (label, text) in enumerate(templates):
        own = template_words(text)
        distinct = list(dict.fromkeys(own))
        made.append(
            F.struct(
                F.lit(number).alias("template"),
                F.lit(label).alias("label"),
                F.array(*map(F.lit, distinct)).alias("tokens"),
                F.lit(block_words(own)).alias("block"),
                F.lit(needed_words(len(distinct), threshold)).alias("needed"),
            )
        )
    table = spark.range(1).select(F.explode(F.array(*made)).alias("t")).select("t.*")
    vocabulary = sorted({w for _, text in templates for w in template_words(text)})
    counts = words.select(F.explode("words").alias("token")).where(F.col("token").isin(vocabulary)).groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("template").orderBy(F.coalesce("n", F.lit(0)), "token")
    return (
        table.select("*", F.explode("tokens").alias("token"))
        .join(counts, "token", "left")
        .withColumn("rank", F.row_number().over(rarest))
        .where(F.col("rank") <= F.size("tokens") - F.col("needed") + 1)
        .select("token", "label", "tokens", "block", "needed")
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    ``score`` is 1 where a fixed phrase occurs, else the largest containment of a matching
    template, else 0.
    """
    templates = TEMPLATES if templates is None else templates
    if not 0 < len(templates) <= MOST_TEMPLATES:
        raise ValueError(f"from 1 to {MOST_TEMPLATES} templates can be joined")
    rows = two_columns(docs, id_col, text_col).select("doc_id", words_of(F.col("text")).alias("words"))
    # A bounded list: at most all words of the templates.
    found = [r.asDict(recursive=True) for r in prefixes(rows, templates, threshold).collect()]
    literal = [
        F.struct(
            F.lit(r["token"]).alias("token"),
            F.lit(r["label"]).alias("label"),
            F.array(*map(F.lit, r["tokens"])).alias("tokens"),
            F.lit(r["block"]).alias("block"),
            F.lit(r["needed"]).alias("needed"),
        )
        for r in found
    ]
    prefix = docs.sparkSession.range(1).select(F.explode(F.array(*literal)).alias("p")).select("p.*")
    rare = F.array(*[F.lit(t) for t in sorted({r["token"] for r in found})])
    least = min(r["needed"] for r in found)

    words = F.col("words")
    rare_places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(rare, F.get(words, i)))
    candidate = (F.size(words) >= least) & F.arrays_overlap(words, rare)
    base = F.array_sort(F.flatten(F.array(*[F.col(f"p{i}") for i in range(len(PHRASES))])))
    labels = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]
    scanned = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "words",
        *[places(words, phrase).alias(f"p{i}") for i, phrase in enumerate(PHRASES)],
        F.when(candidate, rare_places).alias("at"),
    ).select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.get(base, F.lit(0)).cast("long").alias("first_word"),
        F.get(base, F.size(base) - 1).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_labels"),
        F.when(candidate, words).alias("words"),
        F.explode_outer("at").alias("at"),
    )
    joined = scanned.withColumn("token", F.get("words", F.col("at"))).join(F.broadcast(prefix), "token", "left")
    common = F.array_max(
        F.transform(
            F.sequence(F.greatest(F.col("at") - F.col("block") + 1, F.lit(0)), F.col("at")),
            lambda start: F.size(F.array_intersect("tokens", F.slice("words", start + 1, F.col("block")))),
        )
    )
    matched = joined.withColumn("common", F.when(F.col("tokens").isNotNull() & (F.size("words") >= F.col("needed")), common))
    hit = F.col("common") >= F.col("needed")
    kept = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    return (
        matched.groupBy("row", "doc_id")
        .agg(
            *[F.first(name).alias(name) for name in kept],
            F.collect_set(F.when(hit, F.col("label"))).alias("more"),
            F.max(F.when(hit, F.col("common") / F.size("tokens"))).alias("best"),
        )
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_distinct(F.concat("base_labels", "more"))), ",").alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        )
    )
