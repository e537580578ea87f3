"""License scans: an exact set-similarity join of text blocks with templates.

A template of L words is compared with the windows of 2L words at every start. A
window meets a template when it holds enough of the template's distinct words.
The join is exact and looks at few windows:

- words are ordered by how often they occur in all texts, rarest first; a window
  that holds ``need`` of a template's n words holds one of its first
  n - need + 1, so only windows around those are candidates (prefix filter);
- a window is counted at the first of them that it holds, so all words that both
  have are that one and words behind it (position filter);
- of the places that pass, only those are cut into windows where the words of
  all windows together hold ``need`` of these.

All of it is DataFrame operations on built-in functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import read
from contestlab.operators.attach import Lookup, attach
from contestlab.sources.scratch import written

THRESHOLD = 0.9


@dataclass(frozen=True)
class Template:
    """Words and the label they stand for. Of a ``phrase`` all words have to be
    there, one after the other."""

    label: str
    words: tuple[str, ...]
    phrase: bool = False

    def need(self, threshold: float) -> int:
        n = len(set(self.words))
        return n if self.phrase else max(1, ceil(threshold * n - 1e-9))


def _template(label: str, text: str, phrase: bool = False) -> Template:
    return Template(label, tuple(text.split()), phrase)


# The phrases to find, and openings and main paragraphs of widely
# used licenses, so a file whose opening is cut off or reworded has a label too.
PHRASES = (
    _template("mit", "mit license", True),
    _template("apache", "apache license", True),
    _template("gpl", "general public license", True),
)
NOTICES = (
    _template("mit", "released under the mit license"),
    _template("mit", "permission is hereby granted free of charge to any person obtaining a copy"
              " of this software and associated documentation files"),
    _template("apache", "licensed under the apache license version 2 0"),
    _template("apache", "you may not use this file except in compliance with the license"),
    _template("gpl", "this work is licensed under the gnu general public license version 3"),
    _template("gpl", "you can redistribute it and or modify it under the terms of the gnu general"
              " public license as published by the free software foundation"),
    _template("bsd", "redistribution and use in source and binary forms with or without"
              " modification are permitted provided that the following conditions are met"),
    _template("cc-by-nc", "licensed under cc by nc 4 0"),
    _template("mit", "to deal in the software without restriction including without limitation the"
              " rights to use copy modify merge publish distribute sublicense and or sell copies of"
              " the software and to permit persons to whom the software is furnished to do so"),
    _template("mit", "the above copyright notice and this permission notice shall be included in all"
              " copies or substantial portions of the software"),
    _template("apache", "unless required by applicable law or agreed to in writing software"
              " distributed under the license is distributed on an as is basis without warranties"
              " or conditions of any kind either express or implied"),
    _template("gpl", "this program is distributed in the hope that it will be useful but without any"
              " warranty without even the implied warranty of merchantability or fitness for a"
              " particular purpose see the gnu general public license for more details"),
    _template("bsd", "redistributions of source code must retain the above copyright notice this"
              " list of conditions and the following disclaimer"),
    _template("bsd", "redistributions in binary form must reproduce the above copyright notice this"
              " list of conditions and the following disclaimer in the documentation and or other"
              " materials provided with the distribution"),
)


def plain(text: Column) -> Column:
    """The words of a text with one space between them. Only A-Z are
    lower-cased: the two other characters that ``lower`` turns into ASCII
    letters are replaced by one that stays a word character."""
    kept = F.coalesce(text, F.lit(""))
    for other in ("K", "İ"):
        kept = F.replace(kept, F.lit(other), F.lit("ı"))
    return F.trim(F.regexp_replace(F.lower(kept), "[\\x00-/:-`{-\\x7F]+", " "))


def word_frequencies(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often the templates' words occur in all texts: as many rows as the
    templates have words."""
    counts = (
        words.select(F.explode("w").alias("word"))
        .where(F.col("word").isin(list(vocabulary)))
        .groupBy("word")
        .count()
    )
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in counts.collect()}


def prefixes(
    spark: SparkSession,
    templates: Sequence[Template],
    frequency: Mapping[str, int],
    threshold: float,
) -> DataFrame:
    """(word, template, i, ...): the words by which each template is found; one
    row per template and prefix word."""
    rows = []
    for place, t in enumerate(templates):
        ordered = sorted(set(t.words), key=lambda w: (frequency[w], w))
        need = t.need(threshold)
        for i, word in enumerate(ordered[: len(ordered) - need + 1]):
            rows.append(
                F.struct(
                    F.lit(word).alias("word"),
                    F.lit(place).alias("template"),
                    F.lit(i).alias("i"),
                    F.lit(need).alias("need"),
                    F.lit(t.label).alias("label"),
                    F.lit(t.phrase).alias("phrase"),
                    F.array(*map(F.lit, t.words)).alias("words"),
                    F.array(*map(F.lit, ordered)).alias("ordered"),
                )
            )
    return spark.range(1).select(F.inline(F.array(*rows)))


def matches(marked: DataFrame, found_by: DataFrame, probes: Sequence[str]) -> DataFrame:
    """(key, template, at, label, phrase, containment, place): the prefix words
    around which a window meets its template, one row per distinct text,
    template and place of the word. ``containment`` is the best window's,
    ``place`` the start of a phrase. A phrase is found by the first place of its
    prefix word, so each of its places is one row."""
    hits = F.filter(
        F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("word"))),
        lambda h: h["word"].isin(list(probes)),
    )
    length = F.size("words")
    first = F.greatest(F.col("at") - length * 2 + 1, F.lit(0))
    start = (F.col("at") - F.array_position("words", F.col("word")) + 1).cast("int")
    here = F.slice("w", F.greatest(start, F.lit(0)) + 1, length)
    behind = F.slice("ordered", F.col("i") + 1, F.size("ordered"))
    candidates = (
        marked.where("w IS NOT NULL")
        .select("key", "w", F.inline(hits))
        .join(F.broadcast(found_by), "word")
        .select(
            "key", "template", "at", "label", "phrase", "need",
            F.size("ordered").alias("n"),
            length.alias("length"),
            F.when(F.col("phrase") & (start >= 0) & (here == F.col("words")), start).alias("place"),
            behind.alias("behind"),
            (F.col("at") - first).alias("last"),
            F.slice("w", first + 1, F.col("at") - first + length * 2).alias("around"),
        )
    )

    def in_both(block: Column) -> Column:
        return F.size(F.array_intersect("behind", block))

    shares = F.transform(
        F.sequence(F.lit(0), F.col("last")),
        lambda s: in_both(F.slice("around", s + 1, F.col("length") * 2)),
    )
    best = F.when(F.col("phrase"), F.col("n")).otherwise(F.array_max(shares))
    near = F.when(F.col("phrase"), F.col("place").isNotNull())
    return (
        candidates.where(near.otherwise(in_both(F.col("around")) >= F.col("need")))
        .withColumn("best", best)
        .where("best >= need")
        .groupBy("key", "template", "at")
        .agg(
            *[F.any_value(c).alias(c) for c in ("label", "phrase", "place")],
            F.max(F.col("best") / F.col("n")).alias("containment"),
        )
    )


def license_scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: Sequence[Template] = PHRASES,
    notices: Sequence[Template] = NOTICES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) for every row.

    ``n_base`` counts all places of the phrases, ``first_word`` and
    ``last_word`` are the smallest and largest start, null without any.
    ``labels`` are those of all templates met, ``score`` is the largest share of
    a met notice's or phrase's words in one window, 0 if none is met. A phrase
    whose words are in a window but not in a row counts for nothing. Null and
    empty texts have no words. Repeated rows are reported each. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    templates = [*phrases, *notices]
    normal = docs.select(
        F.col(doc_id).alias("doc_id"), plain(F.col(text)).alias("normal")
    )
    words = normal.withColumn("w", F.split("normal", " "))
    vocabulary = sorted({w for t in templates for w in t.words})
    found_by = prefixes(spark, templates, word_frequencies(words, vocabulary), threshold)
    probes = sorted({r["word"] for r in found_by.select("word").distinct().collect()})

    spaces = F.char_length("normal") - F.char_length(F.replace("normal", F.lit(" "), F.lit("")))
    n_words = F.when(F.col("normal") == "", 0).otherwise(spaces + 1).cast("bigint")
    has_probe = F.arrays_overlap("w", F.array(*map(F.lit, probes)))
    marked = written(
        words.select(
            "doc_id",
            n_words.alias("n_words"),
            F.when(has_probe, F.sha2("normal", 256)).alias("key"),
            F.when(has_probe, F.col("w")).alias("w"),
        ),
        "marked",
    )
    per_text = matches(marked, found_by, probes).groupBy("key").agg(
        F.count("place").alias("n_base"),
        F.min("place").alias("first_word"),
        F.max("place").alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max("containment").alias("score"),
    )
    joined = per_text.withColumns(
        {c: F.array_join(F.sort_array(c), ",") for c in ("base_labels", "labels")}
    )
    values = ["n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    out = attach(
        marked.select("doc_id", "n_words", "key"),
        Lookup(joined, {"key": "key"}, {v: v for v in values}),
    )
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


@registered("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))
