"""Labelled texts to fit classifiers on: bounded samples, and all of them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestlab.llm.tables import quoted, shuffled_join

SAMPLE_ROWS = 6000
SAMPLE_TEXT_BYTES = 64 << 10
FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learned from; a null id is held out."""
    fold = F.crc32(quoted(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(True))


@dataclass(frozen=True)
class Sample:
    texts: pa.Array
    labels: np.ndarray


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int = SAMPLE_ROWS,
    text_bytes: int = SAMPLE_TEXT_BYTES,
    seed: int = 29,
) -> Sample:
    """At most ``rows`` labelled texts, chosen by a hash of their ids: ``rows`` of
    them where as many documents have a label and a usable text, else all.

    Held-out ids, null labels, null ids and null texts are left out, and so are
    labels of ids that ``docs`` does not have; an id with several labels counts
    as the larger, one with several texts as the first by code point. Texts of
    more than ``text_bytes`` bytes are scored like all others, but not fitted on,
    so the sample's size has a bound.
    """
    own = quoted("doc_id")
    usable = (F.octet_length(quoted("text")) <= text_bytes) & own.isNotNull() & ~held_out()
    texts = docs.where(usable)
    given = (
        labels.where(~held_out() & quoted(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(quoted(label)).cast("int").alias("y"))
    )
    known = (
        shuffled_join(given, texts.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` ids and labels are broadcast.
    joined = texts.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    table = (
        joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).toArrow()
    ).sort_by("doc_id")
    return Sample(
        table.column("text").combine_chunks().cast(pa.large_string())
        if table.num_rows
        else pa.array([], pa.large_string()),
        table.column("y").to_numpy().astype(np.float32),
    )


@dataclass(frozen=True)
class Labelled:
    """All labelled texts that a label may be learned from: how many there are, how
    many have label 1, and their bytes. The rules are those of ``labelled_sample``,
    but for the bound on a text."""

    docs: DataFrame
    labels: DataFrame
    label: str
    rows: int
    positives: int
    bytes: int

    def table(self, parts: int, where: Column | None = None) -> DataFrame:
        """(doc_id, text, y): a row per id, dealt by id to ``parts`` partitions and
        sorted in them, whatever the machine."""
        texts = _learned_from(self.docs, quoted("text")).select("doc_id", "text")
        known = _known(self.labels, self.label)
        if where is not None:
            texts, known = texts.where(where), known.where(where)
        known = known.repartition(parts, "doc_id")
        met = shuffled_join(texts.repartition(parts, "doc_id"), known, "doc_id")
        one = met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
        return one.sortWithinPartitions("doc_id")


def _learned_from(df: DataFrame, value: Column) -> DataFrame:
    return df.where(~held_out() & quoted("doc_id").isNotNull() & value.isNotNull())


def _known(labels: DataFrame, label: str) -> DataFrame:
    known = _learned_from(labels, quoted(label)).groupBy("doc_id")
    return known.agg(F.max(quoted(label)).cast("int").alias("y"))


def all_labelled(docs: DataFrame, labels: DataFrame, label: str) -> Labelled:
    sizes = _learned_from(docs, quoted("text")).select(
        "doc_id", F.octet_length(quoted("text")).cast("bigint").alias("size")
    )
    longest = sizes.groupBy("doc_id").agg(F.max("size").alias("size"))
    found = shuffled_join(longest, _known(labels, label), "doc_id").agg(
        F.count("*"), F.count_if(F.col("y") > 0), F.coalesce(F.sum("size"), F.lit(0))
    )
    return Labelled(docs, labels, label, *found.first())
