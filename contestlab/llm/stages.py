"""The operators as stages of a corpus pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm import quality, toxicity
from contestlab.llm.mixing import Mix, mixed
from contestlab.llm.near_dedup import keepers
from contestlab.llm.segmentation import sampled_encodings
from contestlab.llm.tables import fresh, quoted, read
from contestlab.llm.token_counts import vocabulary_path

# Of the encoding; half the defaults.
KEPT_BYTES = 3 << 18
SLICE_BYTES = 1 << 18


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    name = fresh(docs.columns, "score")[0]
    scored = quality.quality_scores(docs, read(spark, sf_dir, "labels"), name=name)
    return scored.where(quoted(name) >= quality.THRESHOLD).select(*map(quoted, docs.columns))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    name = fresh(docs.columns, "score")[0]
    scored = toxicity.toxicity_scores(docs, read(spark, sf_dir, "labels"), name=name)
    return scored.where(quoted(name) < toxicity.THRESHOLD).select(*map(quoted, docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with its smallest id."""
    return keepers(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    name = fresh(docs.columns, "copies")[0]
    out = mixed(docs, Mix())
    repeated = F.explode(F.sequence(F.lit(1), quoted(name)))
    taken = out.where(quoted(name) > 0).withColumn(name, repeated)
    return taken.select(*map(quoted, docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled segmentations of every document. Workers take less memory, and more
    time, than by default: the executor holds what the stages before have left."""
    model = vocabulary_path("piece_bpe_32k.model")
    return sampled_encodings(docs, model, kept_bytes=KEPT_BYTES, slice_bytes=SLICE_BYTES)
