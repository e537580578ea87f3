"""Documents to training samples: five stages, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contestlab.llm import stages
from contestlab.sources.scratch import scratch_scope

STAGES = [
    ("quality", stages.good_quality),
    ("toxicity", stages.not_toxic),
    ("near_dedup", stages.without_near_copies),
    ("mixing", stages.mixed_sources),
    ("encoding", stages.encoded),
]

# Fitted classifiers and sampled segmentations are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``. The last result is written too, so
    reading it again does not sample again; it is all that is left in the scratch
    folder, as each stage's own tables go with it and a stage's result with the
    whole.

    Null and empty texts are scored like all others, are no copies of each other,
    have size 0 in the mix and one row without ids if it takes them. Rows that repeat are
    copies, of which one stays. No documents give no rows. Other columns of the
    documents, whatever their names, pass through all stages but the last.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch_scope(spark) as whole:
        for name, stage in STAGES:
            with scratch_scope(spark) as own:
                last = name == STAGES[-1][0]
                docs = (whole if last else own).keep(stage(spark, docs, sf_dir), name)
    return docs
