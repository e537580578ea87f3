"""Train/test membership from a hash of the row's key.

Unlike ``randomSplit`` the answer depends on the key alone, so it survives
repartitioning, retries and re-reads, and costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contestlab.constants import MODEL_TRAIN_PERCENT, SPLIT_SEED


def split_bucket(*keys: str, seed: int = SPLIT_SEED) -> Column:
    """A number in 0..99: the first 32 bits of md5("key:seed"), mod 100."""
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10)
    return head.cast("bigint") % 100


def in_training(
    *keys: str, percent: int = MODEL_TRAIN_PERCENT, seed: int = SPLIT_SEED
) -> Column:
    return split_bucket(*keys, seed=seed) < percent
