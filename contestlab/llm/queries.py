"""All queries of this subpackage; importing it registers them."""

from __future__ import annotations

from contestlab.llm import (  # noqa: F401
    byte_pairs,
    chat,
    licenses,
    mixing,
    near_dedup,
    neighbours,
    phrases,
    quality,
    segmentation,
    token_counts,
    topk,
    toxicity,
    whitening,
)
from contestlab.llm.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
