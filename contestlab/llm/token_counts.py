"""Token counts: Arrow functions that return only lengths.

Texts are cut at safe boundaries into short segments, each distinct segment is
encoded once per batch, and its length is added up wherever it occurs. The
vocabulary's pattern never lets a token cross from a character that is not
white space to one that is, whatever stands around, and looks at most one
character ahead, at white space only; so the places before white space that
follows another character are safe, and the sum of the segments' lengths is
the length of the whole. The special string has no white space and is never
cut. Batches are cut by bytes, so a task holds a few megabytes of text at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import extended, fresh, quoted, read, slices, with_fields

TOKEN_LIMIT = 512
BATCH_BYTES = 4 << 20
CACHED_SEGMENTS = 200_000
CACHED_CHARS = 64
_SEGMENT = re.compile(r"\s*\S+|\s+")


class Counter:
    """Token counts of texts. ``cached`` short segments are remembered, which
    saves time only; a full cache is emptied."""

    def __init__(self, vocabulary: str, cached: int = CACHED_SEGMENTS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}
        self.cached = cached

    def counts(self, texts: list[str]) -> np.ndarray:
        cut = [_SEGMENT.findall(t) for t in texts]
        if len(self.known) > self.cached:
            self.known.clear()
        new = list({s for segments in cut for s in segments if s not in self.known})
        encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, map(len, encoded)))
        length = self.known.__getitem__
        out = np.array([sum(map(length, segments)) for segments in cut], np.int64)
        for s in new:
            if len(s) > CACHED_CHARS:
                del self.known[s]
        return out


def token_counts(
    df: DataFrame, vocabulary: str, text: str = "text", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Add ``n_tokens`` (under a fresh name if taken) to every row.

    Null and empty texts have 0 tokens. Repeated rows are counted each. Other
    columns pass through, whatever their names.
    """
    name = fresh(df.columns, "n_tokens")[0]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = Counter(vocabulary)
        for piece in slices(batches, text, batch_bytes):
            texts = [t or "" for t in piece.column(text).to_pylist()]
            yield extended(piece, **{name: pa.array(counter.counts(texts))})

    return df.mapInArrow(count, with_fields(df, f"`{name}` bigint"))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@registered("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, vocabulary_path())
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length(quoted("text")), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )
