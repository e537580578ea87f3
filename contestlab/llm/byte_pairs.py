"""Byte-level BPE encoding and decoding with the tiktoken library.

The vocabulary is a local file of ranks. tiktoken cuts a text by a pattern and
merges the bytes of each match by rank. Long texts are cut first, at places
where the pattern cuts as well whatever stands around them, so a task holds the
tokens of one segment at a time; the ids of the segments, one behind the other,
are those of the whole text. Decoding joins the bytes that the ids stand for:
raw bytes, so ids that end inside a character decode too.
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
from contestlab.llm.token_counts import vocabulary_path

SEGMENT_CHARS = 1 << 16
BATCH_BYTES = 4 << 20
RANKS = "byte_bpe_50k.tiktoken"

# Between these ASCII characters every match ends: behind a letter that no letter
# follows, a digit that no digit follows, or another sign but an apostrophe before
# a letter, a digit or white space. No match goes on from one to the other, and
# none looks further ahead than one character behind white space.
_SAFE = re.compile(
    r"[A-Za-z](?=[\x00-@\[-`{-\x7f])|[0-9](?=[\x00-/:-\x7f])|[!-&(-/:-@\[-`{-~](?=[A-Za-z0-9 \t-\r])"
)

# White space of Unicode. A run of it is one match up to its last character, or
# whole at the end of the text; the library fails on runs of some hundred thousands.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{_SPACE}]{{{SEGMENT_CHARS},}}")


def segments(text: str, chars: int = SEGMENT_CHARS) -> Iterator[tuple[str, bool]]:
    """``text`` in parts, and whether a part is a single match. Parts have about
    ``chars`` characters and are cut at safe places only; a stretch without one,
    such as a single long word, stays whole."""
    start = 0
    for run in _LONG_SPACE.finditer(text):
        yield from ((part, False) for part in _cut(text, start, run.start(), chars))
        start = run.end() - (run.end() < len(text))
        yield text[run.start() : start], True
    yield from ((part, False) for part in _cut(text, start, len(text), chars))


def _cut(text: str, start: int, end: int, chars: int) -> Iterator[str]:
    while end - start > chars:
        cut = _SAFE.search(text, start + chars - 1, end)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    if start < end:
        yield text[start:end]


class Codec:
    """Ids of texts, and bytes of ids."""

    def __init__(self, ranks: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        known = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={}
        )
        self.tokens: list[bytes | None] = [None] * (max(known.values(), default=-1) + 1)
        for token, rank in known.items():
            self.tokens[rank] = token

    def encode(self, text: str) -> np.ndarray:
        """Little-endian unsigned 32-bit ids; no string is a special token."""
        parts = [np.zeros(0, "<u4")]
        for part, single in segments(text):
            if single:
                found = self.encoding._encode_single_piece(part)
            else:
                found = self.encoding.encode_ordinary(part)
            parts.append(np.array(found, "<u4"))
        return np.concatenate(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        found = [self.tokens[i] if i < len(self.tokens) else None for i in ids.tolist()]
        if None in found:
            raise ValueError(f"no token has the id {int(ids[found.index(None)])}")
        return b"".join(found)


def encoded(
    df: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (under fresh names if taken) to every row:
    the ids of the whole text as little-endian unsigned 32-bit integers in a
    binary value, four bytes an id.

    Null and empty texts have no ids. Repeated rows are encoded each, no rows
    give no rows, and other columns pass through, whatever their names.
    """
    names = fresh(df.columns, "n_tokens", "ids")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, pattern)
        for piece in slices(batches, text, batch_bytes):
            ids = [codec.encode(t.as_py() or "") for t in piece.column(text)]
            columns = [
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([i.tobytes() for i in ids], pa.binary()),
            ]
            yield extended(piece, **dict(zip(names, columns)))

    return df.mapInArrow(encode, with_fields(df, f"`{names[0]}` bigint, `{names[1]}` binary"))


def decoded(
    df: DataFrame,
    ranks: str,
    pattern: str,
    ids: str = "ids",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Add ``decoded`` (under a fresh name if taken) to every row: the bytes that
    the ids of ``encoded`` stand for, which need not be whole characters.

    Null ids give null, no ids no bytes; an id without a token is an error. Other
    columns pass through, whatever their names.
    """
    name = fresh(df.columns, "decoded")[0]

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, pattern)
        for piece in slices(batches, ids, batch_bytes):
            packed = (value.as_py() for value in piece.column(ids))
            found = [None if p is None else codec.decode(np.frombuffer(p, "<u4")) for p in packed]
            yield extended(piece, **{name: pa.array(found, pa.binary())})

    return df.mapInArrow(decode, with_fields(df, f"`{name}` binary"))


def id_list(packed: bytes) -> list[int]:
    """The ids in a value of ``encoded``."""
    return np.frombuffer(packed, "<u4").tolist()


def vocabulary_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@registered("op13_byte_pairs")
def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = vocabulary_path(RANKS), vocabulary_pattern()
    tokens = encoded(docs, *vocabulary).select("doc_id", "n_tokens", "ids")
    return decoded(tokens, *vocabulary).select(
        "doc_id",
        "n_tokens",
        F.sha2(quoted("ids"), 256).alias("ids_sha256"),
        F.sha2(quoted("decoded"), 256).alias("decoded_sha256"),
    )
