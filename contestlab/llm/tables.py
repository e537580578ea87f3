"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
ARROW_BYTES = 4 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(columns: Iterable[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column with exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``ARROW_BYTES`` from now on,
    if they may be larger: a task of either side then holds few megabytes of rows
    at a time, whatever their number. A larger row is a batch of its own."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ARROW_LIMIT).rstrip("bB")) <= ARROW_BYTES:
        conf.set(_ARROW_LIMIT, str(ARROW_BYTES))
    return df


def give_back() -> None:
    """Return memory that is free to the machine: a worker that later tasks and
    stages use again should not keep what the largest of them needed."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each piece have about ``limit``
    bytes; a longer text is a piece of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``slices`` of one array of texts."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    return (piece.column(0) for piece in slices([batch], "text", limit))


def shuffled_join(
    left: DataFrame, right: DataFrame, keys: str | list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join that never broadcasts. Spark takes a table that was read for the size of
    its compressed files, and what an explode makes of a row for one row; what it would
    broadcast by that can be a hundred times larger, and the driver holds it."""
    return left.join(right.hint("shuffle_merge"), keys, how)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], salts: int, how: str = "inner"
) -> DataFrame:
    """``shuffled_join`` where a key may hold a third of the left rows: those rows are
    spread over ``salts`` tasks, to each of which the right rows are copied."""
    spread = F.pmod(F.xxhash64(*[quoted(c) for c in left.columns]), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    copied = right.withColumn("_salt", copies)
    return shuffled_join(left.withColumn("_salt", spread), copied, [*keys, "_salt"], how).drop("_salt")


def with_fields(df: DataFrame, fields: str) -> T.StructType:
    """The schema of ``df`` followed by the fields of a DDL string."""
    return T.StructType(
        [*df.schema.fields, *T.StructType.fromDDL(fields).fields]
    )


def extended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )
