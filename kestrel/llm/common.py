"""Helpers shared by the operators: input columns, written intermediates, size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import scratch_path

#: A side is broadcast only after its written size was measured to be at most this many bytes.
BROADCAST_BYTES = 32 << 20


def doc_texts(docs: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator works on; a null text is the empty text.

    Columns of the input with any other name (also one that an operator
    adds itself) never reach the operator.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       *extra)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor reads and that survive
    a lost executor; unlike a checkpoint the result is columnar and prunable.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_bytes(df: DataFrame) -> int:
    """Size of the files behind a frame read from files (Catalyst's statistics)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bounded(df: DataFrame, name: str, max_bytes: int = BROADCAST_BYTES, factor: int = 6) -> DataFrame:
    """``df`` written and, if its measured size allows, hinted for broadcast.

    ``factor`` is the size of its rows in memory for a byte of the files, which are
    compressed columns.  Beyond the bound the frame carries no hint and joins by a
    shuffle whose skewed partitions adaptive execution splits.
    """
    return hinted(materialise(df, name), max_bytes=max_bytes, factor=factor)


def hinted(df: DataFrame, written: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES, factor: int = 6) -> DataFrame:
    """``df`` with a broadcast hint if the written frame it is a part of (itself by default) is within the bound."""
    return F.broadcast(df) if fits(df if written is None else written, max_bytes, factor) else df


def fits(written: DataFrame, max_bytes: int = BROADCAST_BYTES, factor: int = 6) -> bool:
    """Whether a written frame is small enough to broadcast."""
    return factor * written_bytes(written) <= max_bytes


def batches(source: Iterable[pa.RecordBatch], rows: int = 2000, column: int = 1,
            chars: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the given batches with few rows and few text bytes, so that a
    run of very long texts does not multiply in memory."""
    for batch in source:
        sizes = batch.column(column).nbytes / max(1, batch.num_rows)
        step = max(1, min(rows, int(chars / max(1.0, sizes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
