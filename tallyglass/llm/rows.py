"""What the text operators share: row identity, chunked Arrow batches, checked broadcasts, stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.session import scratch_path

#: Bytes of text a Python worker handles at a time; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: A table of at most so many rows (of a few fixed-width columns) may be broadcast.
BROADCAST_ROWS = 200_000


def identified(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, the text as bytes, and ``text_hash``.

    ``(doc_id, text_hash)`` stands for a row when results are joined back to their texts. Rows that share a
    ``doc_id`` but not a text stay apart; rows equal in both get the same result each.
    """
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("text"),
        *columns,
    )


def join_rows(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join two tables on the row identity, null ids included; the identity is kept once."""
    right = right.withColumnsRenamed({"doc_id": "__doc_id", "text_hash": "__text_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("text_hash") == F.col("__text_hash"))
    return left.join(right, same, how).drop("__doc_id", "__text_hash")


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about CHUNK_BYTES of ``column``, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            held += size or 0
            if held >= CHUNK_BYTES:
                yield batch.slice(start, row + 1 - start)
                start, held = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and executors may go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast if its counted size allows; beyond that the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
