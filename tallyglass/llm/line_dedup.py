"""Removal of repeated lines by overlapping three-line windows.

Every run of three consecutive lines is hashed (128 bits). A window that occurs more than once keeps its first
occurrence in the order of ``doc_id``, then position; the lines under later occurrences go, with overlapping occurrences merged.
Every line that goes equals a line at an earlier place, so each distinct line survives somewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, identified, join_rows, stored

WINDOW = 3


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, text_hash, at, h1, h2``: each window of each text with the number of its first line."""
    lines = docs.select("doc_id", "text_hash", F.split(F.col("text").cast("string"), "\n").alias("lines"))
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("lines") - (window - 1)),
        lambda i: F.struct(
            (i - 1).alias("at"),
            F.xxhash64(F.slice("lines", i, window)).alias("h1"),
            F.xxhash64(F.lit(window), F.slice("lines", i, window)).alias("h2"),
        ),
    )
    return (
        lines.where(F.size("lines") >= window)
        .select("doc_id", "text_hash", F.explode(hashed).alias("w"))
        .select("doc_id", "text_hash", "w.*")
    )


def _without(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            total, gone, kept = [], [], []
            for text, starts in zip(
                batch.column("__text").to_pylist(), batch.column("__starts").to_pylist(), strict=True
            ):
                lines = [] if text is None else text.split(b"\n")
                covered = np.zeros(len(lines), dtype=bool)
                for offset in range(window if starts else 0):
                    covered[np.array(starts) + offset] = True
                total.append(len(lines))
                gone.append(int(covered.sum()))
                kept.append(text if not starts else b"\n".join(lines[i] for i in np.flatnonzero(~covered)))
            out = [c for c in batch.schema.names if c not in ("__text", "__starts")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in out), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                names=[*out, "__lines", "__removed", "__text"],
            )

    return run


def remove_lines(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` and the columns named in ``carry``, one row per row of ``docs``.

    Lines end at ``\\n`` and are compared as they are. A null text has no lines and stays null; an empty one has one
    empty line. A text below ``window`` lines keeps all; so does the first of equal texts. Of rows equal in
    ``doc_id`` and text one is the first, and all windows of the others are later. A null ``doc_id`` sorts first.
    Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    # Carried columns are renamed by position, so that none of their names can clash.
    own = {f"__c{i}": name for i, name in enumerate(carry)}
    rows = identified(docs, *(F.col(f"`{name}`").alias(alias) for alias, name in own.items()))
    windows = stored(_windows(rows, window), "line-windows")
    place = F.struct("doc_id", "text_hash", "at")
    # Stored, so that the join shuffles both sides itself and a hot window can be split over tasks.
    repeated = stored(
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .select("h1", "h2", "first"),
        "repeated-line-windows",
    )
    later = (
        windows.join(repeated, ["h1", "h2"])
        .where(place > F.col("first"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("at").alias("__starts"))
    )
    columns = ["doc_id", *own, F.col("text").alias("__text"), "__starts"]
    copied = stored(
        windows.where("at = 0").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "copied-texts"
    )
    if copied.isEmpty():
        joined = join_rows(rows, later, "left").select(*columns)
    else:
        # Rows equal in id and text are numbered, which no other row needs; all but the first of them lose every window.
        numbered = stored(join_rows(rows, copied).withColumn("__row", F.monotonically_increasing_id()), "copied-rows")
        first = numbered.groupBy("doc_id", "text_hash").agg(F.min("__row").alias("__first"))
        number = F.size(F.split(F.col("text").cast("string"), "\n"))
        starts = F.when(F.col("__row") == F.col("__first"), F.col("__starts")).otherwise(F.sequence(F.lit(0), number - window))
        joined = (
            join_rows(join_rows(rows, copied, "left_anti"), later, "left").select(*columns)
            .unionByName(join_rows(join_rows(numbered, first), later, "left").withColumn("__starts", starts).select(*columns))
        )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema if f.name in ("doc_id", *own))
    return joined.mapInArrow(_without(window), f"{fields}, __lines long, __removed long, __text binary").select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"),
        F.col("__text").cast("string").alias("text"), *(F.col(a).alias(n) for a, n in own.items()),
    )
