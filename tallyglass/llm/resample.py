"""Target-distribution importance resampling over hashed n-grams.

Separators of a text collapse to single spaces, and one overlapped regular expression per length, held to word boundaries by
lookarounds, walks over all its n-grams; the bytes of each span go straight into a CRC, whose remainder is the n-gram's bucket.
Bucket counts of the corpus and of the target give every bucket a gain; a document weighs the mean gain of its n-grams, and
Gumbel noise from a hash of its id turns the highest scores into a draw without replacement, the same on every run.

The texts are read once: buckets (two bytes an n-gram) are stored, then counted, then weighed. Ranks of all eligible rows come
from one range shuffle of three numbers a row and from the row counts of the ranges.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, stored

_SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Rows of a range whose ranks one task gives out; the driver sees a count per range.
ROWS_PER_RANGE = 500_000


@dataclass(frozen=True)
class Draw:
    """Runs of ``least`` to ``most`` words are features; ``percent`` of the documents of ``min_words`` words are drawn.

    The driver and every task hold one number per bucket.
    """

    least: int = 1
    most: int = 1
    buckets: int = 10_000
    percent: int = 10
    min_words: int = 20
    seed: int = 2024


@lru_cache
def _runs(n: int) -> regex.Pattern:
    """``n`` words with a space or an end of the text on either side."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def _spaced(text: bytes | None) -> bytes:
    # ``lower`` of bytes changes A-Z only.
    return _SEPARATORS.sub(b" ", (text or b"").lower()).strip(b" ")


def ngrams(spaced: bytes, least: int, most: int) -> Iterator[bytes]:
    """All runs of ``least`` to ``most`` words of a spaced text, repeats included."""
    for n in range(least, most + 1):
        for match in _runs(n).finditer(spaced, overlapped=True):
            yield match[0]


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _bucket_rows(draw: Draw):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = [_spaced(t) for t in batch.column("text").to_pylist()]
            found = [
                np.fromiter((crc32(g) % draw.buckets for g in ngrams(t, draw.least, draw.most)), _kind(draw.buckets)) for t in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array([t.count(b" ") + 1 if t else 0 for t in texts], pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([f.tobytes() for f in found], pa.binary()),
                ],
                names=["doc_id", "row", "n_words", "n_features", "buckets"],
            )

    return run


def _bucketed(rows: DataFrame, draw: Draw) -> DataFrame:
    """``rows(doc_id, row, text)`` with their word and feature counts and the bucket of each feature, stored."""
    schema = "doc_id long, row long, n_words long, n_features long, buckets binary"
    return stored(rows.mapInArrow(_bucket_rows(draw), schema), "buckets")


def _counted(draw: Draw):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(draw.buckets, dtype=np.int64)
        for batch in chunks(batches, "buckets"):
            whole = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), _kind(draw.buckets))
            total += np.bincount(whole, minlength=draw.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    return run


def counts(bucketed: DataFrame, draw: Draw) -> np.ndarray:
    """How many features each bucket holds: summed up per task, then in Spark; ``buckets`` numbers reach the driver."""
    out = np.zeros(draw.buckets, dtype=np.int64)
    found = bucketed.select("buckets").mapInArrow(_counted(draw), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and corpus, rounded down."""
    n = len(corpus)
    whole, aimed = float(corpus.sum()) + n, float(target.sum()) + n
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * whole / ((s + 1.0) * aimed))) for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of Gumbel noise from the hash of seed and id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(gain: np.ndarray, draw: Draw):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "buckets"):
            found = [np.frombuffer(b, _kind(draw.buckets)) for b in batch.column("buckets").to_pylist()]
            weight = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            score = [w + noise(i, draw.seed) for w, i in zip(weight, batch.column("doc_id").to_pylist(), strict=True)]
            kept = ["doc_id", "row", "n_words", "n_features"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(weight, pa.int64()), pa.array(score, pa.int64())], names=[*kept, "weight", "score"]
            )

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range in their order, with the range's number and theirs in it."""
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        places = pa.array(np.arange(seen + 1, seen + 1 + batch.num_rows), pa.int64())
        seen += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), places], names=[*batch.schema.names, "part", "place"]
        )


def _ranked(scored: DataFrame, draw: Draw, rows_per_range: int) -> DataFrame:
    """The eligible rows with their rank by falling score, then rising id; null beyond the drawn share.

    ``row`` decides between rows of one id and score, so that any number of repeated rows can be dealt to several ranges.
    """
    eligible = scored.where(F.col("n_words") >= draw.min_words)
    n = eligible.count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    # Two ranges at least, so that every size takes the same way.
    ranges = max(2, math.ceil(n / rows_per_range))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema)
    placed = stored(
        eligible.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_numbered, f"{schema}, part int, place long"),
        "places",
    )
    # One row per range, on the driver and broadcast.
    sizes = sorted(tuple(r) for r in placed.groupBy("part").count().collect())
    before = np.cumsum([0, *(size for _, size in sizes)]).tolist()
    offsets = scored.sparkSession.createDataFrame([(part, b) for (part, _), b in zip(sizes, before)], "part int, before long")
    rank = F.col("before") + F.col("place")
    return placed.join(F.broadcast(offsets), "part").select(*scored.columns, F.when(rank <= n * draw.percent // 100, rank).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, draw: Draw = Draw(), carry: tuple[str, ...] = (), rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``, then the columns of ``carry``: one row per row of ``docs``.

    ``rank`` counts the drawn rows from 1 by falling score, ties by rising ``doc_id`` (null last); it is null for the others.
    A null or empty text has no features, weighs 0 and, as any text of less than ``min_words`` words, is never drawn. A null
    ``doc_id`` takes the noise of the empty string. Rows that repeat a ``doc_id`` share their noise, but each counts, weighs and
    is drawn by itself; among rows of equal id and score it is left open which gets which rank. Empty tables
    give an empty result, an empty target no preference. Columns that are not carried are ignored, whatever their names.

    With ``carry`` the corpus is stored once beside its buckets; without it no text leaves the first scan.
    """
    row, text = F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").cast("binary").alias("text")
    # Carried columns are numbered on the way, so that no name can clash.
    carried = [f"__carry_{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row, text, *(F.col(f"`{c}`").alias(name) for c, name in zip(carry, carried))
    )
    if carry:
        rows = stored(rows, "documents")
    bucketed = _bucketed(rows.select("doc_id", "row", "text"), draw)
    aimed = _bucketed(target.select(F.lit(None).cast("long").alias("doc_id"), row, text), draw)
    gain = gains(counts(bucketed, draw), counts(aimed, draw))
    schema = "doc_id long, row long, n_words long, n_features long, weight long, score long"
    scored = stored(bucketed.mapInArrow(_scored(gain, draw), schema), "scores")
    short = scored.where(F.col("n_words") < draw.min_words).withColumn("rank", F.lit(None).cast("long"))
    every = _ranked(scored, draw, rows_per_range).unionByName(short)
    out = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    if not carry:
        return every.select(*out)
    return every.join(rows.select("row", *carried), "row").select(*out, *carried).toDF(*out, *carry)
