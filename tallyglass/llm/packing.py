"""Packing of tokenized documents into sequences of fixed length, by exact-complement hashing.

Packing depends on lengths alone, and there are at most ``capacity`` of them. So documents are tokenized where they lie, and only the
histogram of piece lengths (at most 2,048 rows, whatever the corpus) is planned on the driver:

* lengths are taken from the longest; for the gap it leaves, a single length, a pair or a triple that fills it
  exactly is looked up among the lengths still available, and as many sequences as the counts allow are made;
* where no combination is exact, the longest length that fits goes in (best fit), and the rest of the gap is tried again.

The plan says which ranks of each length go where; every piece finds its place from its rank. Ranks come from
per-task counts, so no length, however frequent, is gathered in one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, stored

CAPACITY = 2048
END = 0
VOCABULARY = "byte_bpe_50k.json"


@lru_cache(maxsize=1)
def _encoders(path: str):
    """The tokenizer of a vocabulary file and, where the same vocabulary lies beside it as ranks, its faster equal."""
    import os

    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    ranks = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return slow, None
    import tiktoken

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return slow, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


def encode(text: str, vocabulary: str) -> list[int]:
    """Ids of the vocabulary's tokenizer without added special tokens."""
    slow, fast = _encoders(public_tokenizers.path(vocabulary))
    # Only the tokenizer itself knows the strings of special tokens; very long white space is its matter too.
    if fast is not None and "<|" not in text and " " * 10_000 not in text:
        return fast.encode_ordinary(text)
    return slow.encode(text, add_special_tokens=False).ids


def _piece_rows(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in chunks(batches):
            out = []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text.decode("utf-8", "replace"), vocabulary) if text else []
                ids.append(END)
                bytes_ = np.array(ids, dtype="<u4").tobytes()
                start, piece = 0, 0
                while start < len(ids):
                    length = (len(ids) - start) % capacity or capacity
                    out.append((row, piece, start, length, int(seen[length]), bytes_[4 * start : 4 * (start + length)]))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            row, piece, start, length, nth, ids = zip(*out, strict=True) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([task] * len(out), pa.int64()), pa.array(nth, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids", "task", "nth"],
            )

    return run


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit) and the piece's place in its task.

    A document is its tokens and id 0. A longer one than ``capacity`` is cut; its first piece is the short one.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        _piece_rows(vocabulary, capacity), "doc_id long, piece int, start long, length long, ids binary, task long, nth long"
    )


def _exact(gap: int, have: np.ndarray) -> list[int] | None:
    """One, two or three available lengths (``have``: counts by length) that fill a gap, the longest first."""
    if gap < len(have) and have[gap]:
        return [gap]
    here = have[: gap + 1] > 0
    pair = _pair(gap, have, here)
    if pair:
        return pair
    for first in np.flatnonzero(here)[::-1]:
        rest = gap - int(first)
        if 3 * first < gap:
            break
        have[first] -= 1
        pair = _pair(rest, have, have[: rest + 1] > 0) if rest > 1 else None
        have[first] += 1
        if pair:
            return [int(first), *pair]
    return None


def _pair(gap: int, have: np.ndarray, here: np.ndarray) -> list[int] | None:
    if gap < 2:
        return None
    both = here[: gap + 1] & here[gap::-1]
    both[0] = both[gap] = False
    if gap % 2 == 0 and have[gap // 2] < 2:
        both[gap // 2] = False
    found = np.flatnonzero(both)
    return [int(found[-1]), gap - int(found[-1])] if len(found) else None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths that share a sequence) and how many sequences follow each; uses every count up."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    patterns = []
    for longest in range(capacity, 0, -1):
        while have[longest]:
            pattern, gap = [longest], capacity - longest
            have[longest] -= 1
            while gap:
                fill = _exact(gap, have)
                if not fill:
                    fits = np.flatnonzero(have[1 : gap + 1])
                    if not len(fits):
                        break
                    fill = [int(fits[-1]) + 1]
                for length in fill:
                    have[length] -= 1
                    gap -= length
                pattern += fill
            used = np.bincount(pattern, minlength=capacity + 1)
            # The pattern once, and as often again as all its lengths allow.
            again = int((have[used > 0] // used[used > 0]).min())
            have -= used * again
            patterns.append((pattern, 1 + again))
    return patterns


def _ranges(patterns: list[tuple[list[int], int]]) -> np.ndarray:
    """For each item of each pattern: length, first rank, first sequence, offset; by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 4)


def _placed(ranges: np.ndarray, columns: list[str]):
    keys = (ranges[:, 0] << 48) + ranges[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(ranges[at, 2] + rank - ranges[at, 1]), pa.array(ranges[at, 3])],
                names=[*columns, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids``: one row per piece.

    Rows of a ``sequence_id`` lie one after the other from offset 0 and hold at most ``capacity`` tokens.
    A null or empty text is the end id alone. A null or repeated ``doc_id`` is carried along; each row is a
    document of its own. Extra columns are ignored, whatever their names; an empty table gives an empty result.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    cut = stored(
        pieces(docs, vocabulary, capacity).withColumn("ids_crc32", F.crc32("ids")).select(*columns, "task", "nth"), "pieces"
    )
    by_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(first, ["task", "length"]).withColumn("rank", F.col("first") + F.col("nth")).select(*columns, "rank")
    types = {f.name: f.dataType.simpleString() for f in ranked.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in columns) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_placed(_ranges(plan(counts, capacity)), columns), schema)
