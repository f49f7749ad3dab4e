"""Removal of long word sequences that occur more than once, on a compacted De Bruijn graph.

Edges of the graph are windows of ``window`` consecutive words (35 unless said otherwise); nodes are their overlaps. Neighbouring
edges that have the same *anchor* (the smallest hash of the short k-mers inside a window) form a path, cut
only by the words themselves, so equal stretches of text give equal paths wherever they lie. Then:

1. every document is turned into its paths, one row each instead of one row per word;
2. paths are counted. A path that occurs twice is repeated as a whole. If an anchor has one distinct path
   only, the graph does not branch there and nothing else is to be done;
3. where it branches, or a path runs in a loop, one occurrence of each distinct path is opened, at its source coordinates, into its
   single windows, and these are counted, each as often as its path occurs;
4. repeated windows are joined back to their coordinates, merged, and cut out of the texts.

Equal windows always have equal anchors, so no repeat is missed, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.rows import chunks, identified, join_rows, stored

WINDOW = 35
ANCHOR_WORDS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ANCHOR_BASE = np.uint64(0xD1342543DE82EF95)


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse (modulo 2**64) for i up to n."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    both = []
    for b in (base, inverse):
        steps = np.full(n + 1, b, dtype=np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


class _Sums:
    """Hashes of any stretch of a word sequence, from running sums of a polynomial modulo 2**64."""

    def __init__(self, words: np.ndarray, base: np.uint64):
        power, self.inverse = _powers(base, len(words))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:-1], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _loops(path: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """1 for every path that passes through one of its windows twice, as in periodic text."""
    own = _mixed(windows + path.astype(np.uint64) * _BASE)
    found = np.zeros(path[-1] + 1, dtype=np.int64)
    ordered = np.sort(own)
    if (ordered[1:] == ordered[:-1]).any():
        _, back, times = np.unique(own, return_inverse=True, return_counts=True)
        found[path[times[back] > 1]] = 1
    return found


def _paths_of(texts: list[bytes | None], window: int, k: int) -> tuple[np.ndarray, ...]:
    """row, anchor, path hash and span of every path in these texts.

    A span packs the first word, whether the path loops, and the number of windows.
    """
    split = [t.split() if t else [] for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    hashes = _word_hashes([w for words in split for w in words])
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none, none
    first = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(split)), counts)
    starts = np.arange(len(hashes) - window + 1)
    inside = row[starts] == row[starts + window - 1]
    at = np.arange(len(hashes) - k + 1)
    anchors = _sliding_min(_Sums(hashes, _ANCHOR_BASE).of(at, at + k), window - k + 1)
    begins = inside.copy()
    begins[1:] &= ~(inside[:-1] & (anchors[1:] == anchors[:-1]))
    # A window inside one text that follows a window across two texts begins a path as well.
    begin = np.flatnonzero(begins)
    if not len(begin):
        return none, none, none, none
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    n = np.flatnonzero(ends) - begin + 1
    sums = _Sums(hashes, _BASE)
    path = _mixed(sums.of(begin, begin + n + window - 1) + n.astype(np.uint64))
    loops = _loops(np.repeat(np.arange(len(begin)), n), sums.of(np.flatnonzero(inside), np.flatnonzero(inside) + window))
    # Start and length both lie below 2**31, since a text has fewer bytes.
    span = ((begin - first[row[begin]]) << 32) | (loops << 31) | n
    return row[begin], anchors[begin].view(np.int64), path.view(np.int64), span


def _path_rows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            row, anchor, path, span = _paths_of(batch.column("text").to_pylist(), window, k)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(anchor),
                    pa.array(path),
                    pa.array(span),
                ],
                names=["doc_id", "text_hash", "anchor", "path", "span"],
            )

    return run


def _window_rows(window: int):
    """The single windows of the given paths of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            parts = []
            for text, spans, anchors, paths, counts in zip(
                *(batch.column(c).to_pylist() for c in ("text", "spans", "anchors", "paths", "counts")), strict=True
            ):
                sums = _Sums(_word_hashes(text.split()), _BASE)
                span = np.array(spans, dtype=np.int64)
                n = span & 0x7FFFFFFF
                which = np.repeat(np.arange(len(n)), n)
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = (span >> 32)[which] + offset
                parts.append(
                    [
                        np.array(anchors, dtype=np.int64)[which],
                        sums.of(start, start + window).view(np.int64),
                        np.array(paths, dtype=np.int64)[which],
                        offset,
                        np.array(counts, dtype=np.int64)[which],
                    ]
                )
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)],
                    names=["anchor", "window", "path", "offset", "n"],
                )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            total, gone, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = text.split() if text else []
                removed = 0
                if spans:
                    span = np.array(spans, dtype=np.int64)
                    start, n = span >> 32, span & 0x7FFFFFFF
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n + window - 1, -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    removed = int(covered.sum())
                    words_kept = [words[i] for i in np.flatnonzero(~covered)]
                else:
                    words_kept = words
                total.append(len(words))
                gone.append(removed)
                kept.append(b" ".join(words_kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "text"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: each text without the words of repeated windows.

    A word goes if any window over it occurs anywhere else, in the same text or another; the words left are
    joined by one space. Words are runs of bytes other than space and \\t to \\r.

    A null or empty text has no words and stays empty. A text below ``window`` words keeps all. Rows repeated
    in full are occurrences like any other, so each removes the other's windows. A null ``doc_id`` is a
    document of its own. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    docs = identified(docs)
    paths = stored(
        docs.mapInArrow(
            _path_rows(window, anchor_words), "doc_id long, text_hash long, anchor long, path long, span long"
        ),
        "paths",
    )
    distinct = paths.groupBy("anchor", "path").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "span")).alias("source")
    )
    anchors = distinct.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n_paths"),
        F.min("n").alias("fewest"),
        F.max(F.shiftright("source.span", 31).bitwiseAND(1)).alias("loops"),
    )
    # What occurs once under an anchor of its own is not repeated; most of a corpus ends here.
    known = stored(
        distinct.join(anchors.where("n_paths > 1 or fewest > 1 or loops = 1"), "anchor").select(
            "anchor", "path", "n", "source", F.expr("fewest = 1 and (n_paths > 1 or loops = 1)").alias("branches")
        ),
        "repeated-paths",
    )
    whole = (
        paths.join(known.where("n > 1").select("anchor", "path"), ["anchor", "path"], "left_semi")
        .select("doc_id", "text_hash", "span")
    )
    opened = (
        known.where("branches")
        .select("anchor", "path", "n", "source.*")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("span", "anchor", "path", "n")).alias("l"))
        .select(
            "doc_id", "text_hash", F.col("l.span").alias("spans"), F.col("l.anchor").alias("anchors"),
            F.col("l.path").alias("paths"), F.col("l.n").alias("counts"),
        )
    )
    # Rows equal in id and text open a path twice; it counts twice already, so nothing changes.
    windows = stored(
        join_rows(docs, opened)
        .select("text", "spans", "anchors", "paths", "counts")
        .mapInArrow(_window_rows(window), "anchor long, window long, path long, offset long, n long"),
        "windows",
    )
    # Stored, so that the join shuffles both sides itself and a hot window can be split over tasks.
    repeated = stored(
        windows.groupBy("anchor", "window").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "window"),
        "repeated-windows",
    )
    single = (
        windows.where("n = 1")
        .join(repeated, ["anchor", "window"], "left_semi")
        .join(known.where("n = 1").select("anchor", "path", "source"), ["anchor", "path"])
        .select(
            "source.doc_id", "source.text_hash",
            (F.shiftleft(F.shiftright("source.span", 32) + F.col("offset"), 32) + 1).alias("span"),
        )
    )
    # A set: rows equal in id and text bring the same spans. Stored, so that the join can split the rows of such a text over tasks.
    spans = stored(whole.unionByName(single).groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans")), "spans")
    return (
        join_rows(docs, spans, "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, text binary")
        .withColumn("text", F.col("text").cast("string"))
    )
