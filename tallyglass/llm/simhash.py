"""Near-duplicates by 64-bit SimHash fingerprints, compared bit-sliced.

Fingerprints are grouped by value first, so copies are one row from then on. Two fingerprints with at most
three differing bits agree on two of five bit blocks, which gives ten groupings; inside a group the bit planes
are stored vertically, 64 fingerprints to a machine word, and one pass over the planes updates 64 distances at
a time with carry-save counters. A block of 64 whose distances all exceed the radius is abandoned early.
Large groups are cut into cells that together hold every pair. A cell gives a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.components import components
from tallyglass.llm.rows import chunks, identified, stored

RADIUS = 3
SHINGLE = 3
#: Fingerprints of a group that one cell takes from each of its two parts.
CELL = 2048
#: Blocks compared at a time.
_BLOCKS = 1 << 17
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the text's shingles; no words: zero."""
    words = text.lower().split() if text else []  # bytes: only A-Z and ASCII white space are touched
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(n)), dtype="<u8", count=n
    )
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprint_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint's 64 bits as a signed long)."""
    return identified(docs).mapInArrow(_fingerprint_rows(shingle), "doc_id long, text_hash long, fp long")


def _masks(radius: int) -> list[int]:
    """Masks of all choices of two among ``radius + 2`` bit blocks: close fingerprints agree on one of them."""
    edges = np.linspace(0, 64, radius + 3).astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def links_within(groups: list[np.ndarray], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each of several groups of fingerprints.

    All groups are laid out in one set of bit planes, each from a machine word of its own on. A block is one
    fingerprint against the 64 of one word of its group.
    """
    sizes = np.array([len(g) for g in groups])
    widths = -(-sizes // 64)
    first_word = np.cumsum(widths) - widths
    group = np.repeat(np.arange(len(groups)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = np.concatenate(groups)
    padded = np.zeros(widths.sum() * 64, dtype=np.uint64)
    padded[first_word[group] * 64 + place] = values
    planes = np.stack(
        [np.packbits((padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little").view("<u8") for b in range(64)]
    )
    blocks = widths[group]
    last = np.cumsum(blocks)
    near = np.zeros(last[-1], dtype=np.uint64)
    for start in range(0, len(near), _BLOCKS):
        block = np.arange(start, min(len(near), start + _BLOCKS))
        q = np.searchsorted(last, block, side="right")
        w = first_word[group[q]] + block - (last[q] - blocks[q])
        # counters[i] holds bit i of 64 distances at once; over: the distance has passed the radius.
        counters = [np.zeros(len(q), dtype=np.uint64) for _ in range((radius + 1).bit_length())]
        over = np.zeros(len(q), dtype=np.uint64)
        for b in range(64):
            carry = planes[b, w] ^ (np.uint64(0) - (values[q] >> np.uint64(b) & np.uint64(1)))
            for level in range(len(counters)):
                counters[level], carry = counters[level] ^ carry, counters[level] & carry
            over |= _equals(counters, radius + 1)
            if b % 8 == 7:
                live = over != _FULL
                if not live.all():
                    block, q, w, over = block[live], q[live], w[live], over[live]
                    counters = [c[live] for c in counters]
                    if not len(q):
                        break
        near[block] = ~over
    # A fingerprint is always near itself, and padding may look near; neither is a link.
    own = last - blocks + place // 64
    near[own] &= ~(np.uint64(1) << (place % 64).astype(np.uint64))
    found = []
    first = np.concatenate([[0], np.cumsum(sizes * widths)])
    for i in np.flatnonzero(np.add.reduceat(near != 0, first[:-1])):
        members = groups[i]
        for a, c in _forest(near[first[i] : first[i + 1]].reshape(sizes[i], widths[i]), int(sizes[i])):
            found.append((members[a], members[c]))
    return found


def _equals(counters: list[np.ndarray], value: int) -> np.ndarray:
    out = np.full(len(counters[0]), _FULL)
    for level, c in enumerate(counters):
        out &= c if value >> level & 1 else ~c
    return out


def _forest(adjacent: np.ndarray, n: int) -> list[tuple[int, int]]:
    unseen = np.packbits(np.arange(adjacent.shape[1] * 64) < n, bitorder="little").view("<u8").copy()
    links = []
    for root in np.flatnonzero(adjacent.any(axis=1)).tolist():
        if not int(unseen[root // 64]) >> (root % 64) & 1:
            continue
        unseen[root // 64] &= ~np.uint64(1 << root % 64)
        todo = [root]
        while todo:
            node = todo.pop()
            new = adjacent[node] & unseen
            if new.any():
                unseen &= ~new
                found = np.flatnonzero(np.unpackbits(new.view(np.uint8), bitorder="little")).tolist()
                links += [(node, x) for x in found]
                todo += found
    return links


def _cell_links(radius: int):
    """Links of each cell; cells come sorted, one after the other, and are compared in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, ready, size = None, [], [], 0

        def out() -> pa.RecordBatch:
            at = np.array(links_within(ready, radius), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("grouping", "key", "i", "j")]
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fps):
                continue
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, end in zip([0, *change], [*change, len(fps)], strict=True):
                here = tuple(int(c[start]) for c in columns)
                if here != key and parts:
                    ready.append(np.concatenate(parts))
                    size += len(ready[-1]) * -(-len(ready[-1]) // 64)
                    parts = []
                    if size >= _BLOCKS:
                        yield out()
                        ready, size = [], 0
                key = here
                parts.append(fps[start:end])
        if parts:
            ready.append(np.concatenate(parts))
        if ready:
            yield out()

    return run


def links(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that connect all within ``radius`` bits."""
    masks = _masks(radius)
    keyed = distinct.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("grouping"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                    for i, m in enumerate(masks)
                ]
            )
        ).alias("g"),
    ).select("fp", "g.*")
    # Aggregates are stored before they are joined, here and below: both sides are then shuffled, and a hot key can be split over tasks.
    sizes = stored(keyed.groupBy("grouping", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key-sizes")
    parts = F.ceil(F.col("n") / cell).cast("int")
    cells = (
        keyed.join(sizes, ["grouping", "key"])
        .select("grouping", "key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"))
        .select("grouping", "key", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("grouping", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp")
    )
    # The rows are few bytes but much work, so their number of partitions is fixed and not coalesced by size.
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        cells.repartition(partitions, "grouping", "key", "i", "j")
        .sortWithinPartitions("grouping", "key", "i", "j")
        .mapInArrow(_cell_links(radius), "a long, b long")
        .distinct()
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def classes(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest ``doc_id`` that links of at most ``radius`` bits lead to.

    A null text has no words, hence fingerprint zero, and is linked like any other. Rows repeated in full are
    both returned. A null ``doc_id`` is never the smallest unless its component has no other. Extra columns are
    ignored; an empty table gives an empty result.
    """
    return _labelled(docs, radius, shingle).drop("text_hash")


def _labelled(docs: DataFrame, radius: int, shingle: int) -> DataFrame:
    rows, labels = _rows_and_labels(docs, radius, shingle)
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id")


def _rows_and_labels(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of each row, and of each fingerprint ``root`` (of its component) and ``component_id``."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    found = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "roots")
    smallest = stored(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    return rows, rooted.join(smallest, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The documents whose ``doc_id`` is the smallest of their component, with all their columns.

    A document without an id stays (nothing could name it as a copy). Rows are judged by their own text: of
    rows that repeat an id those stay that are in a component whose smallest id is theirs.
    """
    gone = _labelled(docs, radius, shingle).where("doc_id <> component_id")
    gone = gone.select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash")).distinct()
    same = (docs["doc_id"] == gone["__doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["__text_hash"])
    return docs.join(gone, same, "left_anti")


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """Exactly one row of each component, with all its columns: smallest ``doc_id``, nulls last, then text hash.

    Of rows equal in both, the one with the least hash of all columns stays (columns with maps aside, which have no
    hash), so a file that was read twice, or a text that is stored many times without an id, is left once. An empty table gives an empty result.
    """
    rows, labels = _rows_and_labels(docs, radius, shingle)
    # Columns are numbered on the way, so that no name can clash.
    names, docs = docs.columns, docs.toDF(*(f"__in_{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"__in_{names.index(c)}") for c in ("doc_id", "text"))
    identity = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    # Rows equal in id and text are one row from here on.
    counted = rows.groupBy("fp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    placed = stored(counted.join(labels.select("fp", "root"), "fp").select("root", "doc_id", "text_hash", "n"), "identities")
    first = stored(placed.groupBy("root").agg(F.min(identity).alias("first")), "firsts")
    judged = stored(
        placed.join(first, "root").select(
            F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash"), "n", (identity == F.col("first")).alias("stays")
        ).where("n > 1 or not stays"),
        "judged",
    )
    same = doc_id.cast("long").eqNullSafe(F.col("__doc_id")) & (F.xxhash64(text.cast("string")) == F.col("__text_hash"))
    single = docs.join(judged, same, "left_anti")
    repeated = judged.where("stays")
    if repeated.isEmpty():
        return single.toDF(*names)
    # Partial aggregation leaves one row of a task however many copies it reads.
    hashed = [F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row = F.struct(*docs.columns)
    kept = (
        docs.join(repeated, same)
        .groupBy("__doc_id", "__text_hash")
        .agg(F.min_by(row, F.xxhash64(*hashed)).alias("__row"))
        .select(*(F.col("__row")[c].alias(c) for c in docs.columns))
    )
    return single.unionByName(kept).toDF(*names)
