"""Approximate nearest neighbours: a forest of random-projection trees searched through one priority queue.

Every tree draws one random direction per level; a node splits at the median of its projections. The medians are fitted on a
bounded sample, then *every* vector is filed under its leaf of every tree. A query walks all trees at once: a
shared queue holds the branches not yet taken, ordered by the squared distance to the planes crossed, and leaves are opened
in that order until ``probes`` leaves are open. What lies in opened leaves is ranked by its exact distance.

Equal vectors are searched as one and expanded at the end, so a hot vector is one row. Leaves larger than a
block are cut into blocks, so no task holds more than a block of vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.llm.rows import stored

TREES = 16
LEAF = 32
PROBES = 1200
#: Distinct vectors that the medians are fitted on, at most (about; twice this in the worst case).
SAMPLE = 65_536
BLOCK = 4096
#: Rows of partial results a task holds before it keeps the nearest of each query only.
_HELD = 400_000


@dataclass(frozen=True)
class Forest:
    directions: np.ndarray  # tree, level, dimension
    medians: np.ndarray  # tree, node; the root is node 1, children of n are 2n and 2n + 1

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, trees: int, leaf: int, seed: int = 7) -> Forest:
        """``rows``: vectors to be filed, which sets the depth as far as the sample has that many leaves."""
        depth = max(0, int(np.ceil(np.log2(max(1, min(rows, len(sample)) / leaf)))))
        directions = np.random.default_rng(seed).normal(size=(trees, depth, sample.shape[1] if len(sample) else 1))
        directions /= np.linalg.norm(directions, axis=2, keepdims=True)
        medians = np.zeros((trees, 1 << depth))
        for t in range(trees):
            node = np.ones(len(sample), dtype=np.int64)
            for level in range(depth):
                p = sample @ directions[t, level]
                order = np.lexsort((p, node))
                nodes = np.arange(1 << level, 2 << level)
                start = np.searchsorted(node[order], nodes)
                end = np.searchsorted(node[order], nodes, side="right")
                medians[t, nodes] = p[order[np.minimum((start + end) // 2, len(sample) - 1)]]
                node = 2 * node + (p >= medians[t, node])
        return cls(directions, medians)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        out = np.ones((len(vectors), len(self.directions)), dtype=np.int64)
        for t in range(out.shape[1]):
            for level in range(self.depth):
                out[:, t] = 2 * out[:, t] + (vectors @ self.directions[t, level] >= self.medians[t, out[:, t]])
        return out

    def search(self, vector: np.ndarray, probes: int) -> list[tuple[int, int]]:
        """(tree, leaf) of the leaves to open, nearest first."""
        p = self.directions @ vector
        queue = [(0.0, t, 1, 0) for t in range(len(p))]
        found = []
        while queue and len(found) < probes:
            cost, t, node, level = heapq.heappop(queue)
            while level < self.depth:
                margin = p[t, level] - self.medians[t, node]
                right = int(margin >= 0)
                level += 1
                heapq.heappush(queue, (cost + margin * margin, t, 2 * node + 1 - right, level))
                node = 2 * node + right
            found.append((t, node))
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _filed(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                leaves = forest.leaves(_matrix(part.column("v")))
                for t in range(leaves.shape[1]):
                    cell = pa.array((t << 32) + leaves[:, t])
                    yield pa.RecordBatch.from_arrays([cell, part.column("id"), part.column("v")], names=["cell", "id", "v"])

    return run


def _asked(forest: Forest, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, vector in enumerate(_matrix(batch.column("v"))):
                cells = [(t << 32) + leaf for t, leaf in forest.search(vector, probes)]
                same = pa.array(np.full(len(cells), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int64()), batch.column("id").take(same), batch.column("v").take(same)],
                    names=["cell", "id", "v"],
                )

    return run


def _nearest_of(query: np.ndarray, found: np.ndarray, distance: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest distinct finds of each query."""
    order = np.lexsort((found, distance, query))
    query, found, distance = query[order], found[order], distance[order]
    new = np.ones(len(query), dtype=bool)
    new[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1])
    query, found, distance = query[new], found[new], distance[new]
    start = np.searchsorted(query, query)
    near = np.arange(len(query)) - start < k
    return query[near], found[near], distance[near]


def _ranked(k: int):
    """Rows come by cell and block; in each the filed vectors stand before the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, held, n_held = None, [], [], [], 0

        def out(parts):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in parts], names=["query", "id", "distance"])

        for batch in batches:
            cell, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block"))
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            number = batch.column("id").to_numpy(zero_copy_only=False)
            matrix = _matrix(batch.column("v"))
            if not len(cell):
                continue
            change = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (asked[1:] != asked[:-1])) + 1
            for start, end in zip([0, *change], [*change, len(cell)], strict=True):
                if (cell[start], block[start]) != key:
                    key, ids, vectors = (cell[start], block[start]), [], []
                if not asked[start]:
                    ids.append(number[start:end])
                    vectors.append(matrix[start:end])
                    continue
                if not ids:
                    continue
                if len(ids) > 1:
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                step = max(1, (1 << 20) // (vectors[0].size or 1))
                for s in range(start, end, step):
                    at = slice(s, min(end, s + step))
                    difference = matrix[at][:, None, :] - vectors[0][None, :, :]
                    distance = np.sqrt((difference * difference).sum(axis=2))
                    n = len(distance)
                    held.append((np.repeat(number[at], len(ids[0])), np.tile(ids[0], n), distance.ravel()))
                    n_held += distance.size
                    if n_held > _HELD:
                        held = [_nearest_of(*map(np.concatenate, zip(*held, strict=True)), k)]
                        n_held = len(held[0][0])
                        if n_held > _HELD // 2:
                            yield out(held[0])
                            held, n_held = [], 0
        if held:
            yield out(_nearest_of(*map(np.concatenate, zip(*held, strict=True)), k))

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: rows with an id and a finite, non-zero vector without nulls, of the length most rows have."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def _top(df: DataFrame, by: str | list[str], order: list[str | Column], k: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(rank) <= k)


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    trees: int = TREES,
    leaf: int = LEAF,
    probes: int = PROBES,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found to each row where ``queries`` (over ``vec_id``) holds.

    An id may stand for several vectors: each is indexed and found at its own distance, and each gives a query with ranks of its own.

    The score is the Euclidean distance in double precision, ties go to the smaller ``vec_id``, and rows with the query's own id
    are left out. Null ids, null or zero vectors, vectors with null or non-finite components or of an
    unusual length take no part. Rows that repeat id and vector count once. Fewer than ``k`` candidates: all of them.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = usable(vectors)
    own = Window.partitionBy("v").orderBy("vec_id")
    # Spark keeps k + 1 ids of a vector in each task before it shuffles, however often the vector occurs.
    kept = (
        rows.withColumn("n", F.dense_rank().over(own)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    )
    # A distinct vector is named by a number of its own, in the order of its smallest id, which decides ties.
    first = F.element_at("ids", 1)
    kept = stored(
        kept.select(first.alias("first"), "v", "ids").repartitionByRange("first", "v").sortWithinPartitions("first", "v")
        .select(F.monotonically_increasing_id().alias("id"), "first", "v", "ids"),
        "distinct-vectors",
    )
    members = kept.select("id", F.explode("ids").alias("vec_id"))
    distinct = kept.select("id", "v")
    count = kept.count()
    share = min(1.0, sample / max(1, count))
    fitted = (
        kept.where(F.pmod(F.xxhash64("first"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample).select("v").toArrow()
    )
    forest = Forest.fit(_matrix(fitted.column("v").combine_chunks()), count, trees, leaf)

    asked_rows = rows.where(queries)
    asked = stored(asked_rows.select("v").distinct().select(F.monotonically_increasing_id().alias("id"), "v"), "query-vectors")
    query_rows = stored(
        asked_rows.join(asked, "v").select(F.col("vec_id").alias("query_id"), F.col("id").alias("query")).distinct(), "query-ids"
    )
    # A query leaves out all vectors of its own id, so as many more are looked for.
    most = query_rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    depth = k + most
    element = kept.schema["v"].dataType.simpleString()
    filed = distinct.mapInArrow(_filed(forest), f"cell long, id long, v {element}")
    # Few bytes but much work: their number of partitions is fixed and not coalesced by size.
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probed = asked.select("id", "v").repartition(partitions, "id").mapInArrow(_asked(forest, probes), f"cell long, id long, v {element}")
    large = filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    large = stored(large.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large-leaves")
    blocks = F.coalesce("blocks", F.lit(1))
    both = (
        filed.join(large, "cell", "left")
        .select("cell", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"), F.lit(False).alias("asked"), "id", "v")
        .unionByName(
            probed.join(large, "cell", "left").select(
                "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(True).alias("asked"), "id", "v"
            )
        )
    )
    near = (
        both.repartition(partitions, "cell", "block")
        .sortWithinPartitions("cell", "block", "asked")
        .mapInArrow(_ranked(depth), "query long, id long, distance double")
        .groupBy("query", "id")
        .agg(F.min("distance").alias("distance"))
    )
    near = _top(near, "query", ["distance", "id"], depth).drop("rank")
    expanded = _top(near.join(members, "id"), "query", ["distance", "vec_id"], depth).drop("rank", "id")
    result = query_rows.join(expanded, "query").where("query_id <> vec_id")
    return _top(result, ["query_id", "query"], ["distance", "vec_id"], k).select(
        "query_id", "rank", "vec_id", F.col("distance").alias("score")
    )
