"""Second-order boosted trees with regularisation, grown level by level over a stored table of binned rows.

Rows are stored once, so what they are made of (a join with learned categories, say) runs once, and cut into quantile bins. Rows that are equal
in bins, categories and label stay equal through all trees, so where many are, they are one row with a count. Per level one pass adds up gradients and
hessians of the logistic loss by node, feature and bin, and by node and learned category; the first level's has the sums of all rows too;
the sums of numeric features (``2 ** depth * features * max_bin`` at most) are compared on the driver, those of learned categories, of
which there may be any number, are stored and compared where they lie, and only the best one per node comes back. Sums are of whole numbers
(fixed point), so trees depend neither on the order of rows nor on retries. Small trees are added to the stored margins as rows are read; once
there are ``PENDING`` splits of them the margins are written anew.

A fitted ensemble is a SQL expression over its input columns, so scoring is a projection.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyglass.functions.expressions import name_sql, text_sql
from tallyglass.session import drop_scratch, scratch_path

#: A split must better the loss by more than this, whatever ``gamma``.
LEAST_GAIN = 1e-6
#: Rank error of the bin bounds, as a share of a bin.
BIN_ACCURACY = 0.05
#: Equal rows become one row with a count where each is there so many times on average.
WORTH_COUNTING = 4
#: Rows with categories are not stored a second time for so few bins to be cut again, over all inputs and levels of trees.
CUT_AGAIN = 8
#: A bin of a feature is coded as ``-1 - feature * BINS - bin``, a category as its index, which is not negative.
BINS = 1 << 16
#: Splits of trees that are not in the stored margins yet, and are evaluated as rows are read.
PENDING = 32


@dataclass(frozen=True)
class Boosting:
    """``subsample`` of the rows and ``colsample`` of the features are drawn for each tree.

    A split gains ``G_l^2 / (H_l + reg_lambda) + G_r^2 / (H_r + reg_lambda) - G^2 / (H + reg_lambda)`` (sums of gradients and hessians,
    ``G`` first moved towards zero by ``reg_alpha``), is made if that exceeds ``gamma`` and leaves hessians of at
    least ``min_child_weight`` on both sides. A leaf weighs ``-learning_rate * G / (H + reg_lambda)``.
    """

    rounds: int = 10
    max_depth: int = 6
    learning_rate: float = 0.1
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    scale_pos_weight: float = 1.0
    max_bin: int = 64
    base_score: float = 0.5
    seed: int = 42


@dataclass(frozen=True)
class Split:
    """Rows for which ``condition`` (SQL) holds go to ``right``; the others, and those where it is null, to ``left``."""

    condition: str
    gain: float
    left: Split | Leaf
    right: Split | Leaf

    def sql(self) -> str:
        return f"if({self.condition}, {self.right.sql()}, {self.left.sql()})"


@dataclass(frozen=True)
class Leaf:
    weight: float

    def sql(self) -> str:
        return f"{self.weight!r}D"


@dataclass(frozen=True)
class Ensemble:
    trees: list[Split | Leaf]
    base: float

    def first(self, rounds: int) -> Ensemble:
        return Ensemble(self.trees[:rounds], self.base)

    def margin_sql(self) -> str:
        return " + ".join([f"{self.base!r}D", *(t.sql() for t in self.trees)])

    def staged(self) -> Column:
        """The margin after each round, as an array."""
        steps = F.expr(f"array({', '.join(t.sql() for t in self.trees)})")
        zero = F.struct(F.lit(self.base).alias("now"), F.array().cast("array<double>").alias("all"))

        def add(state: Column, step: Column) -> Column:
            now = state["now"] + step
            return F.struct(now.alias("now"), F.concat(state["all"], F.array(now)).alias("all"))

        return F.aggregate(steps, zero, add)["all"]

    def with_staged(self, rows: DataFrame, into: str = "staged") -> DataFrame:
        """The rows with ``staged``; a column per tree first, so that Spark compiles them and evaluates each once."""
        steps = {f"__step_{i}": F.expr(t.sql()) for i, t in enumerate(self.trees)}
        sums = [" + ".join([f"{self.base!r}D", *list(steps)[: i + 1]]) for i in range(len(steps))]
        return rows.withColumns(steps).withColumn(into, F.expr(f"CAST(array({', '.join(sums)}) AS array<double>)")).drop(*steps)


def split_conditions(tree: Split | Leaf) -> list[str]:
    return [] if isinstance(tree, Leaf) else [tree.condition, *split_conditions(tree.left), *split_conditions(tree.right)]


@dataclass
class _Node:
    """A node while its tree grows: sums over its rows, then its split."""

    g: float
    h: float
    n: int
    split: tuple | None = None
    children: list[_Node] = field(default_factory=list)


@dataclass(frozen=True)
class _Sums:
    """Of a level: ``node, feature, bin, g, h, n`` of bins, and ``node, cat, g, h, n`` of learned categories as a table stored at ``path``."""

    cells: list[tuple]
    categories: DataFrame | None = None
    path: str | None = None


def _decoded(sums: DataFrame) -> list[tuple]:
    return [(r["node"], *divmod(-1 - r["code"], BINS), r["g"], r["h"], r["n"]) for r in sums.collect()]


def bin_bounds(rows: DataFrame, inputs: Sequence[str], max_bin: int) -> list[list[float]]:
    """Ascending lower bounds of all bins but the first, for each input, from one aggregate over all of them.

    A column of at most ``max_bin`` distinct values, each frequent enough, has a bin for each; a constant one has no bound.
    """
    if not inputs:
        return []
    shares = [i / max_bin for i in range(max_bin + 1)]
    accuracy = math.ceil(max_bin / BIN_ACCURACY)
    found = rows.agg(*[F.percentile_approx(name_sql(c), shares, accuracy).alias(f"b{i}") for i, c in enumerate(inputs)]).first()
    # The least value bounds nothing.
    return [sorted(set(values or []))[1:] for values in found]


def _store(rows: DataFrame, inputs: Sequence[str], cats: str | None, label: str, key: Sequence[str] | None) -> tuple[DataFrame, str, int]:
    """``in_0, in_1, .., cats, y`` of the rows and, if drawn by it, a hash of ``key``, as a stored table; and about how many different rows it has."""
    named = rows.select(
        *[F.col(name_sql(c)).alias(f"in_{i}") for i, c in enumerate(inputs)],
        (F.col(cats) if cats else F.array()).cast("array<bigint>").alias("cats"),
        F.col(label).cast("double").alias("y"),
        *([F.xxhash64(*key).alias("key")] if key else []),
    )
    seen = Observation()
    hashed = F.xxhash64(*[F.col(c) for c in named.columns])
    stored, path = _write(named.observe(seen, F.approx_count_distinct(hashed).alias("different")))
    return stored, path, seen.get["different"]


def _binned(stored: DataFrame, bounds: list[list[float]], base: float) -> DataFrame:
    """``bins, cats, y, key, n, margin``: what the loop reads instead of the rows."""
    cut = [i for i, b in enumerate(bounds) if b]
    rows = stored
    if cut:
        rows = rows.withColumns({f"__in_{i}": F.col(f"in_{i}").cast("double") for i in cut})
        rows = Bucketizer(
            splitsArray=[[-math.inf, *bounds[i], math.inf] for i in cut],
            inputCols=[f"__in_{i}" for i in cut],
            outputCols=[f"__bin_{i}" for i in cut],
        ).transform(rows)
    bins = F.array(*[F.col(f"__bin_{i}").cast("smallint") if b else F.lit(0).cast("smallint") for i, b in enumerate(bounds)])
    kept = [c for c in ("cats", "y", "key") if c in stored.columns]
    return rows.select(bins.cast("array<smallint>").alias("bins"), *kept, F.lit(1).cast("long").alias("n"), F.lit(base).alias("margin"))


def _counted(binned: DataFrame) -> DataFrame:
    """Equal rows as one, ``n`` times."""
    same = [c for c in binned.columns if c != "n"]
    return binned.groupBy(*same).agg(F.sum("n").alias("n")).select(binned.columns)


def _write(df: DataFrame, old: str | None = None) -> tuple[DataFrame, str]:
    """Store the rows of the loop; the former copy goes once the new one is whole."""
    stored, path = _as_table(df)
    if old:
        drop_scratch(df.sparkSession, old)
    return stored, path


def _as_table(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "boosting")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _chance(share: float, *parts) -> Column:
    """True for about ``share`` of the values of ``parts``, by their hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) < int(share * (1 << 30))


def _splits(node: _Node) -> int:
    return 1 + sum(map(_splits, node.children)) if node.split else 0


def margin_of(pending: Sequence[str]) -> Column:
    """The stored margin and what later trees add, in their order."""
    return F.expr(" + ".join(["margin", *pending]))


class _Grower:
    """One tree: its sampled rows and features, and the nodes of the level it is at."""

    def __init__(
        self, rows: DataFrame, bounds: list[list[float]], has_cats: bool, params: Boosting, bits: int, number: int, pending: Sequence[str] = ()
    ):
        self.params, self.bounds, self.has_cats, self.unit = params, bounds, has_cats, float(1 << bits)
        self.number = number
        self.features = self._drawn_features()
        rows = rows.withColumn("margin", margin_of(pending))
        weight = F.when(F.col("y") == 1, params.scale_pos_weight).otherwise(1.0)
        p = 1 / (1 + F.exp(-F.col("margin")))
        drawn = rows.where(_chance(params.subsample, F.col("key"), F.lit(params.seed), F.lit(number))) if params.subsample < 1 else rows
        # Fixed point: sums are exact and the same in any order. Not round, which makes a decimal of each number.
        self.rows = drawn.select(
            "bins",
            "cats",
            (F.rint(weight * (p - F.col("y")) * self.unit).cast("long") * F.col("n")).alias("g"),
            (F.rint(weight * p * (1 - p) * self.unit).cast("long") * F.col("n")).alias("h"),
            "n",
        )

    def _drawn_features(self) -> list[int]:
        usable = [i for i, b in enumerate(self.bounds) if b]
        kept = max(1, round(self.params.colsample * len(usable)))
        rng = np.random.default_rng([self.params.seed, self.number])
        return sorted(rng.permutation(usable)[:kept].tolist()) if usable else []

    def grow(self) -> _Node:
        rows = self.rows.withColumn("node", F.lit(1))
        # Of one feature all bins are added up, which is all rows.
        level_sums = self._sums(rows, self.features[0]) if self.features and self.params.max_depth else None
        if level_sums is None:
            sums = [self.rows.agg(F.sum("g"), F.sum("h"), F.sum("n")).first()]
        else:
            sums = [cell for _, feature, _, *cell in level_sums.cells if feature == self.features[0]]
        g, h, n = (sum(cell[i] or 0 for cell in sums) for i in range(3))
        root = _Node(g / self.unit, h / self.unit, n)
        level = [root]
        for depth in range(self.params.max_depth):
            found = self._best(level_sums or self._sums(rows), level)
            level_sums = None
            for i, (feature, bound, gr, hr, nr, gain) in found.items():
                node = level[i]
                node.split = (feature, bound, gain)
                node.children = [_Node(node.g - gr, node.h - hr, node.n - nr), _Node(gr, hr, nr)]
            if not found:
                break
            if depth + 1 < self.params.max_depth:
                rows = self._routed(rows, level)
            level = [child for node in level for child in node.children]
        return root

    def _routed(self, rows: DataFrame, level: list[_Node]) -> DataFrame:
        """The same rows at the next level: nodes count from 1, rows that are in a leaf have node 0.

        No row is filtered out by its node: a filter would be moved below the steps before and copy them all. The
        numbers of a level are array literals, so one compiled plan serves all trees.
        """
        order = {id(child): i for i, child in enumerate((c for node in level for c in node.children), 1)}
        splits = [(-1, 0, 0, 0), *((*n.split[:2], *(order[id(c)] for c in n.children)) if n.split else (-1, 0, 0, 0) for n in level)]
        feature, bound, left, right = (f"array({', '.join(f'{x}{kind}' for x in column)})[node]" for column, kind in zip(zip(*splits), "LS  "))
        n = len(self.bounds)
        kept = ["bins", "cats", "g", "h", "n"]
        test = f"if(f < {n}L, bins[CAST(f AS INT)] >= {bound}, array_contains(cats, f - {n}L))"
        return rows.selectExpr(*kept, "node", f"{feature} AS f").selectExpr(*kept, f"if(f = -1L, 0, if({test}, {right}, {left})) AS node")

    def weight(self, node: _Node) -> float:
        cover = node.h + self.params.reg_lambda
        return float(-self.params.learning_rate * self._pulled(np.float64(node.g)) / cover) if cover > 0 else 0.0

    def _pulled(self, g: np.ndarray) -> np.ndarray:
        return np.sign(g) * np.maximum(np.abs(g) - self.params.reg_alpha, 0.0)

    def path_sql(self, node: _Node, leaf: Callable[[_Node], str]) -> str:
        """What ``leaf`` says of the node a binned row ends in."""
        if node.split is None:
            return leaf(node)
        feature, bound, _ = node.split
        n = len(self.bounds)
        test = f"bins[{feature}] >= {bound}S" if feature < n else f"array_contains(cats, {feature - n}L)"
        left, right = (self.path_sql(child, leaf) for child in node.children)
        return f"if({test}, {right}, {left})"

    def _best(self, sums: _Sums, level: list[_Node]) -> dict[int, tuple]:
        """For each node of the level that gains by a split: feature, bin, the right side's sums and rows, gain."""
        found = self._best_bins(sums.cells, level) if self.features else {}
        if sums.categories is not None:
            for i, best in self._best_categories(sums.categories, level).items():
                if i not in found or best[-1] > found[i][-1]:
                    found[i] = best
            drop_scratch(sums.categories.sparkSession, sums.path)
        return found

    def _sums(self, rows: DataFrame, whole: int | None = None) -> _Sums:
        """Sums of all bins but the first, which no split needs, of the feature ``whole`` with the first, and of learned categories, from one pass."""
        p, code = self.params, F.col("code")

        def coded(feature: int) -> Column:
            bin_ = F.col("bins")[feature]
            own = (F.lit(-1 - feature * BINS) - bin_).cast("long")
            return own if feature == whole else F.when(bin_ > 0, own)

        codes = F.array(*map(coded, self.features)).cast("array<bigint>")
        asked = code.isNotNull()
        if self.has_cats:
            codes = F.concat(codes, F.coalesce("cats", F.array().cast("array<bigint>")))
            if p.colsample < 1:
                asked &= (code < 0) | _chance(p.colsample, code, F.lit(p.seed), F.lit(self.number))
        sums = (
            rows.select("node", "g", "h", "n", F.explode(codes).alias("code"))
            .where(asked)
            .groupBy("node", "code")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
        )
        if not self.has_cats:
            return _Sums(_decoded(sums))
        stored, path = _as_table(sums)
        cells = _decoded(stored.where(code < 0)) if self.features else []
        return _Sums(cells, stored.where(code >= 0).withColumnRenamed("code", "cat"), path)

    def _best_bins(self, cells: list, level: list[_Node]) -> dict[int, tuple]:
        width = 1 + max(len(self.bounds[i]) for i in self.features)
        sums = np.zeros((3, len(level), len(self.bounds), width), dtype=np.int64)
        for node, feature, bin_, *cell in cells:
            if node:
                sums[:, node - 1, feature, bin_] = cell
        # Right of a bound lies everything from its bin on.
        right = sums[:, :, :, ::-1].cumsum(axis=-1)[:, :, :, ::-1]
        found = {}
        for i, node in enumerate(level):
            gr, hr, nr = right[0, i] / self.unit, right[1, i] / self.unit, right[2, i]
            gain = self._gain(node, gr, hr)
            gain[(nr == 0) | (nr == node.n)] = -np.inf
            gain[:, 0] = -np.inf
            at = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[at] > max(self.params.gamma, LEAST_GAIN):
                found[i] = (int(at[0]), int(at[1]), float(gr[at]), float(hr[at]), int(nr[at]), float(gain[at]))
        return found

    def _gain(self, node: _Node, gr: np.ndarray, hr: np.ndarray) -> np.ndarray:
        p, gl, hl = self.params, node.g - gr, node.h - hr

        def part(g, h):
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(h + p.reg_lambda > 0, self._pulled(np.asarray(g, dtype=float)) ** 2 / (h + p.reg_lambda), 0.0)

        gain = part(gl, hl) + part(gr, hr) - part(node.g, node.h)
        return np.where((hl >= p.min_child_weight) & (hr >= p.min_child_weight), gain, -np.inf)

    def _best_categories(self, sums: DataFrame, level: list[_Node]) -> dict[int, tuple]:
        """The same for learned categories: rows that have one against all others. One row per node comes back."""
        p, cat = self.params, F.col("cat")

        def of(values: list, kind: str) -> Column:
            """A number of each node of the level; rows in leaves have none."""
            return F.expr(f"array(0{kind}, {', '.join(f'{v!r}{kind}' for v in values)})[node]")

        def part(g: Column, h: Column) -> Column:
            pulled = F.greatest(F.abs(g) - p.reg_alpha, F.lit(0.0))
            return F.coalesce(F.try_divide(pulled * pulled, h + p.reg_lambda), F.lit(0.0))

        g, h, gr, hr = of([n.g for n in level], "D"), of([n.h for n in level], "D"), F.col("gr"), F.col("hr")
        split = (
            sums.select("node", "cat", "n", (F.col("g") / self.unit).alias("gr"), (F.col("h") / self.unit).alias("hr"))
            .where((hr >= p.min_child_weight) & (h - hr >= p.min_child_weight) & (F.col("n") < of([n.n for n in level], "L")))
            .select("node", "cat", "gr", "hr", "n", (part(g - gr, h - hr) + part(gr, hr) - part(g, h)).alias("gain"))
            .where(F.col("gain") > max(p.gamma, LEAST_GAIN))
            # The lowest category of equals.
            .groupBy("node")
            .agg(F.max(F.struct("gain", (-cat).alias("cat"), "gr", "hr", "n")).alias("best"))
            .select("node", "best.*")
        )
        return {r["node"] - 1: (len(self.bounds) - r["cat"], 1, r["gr"], r["hr"], r["n"], r["gain"]) for r in split.collect()}


def boost(
    rows: DataFrame,
    inputs: Sequence[str],
    label: str,
    key: Sequence[str],
    params: Boosting = Boosting(),
    cats: str | None = None,
    categories: DataFrame | None = None,
) -> Ensemble:
    """Trees for ``label`` (0 or 1) from numeric ``inputs`` without nulls and, if given, categories.

    ``cats`` is an array of the indices of a row's categories; ``categories(index, column, category)`` says what they mean, and is asked for the
    ones that trees use only. ``key`` identifies a row for sampling. Without rows every tree is a leaf of weight 0.
    """
    base = math.log(params.base_score / (1 - params.base_score))
    drawn = params.subsample < 1
    stored, stored_path, different = _store(rows, inputs, cats, label, key if drawn else None)
    bounds = bin_bounds(stored, [f"in_{i}" for i in range(len(inputs))], params.max_bin)
    count = stored.count()
    if cats is None:
        different = min(different, 2 * math.prod(len(b) + 1 for b in bounds))
    binned = _binned(stored, bounds, base)
    counted = not drawn and different * WORTH_COUNTING <= count
    # Narrow rows of a few files would be read by as few tasks.
    least = rows.sparkSession.sparkContext.defaultParallelism
    dealt = not counted and stored.rdd.getNumPartitions() >= least
    if not dealt:
        binned = (_counted(binned) if counted else binned).repartition(least)
    cuts = params.rounds * params.max_depth * sum(map(bool, bounds))
    state, path = (binned, stored_path) if dealt and cats and cuts <= CUT_AGAIN else _write(binned, stored_path)
    spread = max(1.0, params.scale_pos_weight)
    bits = min(40, 62 - math.ceil(math.log2((count + 1) * spread)))
    grown, pending, splits = [], [], 0
    for number in range(params.rounds):
        grower = _Grower(state, bounds, cats is not None, params, bits, number, pending)
        root = grower.grow()
        grown.append((grower, root))
        pending.append(grower.path_sql(root, lambda node: f"{grower.weight(node)!r}D"))
        splits += max(1, _splits(root))
        if splits > PENDING and number + 1 < params.rounds:
            state, path = _write(state.withColumn("margin", margin_of(pending)), path)
            pending, splits = [], 0
    drop_scratch(rows.sparkSession, path)
    names = _category_names([root for _, root in grown], len(inputs), categories)

    def condition(feature: int, bound: int) -> str:
        if feature < len(inputs):
            return f"{name_sql(inputs[feature])} >= {bounds[feature][bound - 1]!r}D"
        column, category = names[feature - len(inputs)]
        return f"CAST({name_sql(column)} AS STRING) = {text_sql(category)}"

    def tree(grower: _Grower, node: _Node) -> Split | Leaf:
        if node.split is None:
            return Leaf(grower.weight(node))
        feature, bound, gain = node.split
        return Split(condition(feature, bound), gain, *(tree(grower, child) for child in node.children))

    return Ensemble([tree(*both) for both in grown], base)


def _category_names(roots: list[_Node], inputs: int, categories: DataFrame | None) -> dict[int, tuple[str, str]]:
    """Column and category of the indices that splits use: one per split at most."""

    def used(node: _Node) -> set[int]:
        own = {node.split[0] - inputs} if node.split and node.split[0] >= inputs else set()
        return own.union(*(used(child) for child in node.children))

    wanted = sorted(set().union(*map(used, roots)))
    if not wanted:
        return {}
    spark = categories.sparkSession
    asked = spark.createDataFrame([(i,) for i in wanted], "index long")
    return {r["index"]: (r["column"], r["category"]) for r in categories.join(F.broadcast(asked), "index").collect()}
