"""Second-order trees against closed forms and brute force; early stopping; learned categories."""

import datetime as dt
import json
import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyglass.config import Settings
from tallyglass.operators import boosting
from tallyglass.operators.boosting import Boosting, Leaf, bin_bounds, boost, split_conditions
from tallyglass.operators.curves import rank_scores, roc_auc, roc_auc_by
from tallyglass.operators.encode import category_index, distinct_categories, with_category_indices
from tallyglass.operators.model import auc_by_round, best_rounds, kept_rounds, load_model, loss_by_round, save_model, train_model
from tallyglass.session import scratch_path

# Six rows of one feature; at margin 0 each has gradient 0.5 - y and hessian 0.25.
ROWS = [(1.0, 0), (2.0, 0), (3.0, 0), (4.0, 1), (5.0, 1), (6.0, 0)]
STUMP = Boosting(rounds=1, max_depth=1, learning_rate=1.0, reg_lambda=0.0, min_child_weight=0.0)


def grown(spark, params, rows=ROWS):
    df = spark.createDataFrame([(i, x, float(y)) for i, (x, y) in enumerate(rows)], "id long, x double, y double")
    return boost(df, ["x"], "y", ["id"], params).trees


@pytest.mark.parametrize(
    ("change", "bound", "left", "right"),
    [
        # Best cut: x >= 4. Left G = 1.5, H = 0.75; right G = -0.5, H = 0.75.
        ({}, 4.0, -2.0, 2 / 3),
        ({"learning_rate": 0.5}, 4.0, -1.0, 1 / 3),
        # Gains with lambda 1: 1.5^2/1.75 + 0.25/1.75 - 1/2.5 at 4; less elsewhere.
        ({"reg_lambda": 1.0}, 4.0, -1.5 / 1.75, 0.5 / 1.75),
        # Alpha moves G = 1.5 to 1.2 and G = -0.5 to -0.2.
        ({"reg_alpha": 0.3}, 4.0, -1.2 / 0.75, 0.2 / 0.75),
        # The hessian of each side must be 1 at least: four rows, so x >= 5 (left G = 1, H = 1; right G = 0, H = 0.5) is out too.
        ({"min_child_weight": 0.75}, 4.0, -2.0, 2 / 3),
        # Positive rows weigh double: right G = -1.5, H = 1.25.
        ({"scale_pos_weight": 2.0}, 4.0, -2.0, 1.5 / 1.25),
    ],
)
def test_keys_by_hand(spark, change, bound, left, right):
    tree = grown(spark, replace(STUMP, **change))[0]
    assert tree.condition == f"`x` >= {bound!r}D"
    assert (tree.left.weight, tree.right.weight) == (pytest.approx(left), pytest.approx(right))


def test_splits_that_are_not_worth_it(spark):
    # The best gain is 1.5^2/0.75 + 0.25/0.75 - 1/1.5 = 2.6667; a leaf of all rows weighs -1/1.5.
    assert not isinstance(grown(spark, replace(STUMP, gamma=2.66))[0], Leaf)
    for change in ({"gamma": 2.67}, {"min_child_weight": 1.0}, {"max_depth": 0}):
        tree = grown(spark, replace(STUMP, **change))[0]
        assert isinstance(tree, Leaf) and tree.weight == pytest.approx(-1 / 1.5)


def test_base_score_is_the_first_margin(spark):
    p = 0.2
    tree = grown(spark, replace(STUMP, base_score=p, max_depth=0))[0]
    assert tree.weight == pytest.approx(-(6 * p - 2) / (6 * p * (1 - p)))


def brute_tree(rows, margins, params, depth):
    """Nested (feature, bound, left, right) or a weight, from all cuts at all values."""
    g = [1 / (1 + math.exp(-m)) - y for (*_, y), m in zip(rows, margins)]
    h = [1 / (1 + math.exp(-m)) * (1 - 1 / (1 + math.exp(-m))) for m in margins]

    def grow(at, depth):
        score = lambda idx: sum(g[i] for i in idx) ** 2 / (sum(h[i] for i in idx) + params.reg_lambda)
        best = None
        for f in range(len(rows[0]) - 1) if depth else []:
            for bound in sorted({rows[i][f] for i in at})[1:]:
                right = [i for i in at if rows[i][f] >= bound]
                left = [i for i in at if rows[i][f] < bound]
                if min(sum(h[i] for i in s) for s in (left, right)) < params.min_child_weight:
                    continue
                gain = score(left) + score(right) - score(at)
                if gain > max(params.gamma, 1e-6) and (best is None or gain > best[0] + 1e-12):
                    best = (gain, f, bound, left, right)
        if best is None:
            return -params.learning_rate * sum(g[i] for i in at) / (sum(h[i] for i in at) + params.reg_lambda)
        return best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1)

    return grow(list(range(len(rows))), depth)


def weigh(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] >= tree[1] else tree[2]
    return tree


def test_deep_trees_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(*(float(rng.randint(0, 9)) for _ in range(3)), int(rng.random() < 0.5)) for _ in range(400)]
    rows = [(a, b, c, int(a + b * c / 9 > 9) if rng.random() < 0.9 else y) for a, b, c, y in rows]
    params = Boosting(rounds=3, max_depth=3, learning_rate=0.4, reg_lambda=1.0, min_child_weight=2.0, gamma=0.1)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, a double, b double, c double, y int")
    model = boost(df, ["a", "b", "c"], "y", ["id"], params)
    margins = [0.0] * len(rows)
    stages = []
    for _ in range(params.rounds):
        tree = brute_tree(rows, margins, params, params.max_depth)
        margins = [m + weigh(tree, r) for m, r in zip(margins, rows)]
        stages.append(margins)
    found = df.select("id", F.expr(model.margin_sql()).alias("m"), model.staged().alias("staged")).orderBy("id").collect()
    assert [r["m"] for r in found] == pytest.approx(margins)
    for k, want in enumerate(stages):
        assert [r["staged"][k] for r in found] == pytest.approx(want)
    # Another dealing of the rows gives the very same trees.
    assert boost(df.repartition(5, "c"), ["a", "b", "c"], "y", ["id"], params) == model


def test_rows_and_columns_are_drawn_per_tree(spark):
    df = spark.range(4000).select(
        "id", *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10)).cast("double").alias(f"x{k}") for k in range(4)]
    ).withColumn("y", (F.col("x0") + F.col("x1") + F.col("x2") + F.col("x3") > 18).cast("int"))
    inputs = [f"x{k}" for k in range(4)]
    params = Boosting(rounds=4, max_depth=3, colsample=0.5, subsample=0.5)
    trees = boost(df, inputs, "y", ["id"], params).trees
    used = [{c.split("`")[1] for c in split_conditions(t)} for t in trees]
    assert all(1 <= len(u) <= 2 for u in used) and len(set().union(*used)) > 2
    assert trees == boost(df, inputs, "y", ["id"], params).trees
    assert trees != boost(df, inputs, "y", ["id"], replace(params, seed=1)).trees


def written(monkeypatch):
    """The rows of every table that ``boost`` stores from now on, as they are when it is written."""
    counts, write = [], boosting._write

    def counting(df, old=None):
        table, path = write(df, old)
        counts.append(table.count())
        return table, path

    monkeypatch.setattr(boosting, "_write", counting)
    return counts


def test_equal_rows_are_stored_once_and_small_trees_are_not_written(spark, monkeypatch):
    df = spark.range(3000).select(
        "id", *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(4)).cast("double").alias(f"x{k}") for k in range(2)]
    ).withColumn("y", (F.col("x0") + F.col("x1") + F.pmod("id", F.lit(2)) > 3).cast("int"))
    params = Boosting(rounds=4, max_depth=2)
    counts = written(monkeypatch)
    model = boost(df, ["x0", "x1"], "y", ["id"], params)
    assert counts[0] == 3000 and len(counts) == 2 and counts[1] <= 4 * 4 * 2
    # Rows by themselves, and a margin written after each tree, give the very same trees.
    monkeypatch.setattr(boosting, "WORTH_COUNTING", math.inf)
    monkeypatch.setattr(boosting, "PENDING", 0)
    counts.clear()
    assert boost(df, ["x0", "x1"], "y", ["id"], params) == model
    assert counts == [3000] * 5


def test_trees_that_wait_are_those_that_are_written(spark, monkeypatch):
    """Sampled rows, drawn columns and categories; rows that differ are not counted."""
    df = spark.range(2000).select(
        "id",
        *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)).cast("double").alias(f"x{k}") for k in range(3)],
        F.array(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(5))).alias("cats"),
    ).withColumn("y", (F.col("x0") + F.col("x1") > 40 + 9 * F.col("cats")[0]).cast("int"))
    index = spark.createDataFrame([(i, "shop", str(i)) for i in range(5)], "index long, column string, category string")
    for sampling in ({}, {"subsample": 0.7, "colsample": 0.7}):
        params = Boosting(rounds=3, max_depth=2, learning_rate=0.5, **sampling)
        with monkeypatch.context() as patched:
            counts = written(patched)
            models = []
            for pending in (32, 0):
                patched.setattr(boosting, "PENDING", pending)
                models.append(boost(df, ["x0", "x1", "x2"], "y", ["id"], params, "cats", index))
        assert models[0] == models[1] and set(counts) == {2000}


def test_rows_are_made_once(spark):
    """What the rows are made of, the join with learned categories for one, runs once, however often trees read them."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(500).select("id", (F.col("id") % 9).cast("double").alias("x"), F.concat(F.lit("c"), F.col("id") % 13).alias("c"))
    rows = rows.withColumn("y", (F.col("id") % 13 < 4).cast("int")).mapInArrow(counted, "id long, x double, c string, y int")
    index = spark.createDataFrame([(i, "c", f"c{i}") for i in range(13)], "index long, column string, category string")
    # Shuffled, as rows are that are joined with many categories.
    encoded = with_category_indices(rows.repartition(3, "c"), ["c"], index, "cats")
    model = boost(encoded, ["x"], "y", ["id"], Boosting(rounds=2, max_depth=1), "cats", index)
    assert made.value == 500 and len(model.trees) == 2


def test_a_level_reads_its_rows_once(spark, monkeypatch):
    """Sums of bins and of learned categories come from one pass; few bins are cut again instead of stored again, with the same trees."""
    tables, write = [], boosting._write

    def counting(df, old=None):
        table, path = write(df, old)
        tables.append(spark.sparkContext.accumulator(0))

        def counted(batches, read=tables[-1]):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        return table.mapInArrow(counted, table.schema), path

    df = spark.range(900).select("id", (F.col("id") % 90).cast("double").alias("x"), F.array(F.col("id") % 300, F.lit(300)).alias("cats"))
    df = df.withColumn("y", ((F.col("id") % 300 == 7) | (F.col("x") > 40)).cast("int"))
    index = spark.createDataFrame([(i, "shop", str(i)) for i in range(301)], "index long, column string, category string")
    params = Boosting(rounds=3, max_depth=1)
    models = []
    for files, cut_again, stored in ((1, 8, 2), (16, 8, 1), (16, 2, 2)):
        with monkeypatch.context() as patched:
            patched.setattr(boosting, "_write", counting)
            patched.setattr(boosting, "CUT_AGAIN", cut_again, raising=False)
            tables.clear()
            models.append(boost(df.repartition(files), ["x"], "y", ["id"], params, "cats", index))
        # Of rows that are stored once, the bounds and the number are asked first.
        assert [t.value for t in tables][-1] == 900 * (3 if stored == 2 else 5) and len(tables) == stored
    assert models[0] == models[1] == models[2] and len(models[0].trees) == 3
    # A row without an array has no category; its bins count.
    bare = df.withColumn("cats", F.when(F.col("id") % 3 > 0, F.col("cats")))
    empty = df.withColumn("cats", F.when(F.col("id") % 3 > 0, F.col("cats")).otherwise(F.array().cast("array<bigint>")))
    assert boost(bare, ["x"], "y", ["id"], params, "cats", index) == boost(empty, ["x"], "y", ["id"], params, "cats", index)


def test_gradients_make_no_decimals(spark):
    """Spark rounds doubles through decimals and their text, which took most of a pass."""
    state = spark.createDataFrame([([1], [0], 1.0, 0.0, 2), ([0], [], 0.0, 0.3, 1)], "bins array<smallint>, cats array<bigint>, y double, margin double, n long")
    rows = boosting._Grower(state, [[0.5]], True, Boosting(), 20, 0).rows
    assert "round(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    p = 1 / (1 + math.exp(-0.3))
    assert [tuple(r) for r in rows.select("g", "h").collect()] == [(-(2**20), 2**19), (round(p * 2**20), round(p * (1 - p) * 2**20))]


def test_staged_margins_are_plain_columns(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 7 + i % 5 > 5)) for i in range(200)], "id long, a double, b double, y double")
    model = boost(df, ["a", "b"], "y", ["id"], Boosting(rounds=4, max_depth=2))
    staged = model.with_staged(df)
    assert staged.columns == [*df.columns, "staged"]
    assert staged.withColumn("old", model.staged()).where("staged != old").count() == 0
    assert "lambda" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert boosting.Ensemble([], 0.5).with_staged(df).first().staged == []


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "id long, x double, y double")
    assert boost(empty, ["x"], "y", ["id"], STUMP).trees[0].sql() in ("0.0D", "-0.0D")
    same = grown(spark, STUMP, [(1.0, 1)] * 5)
    assert isinstance(same[0], Leaf) and same[0].weight == pytest.approx(2.0)
    df = spark.createDataFrame([(float(i),) for i in range(5)] * 20, "x double")
    assert bin_bounds(df, ["x"], 64) == [[1.0, 2.0, 3.0, 4.0]]
    assert len(bin_bounds(spark.range(10_000).select(F.col("id").cast("double").alias("x")), ["x"], 16)[0]) in (15, 16)


def brute_auc(pairs):
    won = [1.0 if a > b else 0.5 if a == b else 0.0 for a, y in pairs if y for b, z in pairs if not z]
    return sum(won) / len(won) if won else None


def test_auc_of_all_groups_at_once(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.choice([0.1, 0.2, 0.5, rng.random()]), rng.randint(0, 1)) for _ in range(500)]
    rows += [("one class", 0.3, 1), ("a", None, 1), ("a", float("nan"), 0), ("b", 0.5, None), (None, 0.5, 1)]
    df = spark.createDataFrame(rows, "g string, probability double, label int")
    want = {g: brute_auc([(s, y) for k, s, y in rows if k == g and s is not None and s == s and y is not None]) for g in ("a", "b", "c", "one class")}
    for size in (100_000, 20):
        found = {r["g"]: r["auc"] for r in roc_auc_by(df, "g", scores_per_range=size).collect()}
        assert found == {g: None if x is None else pytest.approx(x) for g, x in want.items()}
    assert want["a"] == pytest.approx(roc_auc(rank_scores(df.where("g = 'a'"))).first().auc)


def test_the_kept_round_is_that_of_the_best_auc(spark):
    rng = random.Random(9)
    rows = [([rng.random() + 0.3 * y * (k < 3) for k in range(6)], y) for y in [0, 1] * 60]
    staged = spark.createDataFrame(rows, "staged array<double>, y int")
    want = [brute_auc([(s[k], y) for s, y in rows]) for k in range(6)]
    found = auc_by_round(staged, "y")
    assert found == pytest.approx(want)
    for patience in (1, 2, 6):
        assert kept_rounds(found, Settings(early_stopping_rounds=patience)) == best_rounds([-x for x in want], patience)
    losses = [sum(math.log1p(math.exp(-s[k] if y else s[k])) for s, y in rows) / len(rows) for k in range(6)]
    assert loss_by_round(staged, "y") == pytest.approx(losses)


# --- through the settings ---

BASE = Settings(feature_columns=("a", "b"), numerical_columns=("a",), label_column="y", key_columns=("id",), boosting_rounds=4, max_depth=2)


@pytest.fixture(scope="module")
def labelled(spark):
    """A number, and a shop of six of which two decide the label."""
    path = scratch_path(spark, "labelled")
    rows = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id"), F.lit(100)).cast("double")).alias("a"),
        F.lit(1.0).alias("b"),
        F.when(F.col("id") % 70 != 0, F.concat(F.lit("shop '"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(6)))).alias("shop"),
        F.when(F.col("id") % 11 != 0, F.lit(7)).alias("kind"),
    )
    hot = F.pmod(F.substring("shop", 7, 3).cast("int"), F.lit(3)) == 0
    rows.withColumn("y", (F.coalesce(hot, F.lit(False)) | (F.col("a") > 90)).cast("int")).write.parquet(path)
    return spark.read.parquet(path)


def test_early_stopping_by_auc_in_both_kinds_of_trees(labelled):
    for booster in ("spark", "gbtree"):
        settings = replace(BASE, booster=booster, early_stopping_rounds=1, learning_rate=0.9, boosting_rounds=5)
        for metric, name in (("auc", "auc"), ("logloss", "loss")):
            model = train_model(labelled, replace(settings, eval_metric=metric))
            params = model.info["params"]
            watched = [float(params[f"{name}_{i}"]) for i in range(1, 6)]
            signed = [-x for x in watched] if metric == "auc" else watched
            assert int(params["trees_built"]) == best_rounds(signed, 1)
            if metric == "auc":
                assert model.info["auc"] == pytest.approx(watched[int(params["trees_built"]) - 1], abs=1e-9)


def test_learned_categories_are_model_inputs(spark, labelled):
    plain = replace(BASE, booster="gbtree", boosting_rounds=3, max_depth=4, learning_rate=1.0)
    settings = replace(plain, learned_columns=("shop", "kind"))
    without, model = train_model(labelled, plain), train_model(labelled, settings)
    assert model.info["auc"] > 0.97 > without.info["auc"]
    assert model.info["features"] == ["a", "b", "shop", "kind"]
    assert {tuple(r) for r in model.categories.select("column").distinct().collect()} == {("shop",), ("kind",)}
    path = scratch_path(spark, "model")
    save_model(spark, model, path)
    again = load_model(spark, path)
    strange = labelled.withColumn("shop", F.lit("never seen")).withColumn("id", -F.col("id"))
    rows = labelled.unionByName(strange).unionByName(labelled.withColumn("shop", F.lit(None).cast("string")).withColumn("id", F.col("id") + 10_000))
    assert again.score(rows).exceptAll(model.score(rows)).count() == 0
    assert again.categories.exceptAll(model.categories).count() == model.categories.exceptAll(again.categories).count() == 0
    # An unknown category scores as a null one does.
    scores = again.score(rows).groupBy(F.abs(F.col("id")) % 10_000).agg(F.collect_set(F.when((F.col("id") < 0) | (F.col("id") >= 10_000), F.col("probability"))).alias("p"))
    assert scores.where(F.size("p") > 1).count() == 0
    assert again.predict(rows).where("probability NOT BETWEEN 0 AND 1 OR prediction IS NULL").count() == 0


def test_a_hundred_thousand_categories(spark):
    """Each names two rows; every tenth category is positive, but for one that half of all rows have."""
    n = 100_000
    rows = spark.range(3 * n).select(
        "id",
        F.lit(0.0).alias("x"),
        F.when(F.col("id") < 2 * n, F.concat(F.lit("c"), F.col("id") % n)).otherwise("frequent").alias("c"),
        ((F.col("id") < 2 * n) & (F.col("id") % n % 10 == 0)).cast("int").alias("y"),
    )
    path = scratch_path(spark, "categories")
    category_index(distinct_categories(rows, ["c"]), per_range=7_000).write.parquet(path)
    index = spark.read.parquet(path)
    found = index.agg(F.count("*").alias("n"), F.min("index").alias("a"), F.max("index").alias("b"), F.count_distinct("index").alias("d")).first()
    assert (found["n"], found["a"], found["b"], found["d"]) == (n + 1, 0, n, n + 1)
    assert [r["category"] for r in index.orderBy("index").limit(3).collect()] == ["c0", "c1", "c10"]
    encoded = with_category_indices(rows, ["c"], index, "cats")
    assert encoded.count() == 3 * n and encoded.where(F.size("cats") != 1).count() == 0
    model = boost(encoded, ["x"], "y", ["id"], Boosting(rounds=2, max_depth=2, learning_rate=1.0, min_child_weight=0.0, reg_lambda=0.0), "cats", index)
    assert model.trees[0].condition == "CAST(`c` AS STRING) = 'frequent'"
    # Of the rest the first positive category is the best next split, as all gain the same.
    assert model.trees[0].left.condition == "CAST(`c` AS STRING) = 'c0'"


def test_keys_are_honoured_or_refused(tmp_path, labelled):
    config = tmp_path / "c.json"

    def read(document):
        config.write_text(json.dumps(document))
        return Settings.from_json(config)

    assert read({"max_depth": 2}).booster == "spark"
    settings = read({"lambda": 3, "gamma": 0.5, "min_child_weight": 2, "eta": 0.3, "learned_columns": ["shop"]})
    assert (settings.booster, settings.reg_lambda, settings.gamma, settings.learning_rate) == ("gbtree", 3, 0.5, 0.3)
    assert settings.learned_columns == ("shop",)
    for wrong, name in (
        ({"booster": "spark", "reg_lambda": 2}, "reg_lambda"), ({"tree_method": "exact"}, "tree_method"), ({"eval_metric": "map"}, "map"),
        ({"booster": "dart"}, "dart"), ({"gamma": -1}, "negative"), ({"base_score": 1.5}, "base_score"),
        ({"gamma": 1, "early_stopping_tol": 0.1}, "early_stopping_tol"),
    ):
        with pytest.raises(ValueError, match=name):
            read(wrong)
    heavy = train_model(labelled, replace(BASE, booster="gbtree", gamma=1e9, boosting_rounds=1))
    assert heavy.score(labelled).select("probability").distinct().count() == 1
    assert heavy.info["params"]["gamma"] == "1000000000.0" and heavy.info["model_type"] == "second-order boosted trees"
    assert dt.date.fromisoformat(str(heavy.info["last_updated"])) == BASE.as_of
