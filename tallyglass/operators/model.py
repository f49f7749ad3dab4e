"""Training, saving and applying the boosted-tree classifier."""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.config import REGULARISED, Settings
from tallyglass.functions.expressions import decide, in_test_share
from tallyglass.operators.boosting import Boosting, Ensemble, boost
from tallyglass.operators.curves import best_f1, pr_curve, rank_scores, roc_auc, roc_auc_by
from tallyglass.operators.encode import category_index, distinct_categories, with_category_indices, with_label
from tallyglass.operators.scale import fit_scaler
from tallyglass.operators.split import train_test_split
from tallyglass.session import durable, one_row, shared_dir
from tallyglass.sinks.commits import append
from tallyglass.sinks.metrics import metric_rows
from tallyglass.sources.predictions import read_or_none

INFO_SCHEMA = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("version", T.StringType()),
        T.StructField("last_updated", T.DateType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("best_f1", T.DoubleType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("folder", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("number", T.LongType()),
    ]
)

CATEGORY_SCHEMA = "index long, column string, category string"


@dataclass(frozen=True)
class Model:
    """A fitted pipeline, the threshold tuned on its test rows, and what describes it."""

    pipeline: PipelineModel
    threshold: float
    info: dict
    #: Learned categories and their indices, if there are any.
    categories: DataFrame | None = None

    def score(self, df: DataFrame) -> DataFrame:
        return score(self.pipeline, df)

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.score(df)
        return scored.withColumn("prediction", decide(F.col("probability"), self.threshold))


def _inputs(settings: Settings) -> list[str]:
    return [f"in_{i}" for i in range(len(settings.feature_columns))]


def _prepared(train: DataFrame, settings: Settings) -> SQLTransformer:
    """Fill and scale, with statistics of the training rows."""
    scaler = fit_scaler(train, settings.scaled_columns, settings.fill_value)
    prepared = [
        f"{scaler.sql(c, float(settings.fill_value))} AS {name}"
        for c, name in zip(settings.feature_columns, _inputs(settings))
    ]
    return SQLTransformer(statement=f"SELECT {', '.join(['*', *prepared])} FROM __THIS__")


def training_pipeline(train: DataFrame, settings: Settings, rounds: int) -> Pipeline:
    """Fill, scale, assemble and boost. All of it is saved together, so a scoring job cannot
    prepare its rows differently from the training job."""
    trees = GBTClassifier(
        featuresCol="inputs",
        labelCol=settings.label_column,
        predictionCol="class",
        lossType="logistic",
        maxDepth=settings.max_depth,
        stepSize=settings.learning_rate,
        maxIter=rounds,
        subsamplingRate=settings.subsample,
        featureSubsetStrategy=str(settings.colsample_bytree),
        seed=settings.random_seed,
    )
    trees.setProbabilityCol("class_probability").setRawPredictionCol("raw")
    if settings.early_stopping_tol is not None:
        trees.setParams(validationIndicatorCol="is_test", validationTol=settings.early_stopping_tol)
    return Pipeline(
        stages=[
            _prepared(train, settings),
            VectorAssembler(inputCols=_inputs(settings), outputCol="inputs"),
            trees,
        ]
    )


def score(pipeline: PipelineModel, df: DataFrame) -> DataFrame:
    """The given columns and ``probability``; ids stay on their rows."""
    regularised = isinstance(pipeline.stages[-1], SQLTransformer)
    positive = F.col("boosted_probability") if regularised else vector_to_array("class_probability")[1]
    return pipeline.transform(df).select(*df.columns, positive.alias("probability"))


def _with_test_flag(df: DataFrame, settings: Settings) -> DataFrame:
    """All rows; the trees themselves leave flagged ones out and watch the loss on them."""
    test = in_test_share(settings.key_columns, settings.test_size, settings.random_seed)
    return df.withColumn("is_test", test)


def best_rounds(losses: list[float], patience: int) -> int:
    """Rounds up to the least loss before ``patience`` rounds in a row brought no lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


@dataclass(frozen=True)
class _Boosted:
    """The fitted pipeline, its number of trees, ``eval_metric`` on the test rows after each round if watched, learned categories."""

    pipeline: PipelineModel
    trees: int
    watched: tuple[float, ...] = ()
    categories: DataFrame | None = None


def auc_by_round(staged: DataFrame, label: str) -> list[float]:
    """Exact AUC after every round, from one ranking of all rounds' scores. ``staged``: an array of margins, one per round.

    0.5 where a class is absent: no round is better than another.
    """
    rows = staged.select(F.col(label), F.posexplode("staged").alias("round", "margin"))
    found = {r["round"]: r["auc"] for r in roc_auc_by(rows, "round", "margin", label).collect()}
    return [0.5 if found[i] is None else found[i] for i in sorted(found)]


def loss_by_round(staged: DataFrame, label: str) -> list[float]:
    """Mean logistic loss after every round."""
    rows = staged.select(F.col(label).cast("double").alias("y"), F.posexplode("staged").alias("round", "m"))
    m = F.col("m")
    # Stable for margins of either sign.
    loss = F.greatest(m, F.lit(0.0)) - m * F.col("y") + F.log1p(F.exp(-F.abs(m)))
    return [r["loss"] for r in rows.groupBy("round").agg(F.avg(loss).alias("loss")).orderBy("round").collect()]


def _staged(trees, prepared: DataFrame) -> DataFrame:
    """The margin of Spark's trees after each round, from one pass: every tree adds a column."""
    margin, margins = F.lit(0.0), []
    for i, (tree, weight) in enumerate(zip(trees.trees, trees.treeWeights)):
        prepared = tree.setPredictionCol(f"__tree_{i}").transform(prepared)
        margin = margin + weight * F.col(f"__tree_{i}")
        margins.append(margin)
    return prepared.withColumn("staged", F.array(*margins))


def _boosted(train: DataFrame, test: DataFrame, labelled: DataFrame, settings: Settings) -> _Boosted:
    """Spark's trees."""
    rows = train if settings.early_stopping_tol is None else _with_test_flag(labelled, settings)
    fitted = training_pipeline(train, settings, settings.boosting_rounds).fit(rows)
    trees = fitted.stages[-1]
    if settings.early_stopping_rounds is None:
        return _Boosted(fitted, trees.getNumTrees)
    prepared = PipelineModel(fitted.stages[:-1]).transform(test)
    if settings.eval_metric == "auc":
        watched = auc_by_round(_staged(trees, prepared), settings.label_column)
    else:
        watched = list(trees.evaluateEachIteration(prepared))
    rounds = kept_rounds(watched, settings)
    # Trees are added one after the other from a fixed seed, so fewer rounds give the first of them again.
    if rounds < len(watched):
        fitted = training_pipeline(train, settings, rounds).fit(rows)
    return _Boosted(fitted, rounds, tuple(watched))


def kept_rounds(watched: list[float], settings: Settings) -> int:
    """Rounds up to the best ``eval_metric``; a high AUC is good, a high loss is not."""
    signed = [-x for x in watched] if settings.eval_metric == "auc" else watched
    return best_rounds(signed, settings.early_stopping_rounds) if signed else 0


def _regularised(train: DataFrame, test: DataFrame, settings: Settings) -> _Boosted:
    """Second-order trees, written into the pipeline as SQL, with learned categories among their inputs."""
    prepare = _prepared(train, settings)
    rows, cats, categories = prepare.transform(train), None, None
    if settings.learned_columns:
        categories = durable(category_index(distinct_categories(train, settings.learned_columns)))
        rows, cats = with_category_indices(rows, settings.learned_columns, categories, "__cats"), "__cats"
    params = Boosting(
        settings.boosting_rounds, settings.max_depth, settings.learning_rate, settings.reg_lambda, settings.reg_alpha, settings.gamma,
        settings.min_child_weight, settings.subsample, settings.colsample_bytree, settings.scale_pos_weight, settings.max_bin,
        settings.base_score, settings.random_seed,
    )
    ensemble = boost(rows, _inputs(settings), settings.label_column, settings.key_columns, params, cats, categories)
    watched = []
    if settings.early_stopping_rounds is not None and ensemble.trees:
        staged = ensemble.with_staged(prepare.transform(test))
        by_round = auc_by_round if settings.eval_metric == "auc" else loss_by_round
        watched = by_round(staged, settings.label_column)
        if watched:
            ensemble = ensemble.first(kept_rounds(watched, settings))
    return _Boosted(PipelineModel([prepare, _as_stage(ensemble)]), len(ensemble.trees), tuple(watched), categories)


def _as_stage(ensemble: Ensemble) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, 1D / (1D + exp(-({ensemble.margin_sql()}))) AS boosted_probability FROM __THIS__")


def train_model(features: DataFrame, settings: Settings) -> Model:
    """Fit on the training share, tune the threshold on the rest.

    ``features`` is read several times (statistics, split candidates, binned rows) and should be
    a stored table rather than a plan of joins.
    """
    shared_dir(features.sparkSession)
    label = settings.label_column
    labelled = with_label(features, label).withColumn(label, F.col(label).cast("double"))
    train, test = train_test_split(
        labelled, settings.key_columns, settings.test_size, settings.random_seed
    )
    spark_trees = settings.booster == "spark"
    boosted = _boosted(train, test, labelled, settings) if spark_trees else _regularised(train, test, settings)
    ranked = rank_scores(score(boosted.pipeline, test), "probability", label)
    best = best_f1(pr_curve(ranked)).first()
    auc = roc_auc(ranked).first().auc
    threshold = best.best_threshold if best else settings.prediction_threshold
    in_test = in_test_share(settings.key_columns, settings.test_size, settings.random_seed)
    rows = labelled.agg(F.count(F.lit(1)).alias("all"), F.count_if(in_test).alias("test")).first()
    params = {
        "max_depth": settings.max_depth,
        "learning_rate": settings.learning_rate,
        "objective": settings.objective,
        "subsample": settings.subsample,
        "colsample_bytree": settings.colsample_bytree,
        "eval_metric": settings.eval_metric,
        "seed": settings.random_seed,
        # What was asked for, and what was run.
        "n_estimators": settings.n_estimators,
        "boosting_rounds": settings.boosting_rounds,
        "early_stopping_tol": settings.early_stopping_tol,
        "early_stopping_rounds": settings.early_stopping_rounds,
        "trees_built": boosted.trees,
        "train_rows": rows["all"] - rows["test"],
        "test_rows": rows["test"],
    }
    if not spark_trees:
        params |= {name: getattr(settings, name) for name in REGULARISED if name != "learned_columns"}
    watched = "auc" if settings.eval_metric == "auc" else "loss"
    info = {
        "model_type": "GBTClassifier" if spark_trees else "second-order boosted trees",
        "features": model_features(settings),
        "threshold": float(threshold),
        "version": settings.model_version,
        "last_updated": settings.as_of,
        "auc": auc,
        "best_f1": best.best_f1 if best else None,
        "params": {k: str(v) for k, v in params.items()} | {f"{watched}_{i + 1}": str(x) for i, x in enumerate(boosted.watched)},
    }
    return Model(boosted.pipeline, float(threshold), info, boosted.categories)


def model_features(settings: Settings) -> list[str]:
    """Columns a model takes in."""
    return [*settings.feature_columns, *settings.learned_columns]


def _digest(spark: SparkSession, folder: str) -> str | None:
    """A hash of the names and contents of a model's files; None if there are none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    name = F.regexp_extract("path", r"/versions/(.*)$", 1)
    lines = files.select(F.concat_ws(" ", name, F.sha2("content", 256)).alias("line"))
    # A model has a few dozen files.
    return lines.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n").cast("binary"), 256)).first()[0]


def save_model(spark: SparkSession, model: Model, path: str) -> int:
    """A folder of its own for the pipeline, then a numbered commit that describes it, names the folder and has a hash of its files.

    Scoring goes through the newest whole one, so a model is replaced at once or not at all, and of two that are
    saved at a time each gets a number of its own, which is returned.
    """
    folder = f"versions/{uuid.uuid4().hex}"
    model.pipeline.write().save(f"{path}/{folder}")
    if model.categories is not None:
        model.categories.write.parquet(f"{path}/{folder}/categories")
    return append(spark, f"{path}/info", dict(model.info) | {"folder": folder, "digest": _digest(spark, f"{path}/{folder}")})


def _known(spark: SparkSession, path: str) -> DataFrame | None:
    return read_or_none(spark, f"{path}/info", INFO_SCHEMA, f"{path}/info", "json")


def model_info(spark: SparkSession, path: str) -> DataFrame | None:
    """Type, features, threshold, version, date and parameters of the newest model; None if there is none."""
    known = _known(spark, path)
    return known.orderBy(F.desc("number")).limit(1) if known is not None else None


def load_model(spark: SparkSession, path: str, *fallbacks: str) -> Model | None:
    """The newest whole model below ``path``, or else below the first of the ``fallbacks`` that has one; None if there is none at all.

    A version whose files are not those it was committed with is passed over with a warning, and named in ``info["passed_over"]``.
    """
    passed_over = []
    for root in (path, *fallbacks):
        known = _known(spark, root)
        # A row per version.
        for row in known.orderBy(F.desc("number")).collect() if known is not None else []:
            folder = f"{root}/{row.folder}"
            if row.digest is None or _digest(spark, folder) != row.digest:
                warnings.warn(f"model {row.number} below {root} is damaged", stacklevel=2)
                passed_over.append(f"{root}#{row.number}")
                continue
            info = row.asDict() | {"root": root, "passed_over": passed_over}
            categories = read_or_none(spark, f"{folder}/categories", CATEGORY_SCHEMA, f"{folder}/categories")
            return Model(PipelineModel.load(folder), info["threshold"], info, categories)
    return None


def training_metrics(spark: SparkSession, model: Model) -> DataFrame:
    """Long-form log of a training run, for the metric history: quality, and every parameter that is a number."""
    info = model.info
    logged = {"auc": info["auc"], "best_f1": info["best_f1"], "best_threshold": info["threshold"]}
    for name, value in info["params"].items():
        try:
            logged[name if name.startswith(("loss_", "auc_")) else f"param_{name}"] = float(value)
        except ValueError:
            continue
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in logged])
    return metric_rows(one_row(spark, {k: F.lit(v) for k, v in logged.items()}, schema))
