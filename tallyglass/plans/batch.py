"""The batch job: features, snapshot, train or reuse a model, score, write predictions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tallyglass.config import VOCABULARY, Settings
from tallyglass.operators.encode import align
from tallyglass.operators.features import engineer_features
from tallyglass.operators.model import Model, load_model, model_features, save_model, train_model, training_metrics
from tallyglass.sinks.metrics import log_metrics
from tallyglass.sinks.tables import save_predictions, save_snapshot
from tallyglass.sources.snapshots import read_snapshot
from tallyglass.sources.tables import last_days, normalise_user, read_market, read_user


def yesterday_features(spark: SparkSession, settings: Settings) -> DataFrame:
    day = settings.as_of - dt.timedelta(days=1)
    return stored_features(spark, settings, day, day)


def training_window(spark: SparkSession, settings: Settings, days: int = 30) -> DataFrame:
    return stored_features(spark, settings, *last_days(settings.as_of, days))


def stored_features(spark: SparkSession, settings: Settings, start: dt.date, end: dt.date) -> DataFrame:
    """Features of the stored market and user tables in a date range."""
    market = read_market(spark, settings.market_data_path, settings.as_of, start, end)
    user = read_user(spark, settings.user_data_path, settings.as_of, start, end)
    return engineer_features(market, user, settings, VOCABULARY)


def all_stored_features(spark: SparkSession, settings: Settings) -> DataFrame:
    """Features of the whole stored tables."""
    market = spark.read.parquet(settings.market_data_path)
    user = normalise_user(spark.read.parquet(settings.user_data_path))
    market = market.withColumn("date", market.date.cast("date"))
    return engineer_features(market, user, settings, VOCABULARY)


def model_frame(features: DataFrame, settings: Settings) -> DataFrame:
    """Keys, configured features, columns of learned categories and the label, if there is one. Nulls stay; the saved pipeline
    fills them."""
    ids = [c for c in (*settings.key_columns, "stock_id") if c in features.columns]
    label = [settings.label_column] if settings.label_column in features.columns else []
    return align(features, [*settings.feature_columns, *label], [*ids, *settings.learned_columns])


def train_or_load(
    frame: DataFrame, settings: Settings, store: str, retrain: bool = False
) -> tuple[Model, DataFrame]:
    """The saved model, or one trained now; and the frame to go on with.

    Training reads its rows several times, so they are first stored as a snapshot, and the caller
    continues from exactly that snapshot instead of repeating the joins behind it. A saved model that wants other
    features than the settings name is an error unless ``retrain`` replaces it.
    """
    spark = frame.sparkSession
    path = f"{store}/{settings.model_prefix}"
    model = None if retrain else load_model(spark, path, *settings.model_fallbacks)
    if model is not None:
        if list(model.info["features"]) != model_features(settings):
            raise ValueError("the saved model has other feature columns; retrain it")
        return model, frame
    stamp = f"{settings.as_of:%Y%m%d}_000000"
    save_snapshot(frame, f"{store}/snapshots", stamp)
    stored = read_snapshot(spark, f"{store}/snapshots", stamp)
    model = train_model(stored, settings)
    save_model(spark, model, path)
    log_metrics(
        training_metrics(spark, model),
        f"{store}/metrics",
        f"train-{stamp}",
        dt.datetime.combine(settings.as_of, dt.time()),
    )
    return model, stored


def run_batch(
    features: DataFrame, settings: Settings, store: str, scoring: DataFrame | None = None, retrain: bool = False
) -> str:
    """Score ``scoring`` (by default the training frame itself) and return the prediction root."""
    model, frame = train_or_load(model_frame(features, settings), settings, store, retrain)
    rows = frame if scoring is None else model_frame(scoring, settings)
    return save_predictions(model.predict(rows).drop("date"), f"{store}/predictions", settings.as_of)
