"""Joining market and user rows and deriving features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyglass.config import VOCABULARY, Settings
from tallyglass.functions import expressions as X
from tallyglass.operators.encode import align, one_hot
from tallyglass.operators.skew import salted_join

KEYS = ("user_id", "date")


def join_market_user(
    market: DataFrame, user: DataFrame, keys: Sequence[str] = KEYS, hot_share: float | None = None
) -> DataFrame:
    """Inner equi-join, many market rows per user row allowed.

    The join strategy and the splitting of skewed partitions are left to adaptive execution;
    ``hot_share`` salts keys above that share of the market rows explicitly.
    """
    if hot_share is not None:
        return salted_join(market, user, keys, hot_share)
    return market.join(user, list(keys), "inner")


def add_market_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price_momentum": X.price_momentum(),
            "volume_ratio": X.volume_ratio(),
            "volatility": X.volatility(),
        }
    )


def add_user_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"days_since_last_purchase": X.days_since_last_purchase()})


def engineer_features(
    market: DataFrame,
    user: DataFrame,
    settings: Settings,
    vocabulary: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Join, derived columns and the one-hot columns of a given vocabulary.

    Without one the categorical columns stay as they are, for ``encode_learned``.
    """
    joined = join_market_user(market, user, settings.key_columns, settings.hot_key_share)
    columns = [c for c in settings.categorical_columns if c in joined.columns]
    vocabulary = {c: v for c, v in (vocabulary or {}).items() if c in columns}
    return joined.transform(add_market_features).transform(add_user_features).transform(one_hot, vocabulary)


def request_features(requests: DataFrame, settings: Settings, keep: Sequence[str] = ()) -> DataFrame:
    """Features of scoring requests: fixed vocabulary, columns the request lacks as zero.

    The ids, columns of learned categories and ``keep`` stay on the row next to the feature columns, in configured order.
    """
    wanted = dict.fromkeys(["user_id", "stock_id", "date", *settings.learned_columns, *keep])
    ids = [c for c in wanted if c in requests.columns]
    vocabulary = {c: v for c, v in VOCABULARY.items() if c in requests.columns}
    return (
        requests.transform(add_market_features)
        .transform(one_hot, vocabulary)
        .transform(align, settings.feature_columns, ids)
    )
