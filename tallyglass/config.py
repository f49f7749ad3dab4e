"""Settings of a run: column lists, thresholds, tree parameters, locations and the run date."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, fields
from pathlib import Path

# Category vocabularies of a scoring request.
SECTORS = (
    "Technology",
    "Finance",
    "Healthcare",
    "Consumer",
    "Energy",
    "Utilities",
    "Materials",
    "RealEstate",
    "Other",
)
MARKET_CAPS = ("Large", "Mid", "Small")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
VOCABULARY = {
    "sector": SECTORS,
    "market_cap_category": MARKET_CAPS,
    "day_of_week": WEEKDAYS,
}

# Numeric columns, in configured order.
RAW_NUMERIC = ("close_price", "open_price", "high_price", "low_price", "volume", "avg_volume_30d")
DERIVED = ("price_momentum", "volume_ratio", "volatility", "days_since_last_purchase")
USER_SCORES = ("portfolio_diversity_score", "risk_tolerance")


# Training parameters of the usual boosting libraries that only the regularised trees have, and other names of theirs.
REGULARISED = ("reg_lambda", "reg_alpha", "gamma", "min_child_weight", "scale_pos_weight", "max_bin", "base_score", "learned_columns")
OTHER_NAMES = {"lambda": "reg_lambda", "alpha": "reg_alpha", "min_split_loss": "gamma", "eta": "learning_rate"}
# Parameters that neither kind of trees honours.
UNSUPPORTED = frozenset({"tree_method", "max_delta_step", "colsample_bylevel", "colsample_bynode", "max_leaves", "grow_policy"})
EVAL_METRICS = ("auc", "logloss")


def one_hot_names(vocabulary: dict[str, tuple[str, ...]]) -> tuple[str, ...]:
    return tuple(f"{column}_{value}" for column, values in vocabulary.items() for value in values)


@dataclass(frozen=True)
class Settings:
    """One run's parameters. Dates are never taken from the clock: ``as_of`` plays "today"."""

    as_of: dt.date = dt.date(2024, 1, 30)

    categorical_columns: tuple[str, ...] = tuple(VOCABULARY)
    numerical_columns: tuple[str, ...] = RAW_NUMERIC + DERIVED + USER_SCORES
    feature_columns: tuple[str, ...] = DERIVED + one_hot_names(VOCABULARY) + USER_SCORES
    label_column: str = "purchased_stock"
    key_columns: tuple[str, ...] = ("user_id", "date")

    prediction_threshold: float = 0.5
    drift_threshold: float = 0.1
    alert_accuracy_threshold: float = 0.7
    fill_value: float = 0.0
    test_size: float = 0.2
    random_seed: int = 42
    model_version: str = "1.0.0"

    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    objective: str = "binary:logistic"
    # What early stopping watches on the test rows: "auc" or "logloss".
    eval_metric: str = "auc"
    # "gbtree": second-order trees with the parameters below, columns drawn per tree; "spark": Spark ML's trees, columns drawn per node.
    booster: str = "spark"
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    scale_pos_weight: float = 1.0
    max_bin: int = 64
    base_score: float = 0.5
    # Categorical columns whose categories are learned from the training rows and are inputs of the model beside ``feature_columns``.
    learned_columns: tuple[str, ...] = ()
    # Recorded as asked for; the number of rounds actually run is ``boosting_rounds``, recorded beside it.
    n_estimators: int = 100
    boosting_rounds: int = 10
    # Stop boosting once the loss on the test rows improves by less than this; None runs all rounds.
    early_stopping_tol: float | None = None
    # Keep the rounds up to the best ``eval_metric`` on the test rows, once so many in a row brought no better one.
    early_stopping_rounds: int | None = None

    # Salt join keys above this share of the market rows; None leaves skew to adaptive execution.
    hot_key_share: float | None = None

    market_data_path: str | None = None
    user_data_path: str | None = None
    reference_data_path: str | None = None
    store_path: str | None = None
    # Folders below the store, and the run that monitoring logs into; None names one after the time.
    reports_prefix: str = "reports"
    model_prefix: str = "model"
    # Folders asked for a model, in order, if the store has no whole one.
    model_fallbacks: tuple[str, ...] = ()
    run_id: str | None = None

    def __post_init__(self) -> None:
        if self.objective != "binary:logistic":
            raise ValueError(f"unsupported objective {self.objective!r}")
        if self.eval_metric not in EVAL_METRICS:
            raise ValueError(f"unsupported eval_metric {self.eval_metric!r}")
        if self.booster not in ("spark", "gbtree"):
            raise ValueError(f"unsupported booster {self.booster!r}")
        plain = {f.name: f.default for f in fields(self)}
        unused = [c for c in REGULARISED if getattr(self, c) != plain[c]]
        if self.booster == "spark" and unused:
            raise ValueError(f"booster 'spark' does not honour {', '.join(unused)}; use 'gbtree'")
        if self.booster == "gbtree" and self.early_stopping_tol is not None:
            raise ValueError("early_stopping_tol is for booster 'spark'; use early_stopping_rounds")
        if min(self.reg_lambda, self.reg_alpha, self.gamma, self.min_child_weight) < 0 or self.scale_pos_weight <= 0 or self.max_bin < 2:
            raise ValueError("regularisation must not be negative, scale_pos_weight must be positive and max_bin 2 at least")
        if not 0.0 < self.base_score < 1.0:
            raise ValueError("base_score must lie between 0 and 1")
        if not 0.0 < self.test_size < 1.0:
            raise ValueError("test_size must lie between 0 and 1")
        if self.hot_key_share is not None and not 0.0 < self.hot_key_share < 1.0:
            raise ValueError("hot_key_share must lie between 0 and 1")
        if self.early_stopping_rounds is not None and self.early_stopping_rounds < 1:
            raise ValueError("early_stopping_rounds must be positive")

    @property
    def scaled_columns(self) -> tuple[str, ...]:
        """Numeric columns that are also model inputs; only these are scaled."""
        return tuple(c for c in self.feature_columns if c in self.numerical_columns)

    @classmethod
    def from_json(cls, path: str | Path, **overrides) -> Settings:
        """Read a JSON document. Keys about other services are ignored; a training key that would not
        be honoured is an error. Keys that only the regularised trees have choose these, unless ``booster`` is given."""
        document = {OTHER_NAMES.get(k, k): v for k, v in json.loads(Path(path).read_text()).items()}
        if any(k in document for k in REGULARISED):
            document.setdefault("booster", "gbtree")
        ignored = sorted(UNSUPPORTED & document.keys())
        if ignored:
            raise ValueError(f"unsupported training parameters: {', '.join(ignored)}")
        bucket, prefix = document.get("output_bucket"), document.get("output_prefix")
        if bucket and prefix:
            document.setdefault("store_path", f"s3a://{bucket}/{prefix}")
        document.update(overrides)
        known = {f.name for f in fields(cls)}
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in document.items() if k in known}
        if isinstance(values.get("as_of"), str):
            values["as_of"] = dt.date.fromisoformat(values["as_of"])
        return cls(**values)
