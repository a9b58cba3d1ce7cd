"""Rolling baselines per symbol: z-scores and the forest's features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.values import or_zero, ratio
from tapewright.operators.joins import join_lookup
from tapewright.operators.moments import with_rolling_moments
from tapewright.operators.slicing import Slices, over_slices, plan_slices
from tapewright.schemas import require_columns

# Names of required columns and of features.
ZSCORE_INPUT = ("symbol", "trade_time", "price", "quantity", "trade_value")
FEATURE_INPUT = (*ZSCORE_INPUT, "trade_id")
FEATURES = (
    "price", "quantity", "trade_value", "price_return", "rolling_trade_count",
    "rolling_trade_value_mean",
)


def with_zscores(settings: Settings):
    """z-scores of price and value against their trailing frames, which include the row itself."""
    names = ("price", "trade_value")

    def score(name: str) -> Column:
        apart = ratio(F.col(name) - F.col(f"__last_{name}_mean"), F.col(f"__last_{name}_std"))
        return or_zero(F.when(F.col(f"__last_{name}_n") >= settings.z_min_rows, apart))

    def add(trades: DataFrame, window) -> DataFrame:
        based = with_rolling_moments(trades, window, settings.z_window, names)
        return based.select(
            *trades.columns, *[score(name).alias(f"{name}_zscore") for name in names]
        )

    return add


def flag_zscores(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    beyond = lambda c: F.abs(F.col(c)) >= settings.z_threshold
    return scored.withColumn("is_anomaly", beyond("price_zscore") | beyond("trade_value_zscore"))


def rolling_zscore(
    trades: DataFrame, settings: Settings = DEFAULTS, slices: Slices | None = None
) -> DataFrame:
    """Score each trade's price and value against the symbol's last ``z_window`` trades."""
    require_columns(trades, ZSCORE_INPUT)
    if "trade_id" not in trades.columns:
        trades = trades.withColumn("trade_id", F.lit(None).cast("bigint"))
    slices = plan_slices(trades, settings) if slices is None else slices
    scored = over_slices(trades, slices, settings.z_window - 1, with_zscores(settings))
    return flag_zscores(scored, settings)


def ml_features(
    trades: DataFrame, settings: Settings = DEFAULTS, slices: Slices | None = None
) -> DataFrame:
    """Add price return, rolling trade count and rolling mean value per symbol."""
    require_columns(trades, FEATURE_INPUT)
    slices = plan_slices(trades, settings) if slices is None else slices
    return over_slices(
        trades, slices, max(settings.feature_window - 1, 1), with_features(settings)
    )


def with_features(settings: Settings):
    """Return against the previous trade, count and mean value of the trailing frame."""
    price = F.col("price")

    def add(trades: DataFrame, window) -> DataFrame:
        trailing = window.rowsBetween(1 - settings.feature_window, 0)
        return trades.withColumns(
            {
                "price_return": or_zero(ratio(price, F.lag(price).over(window)) - 1),
                "rolling_trade_count": F.count("trade_id").over(trailing).cast("double"),
                "rolling_trade_value_mean": F.avg("trade_value").over(trailing),
            }
        )

    return add


def feature_moments(features: DataFrame) -> DataFrame:
    """Row count, and mean and population deviation of each feature, by symbol."""
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in FEATURES}
    return features.groupBy("symbol").agg(
        F.count("*").alias("rows"),
        *[F.avg(value).alias(f"__{c}_mean") for c, value in filled.items()],
        *[F.stddev_pop(value).alias(f"__{c}_std") for c, value in filled.items()],
    )


def scaled_features(
    features: DataFrame, settings: Settings = DEFAULTS, moments: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Standardise the feature columns per symbol: population deviation, a zero one counts as 1.

    The moments are partial aggregates looked up by symbol, so no symbol is gathered in one task.
    ``moments`` may give them as a written table; with ``how`` "left", symbols that it lacks are kept
    and have null features.
    """
    written = moments is not None
    moments = moments if written else feature_moments(features)

    def scaled(name: str) -> Column:
        std = F.col(f"__{name}_std")
        unit = F.when(std == 0, F.lit(1.0)).otherwise(std)
        return (F.coalesce(F.col(name), F.lit(0.0)) - F.col(f"__{name}_mean")) / unit

    others = [c for c in features.columns if c not in FEATURES]
    joined = join_lookup(features, moments.drop("rows"), ["symbol"], settings, how, written=written)
    return joined.select(
        *others, *[scaled(c).alias(c) for c in FEATURES]
    )
