"""Multi-store forecasts: future rows, frozen history features, bounds and ensembles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.config import FeatureConfig
from shelfspark.operators import features

# Used where a store's last row has no value.
FUTURE_DEFAULTS: dict[str, object] = {
    "customer_traffic": 0.0,
    "has_promotion": 0,
    "is_open": 1,
    "school_holiday": 0,
    "state_holiday": "none",
    "store_type": "a",
    "assortment": "a",
    "competition_distance": 0.0,
    "promo2": 0,
    "promo_interval": "none",
}
RECENT_ROWS = 30
MARGIN = 0.1


def future_rows(history: DataFrame, days: int) -> DataFrame:
    """The next days of every store, with the attributes of its last row."""
    present = [c for c in FUTURE_DEFAULTS if c in history.columns]
    last = history.groupBy("store_id").agg(
        F.max("date").alias("_last"), F.max_by(F.struct(F.lit(0).alias("_"), *present), "date").alias("_row")
    )
    dates = F.sequence(F.date_add("_last", 1), F.date_add("_last", days), F.expr("INTERVAL 1 DAY"))
    kinds = dict(history.dtypes)

    def latest(name: str, default: object) -> Column:
        if name not in present:
            return F.lit(default)
        return F.coalesce(F.col(f"_row.{name}"), F.lit(default).cast(kinds[name]))

    return last.select(
        F.explode(dates).alias("date"),
        "store_id",
        *[latest(name, default).alias(name) for name, default in FUTURE_DEFAULTS.items()],
    )


def first_future_rows(future: DataFrame, days: int) -> DataFrame:
    """The first N future rows of each store."""
    order = W.partitionBy("store_id").orderBy("date")
    return future.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= days).drop("_n")


def stores_short_of_rows(future: DataFrame, days: int) -> DataFrame:
    return future.groupBy("store_id").agg(F.count("*").alias("rows")).where(F.col("rows") < days)


def require_future_rows(future: DataFrame, days: int) -> DataFrame:
    """The first N rows per store; raises unless every store has them."""
    if not stores_short_of_rows(future, days).isEmpty():
        raise ValueError(f"Future feature data must contain exactly {days} rows.")
    return first_future_rows(future, days)


def recent_sales(history: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """The last rows of each store, newest first (``back`` = 1, 2, ...)."""
    order = W.partitionBy("store_id").orderBy(F.desc("date"))
    return history.select("store_id", "date", "sales", F.row_number().over(order).alias("back")).where(
        F.col("back") <= rows
    )


def frozen_history(history: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Lag and rolling features for every future day of a store, from its last rows.

    Lag n is the n-th last value, window w the last w values; where the history is shorter the
    overall mean is used, with deviation 0. The deviation is that of the population here.
    """
    depth = max(RECENT_ROWS, max(cfg.lags), max(cfg.windows))
    recent = recent_sales(history, depth)
    means = history.groupBy("store_id").agg(F.avg("sales").alias("_mean"))
    back, sales = F.col("back"), F.col("sales")
    # At most ``depth`` values per store.
    per_store = recent.groupBy("store_id").agg(
        F.count("*").alias("_rows"),
        *[F.max(F.when(back == n, sales)).alias(f"_lag_{n}") for n in cfg.lags],
        *[F.avg(F.when(back <= w, sales)).alias(f"_mean_{w}") for w in cfg.windows],
        *[F.stddev_pop(F.when(back <= w, sales)).alias(f"_std_{w}") for w in cfg.windows],
        *[F.sort_array(F.collect_list(F.when(back <= w, sales))).alias(f"_values_{w}") for w in cfg.windows],
    )
    joined = per_store.join(means, "store_id")
    out: list[Column] = [F.col("store_id")]
    for n in cfg.lags:
        out.append(F.when(F.col("_rows") >= n, F.col(f"_lag_{n}")).otherwise(F.col("_mean")).alias(f"sales_lag_{n}"))
    for w in cfg.windows:
        values = F.col(f"_values_{w}")
        size = F.size(values)
        middle = (F.get(values, F.floor((size - 1) / 2).cast("int")) + F.get(values, F.floor(size / 2).cast("int"))) / 2
        stats = {
            "mean": (F.col(f"_mean_{w}"), F.col("_mean")),
            "std": (F.col(f"_std_{w}"), F.lit(0.0)),
            "min": (F.get(values, F.lit(0)), F.col("_mean")),
            "max": (F.get(values, size - 1), F.col("_mean")),
            "median": (middle, F.col("_mean")),
        }
        for name in cfg.stats:
            full, fallback = stats[name]
            out.append(F.when(F.col("_rows") >= w, full).otherwise(fallback).alias(f"sales_rolling_{w}_{name}"))
    return joined.select(*out)


def forecast_inputs(history: DataFrame, future: DataFrame, days: int) -> DataFrame:
    """Model features of the first N future days of every store."""
    config.require_columns(history.columns, config.HISTORY_COLUMNS, "Historical input data")
    config.require_columns(future.columns, config.FUTURE_COLUMNS, "Future feature data")
    rows = features.forecast_features(first_future_rows(future, days).drop("sales"))
    return rows.join(frozen_history(history), "store_id")


def require_features(df: DataFrame, wanted: list[str]) -> None:
    absent = config.missing_columns(df.columns, wanted)
    if absent:
        raise ValueError(
            "Could not build all model features from the provided inputs. "
            "Missing engineered features: " + ", ".join(absent)
        )


def with_bounds(df: DataFrame, prediction: str = "predicted_sales", margin: float = MARGIN) -> DataFrame:
    value = F.col(prediction)
    return df.withColumns({"lower_bound": value * (1 - margin), "upper_bound": value * (1 + margin)})


# --- ensembles ----------------------------------------------------------------------------


def normalised_weights(members: list[str], weights: Mapping[str, float] | None = None) -> dict[str, float]:
    """Shares of the members with weight; equal shares without weights."""
    if weights is None:
        weights = {m: 1.0 for m in members}
    used = {m: weights.get(m, 0.0) for m in members if weights.get(m, 0.0) > 0}
    if not used:
        raise ValueError("No models available for prediction")
    total = sum(used.values())
    return {m: w / total for m, w in used.items()}


def weighted_prediction(predictions: Mapping[str, str], weights: Mapping[str, float] | None = None) -> Column:
    """Weighted average of prediction columns (member -> column)."""
    shares = normalised_weights(list(predictions), weights)
    total = F.lit(0.0)
    for member, share in shares.items():
        total = total + F.col(predictions[member]) * share
    return total


def ensemble_weights(validation_r2: DataFrame, floor: float = 0.2, model: str = "model") -> DataFrame:
    """(model, weight) from validation R squared: share of the sum, at least ``floor``, rescaled.

    Equal weights where the sum is not positive. One row per member model.
    """
    everything = W.partitionBy(F.lit(0))
    total = F.sum("r2").over(everything)
    raw = F.when(total <= 0, F.lit(1.0) / F.count("*").over(everything)).otherwise(
        F.greatest(F.lit(floor), F.try_divide(F.col("r2"), total))
    )
    shares = validation_r2.select(model, raw.alias("_raw"))
    return shares.select(model, (F.col("_raw") / F.sum("_raw").over(everything)).alias("weight"))


def combine_members(long: DataFrame, weights: DataFrame, keys: list[str], model: str = "model") -> DataFrame:
    """Ensemble prediction per key from long predictions (keys, model, yhat) and a weight table."""
    joined = long.join(F.broadcast(weights), model).where(F.col("weight") > 0)
    return joined.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("weight") * F.col("yhat")), F.sum("weight")).alias("yhat")
    )

