"""Naive forecasts of a daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.operators.metrics import metric_rows


def add_baselines(daily: DataFrame, date_col: str = "ds", target: str = "y", groups: Sequence[str] = ()) -> DataFrame:
    """Yesterday, same day last week, and full 7- and 28-row means of earlier rows.

    The daily-total series has one row per day; with ``groups`` each group is its own series.
    """
    window = W.partitionBy(*(groups or [F.lit(0)])).orderBy(date_col)

    def full_mean(n: int):
        frame = window.rowsBetween(-n, -1)
        return F.when(F.count(target).over(frame) == n, F.avg(target).over(frame))

    return df_with(
        daily,
        {
            "yhat_naive_yesterday": F.lag(target, 1).over(window),
            "yhat_seasonal_naive_7": F.lag(target, 7).over(window),
            "yhat_rolling_7": full_mean(7),
            "yhat_rolling_28": full_mean(28),
        },
    )


def df_with(df: DataFrame, columns: dict) -> DataFrame:
    return df.select("*", *[c.alias(name) for name, c in columns.items()])


def long_predictions(df: DataFrame, keys: Sequence[str], target: str, predictions: dict[str, str], label: str = "variant") -> DataFrame:
    """(keys, label, y, yhat): one row per prediction column."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias(label), F.col(target).alias("y"), F.col(c).cast("double").alias("yhat"))
            for name, c in predictions.items()
        ]
    )
    return df.select(*keys, F.inline(pairs))


def baseline_metrics(full: DataFrame) -> DataFrame:
    """Metric rows of every baseline on the validation and test splits."""
    rows = full.where(F.col("split").isin("validation", "test"))
    predictions = {name: f"yhat_{name}" for name in config.BASELINES}
    return metric_rows(long_predictions(rows, ["split"], "y", predictions), ["variant", "split"])
