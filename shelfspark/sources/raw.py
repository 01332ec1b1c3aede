"""Scans of raw CSV tables, user histories and generated histories."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import config, schema


def _scan(spark: SparkSession, path: str | list[str], wanted: T.StructType) -> DataFrame:
    """CSV scan with a known schema: the header decides the order, nothing is inferred."""
    header = spark.read.csv(path, header=True).columns
    kinds = {f.name: f.dataType for f in wanted.fields}
    in_file = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    return spark.read.schema(in_file).csv(path, header=True)


def read_raw_sales(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _scan(spark, path, schema.RAW_SALES)


def read_raw_stores(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _scan(spark, path, schema.RAW_STORES)


def read_history(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """User-supplied sales history in CSV; any number of stores, all inputs must be there."""
    frame = _scan(spark, path, schema.HISTORY)
    config.require_columns(frame.columns, config.HISTORY_COLUMNS, "Historical input data")
    return frame


def _attribute_columns(attributes: dict[str, object]) -> list:
    return [F.lit(value).alias(name) for name, value in attributes.items()]


# Attributes of a generated history when none are given.
DEFAULT_ATTRIBUTES: dict[str, object] = {
    "customer_traffic": 500.0,
    "has_promotion": 0,
    "is_open": 1,
    "school_holiday": 0,
    "state_holiday": "none",
    "store_type": "a",
    "assortment": "a",
    "competition_distance": 500.0,
    "promo2": 0,
    "promo_interval": "none",
}


def _store_days(stores: DataFrame, days: int, end_date: str) -> DataFrame:
    """One row per store and day; ``step`` counts the days from 0."""
    last = F.lit(end_date).cast("date")
    steps = F.sequence(F.lit(0), F.lit(days - 1))
    return stores.select("store_id", F.explode(steps).alias("step")).select(
        "store_id", "step", F.date_add(last, F.col("step") - (days - 1)).alias("date")
    )


def default_history(stores: DataFrame, days: int, end_date: str) -> DataFrame:
    """Plain starting history: 5000, 5100, 5200 ... with constant attributes."""
    return _store_days(stores, days, end_date).select(
        "date",
        "store_id",
        (F.lit(5000.0) + F.col("step") * 100).alias("sales"),
        *_attribute_columns(DEFAULT_ATTRIBUTES),
    )


def sample_history(
    stores: DataFrame,
    days: int,
    end_date: str,
    level: float = 5000.0,
    volatility: float = 0.2,
    seed: int = 42,
    attributes: dict[str, object] | None = None,
) -> DataFrame:
    """Level, 10 % linear trend, 20 % weekly sine and normal noise, never below zero."""
    step = F.col("step")
    trend = step * (level * 0.1 / max(days - 1, 1))
    season = F.sin(step * (2 * math.pi / 7)) * (level * 0.2)
    noise = F.randn(seed) * (level * volatility) if volatility else F.lit(0.0)
    sales = F.greatest(F.lit(0.0), F.lit(level) + trend + season + noise)
    return _store_days(stores, days, end_date).select(
        "date",
        "store_id",
        sales.alias("sales"),
        *_attribute_columns({**DEFAULT_ATTRIBUTES, **(attributes or {})}),
    )
