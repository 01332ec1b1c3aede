"""Store-day panel and daily totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import config
from shelfspark.functions import text
from shelfspark.functions.stats import first_present, ratio, sum_or_zero
from shelfspark.operators import clean

GRAIN = ("date", "store_id")
SUMMED = ("sales", "customer_traffic")
MAXED = ("has_promotion", "is_open", "is_holiday", "school_holiday")
FIRST = ("competition_distance", "promo2", "store_type", "assortment", "state_holiday", "promo_interval")


def aggregate_store_days(df: DataFrame, order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per (date, store_id); columns that are absent are left out.

    ``order_cols`` is the row order that decides "first" (default: all other columns). Rows
    without a key are dropped. Partial aggregation comes before the shuffle, so a store or day
    that holds a large share of the rows shrinks to one row per task first.
    """
    present = set(df.columns)
    order = F.struct(*(order_cols or [c for c in df.columns if c not in GRAIN]))
    aggregates: list[Column] = [sum_or_zero(F.col(c)).alias(c) for c in SUMMED if c in present]
    aggregates += [F.max(c).alias(c) for c in MAXED if c in present]
    aggregates += [first_present(F.col(c), order).alias(c) for c in FIRST if c in present]
    return (
        df.where(F.col("date").isNotNull() & F.col("store_id").isNotNull())
        .groupBy(F.to_date("date").alias("date"), "store_id")
        .agg(*aggregates)
    )


def store_day_panel(sales: DataFrame, stores: DataFrame, include_closed_zero_sales: bool = False) -> DataFrame:
    """Panel straight from the raw tables.

    Gives the rows of ``aggregate_store_days(prepare_sales(join_stores(...)))`` but joins the
    store attributes after the aggregation: they are constant within a store, so the shuffle
    carries few and narrow columns and the join sees store-days instead of raw rows. The store
    number stands for its key until then. A store that occurs twice in ``stores`` ends the job
    instead of multiplying its days.
    """
    fields = {**clean.sales_fields(), "store_id": F.col("Store").cast("bigint")}
    rows = clean.select_rows(
        sales.select(*[c.alias(name) for name, c in fields.items()]), include_closed_zero_sales
    )
    order = [*SUMMED, "has_promotion", "is_open", "state_holiday", "school_holiday"]
    days = aggregate_store_days(rows, order).withColumnRenamed("store_id", "Store")
    attributes = clean.store_fields()
    return clean.join_stores(days, clean.unique_stores(stores)).select(
        "date",
        text.store_key(F.col("Store")).alias("store_id"),
        *SUMMED,
        *MAXED,
        *[attributes[c].alias(c) if c in attributes else F.col(c) for c in FIRST],
    )


def build_daily_totals(df: DataFrame, date_col: str = "date", target: str = "sales") -> DataFrame:
    """One row per day: total, and how many stores promote, are open or on holiday.

    Two chained aggregations, (day, store) and then day, both with partial aggregation. Without
    a store column each row counts as its own store.
    """
    absent = config.missing_columns(df.columns, (date_col, target))
    if absent:
        raise ValueError(f"Missing required columns for daily-total data: {absent}")
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def signal(name: str, default: int) -> Column:
        if name not in kinds:
            return F.lit(default)
        return text.binary_indicator(F.col(name), isinstance(kinds[name], T.NumericType))

    has_store, has_state = "store_id" in kinds, "state_holiday" in kinds
    store = F.coalesce(F.col("store_id").cast("string"), F.lit("nan")) if has_store else F.lit("")
    state = text.state_holiday_indicator(F.col("state_holiday")) if has_state else F.lit(0)

    rows = clean.drop_unusable(df, target, date_col).select(
        F.to_date(date_col).alias("ds"),
        store.alias("store"),
        F.col(target).alias("y"),
        signal("has_promotion", 0).alias("promo"),
        signal("is_open", 1).alias("open"),
        signal("school_holiday", 0).alias("school"),
        state.alias("state"),
    )
    if has_store:
        rows = rows.groupBy("ds", "store").agg(
            F.sum("y").alias("y"),
            *[F.max(c).alias(c) for c in ("promo", "open", "school", "state")],
        )
    per_day = rows.groupBy("ds").agg(
        F.sum("y").alias("y"),
        F.count("*").alias("stores"),
        *[F.sum(c).alias(c) for c in ("promo", "open", "school")],
        F.max("state").alias("state"),
    )
    return per_day.select(
        "ds",
        "y",
        F.col("promo").cast("double").alias("promo_store_count"),
        ratio(F.col("promo"), F.col("stores")).alias("promo_rate"),
        F.col("open").cast("double").alias("open_store_count"),
        ratio(F.col("school"), F.col("stores")).alias("school_holiday_rate"),
        F.col("state").cast("double").alias("state_holiday_flag"),
    )


def ensure_daily_totals(df: DataFrame) -> DataFrame:
    """Takes ready (ds, y) frames or raw rows; absent regressors become 0."""
    if not {"ds", "y"} <= set(df.columns):
        return build_daily_totals(df)
    regressors = [
        F.coalesce(text.number(F.col(c)), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
        for c in config.REGRESSORS
    ]
    return clean.drop_unusable(df, "y", "ds").select("ds", "y", *regressors)
