"""Shared inputs of the queries, and the same inputs as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import baselines, clean, models, panel, splits
from shelfspark.session import scratch_path
from shelfspark.sources import star_tables

# What forecasts of a store's series read. The store's type is kept so that a store that occurs twice still ends the job.
SERIES = ("date", "store_id", "sales", "store_type")
PANEL_ORDER = ("sales", "customer_traffic", "has_promotion", "is_open", "state_holiday", "school_holiday")


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return clean.prepare_sales(
        clean.join_stores(star_tables.raw_sales(spark, folder), star_tables.raw_stores(spark, folder))
    )


def store_days(spark: SparkSession, folder: str) -> DataFrame:
    return panel.store_day_panel(star_tables.raw_sales(spark, folder), star_tables.raw_stores(spark, folder))


def stored_store_days(spark: SparkSession, folder: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The panel, written to the shared folder: for what reads it more than once. The fact table is read once."""
    path = scratch_path(spark, "panel")
    store_days(spark, folder).select(*columns).write.parquet(path)
    return spark.read.parquet(path)


def sales_rows(spark: SparkSession, folder: str) -> DataFrame:
    return clean.prepare_sales_only(star_tables.raw_sales(spark, folder))


def daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    return panel.build_daily_totals(sales_rows(spark, folder))


def labelled_daily(spark: SparkSession, folder: str) -> DataFrame:
    return models.labelled_daily_totals(sales_rows(spark, folder))


def store_predictions(spark: SparkSession, folder: str, panel_rows: DataFrame | None = None) -> DataFrame:
    """(date, store_id, split, model, y, prediction): naive forecasts that stand in for models."""
    panel_rows = stored_store_days(spark, folder, SERIES) if panel_rows is None else panel_rows
    days = panel_rows.select("date", "store_id", "sales")
    guessed = baselines.add_baselines(days, "date", "sales", ["store_id"])
    labels = splits.date_splits(days)
    mixed = (F.col("yhat_naive_yesterday") + F.col("yhat_rolling_7")) / 2
    long = baselines.long_predictions(
        guessed.withColumn("yhat_mixed", mixed).join(F.broadcast(labels), "date"),
        ["date", "store_id", "split"],
        "sales",
        {"xgboost": "yhat_naive_yesterday", "lightgbm": "yhat_rolling_7", "ensemble_store_level": "yhat_mixed"},
        "model",
    )
    return long.where(F.col("yhat").isNotNull()).withColumnRenamed("yhat", "prediction")


# --- SQL ----------------------------------------------------------------------------------

RAW_SALES_SQL = """raw_sales AS (
  SELECT CAST(l_suppkey AS INTEGER) AS Store, CAST(l_shipdate AS DATE) AS Date,
    CAST(CASE WHEN l_quantity < 3 THEN 0 ELSE floor(l_extendedprice * (1 - l_discount)) END AS DOUBLE) AS Sales,
    CASE WHEN l_quantity <> 50 THEN l_quantity END AS Customers,
    CASE WHEN l_tax <> 0.08 THEN CAST(l_linestatus = 'O' AS INTEGER) END AS Open,
    CASE WHEN l_discount <> 0 THEN CAST(l_discount >= 0.05 AS INTEGER) END AS Promo,
    CASE WHEN l_returnflag = 'N' THEN '0' WHEN l_returnflag = 'A' THEN ' A '
         WHEN l_linenumber <> 7 THEN 'b' END AS StateHoliday,
    CAST(l_tax >= 0.06 AS INTEGER) AS SchoolHoliday
  FROM lineitem)"""

RAW_STORES_SQL = """raw_stores AS (
  SELECT CAST(s_suppkey AS INTEGER) AS Store,
    CASE WHEN s_nationkey <> 24 THEN substr('abcd', s_nationkey % 4 + 1, 1) END AS StoreType,
    substr('abc', s_nationkey % 3 + 1, 1) AS Assortment,
    CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS CompetitionDistance,
    CAST(s_suppkey % 2 AS INTEGER) AS Promo2,
    CASE s_suppkey % 6 WHEN 1 THEN 'Jan,Apr,Jul,Oct' WHEN 3 THEN 'Feb,May,Aug,Nov'
         WHEN 5 THEN 'Mar,Jun,Sept,Dec' END AS PromoInterval
  FROM supplier)"""

STORE_ID_SQL = (
    "'store_' || CASE WHEN length(CAST({0} AS VARCHAR)) >= 4 THEN CAST({0} AS VARCHAR) "
    "ELSE lpad(CAST({0} AS VARCHAR), 4, '0') END"
)
STATE_SQL = (
    "CASE WHEN lower(trim(coalesce({0}, ''))) IN ('', '0', '0.0', 'none', 'nan', 'nat', 'false') "
    "THEN 'none' ELSE lower(trim({0})) END"
)

PREPARED_SQL = f"""{RAW_SALES_SQL},
{RAW_STORES_SQL},
prepared AS (
  SELECT f.Date AS date, {STORE_ID_SQL.format('f.Store')} AS store_id, f.Sales AS sales,
    coalesce(f.Customers, 0) AS customer_traffic, coalesce(f.Promo, 0) AS has_promotion,
    coalesce(f.Open, 1) AS is_open, {STATE_SQL.format('f.StateHoliday')} AS state_holiday,
    coalesce(f.SchoolHoliday, 0) AS school_holiday,
    CAST({STATE_SQL.format('f.StateHoliday')} <> 'none' OR coalesce(f.SchoolHoliday, 0) = 1 AS INTEGER) AS is_holiday,
    coalesce(s.StoreType, 'unknown') AS store_type, coalesce(s.Assortment, 'unknown') AS assortment,
    coalesce(s.CompetitionDistance, 0) AS competition_distance, coalesce(s.Promo2, 0) AS promo2,
    coalesce(s.PromoInterval, 'none') AS promo_interval
  FROM raw_sales f LEFT JOIN raw_stores s ON f.Store = s.Store)"""

PANEL_SQL = f"""{PREPARED_SQL},
panel AS (
  SELECT date, store_id, sum(sales) AS sales, sum(customer_traffic) AS customer_traffic,
    max(has_promotion) AS has_promotion, max(is_open) AS is_open, max(is_holiday) AS is_holiday,
    max(school_holiday) AS school_holiday, min(competition_distance) AS competition_distance,
    min(promo2) AS promo2, min(store_type) AS store_type, min(assortment) AS assortment,
    first(state_holiday ORDER BY {', '.join(PANEL_ORDER)}) AS state_holiday,
    min(promo_interval) AS promo_interval
  FROM prepared WHERE is_open = 1 AND sales > 0 GROUP BY date, store_id)"""

DAILY_SQL = f"""{PREPARED_SQL},
store_day AS (
  SELECT date AS ds, store_id, sum(sales) AS y, max(has_promotion) AS promo, max(is_open) AS open,
    max(school_holiday) AS school, max(CAST(state_holiday <> 'none' AS INTEGER)) AS state
  FROM prepared GROUP BY date, store_id),
daily AS (
  SELECT ds, sum(y) AS y, CAST(sum(promo) AS DOUBLE) AS promo_store_count,
    CAST(sum(promo) AS DOUBLE) / count(*) AS promo_rate, CAST(sum(open) AS DOUBLE) AS open_store_count,
    CAST(sum(school) AS DOUBLE) / count(*) AS school_holiday_rate, CAST(max(state) AS DOUBLE) AS state_holiday_flag
  FROM store_day GROUP BY ds)"""

# 1 - 0.2 - 0.1 in floating point.
TRAIN_SHARE = repr(1 - 0.2 - 0.1)


def split_case(rank: str, n: str) -> str:
    """Split label of a 0-based rank among n."""
    train = f"floor(CAST({n} AS DOUBLE) * CAST({TRAIN_SHARE} AS DOUBLE))"
    validation = f"floor(CAST({n} AS DOUBLE) * CAST(0.1 AS DOUBLE))"
    return (
        f"CASE WHEN {rank} < {train} THEN 'train' WHEN {rank} < {train} + {validation} "
        "THEN 'validation' ELSE 'test' END"
    )


def date_split_sql(source: str, day: str, name: str = "day_split") -> str:
    return f"""{name} AS (
  SELECT {day}, {split_case(f'row_number() OVER (ORDER BY {day}) - 1', 'count(*) OVER ()')} AS split
  FROM (SELECT DISTINCT {day} FROM {source}))"""


BASELINE_COLUMNS_SQL = """
    lag({y}, 1) OVER w AS yhat_naive_yesterday,
    lag({y}, 7) OVER w AS yhat_seasonal_naive_7,
    CASE WHEN count({y}) OVER w7 = 7 THEN avg({y}) OVER w7 END AS yhat_rolling_7,
    CASE WHEN count({y}) OVER w28 = 28 THEN avg({y}) OVER w28 END AS yhat_rolling_28"""


def baseline_windows(by: str, order: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"""WINDOW w AS ({part}ORDER BY {order}),
    w7 AS ({part}ORDER BY {order} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
    w28 AS ({part}ORDER BY {order} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)"""


LABELLED_DAILY_SQL = f"""{DAILY_SQL},
{date_split_sql('daily', 'ds')},
labelled AS (SELECT d.*, s.split FROM daily d JOIN day_split s ON d.ds = s.ds)"""

DAILY_BASELINES_SQL = f"""{LABELLED_DAILY_SQL},
guessed AS (
  SELECT ds, split, y,{BASELINE_COLUMNS_SQL.format(y='y')}
  FROM labelled {baseline_windows('', 'ds')})"""

STORE_PREDICTIONS_SQL = f"""{PANEL_SQL},
{date_split_sql('panel', 'date')},
guessed AS (
  SELECT date, store_id, sales,{BASELINE_COLUMNS_SQL.format(y='sales')}
  FROM panel {baseline_windows('store_id', 'date')}),
predictions AS (
  SELECT g.date, g.store_id, s.split, p.model, g.sales AS y, p.prediction
  FROM guessed g JOIN day_split s ON g.date = s.date,
    LATERAL (VALUES ('xgboost', yhat_naive_yesterday), ('lightgbm', yhat_rolling_7),
      ('ensemble_store_level', (yhat_naive_yesterday + yhat_rolling_7) / 2)) AS p(model, prediction)
  WHERE p.prediction IS NOT NULL)"""


def metrics_sql(y: str = "y", yhat: str = "yhat") -> str:
    """The four metrics as aggregates over pairs without nulls."""
    return f"""avg(abs({y} - {yhat})) AS mae, sqrt(avg(({y} - {yhat}) * ({y} - {yhat}))) AS rmse,
    coalesce(avg(CASE WHEN {y} <> 0 THEN abs(({y} - {yhat}) / {y}) END) * 100, 0) AS mape,
    CASE WHEN min({y}) = max({y}) THEN CASE WHEN sum(({y} - {yhat}) * ({y} - {yhat})) = 0 THEN 1.0 ELSE 0.0 END
      ELSE 1 - sum(({y} - {yhat}) * ({y} - {yhat})) / (var_pop({y}) * count({y})) END AS r2"""


DIRTY_SQL = """dirty AS (
  SELECT 'sales/' || strftime(l_shipdate, '%Y-%m') || '-01.parquet' AS file_path,
    CASE WHEN l_quantity = 50 AND l_tax = 0.08 THEN 'not-a-date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
    CASE WHEN l_linenumber <> 6 THEN 'store_' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') END AS store_id,
    CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN 'n/a' WHEN l_linenumber = 7 AND l_quantity = 2 THEN 'Infinity'
      ELSE CAST(CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) AS VARCHAR) END AS sales,
    CASE WHEN l_quantity <> 10 THEN l_quantity - 3 END AS customer_traffic,
    CASE WHEN l_discount = 0.1 THEN CAST(2 AS DOUBLE) ELSE CAST(l_discount >= 0.05 AS DOUBLE) END AS has_promotion,
    CASE WHEN l_tax = 0.03 THEN CAST(0.5 AS DOUBLE) ELSE CAST(l_linestatus = 'O' AS DOUBLE) END AS is_open,
    CAST(l_returnflag <> 'N' AS INTEGER) AS is_holiday
  FROM lineitem),
typed AS (
  SELECT file_path, TRY_CAST(date AS DATE) AS date, date AS date_text, store_id,
    TRY_CAST(sales AS DOUBLE) AS sales, sales AS sales_text, customer_traffic, has_promotion, is_open,
    CAST(is_holiday AS DOUBLE) AS is_holiday
  FROM dirty)"""
NUMERIC_COLUMNS = ("sales", "customer_traffic", "has_promotion", "is_open", "is_holiday")
