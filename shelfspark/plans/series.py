"""Queries on the panel, its features, daily totals, splits and naive forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.operators import baselines, clean, features, panel, splits
from shelfspark.plans import tables as t
from shelfspark.plans.catalog import query, rounded
from shelfspark.sources import star_tables


@query("O5.1 O5.2 O4.1", f"WITH {t.PANEL_SQL} SELECT * FROM panel")
def store_day_panel(spark, folder):
    return t.store_days(spark, folder)


@query("O5.1", f"WITH {t.PANEL_SQL} SELECT * FROM panel")
def store_day_panel_from_prepared_rows(spark, folder):
    trading = clean.select_rows(t.prepared(spark, folder))
    return panel.aggregate_store_days(trading, t.PANEL_ORDER)


@query(
    "O5.1",
    """SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS store_id, round(sum(value), 2) AS sales
    FROM events GROUP BY ALL""",
)
def event_day_panel(spark, folder):
    """Columns that the source lacks are left out of the panel."""
    return rounded(panel.aggregate_store_days(star_tables.event_days(spark, folder)), 2)


def lag_sql(by: str, order: str) -> str:
    return ", ".join(f"lag(sales, {n}) OVER (PARTITION BY {by} ORDER BY {order}) AS sales_lag_{n}" for n in config.LAGS)


def rolling_sql(digits: int, by: str = "store_id", order: str = "date") -> tuple[str, str]:
    """Select list and WINDOW clause of the rolling statistics."""
    functions = {"mean": "avg(sales)", "std": "stddev_samp(sales)", "min": "min(sales)", "max": "max(sales)", "median": "quantile_cont(sales, 0.5)"}
    columns, windows = [], []
    for n in config.WINDOWS:
        part = f"PARTITION BY {by} " if by else ""
        windows.append(f"w{n} AS ({part}ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)")
        for stat in config.WINDOW_STATS:
            columns.append(f"round({functions[stat]} OVER w{n}, {digits}) AS sales_rolling_{n}_{stat}")
    return ", ".join(columns), ", ".join(windows)


ROLLING, WINDOWS = rolling_sql(4)


def comparable(df):
    """Only means, deviations and angles depend on the order of a sum; the rest is exact."""
    inexact = ("_mean", "_std", "_sin", "_cos")
    return rounded(df, 4, [c for c in df.columns if c.endswith(inexact)])


@query("O6.1 O7.1", f"WITH {t.PANEL_SQL} SELECT date, store_id, sales, {lag_sql('store_id', 'date')} FROM panel")
def lag_features(spark, folder):
    return features.lag_features(t.store_days(spark, folder).select("date", "store_id", "sales"))


@query("O6.2 O7.1", f"WITH {t.PANEL_SQL} SELECT date, store_id, sales, {ROLLING} FROM panel WINDOW {WINDOWS}")
def rolling_features(spark, folder):
    return comparable(features.rolling_features(t.store_days(spark, folder).select("date", "store_id", "sales")))


GLOBAL_ROLLING, GLOBAL_WINDOWS = rolling_sql(4, by="", order="date, store_id")


@query(
    "O6.1 O6.2",
    f"""WITH {t.PANEL_SQL} SELECT date, store_id, sales,
    {', '.join(f'lag(sales, {n}) OVER (ORDER BY date, store_id) AS sales_lag_{n}' for n in config.LAGS)}, {GLOBAL_ROLLING}
    FROM panel WINDOW {GLOBAL_WINDOWS}""",
)
def ungrouped_history_features(spark, folder):
    days = t.store_days(spark, folder).select("date", "store_id", "sales")
    return comparable(features.history_features(days, groups=None, tie_break=["store_id"]))


FEATURE_SQL = f"""WITH {t.PANEL_SQL}, built AS (
  SELECT panel.*, {lag_sql('store_id', 'date')}, {ROLLING} FROM panel WINDOW {WINDOWS})
SELECT date, store_id, sales, customer_traffic, CAST(has_promotion AS DOUBLE) AS has_promotion, CAST(is_open AS DOUBLE) AS is_open,
  CAST(is_holiday AS DOUBLE) AS is_holiday, CAST(school_holiday AS DOUBLE) AS school_holiday, competition_distance,
  CAST(promo2 AS DOUBLE) AS promo2, store_type, assortment, state_holiday, promo_interval,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(week(date) AS INTEGER) AS weekofyear, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
  {', '.join(f'coalesce(sales_lag_{n}, 0) AS sales_lag_{n}' for n in config.LAGS)},
  {', '.join(f'coalesce(sales_rolling_{n}_{s}, 0) AS sales_rolling_{n}_{s}' for n in config.WINDOWS for s in config.WINDOW_STATS)},
  round(sin(2 * pi() * month(date) / 12), 4) AS month_sin, round(cos(2 * pi() * month(date) / 12), 4) AS month_cos,
  round(sin(2 * pi() * day(date) / 31), 4) AS day_sin, round(cos(2 * pi() * day(date) / 31), 4) AS day_cos,
  round(sin(2 * pi() * (isodow(date) - 1) / 7), 4) AS dayofweek_sin, round(cos(2 * pi() * (isodow(date) - 1) / 7), 4) AS dayofweek_cos,
  {', '.join(f"{a} || '_' || {b} AS {a}_{b}_interaction" for i, a in enumerate(config.CATEGORICAL_COLUMNS) for b in config.CATEGORICAL_COLUMNS[i + 1:])}
FROM built"""


@query("O6.3 O2.8 O2.9 O2.10 O2.11", FEATURE_SQL)
def all_features(spark, folder):
    days = t.stored_store_days(spark, folder)
    return comparable(features.all_features(days, categories=clean.categorical_columns(days)))


@query(
    "O6.4",
    f"""WITH {t.PANEL_SQL}, built AS (SELECT panel.*, {lag_sql('store_id', 'date')}, {ROLLING} FROM panel WINDOW {WINDOWS})
    SELECT date, store_id, sales, CAST(state_holiday <> 'none' OR school_holiday = 1 AS INTEGER) AS is_holiday,
      store_type || '_' || assortment AS store_type_assortment_interaction, CAST(week(date) AS INTEGER) AS weekofyear,
      {', '.join(f'coalesce(sales_lag_{n}, 0) AS sales_lag_{n}' for n in config.LAGS)},
      {', '.join(f'coalesce(sales_rolling_{n}_{s}, 0) AS sales_rolling_{n}_{s}' for n in config.WINDOWS for s in config.WINDOW_STATS)}
    FROM built""",
)
def forecast_path_features(spark, folder):
    built = features.forecast_features(t.store_days(spark, folder))
    history = [c for c in built.columns if features.is_history_feature(c)]
    return comparable(
        built.select("date", "store_id", "sales", "is_holiday", "store_type_assortment_interaction", "weekofyear", *history)
    )


@query("O5.3 O2.5 O2.6", f"WITH {t.DAILY_SQL} SELECT ds, y, promo_store_count, round(promo_rate, 6) AS promo_rate, "
    "open_store_count, round(school_holiday_rate, 6) AS school_holiday_rate, state_holiday_flag FROM daily")
def daily_totals(spark, folder):
    return rounded(t.daily_totals(spark, folder), 6)


@query(
    "O5.3 O5.4",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS ds, count(*) AS n, sum(floor(o_totalprice)) AS y FROM orders GROUP BY 1)
    SELECT ds, y, CAST(0 AS DOUBLE) AS promo_store_count, CAST(0 AS DOUBLE) AS promo_rate, CAST(n AS DOUBLE) AS open_store_count,
      CAST(0 AS DOUBLE) AS school_holiday_rate, CAST(0 AS DOUBLE) AS state_holiday_flag FROM d""",
)
def daily_totals_of_orders(spark, folder):
    """No store column and no signals: each row is its own store and everything is open."""
    orders = star_tables.read_table(spark, folder, "orders")
    rows = orders.select(F.col("o_orderdate").alias("date"), F.floor("o_totalprice").cast("double").alias("sales"))
    return panel.ensure_daily_totals(rows)


@query(
    "O5.4",
    """SELECT CAST(ts AS DATE) AS ds, round(sum(value), 2) AS y, CAST(0 AS DOUBLE) AS promo_store_count,
      CAST(0 AS DOUBLE) AS promo_rate, CAST(count(*) AS DOUBLE) AS open_store_count, CAST(0 AS DOUBLE) AS school_holiday_rate,
      CAST(0 AS DOUBLE) AS state_holiday_flag FROM events GROUP BY 1""",
)
def ready_daily_frame(spark, folder):
    """A ready (ds, y) frame keeps its values; absent regressors become 0."""
    events = star_tables.event_days(spark, folder)
    ready = events.groupBy(F.col("date").alias("ds")).agg(F.sum("sales").alias("y"), F.count("*").alias("open_store_count"))
    return rounded(panel.ensure_daily_totals(ready), 2)


@query(
    "O6.5 O6.6",
    f"""WITH {t.DAILY_BASELINES_SQL} SELECT ds, y, split, yhat_naive_yesterday, yhat_seasonal_naive_7,
    round(yhat_rolling_7, 4) AS yhat_rolling_7, round(yhat_rolling_28, 4) AS yhat_rolling_28 FROM guessed""",
)
def naive_forecasts(spark, folder):
    guessed = baselines.add_baselines(t.labelled_daily(spark, folder))
    return rounded(guessed.select("ds", "y", "split", *[f"yhat_{b}" for b in config.BASELINES]))


@query(
    "O6.8",
    f"""WITH {t.PANEL_SQL} SELECT date, store_id, sales,
    {t.split_case('row_number() OVER (ORDER BY date, store_id) - 1', 'count(*) OVER ()')} AS split FROM panel""",
)
def split_by_rows(spark, folder):
    return splits.split_by_rows(t.stored_store_days(spark, folder).select("date", "store_id", "sales"))


@query(
    "O6.9 O4.3",
    f"""WITH {t.PREPARED_SQL}, {t.date_split_sql('prepared', 'date')}
    SELECT p.date, p.store_id, p.sales, s.split FROM prepared p JOIN day_split s ON p.date = s.date""",
)
def split_by_dates(spark, folder):
    return splits.split_by_dates(t.sales_rows(spark, folder).select("date", "store_id", "sales"))


@query(
    "O4.3 O8.1",
    f"""WITH {t.PREPARED_SQL}, {t.date_split_sql('prepared', 'date')}
    SELECT s.split, count(*) AS rows, sum(p.sales) AS sales, min(p.date) AS first_day, max(p.date) AS last_day
    FROM prepared p JOIN day_split s ON p.date = s.date GROUP BY 1""",
)
def rows_of_each_split(spark, folder):
    """Semi joins by the days of a split, labelled and put together again."""
    rows = t.sales_rows(spark, folder)
    days = splits.date_splits(rows)
    parts = [splits.rows_of_split(rows, days, s).withColumn("split", F.lit(s)) for s in splits.SPLITS]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.groupBy("split").agg(
        F.count("*").alias("rows"), F.sum("sales").alias("sales"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
