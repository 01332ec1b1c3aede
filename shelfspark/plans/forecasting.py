"""Queries on future rows, frozen history and category codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.operators import encoding, features, forecast
from shelfspark.plans import tables as t
from shelfspark.plans.catalog import query, rounded
from shelfspark.plans.evaluation import SPLIT_PANEL_SQL, split_panel

ATTRIBUTES = list(forecast.FUTURE_DEFAULTS)
LAST_SQL = f"""{t.PANEL_SQL}, last AS (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY date DESC) = 1),
  future AS (SELECT date + CAST(k AS INTEGER) AS date, store_id, {', '.join(ATTRIBUTES)}
    FROM (SELECT *, unnest(generate_series(1, {{days}})) AS k FROM last))"""


@query("O7.6", f"WITH {LAST_SQL.format(days=30)} SELECT * FROM future")
def future_rows(spark, folder):
    return forecast.future_rows(t.store_days(spark, folder), 30)


@query("O7.7", f"WITH {LAST_SQL.format(days=14)} SELECT * FROM future")
def first_future_rows(spark, folder):
    return forecast.require_future_rows(forecast.future_rows(t.store_days(spark, folder), 30), 14)


@query(
    "O7.8",
    f"""WITH {t.PANEL_SQL} SELECT store_id, date, sales, CAST(row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS INTEGER)
    AS back FROM panel QUALIFY back <= 30""",
)
def recent_sales(spark, folder):
    return forecast.recent_sales(t.store_days(spark, folder))


def _frozen_sql() -> str:
    columns = [f"CASE WHEN max(n) >= {k} THEN max(sales) FILTER (WHERE back = {k}) ELSE max(mean) END AS sales_lag_{k}" for k in config.LAGS]
    functions = {"mean": "avg(sales)", "std": "stddev_pop(sales)", "min": "min(sales)", "max": "max(sales)", "median": "quantile_cont(sales, 0.5)"}
    for w in config.WINDOWS:
        for name, fn in functions.items():
            other = "0" if name == "std" else "max(mean)"
            columns.append(
                f"CASE WHEN max(n) >= {w} THEN {fn} FILTER (WHERE back <= {w}) ELSE {other} END AS sales_rolling_{w}_{name}"
            )
    rounded_columns = [f"round({c.split(' AS ')[0]}, 4) AS {c.split(' AS ')[1]}" for c in columns]
    return f"""numbered AS (SELECT store_id, sales, row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS back,
      avg(sales) OVER (PARTITION BY store_id) AS mean, least(count(*) OVER (PARTITION BY store_id), 30) AS n FROM {{source}})
    SELECT store_id, {', '.join(rounded_columns)} FROM numbered WHERE back <= 30 GROUP BY store_id"""


@query("O10.13 O7.8", f"WITH {t.PANEL_SQL}, {_frozen_sql().format(source='panel')}")
def frozen_history(spark, folder):
    return rounded(forecast.frozen_history(t.store_days(spark, folder)))


@query(
    "O10.13",
    "WITH days AS (SELECT CAST(user_id AS VARCHAR) AS store_id, CAST(ts AS DATE) AS date, sum(floor(value)) AS sales FROM events GROUP BY ALL), "
    + _frozen_sql().format(source="days"),
)
def frozen_history_of_short_series(spark, folder):
    """Users with few days fall back to their mean."""
    from shelfspark.sources.star_tables import event_days

    days = event_days(spark, folder).groupBy("store_id", "date").agg(F.sum(F.floor("sales").cast("double")).alias("sales"))
    return rounded(forecast.frozen_history(days))


@query(
    "O10.13 O10.14 O6.4",
    f"""WITH {LAST_SQL.format(days=7)}, {_frozen_sql().format(source='panel').replace('SELECT store_id, round', 'frozen AS (SELECT store_id, round', 1)})
    SELECT f.date, f.store_id, CAST(isodow(f.date) - 1 AS INTEGER) AS dayofweek,
      CAST(f.state_holiday <> 'none' OR f.school_holiday = 1 AS INTEGER) AS is_holiday,
      f.store_id || '_' || f.store_type AS store_id_store_type_interaction, h.sales_lag_1, h.sales_rolling_7_mean
    FROM future f JOIN frozen h ON f.store_id = h.store_id""".replace("numbered AS", "numbered AS").replace(")\n    frozen", "),\n    frozen"),
)
def forecast_inputs(spark, folder):
    history = t.store_days(spark, folder)
    rows = forecast.forecast_inputs(history, forecast.future_rows(history, 7), 7)
    wanted = ["date", "store_id", "dayofweek", "is_holiday", "store_id_store_type_interaction", "sales_lag_1", "sales_rolling_7_mean"]
    forecast.require_features(rows, wanted)
    return rounded(rows.select(*wanted))


ENCODED = ("store_id", "store_type", "state_holiday", "store_id_state_holiday_interaction")
CODES_SQL = f"""{SPLIT_PANEL_SQL}, crossed AS (SELECT *, store_id || '_' || state_holiday AS store_id_state_holiday_interaction FROM split_panel),
  cats AS (SELECT DISTINCT p.c, p.v FROM crossed, LATERAL (VALUES {', '.join(f"('{c}', {c})" for c in ENCODED)}) AS p(c, v) WHERE split = 'train'),
  codes AS (SELECT c, v, CAST(row_number() OVER (PARTITION BY c ORDER BY v) - 1 AS DOUBLE) AS code FROM cats)"""


def crossed_panel(spark, folder):
    return features.interaction_features(split_panel(spark, folder), ["store_id", "state_holiday"])


@query("O10.1", f"""WITH {CODES_SQL} SELECT c AS "column", v AS category, code FROM codes""")
def category_codes(spark, folder):
    rows = crossed_panel(spark, folder)
    return encoding.fit_codes(rows.where(F.col("split") == "train"), ENCODED)


@query(
    "O10.1 O10.2",
    f"WITH {CODES_SQL} SELECT date, store_id AS store_key, split, "
    + ", ".join(f"coalesce((SELECT code FROM codes WHERE c = '{c}' AND v = crossed.{c}), -1) AS {c}" for c in ENCODED)
    + " FROM crossed",
)
def encoded_categories(spark, folder):
    rows = crossed_panel(spark, folder).withColumn("store_key", F.col("store_id")).persist()
    codes = encoding.fit_codes(rows.where(F.col("split") == "train"), ENCODED)
    return encoding.encode(rows, codes).select("date", "store_key", "split", *ENCODED)


@query(
    "O10.1 O10.2",
    """WITH d AS (SELECT event_id, event_type || user_id AS label, ts < TIMESTAMP '2024-01-05' AS train FROM events),
    codes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM d WHERE train))
    SELECT event_id, CAST(coalesce(code, -1) AS DOUBLE) AS label FROM d LEFT JOIN codes USING (label)""",
)
def unseen_categories_encoded(spark, folder):
    from shelfspark.sources.star_tables import read_table

    events = read_table(spark, folder, "events")
    rows = events.select(
        "event_id", F.concat("event_type", F.col("user_id").cast("string")).alias("label"), (F.col("ts") < "2024-01-05").alias("train")
    )
    codes = encoding.fit_codes(rows.where("train"), ["label"])
    return encoding.encode(rows, codes).select("event_id", "label")


@query(
    "O10.10",
    f"""WITH {t.STORE_PREDICTIONS_SQL}, w AS (SELECT date, store_id, max(prediction) FILTER (WHERE model = 'xgboost') AS a,
      max(prediction) FILTER (WHERE model = 'lightgbm') AS b FROM predictions GROUP BY 1, 2)
    SELECT date, store_id, round(a * 0.8::DOUBLE + b * 0.2::DOUBLE, 3) AS yhat, round(a * 0.5::DOUBLE + b * 0.5::DOUBLE, 3) AS equal_weights
    FROM w WHERE b IS NOT NULL""",
)
def weighted_member_columns(spark, folder):
    wide = (
        t.store_predictions(spark, folder)
        .groupBy("date", "store_id")
        .agg(*[F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(m) for m in ("xgboost", "lightgbm")])
        .where("lightgbm IS NOT NULL")
    )
    members = {"xgboost": "xgboost", "lightgbm": "lightgbm"}
    weighted = forecast.weighted_prediction(members, {"xgboost": 8.0, "lightgbm": 2.0})
    return rounded(wide.select("date", "store_id", weighted.alias("yhat"), forecast.weighted_prediction(members).alias("equal_weights")), 3)


