"""Queries on metrics, comparisons, diagnosis and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.functions.stats import correlation, error_metrics
from shelfspark.operators import baselines, compare, forecast, metrics, registry, reports, splits
from shelfspark.plans import tables as t
from shelfspark.plans.catalog import query, rounded
from shelfspark.session import scratch_path, shared_folder
from shelfspark.sources import star_tables

ROUNDED_METRICS = "round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(mape, 4) AS mape, round(r2, 4) AS r2"


def _unpivot_sql(pairs: dict[str, str]) -> str:
    values = ", ".join(f"('{name}', {expr})" for name, expr in pairs.items())
    return f"LATERAL (VALUES {values}) AS p(variant, yhat)"


BASELINE_PAIRS = {b: f"yhat_{b}" for b in config.BASELINES}
# Combinations of naive forecasts under the variants' names: data for the comparison queries.
STAND_INS = {
    "prophet_univariate": "yhat_rolling_28",
    "prophet_promo_only": "(yhat_naive_yesterday + yhat_rolling_7) / 2",
    "prophet_open_store_only": "(yhat_rolling_7 + yhat_rolling_28) / 2",
    "prophet_holiday_only": "(yhat_seasonal_naive_7 + yhat_rolling_28) / 2",
    "prophet_all_regressors": "(yhat_naive_yesterday + yhat_seasonal_naive_7 + yhat_rolling_7) / 3",
}
BASELINE_METRICS_SQL = f"""{t.DAILY_BASELINES_SQL}, pairs AS (
  SELECT split, y, p.variant, p.yhat FROM guessed, {_unpivot_sql(BASELINE_PAIRS)} WHERE split <> 'train' AND p.yhat IS NOT NULL),
metrics AS (SELECT variant, split, {t.metrics_sql()} FROM pairs GROUP BY variant, split)"""
VARIANT_METRICS_SQL = BASELINE_METRICS_SQL.replace(
    _unpivot_sql(BASELINE_PAIRS), _unpivot_sql({**BASELINE_PAIRS, **STAND_INS})
)
COMPARED_SQL = f"""{VARIANT_METRICS_SQL}, compared AS (
  SELECT m.*, coalesce(m.variant <> 'seasonal_naive_7' AND m.rmse < b.rmse, false) AS beats_seasonal_naive_7
  FROM metrics m LEFT JOIN metrics b ON b.split = m.split AND b.variant = 'seasonal_naive_7')"""


def variant_metrics(spark, folder):
    guessed = baselines.add_baselines(t.labelled_daily(spark, folder)).where(F.col("split") != "train")
    predictions = guessed.select("split", "y", *BASELINE_PAIRS.values(), *[F.expr(e).alias(v) for v, e in STAND_INS.items()])
    pairs = {**BASELINE_PAIRS, **{v: v for v in STAND_INS}}
    long = baselines.long_predictions(predictions, ["split"], "y", pairs)
    return compare.add_seasonal_comparison(metrics.metric_rows(long, ["variant", "split"]))


@query("O9.1 O5.5 O5.6 O8.4", f"WITH {BASELINE_METRICS_SQL} SELECT variant, split, {ROUNDED_METRICS} FROM metrics")
def baseline_metrics(spark, folder):
    guessed = baselines.add_baselines(t.labelled_daily(spark, folder))
    return rounded(baselines.baseline_metrics(guessed).select("variant", "split", *compare.METRICS).select("variant", "split", "mae", "rmse", "mape", "r2"))


@query(
    "O5.5",
    f"""WITH {t.STORE_PREDICTIONS_SQL}, m AS (SELECT store_id, model, {t.metrics_sql('y', 'prediction')} FROM predictions GROUP BY 1, 2)
    SELECT store_id, model, {ROUNDED_METRICS} FROM m""",
)
def metrics_per_store(spark, folder):
    predictions = t.store_predictions(spark, folder)
    return rounded(metrics.metric_rows(predictions, ["store_id", "model"], yhat="prediction").select("store_id", "model", "mae", "rmse", "mape", "r2"))


@query(
    "O5.6",
    """WITH d AS (SELECT event_type AS model, value AS y, CASE WHEN user_id % 5 = 0 THEN NULL WHEN user_id % 7 = 0
      THEN CAST('Infinity' AS DOUBLE) WHEN event_type = 'click' THEN value ELSE 10 END AS yhat FROM events),
    k AS (SELECT * FROM d WHERE yhat < CAST('Infinity' AS DOUBLE))
    SELECT d.model, round(avg(abs(k.y - k.yhat)), 4) AS mae, round(max(m.r2), 4) AS r2 FROM (SELECT DISTINCT model FROM d) d
    LEFT JOIN k ON d.model = k.model LEFT JOIN (SELECT model, """
    + t.metrics_sql()
    + """ FROM k GROUP BY model) m ON d.model = m.model GROUP BY d.model""",
)
def metrics_without_broken_pairs(spark, folder):
    events = star_tables.read_table(spark, folder, "events")
    user, kind = F.col("user_id"), F.col("event_type")
    guess = F.when(user % 5 == 0, None).when(user % 7 == 0, float("inf")).when(kind == "click", F.col("value")).otherwise(10.0)
    rows = events.select(kind.alias("model"), F.col("value").alias("y"), guess.alias("yhat"))
    return rounded(metrics.metric_rows(rows, ["model"]).select("model", "mae", "r2"))


@query("O4.5", f"WITH {COMPARED_SQL} SELECT variant, split, {ROUNDED_METRICS}, beats_seasonal_naive_7 FROM compared")
def seasonal_comparison(spark, folder):
    return rounded(variant_metrics(spark, folder))


@query(
    "O7.4",
    f"""WITH {VARIANT_METRICS_SQL} SELECT * FROM (
      SELECT split, 'rmse' AS metric, variant, round(rmse, 4) AS value FROM metrics WHERE split = 'test' ORDER BY rmse, variant LIMIT 1)
    UNION ALL SELECT * FROM (
      SELECT split, 'r2', variant, round(r2, 4) FROM metrics WHERE split = 'validation' ORDER BY r2 DESC, variant LIMIT 1)""",
)
def best_variants(spark, folder):
    rows = variant_metrics(spark, folder)
    low = compare.best_variant(rows).select("split", F.lit("rmse").alias("metric"), "variant", F.col("rmse").alias("value"))
    high = compare.best_variant(rows, "validation", "r2").select("split", F.lit("r2").alias("metric"), "variant", F.col("r2").alias("value"))
    return rounded(low.unionByName(high))


@query(
    "O7.5",
    f"WITH {COMPARED_SQL} SELECT split, variant, round(rmse, 4) AS rmse, beats_seasonal_naive_7 FROM compared ORDER BY split, rmse, variant",
)
def variant_summary_table(spark, folder):
    table = compare.summary_table(variant_metrics(spark, folder))
    return rounded(table.select("split", "variant", "rmse", "beats_seasonal_naive_7"))


def _best_sql(where: str, column: str) -> str:
    return f"(SELECT {column} FROM compared WHERE {where} ORDER BY rmse, variant LIMIT 1)"


def _rmse_sql(variant: str) -> str:
    return f"(SELECT rmse FROM compared WHERE split = 'test' AND variant = '{variant}')"


MODELS = "variant LIKE 'prophet%'"
VERDICT_SQL = f"""WITH {COMPARED_SQL}, gains AS (
  SELECT * FROM (VALUES ('promo', 'prophet_promo_only', {_rmse_sql('prophet_univariate')} - {_rmse_sql('prophet_promo_only')}),
    ('open_store', 'prophet_open_store_only', {_rmse_sql('prophet_univariate')} - {_rmse_sql('prophet_open_store_only')}),
    ('holiday', 'prophet_holiday_only', {_rmse_sql('prophet_univariate')} - {_rmse_sql('prophet_holiday_only')})) g(grp, variant, gain))
SELECT {_best_sql("split = 'validation'", 'variant')} AS best_validation_variant,
  round({_best_sql("split = 'validation'", 'rmse')}, 4) AS best_validation_rmse,
  {_best_sql("split = 'test'", 'variant')} AS best_test_variant, round({_best_sql("split = 'test'", 'rmse')}, 4) AS best_test_rmse,
  {_best_sql(f"split = 'test' AND {MODELS}", 'variant')} AS best_prophet_variant,
  round({_best_sql(f"split = 'test' AND {MODELS}", 'rmse')}, 4) AS best_prophet_test_rmse,
  {_best_sql(f"split = 'test' AND {MODELS} AND variant <> 'prophet_univariate'", 'variant')} AS best_regressor_variant,
  round({_best_sql(f"split = 'test' AND {MODELS} AND variant <> 'prophet_univariate'", 'rmse')}, 4) AS best_regressor_test_rmse,
  round({_rmse_sql('seasonal_naive_7')}, 4) AS seasonal_naive_7_test_rmse,
  {_best_sql(f"split = 'test' AND {MODELS}", 'rmse')} < {_rmse_sql('seasonal_naive_7')} AS prophet_beats_seasonal_naive_7,
  {_best_sql(f"split = 'test' AND {MODELS} AND variant <> 'prophet_univariate'", 'rmse')} < {_rmse_sql('prophet_univariate')}
    AS regressors_improve_over_univariate,
  {_rmse_sql('prophet_all_regressors')} < {_rmse_sql('prophet_univariate')} AS all_regressors_improve_over_univariate,
  round({_rmse_sql('prophet_all_regressors')}, 4) AS all_regressors_test_rmse,
  round({_rmse_sql('prophet_univariate')}, 4) AS univariate_test_rmse,
  (SELECT grp FROM gains ORDER BY gain DESC LIMIT 1) AS best_regressor_group,
  (SELECT variant FROM gains ORDER BY gain DESC LIMIT 1) AS best_group_variant,
  round((SELECT max(gain) FROM gains), 4) AS best_group_rmse_gain,
  CASE WHEN (SELECT bool_or(beats_seasonal_naive_7) FROM compared WHERE split = 'test' AND {MODELS})
    THEN '{compare.KEEP}' ELSE '{compare.WEAK}' END AS recommendation"""


@query("O9.5 O9.6", VERDICT_SQL)
def experiment_verdict(spark, folder):
    return rounded(compare.experiment_verdict(variant_metrics(spark, folder)))


# --- diagnosis ----------------------------------------------------------------------------


def split_panel(spark, folder):
    return splits.split_by_rows(t.stored_store_days(spark, folder))


SPLIT_PANEL_SQL = f"""{t.PANEL_SQL}, split_panel AS (SELECT *,
  {t.split_case('row_number() OVER (ORDER BY date, store_id) - 1', 'count(*) OVER ()')} AS split FROM panel)"""


@query(
    "O5.7",
    f"""WITH {SPLIT_PANEL_SQL}, s AS (SELECT split, count(*) AS n, avg(sales) AS mean, stddev_samp(sales) AS std FROM split_panel GROUP BY 1),
    m AS (SELECT *, abs(mean - (SELECT mean FROM s WHERE split = 'train')) / (SELECT mean FROM s WHERE split = 'train') AS shift FROM s)
    SELECT split, n, round(mean, 4) AS mean, round(std, 4) AS std, round(shift, 4) AS mean_shift, shift > 0.2 AS shifted FROM m""",
)
def split_stats(spark, folder):
    return rounded(metrics.split_stats(split_panel(spark, folder)))


@query(
    "O5.8",
    f"""WITH {SPLIT_PANEL_SQL}, q AS (SELECT split, quantile_cont(customer_traffic, 0.25) AS q1, quantile_cont(customer_traffic, 0.75) AS q3
      FROM split_panel GROUP BY 1), b AS (SELECT split, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q)
    SELECT split, lower_bound, upper_bound, count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) AS outliers,
      round(count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) * 100.0 / count(*), 4) AS percentage,
      min(v) FILTER (WHERE v < lower_bound OR v > upper_bound) AS min_outlier,
      max(v) FILTER (WHERE v < lower_bound OR v > upper_bound) AS max_outlier
    FROM (SELECT split, customer_traffic AS v FROM split_panel) JOIN b USING (split) GROUP BY ALL""",
)
def outlier_report(spark, folder):
    return rounded(metrics.outlier_report(split_panel(spark, folder), ["split"], "customer_traffic"))


@query(
    "O5.9",
    f"""WITH {t.STORE_PREDICTIONS_SQL}, p AS (SELECT model, y, prediction AS yhat FROM predictions),
    l AS (SELECT model, min(y) AS lo, max(y) AS hi FROM p GROUP BY 1)
    SELECT model, round(avg(yhat), 4) AS pred_mean, round(stddev_pop(yhat), 4) AS pred_std,
      count(*) FILTER (WHERE yhat < lo * 0.5) AS extreme_low_count, count(*) FILTER (WHERE yhat > hi * 1.5) AS extreme_high_count,
      round(avg(y - yhat), 4) AS residual_mean, round(stddev_samp(y - yhat), 4) AS residual_std,
      round(CASE WHEN count(*) FILTER (WHERE y = 0) = 0 THEN avg(abs((y - yhat) / y)) * 100 END, 4) AS mape
    FROM p JOIN l USING (model) GROUP BY model""",
)
def prediction_analysis(spark, folder):
    predictions = t.store_predictions(spark, folder).withColumnRenamed("prediction", "yhat")
    return rounded(metrics.prediction_analysis(predictions))


CORRELATED = ("customer_traffic", "has_promotion", "is_open", "is_holiday", "school_holiday", "competition_distance", "promo2")


@query(
    "O5.10",
    f"""WITH {SPLIT_PANEL_SQL}, train AS (SELECT *, sales * 2 + has_promotion AS leaked FROM split_panel WHERE split = 'train') """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(CASE WHEN stddev_samp({c}) > 0 THEN corr({c}, sales) END, 4) AS correlation,
        coalesce(abs(CASE WHEN stddev_samp({c}) > 0 THEN corr({c}, sales) END) > 0.95, false) AS leak FROM train"""
        for c in (*CORRELATED, "leaked")
    ),
)
def target_correlations(spark, folder):
    train = split_panel(spark, folder).where(F.col("split") == "train")
    leaked = train.withColumn("leaked", F.col("sales") * 2 + F.col("has_promotion"))
    return rounded(metrics.target_correlations(leaked.select("sales", *CORRELATED, "leaked")))


@query(
    "O5.11",
    f"""WITH {t.PREPARED_SQL} SELECT 'feature_count' AS rule, CAST(12 AS DOUBLE) AS value, CAST(50 AS DOUBLE) AS "limit", false AS flagged FROM prepared HAVING count(*) > 0
    UNION ALL SELECT 'train_rows', CAST(count(*) AS DOUBLE), CAST(1000 AS DOUBLE), count(*) < 1000 FROM prepared
    UNION ALL SELECT 'zero_sales', CAST(count(*) FILTER (WHERE sales = 0) AS DOUBLE), CAST(count(*) * CAST(0.1 AS DOUBLE) AS DOUBLE),
      count(*) FILTER (WHERE sales = 0) > count(*) * CAST(0.1 AS DOUBLE) FROM prepared""",
)
def rule_flags(spark, folder):
    return metrics.rule_flags(t.prepared(spark, folder))


@query(
    "O9.12",
    f"""WITH {SPLIT_PANEL_SQL}, train AS (SELECT * FROM split_panel WHERE split = 'train'),
    s AS (SELECT split, avg(customer_traffic * is_holiday * year(date)) AS mean FROM split_panel GROUP BY 1),
    m AS (SELECT split, abs(mean - (SELECT mean FROM s WHERE split = 'train')) / (SELECT mean FROM s WHERE split = 'train') AS shift FROM s)
    SELECT 'distribution_shift' AS topic, 'Mean of the ' || split || ' set moved by ' || printf('%.1f', shift * 100) || '% against train' AS detail
      FROM m WHERE split <> 'train' AND shift > 0.2
    UNION ALL SELECT 'data_leakage', CAST(n AS VARCHAR) || ' features correlate with the target above 95%' FROM (
      SELECT CAST(abs(corr(sales, sales * 3)) > 0.95 AS INTEGER) AS n FROM train) WHERE n > 0
    UNION ALL SELECT 'train_rows', 'train_rows is ' || count(*) || ' (limit 1000)' FROM train HAVING count(*) < 1000
    UNION ALL SELECT 'zero_sales', 'zero_sales is ' || count(*) FILTER (WHERE is_open * has_promotion = 0) || ' (limit '
      || printf('%.0f', count(*) * 0.1) || ')' FROM train HAVING count(*) FILTER (WHERE is_open * has_promotion = 0) > count(*) * 0.1""",
)
def diagnosis_recommendations(spark, folder):
    rows = split_panel(spark, folder)
    train = rows.where(F.col("split") == "train")
    weighted = rows.withColumn("signal", F.col("customer_traffic") * F.col("is_holiday") * F.year("date"))
    leaked = train.select("sales", (F.col("sales") * 3).alias("copy"))
    idle = train.withColumn("sales", F.col("is_open") * F.col("has_promotion"))
    return metrics.recommendations(
        metrics.split_stats(weighted, "signal"), metrics.target_correlations(leaked), metrics.rule_flags(idle)
    )


@query(
    "O5.12",
    f"""WITH {t.PANEL_SQL} SELECT store_id, sum(sales) AS total_predicted_sales, round(avg(sales), 4) AS average_daily_sales,
      max(sales) AS max_daily_sales, min(sales) AS min_daily_sales, count(*) AS forecast_days FROM panel GROUP BY 1""",
)
def forecast_summary(spark, folder):
    return rounded(metrics.forecast_summary(t.store_days(spark, folder), "sales"))


@query(
    "O5.14",
    f"""WITH {SPLIT_PANEL_SQL}, l AS (SELECT split, p.c, p.v FROM split_panel, LATERAL (VALUES
        ('store_id', store_id), ('week', store_type || year(date) || month(date))) AS p(c, v))
    SELECT c AS "column", split, CAST(sum(CASE WHEN v NOT IN (SELECT t.v FROM l t WHERE t.split = 'train' AND t.c = l.c) THEN 1 ELSE 0 END) AS BIGINT)
      AS unknown_rows FROM l WHERE split <> 'train' GROUP BY 1, 2""",
)
def unknown_categories(spark, folder):
    month = F.concat("store_type", F.year("date").cast("string"), F.month("date").cast("string"))
    rows = split_panel(spark, folder).select("split", "store_id", month.alias("week"))
    return metrics.unknown_categories(
        rows.where(F.col("split") == "train"), rows.where(F.col("split") != "train"), ["store_id", "week"]
    )


# --- report tables ------------------------------------------------------------------------


@query(
    "O4.2",
    f"""WITH {t.STORE_PREDICTIONS_SQL} SELECT date, store_id, model, y, round(prediction, 4) AS yhat, round(y - prediction, 4) AS residual
    FROM predictions""",
)
def residuals(spark, folder):
    days = t.stored_store_days(spark, folder)
    rows = reports.residuals(days, t.store_predictions(spark, folder, days), ["date", "store_id"])
    return rounded(rows)


@query(
    "O4.2",
    f"""WITH {t.DAILY_BASELINES_SQL} SELECT ds AS date, 'rolling_7' AS model, y, round(yhat_rolling_7, 4) AS yhat,
    round(y - yhat_rolling_7, 4) AS residual FROM guessed WHERE yhat_rolling_7 IS NOT NULL""",
)
def daily_residuals(spark, folder):
    guessed = baselines.add_baselines(t.labelled_daily(spark, folder)).withColumnRenamed("ds", "date")
    predictions = guessed.select("date", F.lit("rolling_7").alias("model"), F.col("yhat_rolling_7").alias("prediction"))
    rows = reports.residuals(guessed, predictions.where("prediction IS NOT NULL"), ["date"], "y")
    return rounded(rows)


RESIDUAL_SQL = f"{t.STORE_PREDICTIONS_SQL}, res AS (SELECT date, store_id, model, split, y, y - prediction AS residual FROM predictions)"


def residual_rows(spark, folder, *keys):
    """(model, keys, residual), written to the shared folder: quantiles, ranks and histograms read it several times."""
    rows = t.store_predictions(spark, folder).select("model", *keys, (F.col("y") - F.col("prediction")).alias("residual"))
    path = scratch_path(spark, "residuals")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@query(
    "O9.9",
    f"""WITH {RESIDUAL_SQL} SELECT model, count(*) AS n, round(min(residual), 4) AS min, round(quantile_cont(residual, 0.25), 4) AS q1,
    round(quantile_cont(residual, 0.5), 4) AS median, round(quantile_cont(residual, 0.75), 4) AS q3, round(max(residual), 4) AS max
    FROM res GROUP BY model""",
)
def residual_summary(spark, folder):
    return rounded(reports.residual_summary(residual_rows(spark, folder)))


def _poly_sql(coefficients: tuple[float, ...], x: str) -> str:
    total = f"CAST({coefficients[0]!r} AS DOUBLE)"
    for c in coefficients[1:]:
        total = f"({total} * {x} + CAST({c!r} AS DOUBLE))"
    return total


def _normal_sql(p: str) -> str:
    from shelfspark.functions import stats as s

    middle = f"({p} - 0.5) * {_poly_sql(s._A, f'(({p} - 0.5) * ({p} - 0.5))')} / {_poly_sql(s._B, f'(({p} - 0.5) * ({p} - 0.5))')}"

    def tail(q: str) -> str:
        return f"{_poly_sql(s._C, f'sqrt(-2 * ln({q}))')} / {_poly_sql(s._D, f'sqrt(-2 * ln({q}))')}"

    return f"CASE WHEN {p} < {s._TAIL} THEN {tail(p)} WHEN {p} > 1 - {s._TAIL} THEN -({tail(f'(1 - {p})')}) ELSE {middle} END"


@query(
    "O9.10",
    f"""WITH {RESIDUAL_SQL}, r AS (SELECT date, store_id, model, residual, count(*) OVER (PARTITION BY model) AS n,
      row_number() OVER (PARTITION BY model ORDER BY residual, date, store_id) AS rank FROM res),
    p AS (SELECT *, CASE WHEN rank = n THEN pow(0.5, 1.0::DOUBLE / n) WHEN rank = 1 THEN 1 - pow(0.5, 1.0::DOUBLE / n)
      ELSE (rank - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS q FROM r)
    SELECT model, rank, round({_normal_sql('q')}, 4) AS theoretical, round(residual, 4) AS sample FROM p""",
)
def normal_quantile_points(spark, folder):
    points = reports.normal_quantile_points(residual_rows(spark, folder, "date", "store_id"), ["date", "store_id"])
    return rounded(points.drop("date", "store_id"))


def histogram_sql(source: str, group: str, value: str) -> str:
    return f"""e AS (SELECT {group} AS g, min({value}) AS lo, (max({value}) - min({value})) / 50 AS w, count(*) AS n FROM {source} GROUP BY 1),
    c AS (SELECT g, CAST(least(floor(({value} - lo) / w), 49) AS INTEGER) AS bin, count(*) AS rows
      FROM {source} JOIN e ON {group} = g GROUP BY ALL),
    h AS (SELECT e.g, lo, w, n, b.bin, coalesce(rows, 0) AS rows
      FROM e CROSS JOIN (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin) b LEFT JOIN c ON e.g = c.g AND b.bin = c.bin)
    SELECT g AS {group}, bin, round(lo + bin * w, 4) AS bin_start, rows, round(rows / (n * w), 10) AS density FROM h"""


@query("O9.11", f"WITH {RESIDUAL_SQL}, err AS (SELECT model, abs(residual) AS error FROM res), {histogram_sql('err', 'model', 'error')}")
def error_histogram(spark, folder):
    errors = residual_rows(spark, folder).select("model", F.abs("residual").alias("error"))
    h = reports.density_histogram(errors, ["model"], "error")
    return rounded(rounded(h, 4, ["bin_start"]), 10, ["density"])


@query("O9.11", f"WITH {RESIDUAL_SQL}, {histogram_sql('res', 'model', 'residual')}")
def residual_histogram(spark, folder):
    h = reports.density_histogram(residual_rows(spark, folder), ["model"], "residual")
    return rounded(rounded(h, 4, ["bin_start"]), 10, ["density"])


@query("O9.11", f"WITH {SPLIT_PANEL_SQL}, {histogram_sql('split_panel', 'split', 'sales')}")
def target_histogram(spark, folder):
    h = reports.density_histogram(split_panel(spark, folder), ["split"], "sales")
    return rounded(rounded(h, 4, ["bin_start"]), 10, ["density"])


@query(
    "O9.8",
    f"""WITH {t.STORE_PREDICTIONS_SQL} SELECT date, store_id, 'actual' AS series, sales AS value FROM panel
    UNION ALL SELECT date, store_id, model, round(prediction, 4) FROM predictions""",
)
def comparison_series(spark, folder):
    days = t.stored_store_days(spark, folder)
    rows = reports.comparison_series(days, t.store_predictions(spark, folder, days), ["date", "store_id"])
    return rounded(rows)


IMPORTANCE_SQL = f"""{SPLIT_PANEL_SQL}, imp AS (SELECT store_id AS model, p.feature, p.importance FROM (
    SELECT store_id, {', '.join(f'abs(corr({c}, sales)) AS {c}' for c in ('customer_traffic', 'has_promotion', 'is_holiday', 'school_holiday'))}
    FROM split_panel GROUP BY 1), LATERAL (VALUES
    {', '.join(f"('{c}', {c})" for c in ('customer_traffic', 'has_promotion', 'is_holiday', 'school_holiday'))}) AS p(feature, importance)
  WHERE NOT isnan(p.importance) AND p.importance IS NOT NULL)"""


@query(
    "O7.2 O7.3",
    f"""WITH {IMPORTANCE_SQL} SELECT * FROM (SELECT model, feature, round(importance, 6) AS importance,
      CAST(row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS INTEGER) AS place FROM imp) WHERE place <= 3""",
)
def top_importances(spark, folder):
    """Correlation with sales stands in for importance, one model per store."""
    names = ("customer_traffic", "has_promotion", "is_holiday", "school_holiday")
    wide = t.store_days(spark, folder).groupBy(F.col("store_id").alias("model")).agg(*[F.abs(correlation(F.col(c), F.col("sales"))).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in names])
    long = wide.select("model", F.inline(pairs)).where("importance IS NOT NULL")
    return rounded(reports.top_importances(long, 3), 6)


# --- model tables -------------------------------------------------------------------------

MODEL_METRICS_SQL = f"""{t.STORE_PREDICTIONS_SQL}, daily_pred AS (SELECT date, sum(y) AS y, sum(prediction) AS yhat FROM predictions
    WHERE model = 'lightgbm' GROUP BY date),
  model_metrics AS (SELECT model AS model_key, {t.metrics_sql('y', 'prediction')} FROM predictions WHERE split = 'test' GROUP BY 1
    UNION ALL SELECT 'prophet_daily_total', {t.metrics_sql()} FROM daily_pred
    UNION ALL SELECT 'other', {t.metrics_sql()} FROM daily_pred
    UNION ALL SELECT 'xgboost_store_level', {t.metrics_sql('y', 'prediction')} FROM predictions WHERE split = 'validation' AND model = 'xgboost'),
  names AS (SELECT * FROM (VALUES ('xgboost', 'xgboost', 'xgboost_store_level', 'store_level', 'date+store_id', NULL),
    ('xgboost_store_level', 'xgboost', 'xgboost_store_level', 'store_level', 'date+store_id', NULL),
    ('lightgbm', 'lightgbm', 'lightgbm_store_level', 'store_level', 'date+store_id', NULL),
    ('ensemble_store_level', 'ensemble', 'ensemble_store_level', 'store_level', 'date+store_id', 'xgboost_store_level,lightgbm_store_level'),
    ('prophet_daily_total', 'prophet_daily_total', 'prophet_daily_total', 'daily_total', 'date', NULL))
    n(model_key, artifact_path, registered_name, forecast_level, target_grain, ensemble_members)),
  canonical AS (SELECT m.model_key, m.mae, m.rmse, m.mape, m.r2, coalesce(n.registered_name, m.model_key) AS registered_name,
    n.forecast_level, n.target_grain, n.artifact_path, n.ensemble_members, n.registered_name IS NOT NULL AS known
    FROM model_metrics m LEFT JOIN names n ON m.model_key = n.model_key),
  best AS (SELECT forecast_level, registered_name AS model_name, rmse FROM (
    SELECT *, row_number() OVER (PARTITION BY forecast_level ORDER BY rmse, CASE registered_name WHEN 'xgboost_store_level' THEN 0
      WHEN 'lightgbm_store_level' THEN 1 ELSE 2 END) AS place FROM canonical WHERE known) WHERE place = 1)"""


def model_metrics(spark, folder, days=None):
    """Predictions are made once: one aggregation gives the metrics of a name and, without a name, the totals of a day."""
    predictions = t.store_predictions(spark, folder, days)
    model, split = F.col("model"), F.col("split")
    name = F.when(split == "test", model).when((split == "validation") & (model == "xgboost"), "xgboost_store_level")
    day = F.when(model == "lightgbm", F.col("date"))
    uses = F.array(
        F.struct(name.alias("model"), F.lit(None).cast("date").alias("date")),
        F.struct(F.lit(None).cast("string").alias("model"), day.alias("date")),
    )
    used = predictions.where(name.isNotNull() | day.isNotNull()).select("y", F.col("prediction").alias("yhat"), F.inline(uses))
    rows = used.where(F.col("model").isNotNull() | F.col("date").isNotNull())
    totals = [F.sum("y").alias("y"), F.sum("yhat").alias("yhat")]
    scores = [c.alias(metric) for metric, c in error_metrics(F.col("y"), F.col("yhat")).items()]
    shared_folder(spark)
    # One row for each name and day.
    summed = rows.groupBy("model", "date").agg(*scores, *totals).checkpoint()
    daily = summed.where(F.col("date").isNotNull())
    named = daily.select("y", "yhat", F.explode(F.array(F.lit("prophet_daily_total"), F.lit("other"))).alias("model"))
    columns = ["model", "mae", "rmse", "mape", "r2"]
    out = summed.where(F.col("model").isNotNull()).select(*columns).unionByName(metrics.metric_rows(named, ["model"]).select(*columns))
    return out.withColumnRenamed("model", "model_key")


@query(
    "O4.7",
    f"""WITH {MODEL_METRICS_SQL} SELECT model_key, {ROUNDED_METRICS}, registered_name, forecast_level, target_grain, artifact_path,
    ensemble_members, known FROM canonical""",
)
def canonical_models(spark, folder):
    return rounded(registry.canonicalise(model_metrics(spark, folder)))


@query("O9.2", f"WITH {MODEL_METRICS_SQL} SELECT forecast_level, model_name, round(rmse, 4) AS rmse FROM best")
def best_model_per_level(spark, folder):
    return rounded(registry.best_by_level(registry.canonicalise(model_metrics(spark, folder))))


@query(
    "O9.3",
    f"""WITH {MODEL_METRICS_SQL}, p AS (SELECT c.*, row_number() OVER (PARTITION BY registered_name ORDER BY model_key) AS place,
      registered_name IN (SELECT model_name FROM best) AS is_best FROM canonical c),
    r AS (SELECT *, CASE WHEN NOT known THEN 'no registry mapping' WHEN place > 1
      THEN 'duplicate registration target ' || registered_name END AS skipped_because FROM p)
    SELECT model_key, registered_name, artifact_path, forecast_level, target_grain, ensemble_members,
      CASE WHEN skipped_because IS NULL THEN is_best END AS is_best,
      CASE WHEN skipped_because IS NULL THEN CASE WHEN is_best THEN 'Production' WHEN forecast_level = 'store_level' THEN 'Staging' END END
        AS recommended_stage, skipped_because FROM r""",
)
def registration_plan(spark, folder):
    canonical = registry.canonicalise(model_metrics(spark, folder))
    return registry.registration_plan(canonical, registry.best_by_level(canonical))


REPORT_SQL = f"""WITH {MODEL_METRICS_SQL}
  SELECT coalesce(CASE WHEN forecast_level = 'daily_total' THEN 'daily_total' END, 'store_level') AS forecast_level, registered_name,
    model_key, {ROUNDED_METRICS}, registered_name IN (SELECT model_name FROM best) AS is_best,
    (SELECT count(*) FROM panel) AS total_rows, (SELECT count(DISTINCT date) FROM panel) AS total_files_validated
  FROM canonical"""


def performance_rows(spark, folder):
    panel = t.stored_store_days(spark, folder, t.SERIES)
    canonical = registry.canonicalise(model_metrics(spark, folder, panel))
    days = panel.groupBy("date").count()
    batch = days.agg(F.sum("count").alias("total_rows"), F.count("*").alias("total_files_validated"))
    return rounded(registry.performance_report(canonical, registry.best_by_level(canonical), batch))


@query("O9.4", REPORT_SQL)
def performance_report(spark, folder):
    return performance_rows(spark, folder)


@query(
    "O9.7",
    f"""WITH {MODEL_METRICS_SQL}, l AS (SELECT p.metric, model_key AS model, p.value FROM model_metrics, LATERAL (VALUES ('mae', mae),
      ('rmse', rmse), ('mape', mape), ('r2', r2)) AS p(metric, value))
    SELECT metric, model, round(value, 4) AS value,
      rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END) = 1 AS is_best FROM l""",
)
def metric_comparison(spark, folder):
    rows = model_metrics(spark, folder).withColumnRenamed("model_key", "model")
    return rounded(compare.metric_comparison(rows))


RUNS_SQL = """runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING'
  ELSE 'FAILED' END AS status, CAST(o_orderdate AS DATE) AS start_time, o_totalprice AS rmse FROM orders)"""


def run_log(spark, folder):
    """Orders as a log of runs."""
    o = star_tables.read_table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED")
    return o.select(
        F.col("o_orderkey").cast("string").alias("run_id"), status.alias("status"), F.to_date("o_orderdate").alias("start_time"), F.col("o_totalprice").alias("rmse")
    )


@query("O7.9", f"WITH {RUNS_SQL} SELECT * FROM runs WHERE status = 'FINISHED' ORDER BY start_time DESC, run_id LIMIT 1")
def latest_run(spark, folder):
    return registry.latest_run(run_log(spark, folder))


@query("O7.9", f"WITH {RUNS_SQL} SELECT * FROM runs ORDER BY rmse, run_id LIMIT 1")
def best_run(spark, folder):
    return registry.best_run(run_log(spark, folder))


@query(
    "O7.9",
    """SELECT name, version, stage FROM (SELECT o_orderpriority AS name, CAST(o_orderkey AS VARCHAR) AS version, o_orderstatus AS stage,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey DESC) AS place FROM orders) WHERE place = 1""",
)
def newest_model_versions(spark, folder):
    versions = star_tables.read_table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("name"), F.col("o_orderkey").cast("string").alias("version"), F.col("o_orderstatus").alias("stage")
    )
    return registry.newest_versions(versions)


WEIGHTS_SQL = f"""{t.STORE_PREDICTIONS_SQL}, s AS (SELECT model, exp({{r2}}) AS r2 FROM (
    SELECT model, {t.metrics_sql('y', 'prediction')} FROM predictions WHERE split = 'validation' AND model <> 'ensemble_store_level' GROUP BY 1)),
  raw AS (SELECT model, CASE WHEN sum(r2) OVER () <= 0 THEN 1.0 / count(*) OVER () ELSE greatest(0.2, r2 / sum(r2) OVER ()) END AS w FROM s),
  weights AS (SELECT model, w / sum(w) OVER () AS weight FROM raw)"""


def member_weights(spark, folder, raw: bool = False):
    rows = t.store_predictions(spark, folder).where((F.col("split") == "validation") & (F.col("model") != "ensemble_store_level"))
    scores = metrics.metric_rows(rows, ["model"], yhat="prediction")
    # The naive members can have a negative R squared; exp keeps the order and makes shares differ.
    return forecast.ensemble_weights(scores if raw else scores.withColumn("r2", F.exp(F.col("r2") * 3)))


@query("O10.9", "WITH " + WEIGHTS_SQL.format(r2="r2 * 3") + " SELECT model, round(weight, 6) AS weight FROM weights")
def ensemble_weights(spark, folder):
    return rounded(member_weights(spark, folder), 6)


@query("O10.9", "WITH " + WEIGHTS_SQL.format(r2="r2").replace("exp(r2)", "r2") + " SELECT model, round(weight, 6) AS weight FROM weights")
def ensemble_weights_of_raw_scores(spark, folder):
    return rounded(member_weights(spark, folder, raw=True), 6)


@query(
    "O10.10 O10.15",
    "WITH " + WEIGHTS_SQL.format(r2="r2 * 3") + """ SELECT p.date, p.store_id, round(sum(w.weight * p.prediction) / sum(w.weight), 3) AS yhat
    FROM predictions p JOIN weights w ON p.model = w.model WHERE p.split = 'test' GROUP BY 1, 2""",
)
def ensemble_predictions(spark, folder):
    rows = t.store_predictions(spark, folder).where((F.col("split") == "test") & (F.col("model") != "ensemble_store_level"))
    long = rows.withColumnRenamed("prediction", "yhat")
    return rounded(forecast.combine_members(long, member_weights(spark, folder), ["date", "store_id"]), 3)
