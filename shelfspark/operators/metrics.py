"""Forecast metrics and diagnosis aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.stats import correlation, error_metrics
from shelfspark.operators.joins import sized
from shelfspark.operators.quantiles import exact_quantiles

SHIFT_LIMIT = 0.2
LEAK_LIMIT = 0.95
MANY_FEATURES = 50
FEW_ROWS = 1000
ZERO_SHARE = 0.1
QUARTILES = {"q1": 0.25, "q3": 0.75}


def metric_rows(predictions: DataFrame, keys: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """MAE, RMSE, MAPE and R squared per key, in one aggregation."""
    metrics = error_metrics(F.col(y), F.col(yhat))
    return predictions.groupBy(*keys).agg(*[c.alias(name) for name, c in metrics.items()])


def row_set_summary(full: DataFrame, trading: Column) -> DataFrame:
    """How many rows are closed or without sales, and the date range."""
    return full.agg(
        F.count("*").alias("full_rows"),
        F.count_if(~F.coalesce(trading, F.lit(False))).alias("closed_or_zero_rows"),
        F.count_if(F.col("is_open") == 0).alias("closed_rows"),
        F.count_if(F.col("sales") == 0).alias("zero_sales_rows"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
    )


def split_stats(df: DataFrame, target: str = "sales") -> DataFrame:
    """Mean and sample deviation per split, with the mean's relative shift from train."""
    stats = df.groupBy("split").agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std")
    )
    train = stats.where(F.col("split") == "train").select("mean").scalar()
    shift = F.try_divide(F.abs(F.col("mean") - train), train)
    return stats.select(
        "split", "n", "mean", "std", shift.alias("mean_shift"), F.coalesce(shift > SHIFT_LIMIT, F.lit(False)).alias("shifted")
    )


def iqr_bounds(quartiles: DataFrame) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    return quartiles.withColumns(
        {"lower_bound": F.col("q1") - 1.5 * spread, "upper_bound": F.col("q3") + 1.5 * spread}
    )


def outlier_report(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """IQR outliers per group: count, share, bounds and extremes."""
    bounds = sized(iqr_bounds(exact_quantiles(df, groups, [value], QUARTILES).drop("column")))
    v = F.col(value)
    outside = (v < F.col("lower_bound")) | (v > F.col("upper_bound"))
    return df.join(bounds, [*groups]).groupBy(*groups, "lower_bound", "upper_bound").agg(
        F.count_if(outside).alias("outliers"),
        (F.count_if(outside) / F.count("*") * 100).alias("percentage"),
        F.min(F.when(outside, v)).alias("min_outlier"),
        F.max(F.when(outside, v)).alias("max_outlier"),
    )


def prediction_analysis(predictions: DataFrame, model: str = "model") -> DataFrame:
    """Spread, extremes and residuals of each model's predictions (model, y, yhat).

    The limits for extremes come from all actuals of a model's rows. A zero actual makes MAPE
    null.
    """
    limits = sized(predictions.groupBy(model).agg(F.min("y").alias("low"), F.max("y").alias("high")))
    residual = F.col("y") - F.col("yhat")
    zero = F.count_if((F.col("y") == 0) & F.col("yhat").isNotNull())
    return (
        predictions.join(limits, model)
        .groupBy(model)
        .agg(
            F.avg("yhat").alias("pred_mean"),
            F.stddev_pop("yhat").alias("pred_std"),
            F.count_if(F.col("yhat") < F.col("low") * 0.5).alias("extreme_low_count"),
            F.count_if(F.col("yhat") > F.col("high") * 1.5).alias("extreme_high_count"),
            F.avg(residual).alias("residual_mean"),
            F.stddev_samp(residual).alias("residual_std"),
            F.when(zero == 0, F.avg(F.abs(F.try_divide(residual, F.col("y")))) * 100).alias("mape"),
        )
    )


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without
    ]


def target_correlations(train: DataFrame, target: str = "sales") -> DataFrame:
    """(column, correlation, leak) for every numeric column, from one aggregation."""
    columns = numeric_columns(train, [target])
    wide = train.agg(*[correlation(F.col(c), F.col(target)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("correlation")) for c in columns])
    value = F.col("correlation")
    return wide.select(F.inline(pairs)).select(
        "column",
        value.alias("correlation"),
        F.coalesce(F.abs(value) > LEAK_LIMIT, F.lit(False)).alias("leak"),
    )


def rule_flags(train: DataFrame, target: str = "sales", date_col: str = "date") -> DataFrame:
    """(rule, value, limit, flagged): too many features, too few rows, many zero sales."""
    features = len([c for c in train.columns if c not in (target, date_col, "split")])
    counts = train.agg(F.count("*").alias("rows"), F.count_if(F.col(target) == 0).alias("zeros"))
    rules = F.array(
        F.struct(
            F.lit("feature_count").alias("rule"),
            F.lit(float(features)).alias("value"),
            F.lit(float(MANY_FEATURES)).alias("limit"),
            F.lit(features > MANY_FEATURES).alias("flagged"),
        ),
        F.struct(
            F.lit("train_rows").alias("rule"),
            F.col("rows").cast("double").alias("value"),
            F.lit(float(FEW_ROWS)).alias("limit"),
            (F.col("rows") < FEW_ROWS).alias("flagged"),
        ),
        F.struct(
            F.lit("zero_sales").alias("rule"),
            F.col("zeros").cast("double").alias("value"),
            (F.col("rows") * F.lit(ZERO_SHARE)).alias("limit"),
            (F.col("zeros") > F.col("rows") * F.lit(ZERO_SHARE)).alias("flagged"),
        ),
    )
    return counts.select(F.inline(rules))


def unknown_categories(train: DataFrame, other: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """(column, split, unknown_rows): rows whose category never occurs in train.

    Categories are counted before they are joined, so a frequent one is a single row.
    """
    def long(df: DataFrame, *keep: str) -> DataFrame:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]
        )
        return df.select(*keep, F.inline(pairs))

    known = long(train).distinct()
    seen = long(other, split).groupBy(split, "column", "category").count()
    marked = seen.join(known.withColumn("known", F.lit(True)), ["column", "category"], "left")
    return marked.groupBy("column", split).agg(
        F.sum(F.when(F.col("known").isNull(), F.col("count")).otherwise(0)).alias("unknown_rows")
    )


def forecast_summary(forecast: DataFrame, value: str = "predicted_sales") -> DataFrame:
    return forecast.groupBy("store_id").agg(
        F.sum(value).alias("total_predicted_sales"),
        F.avg(value).alias("average_daily_sales"),
        F.max(value).alias("max_daily_sales"),
        F.min(value).alias("min_daily_sales"),
        F.count("*").alias("forecast_days"),
    )


def recommendations(split_table: DataFrame, correlations: DataFrame, flags: DataFrame) -> DataFrame:
    """(topic, detail): the advice that follows from the diagnosis tables."""
    names = F.create_map(F.lit("validation"), F.lit("validation set"), F.lit("test"), F.lit("test set"))
    shifts = split_table.where("shifted").where(F.col("split") != "train").select(
        F.lit("distribution_shift").alias("topic"),
        F.format_string("Mean of the %s moved by %.1f%% against train", names[F.col("split")], F.col("mean_shift") * 100).alias("detail"),
    )
    leaks = correlations.agg(F.count_if(F.col("leak")).alias("n")).where("n > 0").select(
        F.lit("data_leakage").alias("topic"),
        F.format_string("%d features correlate with the target above 95%%", F.col("n")).alias("detail"),
    )
    rules = flags.where("flagged").select(
        F.col("rule").alias("topic"),
        F.format_string("%s is %.0f (limit %.0f)", "rule", "value", "limit").alias("detail"),
    )
    return shifts.unionByName(leaks).unionByName(rules)
