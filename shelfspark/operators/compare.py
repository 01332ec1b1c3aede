"""Comparing variants and models, and the verdicts drawn from it.

Metric tables hold one row per (variant, split) or model: a few dozen rows whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark import config

METRICS = ("mae", "rmse", "mape", "r2")
KEEP = "keep Prophet as a useful daily-total model"
WEAK = "treat Prophet only as a weak daily-total baseline"
# Relative difference up to which two metrics are the same.
SAME = 1e-9


def add_seasonal_comparison(metrics: DataFrame, baseline: str = config.SEASONAL_BASELINE) -> DataFrame:
    """Whether a row's RMSE is below that of the seasonal baseline on the same split."""
    reference = metrics.where(F.col("variant") == baseline).select("split", F.col("rmse").alias("_base"))
    better = (F.col("variant") != baseline) & (F.col("rmse") < F.col("_base"))
    return metrics.join(F.broadcast(reference), "split", "left").select(
        "variant",
        "split",
        *METRICS,
        F.coalesce(better, F.lit(False)).alias("beats_seasonal_naive_7"),
    )


def best_variant(metrics: DataFrame, split: str = "test", metric: str = "rmse") -> DataFrame:
    """The best row of a split: highest R squared, lowest otherwise; ties go by name."""
    order = F.desc(metric) if metric == "r2" else F.asc(metric)
    rows = metrics.where((F.col("split") == split) & F.col(metric).isNotNull())
    return rows.orderBy(order, "variant").limit(1)


def summary_table(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("split").isin("validation", "test")).orderBy("split", "rmse", "variant")


def _best(name: str, condition: Column, value: str) -> list[Column]:
    """Name and value of the row with the smallest value; ties go by name."""
    eligible = F.when(condition & F.col(value).isNotNull(), F.struct(value, "variant"))
    return [F.min(eligible)["variant"].alias(f"best_{name}_variant"), F.min(eligible)[value].alias(f"best_{name}_rmse")]


def experiment_verdict(metrics: DataFrame) -> DataFrame:
    """One row: best variants, whether they beat the seasonal baseline, and the advice."""
    test, validation = F.col("split") == "test", F.col("split") == "validation"
    variant = F.col("variant")
    models = list(config.DAILY_VARIANTS)
    regressor_models = [v for v in models if v != "prophet_univariate"]

    def rmse_of(name: str) -> Column:
        return F.max(F.when(test & (variant == name), F.col("rmse")))

    gain = F.struct(
        *[rmse_of(v).alias(v) for v in [*config.REGRESSOR_GROUPS.values(), "prophet_univariate", "prophet_all_regressors"]]
    )
    row = metrics.agg(
        *_best("validation", validation, "rmse"),
        *_best("test", test, "rmse"),
        *_best("prophet", test & variant.isin(models), "rmse"),
        *_best("regressor", test & variant.isin(regressor_models), "rmse"),
        rmse_of(config.SEASONAL_BASELINE).alias("seasonal_naive_7_test_rmse"),
        gain.alias("_rmse"),
        F.max(F.coalesce(test & variant.startswith("prophet_") & F.col("beats_seasonal_naive_7"), F.lit(False))).alias("_any_beats"),
    )
    univariate = F.col("_rmse.prophet_univariate")
    everything = F.col("_rmse.prophet_all_regressors")
    groups = F.array(
        *[
            F.struct(
                (univariate - F.col(f"_rmse.{v}")).alias("gain"),
                F.lit(-i).alias("position"),
                F.lit(group).alias("group"),
                F.lit(v).alias("variant"),
            )
            for i, (group, v) in enumerate(config.REGRESSOR_GROUPS.items())
        ]
    )
    best_group = F.array_max(F.filter(groups, lambda g: g["gain"].isNotNull()))

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    beats = yes(F.col("best_prophet_rmse") < F.col("seasonal_naive_7_test_rmse"))
    useful = (beats & yes(F.col("best_prophet_variant") == F.col("best_test_variant"))) | F.col("_any_beats")
    return row.select(
        "best_validation_variant",
        "best_validation_rmse",
        "best_test_variant",
        "best_test_rmse",
        "best_prophet_variant",
        F.col("best_prophet_rmse").alias("best_prophet_test_rmse"),
        "best_regressor_variant",
        F.col("best_regressor_rmse").alias("best_regressor_test_rmse"),
        "seasonal_naive_7_test_rmse",
        beats.alias("prophet_beats_seasonal_naive_7"),
        yes(F.col("best_regressor_rmse") < univariate).alias("regressors_improve_over_univariate"),
        yes(everything < univariate).alias("all_regressors_improve_over_univariate"),
        everything.alias("all_regressors_test_rmse"),
        univariate.alias("univariate_test_rmse"),
        best_group["group"].alias("best_regressor_group"),
        best_group["variant"].alias("best_group_variant"),
        best_group["gain"].alias("best_group_rmse_gain"),
        F.when(useful, KEEP).otherwise(WEAK).alias("recommendation"),
    )


def verdict_lines(verdict: DataFrame) -> DataFrame:
    """(position, line): the verdict as text."""
    def num(c: str) -> Column:
        return F.coalesce(F.format_number(F.col(c), 4), F.lit("n/a"))

    def yes_no(c: str) -> Column:
        return F.when(F.col(c), "yes").otherwise("no")

    none = F.lit("none")
    lines = [
        F.concat(F.lit("Best validation RMSE variant: "), F.coalesce("best_validation_variant", none), F.lit(" ("), num("best_validation_rmse"), F.lit(")")),
        F.concat(F.lit("Best test RMSE variant: "), F.coalesce("best_test_variant", none), F.lit(" ("), num("best_test_rmse"), F.lit(")")),
        F.concat(F.lit("Prophet beats seasonal_naive_7 on test RMSE: "), yes_no("prophet_beats_seasonal_naive_7")),
        F.concat(F.lit("All regressors improve over univariate Prophet on test RMSE: "), yes_no("all_regressors_improve_over_univariate")),
        F.concat(F.lit("Best individual regressor group: "), F.coalesce("best_regressor_group", none), F.lit(" (RMSE improvement vs univariate: "), num("best_group_rmse_gain"), F.lit(")")),
        F.concat(F.lit("Recommendation: "), F.col("recommendation")),
    ]
    return verdict.select(F.posexplode(F.array(*lines)).alias("position", "line"))


def metric_comparison(metrics: DataFrame, key: str = "model") -> DataFrame:
    """(metric, model, value, is_best): lower is better but for R squared.

    All models that are as good as the best are best: equal predictions give metrics that differ in their last bits, as
    sums run in any order.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])
    long = metrics.select(key, F.inline(pairs))
    score = F.when(F.col("metric") == "r2", -F.col("value")).otherwise(F.col("value"))
    best = F.min(score).over(W.partitionBy("metric"))
    near = F.when(F.abs(best) < float("inf"), score - best <= F.abs(best) * SAME).otherwise(score == best)
    return long.select("metric", key, "value", F.coalesce(near, F.lit(False)).alias("is_best"))
