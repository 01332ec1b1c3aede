"""Model names, run logs, model choice and registration decisions, as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STORE_LEVEL = "store_level"
DAILY_LEVEL = "daily_total"
MEMBERS = "xgboost_store_level,lightgbm_store_level"

# Result key, saved-model name, registered name, level, grain, ensemble members.
MODEL_NAMES = (
    ("xgboost", "xgboost", "xgboost_store_level", STORE_LEVEL, "date+store_id", None),
    ("xgboost_store_level", "xgboost", "xgboost_store_level", STORE_LEVEL, "date+store_id", None),
    ("lightgbm", "lightgbm", "lightgbm_store_level", STORE_LEVEL, "date+store_id", None),
    ("lightgbm_store_level", "lightgbm", "lightgbm_store_level", STORE_LEVEL, "date+store_id", None),
    ("ensemble_store_level", "ensemble", "ensemble_store_level", STORE_LEVEL, "date+store_id", MEMBERS),
    ("prophet_daily_total", "prophet_daily_total", "prophet_daily_total", DAILY_LEVEL, "date", None),
)
# Order in which models of a level are compared; the earlier wins a tie.
SELECTION_ORDER = {
    STORE_LEVEL: ("xgboost_store_level", "lightgbm_store_level", "ensemble_store_level"),
    DAILY_LEVEL: ("prophet_daily_total",),
}


def model_map(spark: SparkSession) -> DataFrame:
    """The name table: six rows, so joins with it are broadcast."""
    fields = ("model_key", "_artifact", "_registered", "_level", "_grain", "_members")
    rows = F.array(
        *[
            F.struct(*[F.lit(v).cast("string").alias(f) for f, v in zip(fields, row)])
            for row in MODEL_NAMES
        ]
    )
    return spark.range(1).select(F.inline(rows))


def canonicalise(results: DataFrame) -> DataFrame:
    """Adds registered name, level, grain, artifact path and members to (model_key, ...) rows.

    Values that a result already carries win over those of the name table; unknown keys keep
    their own name and get ``known`` = false.
    """
    named = results.join(F.broadcast(model_map(results.sparkSession)), "model_key", "left")

    def own_or(name: str, fallback: str) -> Column:
        return F.coalesce(F.col(name), F.col(fallback)) if name in results.columns else F.col(fallback)

    derived = {
        "registered_name": F.coalesce("_registered", "model_key"),
        "forecast_level": own_or("forecast_level", "_level"),
        "target_grain": own_or("target_grain", "_grain"),
        "artifact_path": own_or("artifact_path", "_artifact"),
        "ensemble_members": own_or("ensemble_members", "_members"),
        "known": F.col("_registered").isNotNull(),
    }
    kept = [c for c in results.columns if c not in derived]
    return named.select(*kept, *[c.alias(name) for name, c in derived.items()])


def models_by_level(canonical: DataFrame) -> DataFrame:
    """(forecast_level, registered_name) of every model that belongs to a level."""
    return canonical.where(F.col("forecast_level").isin(STORE_LEVEL, DAILY_LEVEL)).select(
        "forecast_level", "registered_name"
    )


def _list_position(name: Column) -> Column:
    position = F.lit(None).cast("int")
    for names in SELECTION_ORDER.values():
        for i, n in enumerate(names):
            position = F.when(name == n, i).otherwise(position)
    return position


def best_by_level(canonical: DataFrame) -> DataFrame:
    """Lowest RMSE within each level; levels are never compared with each other."""
    candidates = canonical.withColumn("_position", _list_position(F.col("registered_name"))).where(
        F.col("_position").isNotNull() & F.col("rmse").isNotNull() & ~F.isnan("rmse")
    )
    level = F.when(F.col("registered_name").isin(*SELECTION_ORDER[DAILY_LEVEL]), DAILY_LEVEL).otherwise(STORE_LEVEL)
    place = F.row_number().over(W.partitionBy("_level").orderBy("rmse", "_position"))
    return (
        candidates.withColumn("_level", level)
        .withColumn("_place", place)
        .where("_place = 1")
        .select(F.col("_level").alias("forecast_level"), F.col("registered_name").alias("model_name"), "rmse")
    )


def registration_plan(canonical: DataFrame, best: DataFrame, order: str = "model_key") -> DataFrame:
    """Stage for each model to register, or the reason it is skipped.

    The best model of a level goes to Production, other store-level models to Staging. The first
    result (by ``order``) of a registered name wins.
    """
    winners = best.select(F.col("model_name").alias("registered_name"), F.lit(True).alias("_best"))
    place = F.row_number().over(W.partitionBy("registered_name").orderBy(order))
    rows = canonical.withColumn("_place", place).join(F.broadcast(winners), "registered_name", "left")
    is_best = F.coalesce("_best", F.lit(False))
    reason = F.when(~F.col("known"), F.lit("no registry mapping")).when(
        F.col("_place") > 1, F.concat(F.lit("duplicate registration target "), F.col("registered_name"))
    )
    stage = F.when(is_best, "Production").when(F.col("forecast_level") == STORE_LEVEL, "Staging")
    return rows.select(
        "model_key",
        "registered_name",
        "artifact_path",
        "forecast_level",
        "target_grain",
        "ensemble_members",
        F.when(reason.isNull(), is_best).alias("is_best"),
        F.when(reason.isNull(), stage).alias("recommended_stage"),
        reason.alias("skipped_because"),
    )


def performance_report(canonical: DataFrame, best: DataFrame, batch: DataFrame) -> DataFrame:
    """Metric rows by level with the data they rest on (one-row batch summary)."""
    winners = best.select(F.col("model_name").alias("registered_name"), F.lit(True).alias("_best"))
    report = canonical.join(F.broadcast(winners), "registered_name", "left").select(
        F.when(F.col("forecast_level") == DAILY_LEVEL, DAILY_LEVEL).otherwise(STORE_LEVEL).alias("forecast_level"),
        "registered_name",
        "model_key",
        "mae",
        "rmse",
        "mape",
        "r2",
        F.coalesce("_best", F.lit(False)).alias("is_best"),
    )
    facts = [c for c in ("total_rows", "total_files_validated", "issues_found", "validation_mode") if c in batch.columns]
    summary = batch.agg(F.struct(*[F.first(c).alias(c) for c in facts]).alias("s")).scalar()
    return report.select("*", *[summary[c].alias(c) for c in facts])


# --- run log ------------------------------------------------------------------------------


def latest_run(runs: DataFrame) -> DataFrame:
    """Finished run with the latest start."""
    done = runs.where(F.col("status") == "FINISHED")
    return done.orderBy(F.desc("start_time"), "run_id").limit(1)


def best_run(runs: DataFrame, metric: str = "rmse", ascending: bool = True) -> DataFrame:
    order = F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)
    return runs.orderBy(order, "run_id").limit(1)


def newest_versions(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Highest version number of each name (numbers, not text), within a stage if given.

    ``max_by`` combines partially, so a name with very many versions needs no large group.
    """
    rows = versions if stage is None else versions.where(F.col("stage") == stage)
    others = [c for c in versions.columns if c != "name"]
    newest = F.max_by(F.struct(*others), F.col("version").cast("long")).alias("_n")
    return rows.groupBy("name").agg(newest).select("name", *[F.col(f"_n.{c}").alias(c) for c in others])
