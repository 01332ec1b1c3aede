"""Forecasters: boosted trees per store-day, a seasonal regression per day."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.config import TREES_A, TREES_B, TreeConfig
from shelfspark.operators import baselines, boosting, compare, encoding, features, forecast, panel, registry, search, splits
from shelfspark.operators.boosting import BoostedTrees
from shelfspark.operators.clean import categorical_columns
from shelfspark.operators.daily_model import DailyForecaster, fit_daily, fit_variants
from shelfspark.operators.metrics import metric_rows, numeric_columns
from shelfspark.operators.search import Parameter, Trial
from shelfspark.session import small_methods

TARGET = "sales"
NOT_FEATURES = ("date", "split", TARGET)
STORE_MODELS = ("xgboost", "lightgbm")
DAILY_MODEL = "prophet_daily_total"


# --- store level --------------------------------------------------------------------------


@dataclass(frozen=True)
class StoreData:
    """Encoded feature rows with their split, the dictionary, and the feature order."""

    rows: DataFrame
    codes: DataFrame
    features: tuple[str, ...]


def prepare_store_data(store_days: DataFrame, split_cfg: config.SplitConfig = config.SplitConfig()) -> StoreData:
    """Features, chronological split, and categories encoded from the train rows."""
    small_methods(store_days.sparkSession)
    categories = categorical_columns(store_days)
    built = features.all_features(store_days, TARGET, "date", ("store_id",), categories)
    labelled = splits.split_by_rows(built, TARGET, cfg=split_cfg, count_on=store_days)
    texts = [name for name, kind in built.dtypes if kind == "string"]
    # The keys stay next to their codes, so that predictions can be joined back.
    labelled = labelled.withColumn("store_key", F.col("store_id")).persist()
    codes = encoding.fit_codes(labelled.where(F.col("split") == "train"), texts)
    rows = encoding.encode(labelled, codes, texts)
    names = tuple(c for c in numeric_columns(rows, NOT_FEATURES) if c != "store_key")
    return StoreData(rows, codes, names)


def training_blocks(data: StoreData) -> boosting.Blocks:
    """Binned train and validation rows."""
    rows = data.rows.where(F.col("split").isin("train", "validation")).withColumn("is_validation", F.col("split") == "validation")
    return boosting.binned(rows, data.features, TARGET, "is_validation")


def fit_trees(data: StoreData, cfg: TreeConfig) -> BoostedTrees:
    """Boosted trees on the train rows, cut at the prefix that the validation rows like best."""
    blocks = training_blocks(data)
    try:
        return boosting.fitted(blocks, cfg)
    finally:
        blocks.release()


def predict_trees(model: BoostedTrees, rows: DataFrame, name: str) -> DataFrame:
    """Adds the prediction as a column of the given name."""
    return model.transform(rows).withColumnRenamed("prediction", name)


# The range of each setting that is searched, for depth-bounded and for leaf-bounded trees.
_SHARED_SPACE = (
    Parameter("trees", 50, 300, whole=True),
    Parameter("rate", 0.01, 0.3, log=True),
    Parameter("row_share", 0.6, 1.0),
    Parameter("column_share", 0.6, 1.0),
    Parameter("l1", 0.0, 1.0),
    Parameter("l2", 0.0, 1.0),
)
SPACES = {
    "xgboost": (Parameter("depth", 3, 10, whole=True), Parameter("gamma", 0.0, 0.5), *_SHARED_SPACE),
    "lightgbm": (Parameter("leaves", 20, 100, whole=True), Parameter("min_rows", 10, 50, whole=True), *_SHARED_SPACE),
}


def search_trees(data: StoreData, base: TreeConfig, trials: int = 50, seed: int = 42, at_once: int = 8) -> tuple[TreeConfig, list[tuple[Trial, int]]]:
    """The setting with the lowest validation RMSE, and every trial with the trees it kept.

    Rows are binned once. A trial is a fit whose prefix errors can end it early; ``at_once`` fits share the cluster.
    """
    blocks = training_blocks(data)
    kept: dict[str, int] = {}

    def tried(setting: dict[str, float], give_up: Callable[[int, float], bool]) -> tuple[list[tuple[int, float]], bool]:
        cfg = replace(base, **setting)
        model = boosting.fitted(blocks, cfg, give_up)
        last, kept[repr(setting)] = model.curve[-1][0], len(model.trees)
        return [(n, e) for n, _, e in model.curve if e is not None], last < min(cfg.trees, kept[repr(setting)] + cfg.patience)

    try:
        done = search.tree_parzen(SPACES[base.name], tried, trials, at_once=at_once, seed=seed)
    finally:
        blocks.release()
    best = min(done, key=lambda t: (t.error, t.number))
    return replace(base, **best.setting), [(t, kept[repr(t.setting)]) for t in done]


def importances(model: BoostedTrees, names: Sequence[str], label: str, spark: SparkSession) -> DataFrame:
    """(model, feature, importance): one row per feature column."""
    return spark.createDataFrame([(label, n, v) for n, v in zip(names, model.importances())], "model string, feature string, importance double")


# --- daily level --------------------------------------------------------------------------


class DailyTransformer(Protocol):
    """Whatever a daily fit returns: it adds ``yhat`` to rows with ``ds`` and the regressors."""

    def transform(self, df: DataFrame) -> DataFrame: ...


DailyFit = Callable[[DataFrame, Sequence[str]], DailyTransformer]


def train_daily_total(daily: DataFrame, variant: str = config.DEFAULT_DAILY_VARIANT, fit: DailyFit = fit_daily) -> tuple[DailyTransformer, DataFrame]:
    """Fits one variant on the train days and adds ``yhat`` to the validation and test days."""
    regressors = list(config.DAILY_VARIANTS[variant])
    held_out = daily.where(F.col("split") != "train")
    if held_out.where(F.col("split") == "test").isEmpty():
        raise ValueError("The daily-total model requires test dates for evaluation")
    model = fit(daily.where(F.col("split") == "train").select("ds", "y", *regressors), regressors)
    scored = model.transform(held_out.select("ds", "split", "y", *regressors))
    if "yhat" not in scored.columns:
        raise ValueError("Daily forecast output must contain a yhat column")
    return model, scored.select("ds", "split", "y", F.lit(variant).alias("variant"), "yhat")


def labelled_daily_totals(full_rows: DataFrame, split_cfg: config.SplitConfig = config.SplitConfig()) -> DataFrame:
    """Daily totals of full rows, with the split of each day."""
    return splits.label_days(panel.build_daily_totals(full_rows).where(F.col("ds").isNotNull()), "ds", split_cfg)


def run_experiments(daily: DataFrame, fit: DailyFit = fit_daily) -> DataFrame:
    """Metric rows of the naive baselines and every variant, on validation and test.

    The variants share one pass over the training days. The baselines run over the joined timeline, so the held-out days
    see earlier actuals. The daily frame has one row per day and is used by every variant, hence persisted.
    """
    daily = daily.persist()
    rows = baselines.baseline_metrics(baselines.add_baselines(daily))
    predictions = None
    fitted = fit_variants(daily.where(F.col("split") == "train"), dict(config.DAILY_VARIANTS)) if fit is fit_daily else {}
    for variant in config.DAILY_VARIANTS:
        known = fitted.get(variant)
        _, scored = train_daily_total(daily, variant, fit if known is None else lambda *_, known=known: known)
        predictions = scored if predictions is None else predictions.unionByName(scored)
    rows = rows.unionByName(metric_rows(predictions, ["variant", "split"]))
    return compare.add_seasonal_comparison(rows)


# --- everything ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TrainedStoreModels:
    models: Mapping[str, BoostedTrees]
    weights: Mapping[str, float]
    codes: DataFrame
    features: tuple[str, ...]

    def predict(self, rows: DataFrame) -> DataFrame:
        """Member predictions and the weighted ensemble next to each other, on encoded rows."""
        forecast.require_features(rows, list(self.features))
        out = rows
        for name, model in self.models.items():
            out = predict_trees(model, out, f"yhat_{name}")
        members = {name: f"yhat_{name}" for name in self.models}
        return out.withColumn("yhat_ensemble", forecast.weighted_prediction(members, self.weights))

    def save(self, spark: SparkSession, folder: str) -> None:
        for name, model in self.models.items():
            model.save(spark, f"{folder}/{name}")
        self.codes.write.mode("overwrite").parquet(f"{folder}/encoders")
        about = json.dumps({"weights": dict(self.weights), "features": list(self.features)})
        spark.range(1).select(F.lit(about).alias("value")).write.mode("overwrite").text(f"{folder}/ensemble")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> TrainedStoreModels:
        """Loads what was saved. Without the saved ensemble this fails: weights are never made up.

        A member that is missing is skipped only if it has no weight.
        """
        try:
            about = json.loads(spark.read.text(f"{folder}/ensemble").first()["value"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise ValueError(f"No saved ensemble below {folder}") from error
        members = [m for m, w in about["weights"].items() if w > 0]
        return TrainedStoreModels(
            {m: BoostedTrees.load(spark, f"{folder}/{m}") for m in members},
            about["weights"],
            spark.read.parquet(f"{folder}/encoders"),
            tuple(about["features"]),
        )


def load_available(spark: SparkSession, folder: str, names: Sequence[str] = STORE_MODELS) -> dict[str, BoostedTrees]:
    """Saved tree models by registered name; what is not there is skipped."""
    registered = {row[0]: row[2] for row in registry.MODEL_NAMES}
    found: dict[str, BoostedTrees] = {}
    for name in names:
        try:
            found[registered.get(name, name)] = BoostedTrees.load(spark, f"{folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def train_store_models(data: StoreData, configs: Sequence[TreeConfig] = (TREES_A, TREES_B), floor: float = 0.2) -> TrainedStoreModels:
    """Both tree models on rows that are binned once, and ensemble weights from their validation R squared.

    The models are fitted in step, so that a job sums for both.
    """
    blocks = training_blocks(data)
    try:
        models = dict(zip([cfg.name for cfg in configs], boosting.fitted_together(blocks, configs)))
    finally:
        blocks.release()
    validation = data.rows.where(F.col("split") == "validation")
    for name, model in models.items():
        validation = predict_trees(model, validation, f"yhat_{name}")
    long = baselines.long_predictions(validation, [], TARGET, {m: f"yhat_{m}" for m in models}, "model")
    weights = forecast.ensemble_weights(metric_rows(long, ["model"]), floor)
    # One row per member.
    return TrainedStoreModels(
        models, {r["model"]: r["weight"] for r in weights.collect()}, data.codes, data.features
    )


def test_predictions(trained: TrainedStoreModels, data: StoreData) -> DataFrame:
    """(date, store_id, model, y, yhat) on the test rows, for the members and the ensemble."""
    scored = trained.predict(data.rows.where(F.col("split") == "test"))
    columns = {name: f"yhat_{name}" for name in trained.models}
    columns["ensemble_store_level"] = "yhat_ensemble"
    keyed = scored.withColumn("store_id", F.col("store_key"))
    return baselines.long_predictions(keyed, ["date", "store_id"], TARGET, columns, "model")


def forecast_stores(trained: TrainedStoreModels, history: DataFrame, future: DataFrame, days: int) -> DataFrame:
    """Forecast of every store with bounds, and the members' predictions beside it."""
    rows = forecast.forecast_inputs(history, future, days).withColumn("store_key", F.col("store_id"))
    scored = trained.predict(encoding.encode(rows, trained.codes))
    result = scored.select(
        "date",
        F.col("store_key").alias("store_id"),
        F.col("yhat_ensemble").alias("predicted_sales"),
        *[F.col(f"yhat_{m}") for m in trained.models],
    )
    return forecast.with_bounds(result)


def registered_name(name: str) -> str:
    """The registered name of a model that is given by its key or its registered name."""
    known = {key: row[2] for row in registry.MODEL_NAMES for key in (row[0], row[2])}
    if name not in known:
        raise ValueError(f"Unknown model {name!r}. Known models: {', '.join(sorted(set(known.values())))}")
    return known[name]


def load_named(spark: SparkSession, folder: str, name: str) -> TrainedStoreModels | DailyForecaster:
    """What a saved training run holds under a name: the store-level models, or the daily-total forecaster."""
    registered = registered_name(name)
    return DailyForecaster.load(spark, f"{folder}/{registered}") if registered == DAILY_MODEL else TrainedStoreModels.load(spark, folder)


def forecast_named(spark: SparkSession, folder: str, name: str, history: DataFrame, future: DataFrame, days: int) -> DataFrame:
    """(model, date, store_id, predicted_sales, lower_bound, upper_bound) by one saved model, at its own level.

    A daily total has no store_id. A member without weight is not saved with the ensemble and gives an error.
    """
    registered = registered_name(name)
    model = load_named(spark, folder, registered)
    if isinstance(model, DailyForecaster):
        totals = panel.build_daily_totals(forecast.require_future_rows(future, days).withColumn(TARGET, F.lit(0.0)))
        found = model.transform(totals).select(F.col("ds").alias("date"), F.lit(None).cast("string").alias("store_id"), F.col("yhat").alias("predicted_sales"))
        found = forecast.with_bounds(found)
    else:
        member = next(row[0] for row in registry.MODEL_NAMES if row[2] == registered)
        found = forecast_stores(model, history, future, days)
        if registered != "ensemble_store_level":
            if member not in model.models:
                raise ValueError(f"Model {registered} is not part of the saved ensemble")
            found = forecast.with_bounds(found.withColumn("predicted_sales", F.col(f"yhat_{member}")))
    return found.select(F.lit(registered).alias("model"), "date", "store_id", "predicted_sales", "lower_bound", "upper_bound")
