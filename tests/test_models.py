import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.operators import compare, encoding, forecast, metrics, models, registry, reports

DAY = dt.date(2024, 1, 1)


def daily_series(spark):
    rows = []
    for i in range(70):
        promo, opened, school, state = float(i % 5 == 0) * 3, 10 + i % 3, float(i % 9 == 0), float(i % 20 == 0)
        y = 500 + 4 * (i % 7) + 20 * promo + 3 * opened - 15 * school - 25 * state
        split = "train" if i < 45 else "validation" if i < 55 else "test"
        rows.append((DAY + dt.timedelta(days=i), y, promo, promo / 10, opened, school, state, split))
    return spark.createDataFrame(
        rows,
        "ds date, y double, promo_store_count double, promo_rate double, open_store_count int, school_holiday_rate double, "
        "state_holiday_flag double, split string",
    )


def test_experiments(spark):
    table = models.run_experiments(daily_series(spark)).collect()
    assert len(table) == 18
    assert {r["variant"] for r in table} == {*config.BASELINES, *config.DAILY_VARIANTS}
    assert all(math.isfinite(r[m]) for r in table for m in ("mae", "rmse", "mape", "r2"))
    assert not any(r["beats_seasonal_naive_7"] for r in table if r["variant"] == "seasonal_naive_7")
    rmse = {(r["variant"], r["split"]): r["rmse"] for r in table}
    assert rmse[("prophet_all_regressors", "test")] < rmse[("prophet_univariate", "test")]


def test_verdict(spark):
    verdict = compare.experiment_verdict(models.run_experiments(daily_series(spark)).persist())
    row = verdict.first()
    assert row["best_test_variant"] == "prophet_all_regressors"
    assert row["prophet_beats_seasonal_naive_7"] and row["all_regressors_improve_over_univariate"]
    assert row["best_regressor_group"] in config.REGRESSOR_GROUPS and row["recommendation"] == compare.KEEP
    lines = [r["line"] for r in compare.verdict_lines(verdict).orderBy("position").collect()]
    assert len(lines) == 6 and lines[2].endswith("yes") and lines[5] == f"Recommendation: {compare.KEEP}"


def test_verdict_without_models(spark):
    rows = [("naive_yesterday", "test", 5.0), ("seasonal_naive_7", "test", 6.0), ("rolling_7", "test", None)]
    df = spark.createDataFrame(rows, "variant string, split string, rmse double").select(
        "*", *[F.lit(1.0).alias(c) for c in ("mae", "mape", "r2")]
    )
    row = compare.experiment_verdict(compare.add_seasonal_comparison(df)).first()
    assert row["best_test_variant"] == "naive_yesterday" and row["best_prophet_variant"] is None
    assert row["recommendation"] == compare.WEAK and row["best_regressor_group"] is None
    assert not row["prophet_beats_seasonal_naive_7"]


def test_daily_contract(spark):
    seen = {}

    class Constant:
        def transform(self, df):
            return df.withColumn("yhat", F.lit(100.0))

    def fit(df, regressors):
        seen["columns"], seen["regressors"] = df.columns, list(regressors)
        return Constant()

    _, scored = models.train_daily_total(daily_series(spark), "prophet_promo_only", fit)
    assert seen["columns"] == ["ds", "y", "promo_store_count", "promo_rate"]
    assert {r["split"] for r in scored.collect()} == {"validation", "test"}
    with pytest.raises(ValueError, match="Unknown daily-total variant 'x'. Valid variants: prophet_all_regressors"):
        models.train_daily_total(daily_series(spark), "x")
    with pytest.raises(ValueError, match="yhat"):
        models.train_daily_total(daily_series(spark), fit=lambda df, r: type("T", (), {"transform": lambda self, d: d})())
    with pytest.raises(ValueError, match="two training dates"):
        models.fit_daily(daily_series(spark).limit(1), [])


def store_panel(spark, stores=4, days=90):
    rows = [
        (DAY + dt.timedelta(days=d), f"store_{s:04d}", 100.0 * s + 10 * (d % 7), 5.0, d % 2, 1, 0, 0, 50.0 * s, s % 2, "ab"[s % 2], "a", "none", "none")
        for s in range(1, stores + 1)
        for d in range(days)
    ]
    return spark.createDataFrame(
        rows,
        "date date, store_id string, sales double, customer_traffic double, has_promotion int, is_open int, is_holiday int, school_holiday int, "
        "competition_distance double, promo2 int, store_type string, assortment string, state_holiday string, promo_interval string",
    )


def test_store_models_end_to_end(spark, tmp_path):
    history = store_panel(spark)
    data = models.prepare_store_data(history)
    assert "store_id_store_type_interaction" in data.features and "sales" not in data.features and "date" not in data.features
    # Every tree counts by its rate, the first one too.
    configs = [replace(config.TREES_A, trees=25, depth=4), replace(config.TREES_B, trees=40, leaves=8)]
    trained = models.train_store_models(data, configs)
    assert math.isclose(sum(trained.weights.values()), 1.0) and min(trained.weights.values()) >= 0.16
    predictions = models.test_predictions(trained, data)
    scores = {r["model"]: r["r2"] for r in metrics.metric_rows(predictions, ["model"]).collect()}
    assert set(scores) == {"xgboost", "lightgbm", "ensemble_store_level"} and scores["ensemble_store_level"] > 0.8
    trained.save(spark, str(tmp_path / "m"))
    loaded = models.TrainedStoreModels.load(spark, str(tmp_path / "m"))
    assert dict(loaded.weights) == dict(trained.weights)
    available = models.load_available(spark, str(tmp_path / "m"), ["lightgbm", "never_saved"])
    assert list(available) == ["lightgbm_store_level"]
    out = models.forecast_stores(loaded, history, forecast.future_rows(history, 5), 5)
    rows = out.orderBy("store_id", "date").collect()
    assert len(rows) == 20 and rows[0]["date"] == DAY + dt.timedelta(days=90)
    assert all(math.isclose(r["lower_bound"], r["predicted_sales"] * 0.9) for r in rows)
    w = trained.weights
    assert all(math.isclose(r["predicted_sales"], w["xgboost"] * r["yhat_xgboost"] + w["lightgbm"] * r["yhat_lightgbm"]) for r in rows)
    daily, _ = models.train_daily_total(models.labelled_daily_totals(history))
    daily.save(spark, str(tmp_path / "m" / models.DAILY_MODEL))
    future = forecast.future_rows(history, 5)
    by_name = {n: models.forecast_named(spark, str(tmp_path / "m"), n, history, future, 5).orderBy("store_id", "date").collect() for n in ("xgboost", "lightgbm_store_level", "ensemble_store_level", "prophet_daily_total")}
    for name, column in (("xgboost", "yhat_xgboost"), ("lightgbm_store_level", "yhat_lightgbm"), ("ensemble_store_level", "predicted_sales")):
        assert [r["predicted_sales"] for r in by_name[name]] == [r[column] for r in rows]
    totals = by_name["prophet_daily_total"]
    assert len(totals) == 5 and all(r["store_id"] is None and math.isclose(r["lower_bound"], r["predicted_sales"] * 0.9) for r in totals)
    with pytest.raises(ValueError, match="Unknown model 'x'. Known models: ensemble_store_level, lightgbm_store_level, prophet_daily_total, xgboost_store_level"):
        models.forecast_named(spark, str(tmp_path / "m"), "x", history, future, 5)
    top = reports.top_importances(models.importances(loaded.models["xgboost"], loaded.features, "a", spark), 3)
    assert top.count() == 3


def test_missing_ensemble_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="No saved ensemble"):
        models.TrainedStoreModels.load(spark, str(tmp_path / "nothing"))


def test_missing_features_are_named(spark):
    with pytest.raises(ValueError, match="Missing engineered features: sales_lag_9"):
        forecast.require_features(spark.range(1), ["id", "sales_lag_9"])


def test_ensemble_arithmetic(spark):
    df = spark.createDataFrame([(10.0, 30.0)], "a double, b double")
    pair = {"a": "a", "b": "b"}
    row = df.select(
        forecast.weighted_prediction(pair, {"a": 0.8, "b": 0.2}).alias("w"),
        forecast.weighted_prediction(pair, {"a": 4.0}).alias("only"),
        forecast.weighted_prediction(pair).alias("equal"),
    ).first()
    assert (row["w"], row["only"], row["equal"]) == (14.0, 10.0, 20.0)
    with pytest.raises(ValueError, match="No models available"):
        forecast.normalised_weights(["a"], {"b": 1.0})


@pytest.mark.parametrize(
    "scores, expected",
    [((0.6, 0.4), (0.6, 0.4)), ((0.9, 0.1), (0.9 / 1.1, 0.2 / 1.1)), ((-0.5, 0.2), (0.5, 0.5))],
)
def test_ensemble_weights(spark, scores, expected):
    df = spark.createDataFrame(list(zip(("a", "b"), scores)), "model string, r2 double")
    got = [r["weight"] for r in forecast.ensemble_weights(df).orderBy("model").collect()]
    assert got == pytest.approx(expected)


def history_rows(spark, days=10):
    rows = [(DAY + dt.timedelta(days=i), "store_0001", 100.0 + 10 * i, 50.0, 0, 1, int(i == 9), "a" if i == 8 else "none", "a", "a", 500.0, 0, None) for i in range(days)]
    return spark.createDataFrame(
        rows,
        "date date, store_id string, sales double, customer_traffic double, has_promotion int, is_open int, school_holiday int, "
        "state_holiday string, store_type string, assortment string, competition_distance double, promo2 int, promo_interval string",
    )


def test_future_rows_and_frozen_lags(spark):
    history = history_rows(spark)
    future = forecast.future_rows(history, 3).orderBy("date").collect()
    assert [r["date"].day for r in future] == [11, 12, 13]
    assert future[0]["promo_interval"] == "none" and future[0]["school_holiday"] == 1
    row = forecast.frozen_history(history).first()
    assert (row["sales_lag_1"], row["sales_lag_7"], row["sales_lag_14"]) == (190.0, 130.0, 145.0)
    assert (row["sales_rolling_3_mean"], row["sales_rolling_3_median"]) == (180.0, 180.0)
    assert math.isclose(row["sales_rolling_3_std"], math.sqrt(200 / 3))
    assert (row["sales_rolling_14_mean"], row["sales_rolling_14_std"]) == (145.0, 0.0)
    inputs = forecast.forecast_inputs(history, forecast.future_rows(history, 3), 3).collect()
    assert len(inputs) == 3 and {r["sales_lag_1"] for r in inputs} == {190.0}


def test_future_rows_must_suffice(spark):
    future = forecast.future_rows(history_rows(spark), 3)
    assert forecast.require_future_rows(future, 2).count() == 2
    with pytest.raises(ValueError, match="exactly 4 rows"):
        forecast.require_future_rows(future, 4)
    with pytest.raises(ValueError, match="Future feature data is missing required columns: promo2"):
        forecast.forecast_inputs(history_rows(spark), future.drop("promo2"), 2)


def model_rows(spark, rows):
    return spark.createDataFrame(rows, "model_key string, rmse double")


def test_levels_are_never_compared(spark):
    rows = [("xgboost", 100.0), ("lightgbm", 90.0), ("ensemble_store_level", 80.0), ("prophet_daily_total", 1.0), ("mystery", 0.1)]
    canonical = registry.canonicalise(model_rows(spark, rows))
    best = registry.best_by_level(canonical)
    assert {(r["forecast_level"], r["model_name"], r["rmse"]) for r in best.collect()} == {
        ("store_level", "ensemble_store_level", 80.0),
        ("daily_total", "prophet_daily_total", 1.0),
    }
    plan = {r["model_key"]: r for r in registry.registration_plan(canonical, best).collect()}
    assert plan["ensemble_store_level"]["recommended_stage"] == plan["prophet_daily_total"]["recommended_stage"] == "Production"
    assert plan["xgboost"]["recommended_stage"] == "Staging" and plan["xgboost"]["registered_name"] == "xgboost_store_level"
    assert plan["mystery"]["skipped_because"] == "no registry mapping" and plan["mystery"]["recommended_stage"] is None
    assert plan["ensemble_store_level"]["ensemble_members"] == "xgboost_store_level,lightgbm_store_level"
    levels = {(r["forecast_level"], r["registered_name"]) for r in registry.models_by_level(canonical).collect()}
    assert ("daily_total", "prophet_daily_total") in levels and len(levels) == 4


def test_ties_go_to_the_earlier_model_and_duplicates_are_skipped(spark):
    canonical = registry.canonicalise(model_rows(spark, [("ensemble_store_level", 5.0), ("xgboost_store_level", 5.0), ("xgboost", None)]))
    assert registry.best_by_level(canonical).first()["model_name"] == "xgboost_store_level"
    plan = {r["model_key"]: r["skipped_because"] for r in registry.registration_plan(canonical, registry.best_by_level(canonical)).collect()}
    assert plan["xgboost_store_level"] == "duplicate registration target xgboost_store_level" and plan["xgboost"] is None


def test_own_values_win_over_the_name_table(spark):
    df = spark.createDataFrame([("xgboost", 1.0, "daily_total"), ("lightgbm", 1.0, None)], "model_key string, rmse double, forecast_level string")
    got = {r["model_key"]: r["forecast_level"] for r in registry.canonicalise(df).collect()}
    assert got == {"xgboost": "daily_total", "lightgbm": "store_level"}


def test_versions_are_numbers(spark):
    df = spark.createDataFrame([("m", "9", "None"), ("m", "10", "Production"), ("n", "1", "Production")], "name string, version string, stage string")
    assert {r["name"]: r["version"] for r in registry.newest_versions(df).collect()} == {"m": "10", "n": "1"}
    assert {r["name"]: r["version"] for r in registry.newest_versions(df, "None").collect()} == {"m": "9"}


def test_unseen_category_at_forecast_time(spark):
    codes = encoding.fit_codes(spark.createDataFrame([("a",), ("b",)], "t string"), ["t"])
    rows = encoding.encode(spark.createDataFrame([("b",), ("q",), (None,)], "t string"), codes).collect()
    assert sorted(r["t"] for r in rows) == [-1.0, -1.0, 1.0]


def test_diagnosis_tables(spark):
    rows = [("train", 10.0), ("train", 12.0), ("train", 0.0), ("validation", 30.0), ("test", 9.0)]
    df = spark.createDataFrame(rows, "split string, sales double").withColumn("copy", F.col("sales") * 2).withColumn("flat", F.lit(1.0))
    stats = metrics.split_stats(df)
    assert {r["split"]: r["shifted"] for r in stats.collect()} == {"train": False, "validation": True, "test": True}
    train = df.where("split = 'train'")
    leaks = metrics.target_correlations(train)
    assert {r["column"]: r["leak"] for r in leaks.collect()} == {"copy": True, "flat": False}
    flags = metrics.rule_flags(train)
    assert {r["rule"]: r["flagged"] for r in flags.collect()} == {"feature_count": False, "train_rows": True, "zero_sales": True}
    topics = [r["topic"] for r in metrics.recommendations(stats, leaks, flags).collect()]
    assert sorted(topics) == ["data_leakage", "distribution_shift", "distribution_shift", "train_rows", "zero_sales"]


def test_histogram_counts_everything(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(101)] + [("b", 3.0)], "g string, v double")
    rows = reports.density_histogram(df, ["g"], "v").collect()
    assert sum(r["rows"] for r in rows) == 102
    a = [r for r in rows if r["g"] == "a"]
    assert max(r["bin"] for r in a) == 49 and math.isclose(sum(r["density"] * 2.0 for r in a), 1.0)
    b = [r for r in rows if r["g"] == "b"]
    assert [(r["bin"], r["density"]) for r in b if r["rows"]] == [(25, 50.0)]
    # Bins without rows are there too.
    assert len(a) == len(b) == 50 and {r["density"] for r in b if not r["rows"]} == {0.0}


def test_quantile_points(spark):
    df = spark.createDataFrame([("m", i, float(i)) for i in range(1, 6)], "model string, id int, residual double")
    rows = reports.normal_quantile_points(df, ["id"]).orderBy("rank").collect()
    assert [r["sample"] for r in rows] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert rows[2]["theoretical"] == pytest.approx(0.0, abs=1e-9)
    assert rows[4]["theoretical"] == pytest.approx(1.1289, abs=1e-3) and rows[0]["theoretical"] == pytest.approx(-rows[4]["theoretical"])


def test_equal_models_are_best_whatever_the_last_bits_of_their_metrics(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 0.1 + 0.2, 2.0, nan, 0.9), ("b", 0.3, 2.0 + 1e-6, nan, 0.9 - 1e-16), ("c", None, 3.0, inf, -inf)]
    got = compare.metric_comparison(spark.createDataFrame(rows, "model string, mae double, rmse double, mape double, r2 double")).where("is_best").collect()
    assert sorted((r.metric, r.model) for r in got) == [("mae", "a"), ("mae", "b"), ("mape", "c"), ("r2", "a"), ("r2", "b"), ("rmse", "a")]


def test_wide_rows_are_generated_as_small_methods(spark):
    """Also in a session that others have built; a limit of its own stays."""
    from shelfspark.session import small_methods

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        for own, wanted in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(name, own)
            small_methods(spark)
            assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)
