import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.config import FeatureConfig, SplitConfig
from shelfspark.operators import baselines, clean, features, panel, splits
from shelfspark.sources import raw

DAY = dt.date(2024, 1, 1)


def test_raw_csv_tables(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        "Store,DayOfWeek,Date,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday\n"
        "1,1,2024-01-01,100,10,1,0,0,0\n1,2,2024-01-02,0,0,1,1,0,0\n2,1,2024-01-01,0,0,0,0,a,1\n"
    )
    (tmp_path / "store.csv").write_text(
        "Store,StoreType,Assortment,CompetitionDistance,CompetitionOpenSinceMonth,CompetitionOpenSinceYear,"
        "Promo2,Promo2SinceWeek,Promo2SinceYear,PromoInterval\n1,a,b,500.0,1,2010,0,,,\n"
    )
    joined = clean.join_stores(
        raw.read_raw_sales(spark, str(tmp_path / "train.csv")), raw.read_raw_stores(spark, str(tmp_path / "store.csv"))
    )
    full = clean.prepare_sales(joined)
    trading = clean.select_rows(full).collect()
    assert [(r["store_id"], r["sales"], r["is_open"], r["store_type"]) for r in trading] == [("store_0001", 100.0, 1, "a")]
    rows = {(r["store_id"], r["date"].day): r for r in full.collect()}
    assert len(rows) == 3
    closed = rows[("store_0002", 1)]
    assert (closed["state_holiday"], closed["is_holiday"], closed["store_type"], closed["promo_interval"]) == ("a", 1, "unknown", "none")
    assert rows[("store_0001", 2)]["sales"] == 0.0


def test_a_store_that_occurs_twice_is_an_error(spark):
    once = spark.createDataFrame([(1, "a"), (3_000_000_000, "b")], "Store bigint, StoreType string")
    assert sorted(tuple(r) for r in clean.unique_stores(once).collect()) == [(1, "a"), (3_000_000_000, "b")]
    with pytest.raises(Exception, match="occurs more than once in the store table: 1"):
        clean.unique_stores(once.union(once.limit(1))).collect()


def test_large_store_numbers_have_keys(spark):
    from shelfspark.functions import text

    assert spark.range(1).select(text.store_key(F.lit(3_000_000_000))).first()[0] == "store_3000000000"


def test_defaults_of_prepared_rows(spark):
    joined = spark.createDataFrame(
        [(7, DAY, 5.0, None, None, None, None, None, None, None, None, None, None)],
        "Store int, Date date, Sales double, Customers double, Open int, Promo int, StateHoliday string, SchoolHoliday int, "
        "StoreType string, Assortment string, CompetitionDistance double, Promo2 int, PromoInterval string",
    )
    assert list(clean.prepare_sales(joined).first()) == [
        DAY, "store_0007", 5.0, 0.0, 0, 1, "none", 0, 0, "unknown", "unknown", 0.0, 0, "none",
    ]


def test_store_day_aggregate(spark):
    rows = [
        (DAY, "store_0001", 10.0, 1.0, 0, 1, 0, "a"),
        (DAY, "store_0001", 20.0, 2.0, 1, 1, 1, "a"),
        (DAY, "store_0002", 30.0, 3.0, 0, 1, 0, "b"),
        (DAY, None, 99.0, 3.0, 0, 1, 0, "b"),
    ]
    df = spark.createDataFrame(
        rows, "date date, store_id string, sales double, customer_traffic double, has_promotion int, is_open int, school_holiday int, store_type string"
    )
    out = panel.aggregate_store_days(df).orderBy("store_id").collect()
    assert len(out) == 2
    first = out[0].asDict()
    assert (first["sales"], first["customer_traffic"], first["has_promotion"], first["school_holiday"], first["store_type"]) == (30.0, 3.0, 1, 1, "a")
    assert "promo2" not in first
    assert clean.categorical_columns(df) == ["store_id", "store_type"]


def test_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([(DAY, "s", None)], "date date, store_id string, sales double")
    assert panel.aggregate_store_days(df).first()["sales"] == 0.0


def test_features_see_only_the_past(spark):
    df = spark.createDataFrame(
        [(1, DAY + dt.timedelta(days=i), 10.0 * (i + 1)) for i in range(3)], "store_id int, date date, sales double"
    )
    cfg = FeatureConfig(lags=(1,), windows=(2,))
    rows = features.all_features(df, cfg=cfg).orderBy("date").collect()
    assert (rows[0]["sales_lag_1"], rows[0]["sales_rolling_2_mean"]) == (0.0, 0.0)
    last = rows[2]
    assert [last[f"sales_rolling_2_{s}"] for s in ("mean", "min", "max", "median")] == [15.0, 10.0, 20.0, 15.0]
    assert last["sales_lag_1"] == 20.0


def test_rolling_features_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        [(f"s{s}", DAY + dt.timedelta(days=int(i)), None if (i * s) % 13 == 5 else float(rng.integers(0, 1000))) for s in range(4) for i in range(60)],
        columns=["store_id", "date", "sales"],
    )
    rows = list(pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None))
    df = spark.createDataFrame(rows, "store_id string, date date, sales double")
    got = features.history_features(df).orderBy("store_id", "date").toPandas()
    for n in (3, 7, 14, 21, 30):
        for stat in ("mean", "std", "min", "max", "median"):
            want = pdf.groupby("store_id")["sales"].transform(lambda x: x.shift(1).rolling(n, min_periods=1).agg(stat))
            np.testing.assert_allclose(got[f"sales_rolling_{n}_{stat}"].astype(float), want, atol=1e-6)
    for n in (1, 2, 3, 7, 14, 21, 30):
        np.testing.assert_allclose(got[f"sales_lag_{n}"].astype(float), pdf.groupby("store_id")["sales"].shift(n))


def test_imputation_names_and_means(spark):
    df = spark.createDataFrame(
        [(None, None, 1), (2.0, 4.0, None), (4.0, 6.0, 0)], "sales_lag_7 double, traffic double, state_holiday_flag int"
    )
    rows = features.impute(df).collect()
    assert [r["sales_lag_7"] for r in rows] == [0.0, 2.0, 4.0]
    assert [r["traffic"] for r in rows] == [5.0, 4.0, 6.0]
    assert [r["state_holiday_flag"] for r in rows] == [1.0, 0.5, 0.0]


def test_interactions_print_nulls(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    row = features.interaction_features(df, ["x", "y", "z"]).first()
    assert (row["x_y_interaction"], row["x_z_interaction"], row["y_z_interaction"]) == ("a_nan", "a_c", "nan_c")


DAILY_SCHEMA = "date date, store_id string, sales double, has_promotion int, is_open int, school_holiday int, state_holiday string"


def test_daily_totals(spark):
    second = DAY + dt.timedelta(days=1)
    rows = [
        (DAY, "s1", 100.0, 1, 1, 0, "none"),
        (DAY, "s2", 200.0, 0, 1, 1, "a"),
        (DAY, "s3", 0.0, 1, 0, 0, "none"),
        (second, "s1", 50.0, 0, 1, 0, "0"),
        (second, "s2", 70.0, 0, 1, 0, "none"),
    ]
    out = panel.build_daily_totals(spark.createDataFrame(rows, DAILY_SCHEMA)).orderBy("ds").collect()
    assert [r["y"] for r in out] == [300.0, 120.0]
    a, b = out
    assert (a["promo_store_count"], a["open_store_count"], a["state_holiday_flag"]) == (2.0, 2.0, 1.0)
    assert math.isclose(a["promo_rate"], 2 / 3) and math.isclose(a["school_holiday_rate"], 1 / 3)
    assert (b["promo_store_count"], b["promo_rate"], b["open_store_count"], b["school_holiday_rate"], b["state_holiday_flag"]) == (0, 0, 2, 0, 0)


def test_daily_totals_defaults(spark):
    df = spark.createDataFrame([(DAY, "s1", 1.0), (DAY, "s2", 2.0)], "date date, store_id string, sales double")
    row = panel.build_daily_totals(df).first()
    assert (row["y"], row["promo_store_count"], row["open_store_count"], row["school_holiday_rate"], row["state_holiday_flag"]) == (3.0, 0, 2, 0, 0)
    with pytest.raises(ValueError, match="sales"):
        panel.build_daily_totals(df.drop("sales"))


def test_date_split_keeps_days_together(spark):
    rows = [(DAY + dt.timedelta(days=i), s, v, 1, 1, 0, "none") for i in range(5) for s, v in (("s1", 100.0), ("s2", 0.0))]
    out = splits.split_by_dates(spark.createDataFrame(rows, DAILY_SCHEMA), cfg=SplitConfig(0.2, 0.2))
    counts = {(r["split"], r["date"]): r["count"] for r in out.groupBy("split", "date").count().collect()}
    assert sum(counts.values()) == 10
    assert sorted(s for s, _ in counts) == ["test", "train", "train", "train", "validation"]


def test_naive_forecasts(spark):
    rows = [(DAY + dt.timedelta(days=i), float(i)) for i in range(40)]
    out = baselines.add_baselines(spark.createDataFrame(rows, "ds date, y double")).orderBy("ds").collect()
    assert out[0]["yhat_naive_yesterday"] is None and out[6]["yhat_rolling_7"] is None
    assert out[7]["yhat_seasonal_naive_7"] == 0.0 and out[7]["yhat_rolling_7"] == 3.0
    assert out[27]["yhat_rolling_28"] is None and out[28]["yhat_rolling_28"] == 13.5


def test_forecast_inputs_are_checked(spark):
    df = spark.createDataFrame([("s", 2, 1.0), ("s", 1, -1.0)], "store_id string, is_open int, sales double")
    with pytest.raises(ValueError, match="is_open must contain only 0/1 values.*sales cannot be negative"):
        clean.normalise_inputs(df)
    good = spark.createDataFrame([("0", "1"), ("a", "0"), ("none", "0")], "state_holiday string, school_holiday string")
    assert [r["is_holiday"] for r in clean.normalise_inputs(good).collect()] == [1, 1, 0]


def test_plan_has_one_window_sort(spark):
    df = spark.createDataFrame([("s", DAY, 1.0)], "store_id string, date date, sales double")
    plan = features.history_features(df)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.count("Sort [") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_store_columns_are_pruned_and_filters_reach_the_scan(spark, tmp_path):
    df = spark.range(10).select(
        F.lit("s").alias("store_id"), F.current_date().alias("date"), F.col("id").cast("double").alias("sales"), F.lit(1).alias("is_open"), F.lit("x").alias("unused")
    )
    df.write.parquet(str(tmp_path / "p"))
    read = clean.select_rows(spark.read.parquet(str(tmp_path / "p")))
    plan = panel.aggregate_store_days(read.select("date", "store_id", "sales", "is_open"))._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan
    assert "GreaterThan(sales,0.0)" in plan
