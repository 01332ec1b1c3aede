import datetime as dt
import math
import statistics

from pyspark.sql import functions as F

from shelfspark.functions import dates, stats, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_state_holiday_texts(spark):
    values = [None, "", " 0 ", "0.0", "None", "NaN", "nat", "FALSE", " A ", "\tb\n", "c"]
    rows = column(spark, values).select(
        text.state_holiday_code(F.col("c")).alias("code"), text.state_holiday_indicator(F.col("c")).alias("flag")
    ).collect()
    assert [r["code"] for r in rows] == ["none"] * 8 + ["a", "b", "c"]
    assert [r["flag"] for r in rows] == [0] * 8 + [1, 1, 1]


def test_binary_indicator(spark):
    values = [None, "0", "1", "2.5", "-1", "Yes", " TRUE ", "y", "no", "nan", "maybe"]
    rows = column(spark, values).select(text.binary_indicator(F.col("c")).alias("f")).collect()
    assert [r["f"] for r in rows] == [0, 0, 1, 1, 1, 1, 1, 1, 0, 0, 0]
    numbers = column(spark, [None, 0.0, 2.0, float("nan")], "double")
    assert [r[0] for r in numbers.select(text.binary_indicator(F.col("c"), True)).collect()] == [0, 0, 1, 0]


def test_store_key_is_padded_but_never_cut(spark):
    rows = column(spark, [1, 123, 1234, 56789], "int").select(text.store_key(F.col("c"))).collect()
    assert [r[0] for r in rows] == ["store_0001", "store_0123", "store_1234", "store_56789"]


def test_labels_both_ways(spark):
    rows = column(spark, ["1", "0", None, "7", "x"]).select(text.yes_no_label(F.col("c"))).collect()
    assert [r[0] for r in rows] == ["Yes", "No", "No", "No", "No"]
    back = column(spark, ["Yes", "No", "1", "0"]).select(text.yes_no_value(F.col("c"))).collect()
    assert [r[0] for r in back] == [1, 0, 1, 0]


def test_mixed_date_formats(spark):
    values = ["2024-01-02", "2024/1/2", "1/2/2024", "20240102", "Jan 2, 2024", "2024-01-02 13:00:00", "bad", None]
    rows = column(spark, values).select(dates.parsed_date(F.col("c"))).collect()
    assert [r[0] for r in rows] == [dt.date(2024, 1, 2)] * 6 + [None, None]


def test_calendar_parts_match_python(spark):
    days = [dt.date(2019, 12, 29) + dt.timedelta(days=i) for i in range(800)]
    parts = dates.calendar_parts(F.col("c"))
    for row in column(spark, days, "date").select("c", *[e.alias(n) for n, e in parts.items()]).collect():
        day = row["c"]
        assert row["dayofweek"] == day.weekday()
        assert row["weekofyear"] == day.isocalendar().week
        assert row["is_weekend"] == int(day.weekday() >= 5)
        assert (row["year"], row["month"], row["day"]) == (day.year, day.month, day.day)


def test_easter_and_german_holidays(spark):
    # Known Easter Sundays.
    known = {1994: (4, 3), 2000: (4, 23), 2011: (4, 24), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25)}
    rows = column(spark, list(known), "int").select("c", dates.easter_sunday(F.col("c")).alias("e")).collect()
    assert {r["c"]: (r["e"].month, r["e"].day) for r in rows} == known
    year = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(366)]
    found = column(spark, year, "date").where(dates.german_public_holiday(F.col("c"))).collect()
    assert [(r["c"].month, r["c"].day) for r in found] == [
        (1, 1), (3, 29), (4, 1), (5, 1), (5, 9), (5, 20), (10, 3), (12, 25), (12, 26),
    ]


def test_inverse_normal(spark):
    values = [0.0001, 0.01, 0.024, 0.03, 0.25, 0.5, 0.75, 0.97, 0.98, 0.9999]
    rows = column(spark, values, "double").select("c", stats.inverse_normal(F.col("c")).alias("z")).collect()
    for r in rows:
        assert math.isclose(r["z"], statistics.NormalDist().inv_cdf(r["c"]), abs_tol=1e-7)


def metrics_of(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, yhat double")
    return df.agg(*[c.alias(n) for n, c in stats.error_metrics(F.col("y"), F.col("yhat")).items()]).first()


def test_metrics(spark):
    row = metrics_of(spark, [(10.0, 8.0), (0.0, 1.0), (20.0, 25.0), (5.0, None), (None, 5.0), (5.0, float("inf")), (float("nan"), 1.0)])
    assert row["mae"] == (2 + 1 + 5) / 3
    assert math.isclose(row["rmse"], math.sqrt((4 + 1 + 25) / 3))
    assert math.isclose(row["mape"], (0.2 + 0.25) / 2 * 100)
    assert math.isclose(row["r2"], 1 - 30 / 200)


def test_metrics_edge_cases(spark):
    assert metrics_of(spark, [(5.0, 5.0), (5.0, 5.0)])["r2"] == 1.0
    assert metrics_of(spark, [(5.0, 4.0), (5.0, 5.0)])["r2"] == 0.0
    assert metrics_of(spark, [(0.0, 4.0)])["mape"] == 0.0
    assert list(metrics_of(spark, [(None, 1.0)])) == [None] * 4


def test_first_present_skips_nulls(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, None), (1, 2, "b"), (2, 1, None)], "g int, o int, v string")
    rows = df.groupBy("g").agg(stats.first_present(F.col("v"), F.col("o")).alias("v")).orderBy("g").collect()
    assert [r["v"] for r in rows] == ["b", None]
