import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfspark.config import QualityRules
from shelfspark.operators import quality
from shelfspark.sources import daily

CLEAN = "sales/year=2024/month=01/day=01/sales_2024-01-01.parquet"
BAD = "sales/year=2024/month=01/day=02/sales_2024-01-02.parquet"
SCHEMA = (
    "file_path string, date string, store_id string, sales double, customer_traffic double, has_promotion int, is_open int, is_holiday int"
)
CLEAN_ROWS = [
    (CLEAN, "2024-01-01", "store_0001", 100.0, 10.0, 0, 1, 0),
    (CLEAN, "2024-01-01", "store_0002", 120.0, 12.0, 1, 1, 0),
]
BAD_ROWS = [
    (BAD, "not-a-date", "store_0001", 100.0, 10.0, 0, 1, 0),
    (BAD, "2024-01-03", "store_0002", -1.0, -5.0, 2, 1, 0),
    (BAD, "2024-01-03", "store_0002", 120.0, 12.0, 1, 1, 0),
]


def validate(spark, rows, schema=SCHEMA, **rules):
    df = spark.createDataFrame(rows, schema)
    return quality.validate_batch(df, QualityRules().merged(rules), today=F.lit(dt.date(2024, 6, 1)))


def checks(issues):
    return {r["check"]: r["n"] for r in issues.groupBy("check").agg(F.count("*").alias("n")).collect()}


def test_clean_file_has_no_issues(spark):
    issues, files, summary = validate(spark, CLEAN_ROWS)
    assert issues.count() == 0 and not quality.is_blocking(issues)
    row = summary.first()
    assert (row["total_rows"], row["issues_found"], row["validation_mode"]) == (2, 0, "full")
    assert [tuple(r) for r in files.collect()] == [(CLEAN, 2, 0, 0, 0, "")]


def test_bad_file(spark):
    issues, files, summary = validate(spark, CLEAN_ROWS + BAD_ROWS)
    found = checks(issues)
    assert found["schema"] == 1 and found["nulls"] == 1 and found["value_range"] >= 3
    assert found["binary_domain"] == 1 and found["unique_key"] == 1
    assert found["file_partition"] == 1 and found["time_series"] == 1
    row = summary.first()
    assert row["total_rows"] == 5 and row["blocking_issues_found"] >= 7 and row["warnings_found"] >= 1
    assert quality.is_blocking(issues)
    by_file = {r["file_path"]: r for r in files.collect()}
    assert by_file[CLEAN]["issues_found"] == 0
    assert by_file[BAD]["checks_failed"].split(",") == ["binary_domain", "file_partition", "nulls", "schema", "unique_key", "value_range"]


def test_messages(spark):
    issues = validate(spark, CLEAN_ROWS + BAD_ROWS)[0]
    lines = {r[0] for r in issues.select(quality.format_issue()).collect()}
    assert f"ERROR value_range [{BAD}] column=sales: 1 value(s) below minimum 0" in lines
    assert f"ERROR binary_domain [{BAD}] column=has_promotion: 1 non-binary value(s); examples=[2.0]" in lines
    assert f"ERROR file_partition [{BAD}] column=date: File partition date does not match row date (2024-01-02 != 2024-01-03)" in lines
    assert "WARNING time_series: Missing 1 date(s) between selected validation files; sample=[2024-01-02]" in lines


def test_types_and_infinities(spark):
    schema = "file_path string, date string, store_id string, sales string, customer_traffic string, has_promotion double, is_open int, is_holiday int"
    rows = [
        ("f", "2024-01-01", "a", "x", "Infinity", 0.5, 1, 0),
        ("f", "2024-01-01", "b", "nan", "-Infinity", 1.0, 1, 0),
        ("f", "2024-01-01", "c", "3", None, float("inf"), 1, 0),
    ]
    got = {(r["check"], r["column"]): r["count"] for r in validate(spark, rows, schema)[0].collect()}
    assert got[("schema", "sales")] == 2 and got[("nulls", "sales")] == 2
    assert got[("numeric_values", "customer_traffic")] == 2
    assert got[("schema", "has_promotion")] == 2 and got[("binary_domain", "has_promotion")] == 2


def test_missing_columns_and_future_dates(spark):
    rows = [("f", "2024-07-01", "a", 1.0)]
    issues = validate(spark, rows, "file_path string, date string, store_id string, sales double")[0]
    assert {(r["severity"], r["check"]) for r in issues.collect()} == {("error", "schema"), ("warning", "time_series")}
    strict = validate(spark, rows, "file_path string, date string, store_id string, sales double", fail_on_future=True, required=("date",))[0]
    assert [(r["severity"], r["check"]) for r in strict.collect()] == [("error", "time_series")]


def test_no_valid_dates_and_several_days(spark):
    rows = [("f", "x", "a", 1.0), ("g", "2024-01-01", "a", 1.0), ("g", "2024-01-02", "a", 1.0)]
    issues = validate(spark, rows, "file_path string, date string, store_id string, sales double", required=("date",), non_null=())[0]
    got = {(r["file_path"], r["check"]): r["message"] for r in issues.collect()}
    assert got[("f", "time_series")] == "No valid values in date column date"
    assert got[("g", "file_partition")].endswith("found 2")


def test_duplicates_and_keys_across_files(spark):
    schema = "file_path string, date string, store_id string, sales double"
    rows = [
        ("f1", "2024-01-01", "a", 1.0),
        ("f1", "2024-01-01", "a", 1.0),
        ("f1", "2024-01-01", None, 1.0),
        ("f1", "2024-01-01", None, 2.0),
        ("f2", "2024-01-01", "a", 5.0),
        ("f2", "2024-01-01", "a", 6.0),
        ("f2", "2024-01-01", None, 6.0),
        ("f3", "2024-01-01", "a", 7.0),
    ]
    issues = validate(spark, rows, schema, required=(), non_null=())[0].collect()
    got = sorted((r["file_path"], r["check"], r["count"], "earlier" in r["message"]) for r in issues if r["check"] in ("duplicate_rows", "unique_key"))
    assert got == [
        ("f1", "duplicate_rows", 1, False),
        ("f1", "unique_key", 2, False),
        ("f2", "unique_key", 1, False),
        ("f2", "unique_key", 2, True),
        ("f3", "unique_key", 1, True),
    ]


def test_outliers_by_both_methods(spark):
    values = [10.0, 11.0, 12.0, 11.0, 10.0, 12.0, 11.0, 500.0, float("inf"), None]
    df = spark.createDataFrame([("f", v, 1.0) for v in values], "file_path string, v double, flat double")
    iqr = {r["column"]: r["outliers"] for r in quality.outlier_counts(df, ["v", "flat"]).collect()}
    assert iqr == {"v": 1, "flat": 0}
    many = spark.createDataFrame([("f", v, 1.0) for v in [1.0, 2.0] * 20 + [99.0]], "file_path string, v double, flat double")
    z = {r["column"]: r["outliers"] for r in quality.outlier_counts(many, ["v", "flat"], "zscore").collect()}
    assert z == {"v": 1, "flat": 0}
    with pytest.raises(ValueError):
        quality.outlier_counts(df, ["v"], "other")


def test_binary_examples_are_few(spark):
    schema = "file_path string, has_promotion double"
    df = spark.createDataFrame([("f", float(v)) for v in range(2, 12)] * 3, schema)
    row = quality.binary_issues(quality.check_types(df)).first()
    assert row["count"] == 30
    assert row["message"] == "30 non-binary value(s); examples=[2.0, 3.0, 4.0, 5.0, 6.0]"


def test_frame_report(spark):
    df = spark.createDataFrame([r[1:] for r in CLEAN_ROWS], SCHEMA.replace("file_path string, ", ""))
    report = quality.frame_report(df, today=F.lit(dt.date(2024, 6, 1)))
    assert report.is_valid.first()["is_valid"] and report.gaps.count() == 0
    assert report.date_range.first()["unique_dates"] == 1
    profile = {r["column"]: r for r in report.profile.collect()}
    assert profile["sales"]["mean"] == 110.0 and profile["store_id"]["unique_values"] == 2
    empty = quality.frame_report(df.limit(0))
    assert [r["message"] for r in empty.issues.collect()] == ["File contains no rows"]
    assert not empty.is_valid.first()["is_valid"]


def test_gaps(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", day), ("a", day + dt.timedelta(days=5)), ("b", day), ("b", day + dt.timedelta(days=1)), ("c", day), ("c", None)]
    df = spark.createDataFrame(rows, "store_id string, date date")
    assert [tuple(r) for r in quality.group_gaps(df).collect()] == [("a", 4, 5)]
    many = spark.createDataFrame([(f"s{i:03d}", day + dt.timedelta(days=d)) for i in range(40) for d in (0, 3)], "store_id string, date date")
    assert quality.group_gaps(many).count() == 40
    assert {r["groups_with_gaps"] for r in quality.group_gaps(many, limit=5).collect()} == {40}
    assert sorted(r["date"].day for r in quality.missing_dates(df).collect()) == [3, 4, 5]
    row = quality.date_range(df).first()
    assert (row["days"], row["unique_dates"]) == (5, 3)


def test_prediction_shift(spark):
    train = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, 3.0)], "a double, b double, c double")
    now = spark.createDataFrame([(9.0, 50.0, 3.0)], "a double, b double, c double")
    assert [r["column"] for r in quality.prediction_shift(now, train, ["a", "b", "c"]).collect()] == ["a"]


def test_prediction_data(spark):
    schema = "date string, store_id string, sales double, customer_traffic double, has_promotion int, is_open int, is_holiday int"
    train = spark.createDataFrame([("2024-01-01", f"s{i}", 10.0 + i, 5.0 + i, 0, 1, 0) for i in range(5)], schema)
    good = quality.prediction_data_issues(train, train)
    assert good.count() == 0
    far = train.withColumn("sales", F.col("sales") * 100).withColumn("date", F.lit("never")).drop("is_open")
    got = {(r["check"], r["column"]) for r in quality.prediction_data_issues(far, train).collect()}
    assert got == {("schema", None), ("schema", "date"), ("distribution_shift", "sales")}


def test_distinct_values_ignore_the_sign_of_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "sales double")
    row = quality.column_profile(quality.check_types(df)).first()
    assert (row["unique_values"], row["null_count"], row["null_percentage"]) == (2, 1, 25.0)


def test_path_dates(spark):
    paths = ["x/sales_2024-01-05.parquet", "sales/year=2024/month=01/day=07/part-0.parquet", "none"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(daily.path_date(F.col("p"))).collect()] == [dt.date(2024, 1, 5), dt.date(2024, 1, 7), None]


def test_rules_merge():
    rules = QualityRules().merged({"ranges": {"sales": (1, 2)}, "required": "date", "max_examples": 3, "binary": None})
    assert rules.ranges["sales"] == (1, 2) and rules.ranges["promo2"] == (0, 1)
    assert rules.required == rules.non_null == ("date",) and rules.max_examples == 3


def test_a_frame_report_finds_its_quartiles_once(spark, monkeypatch):
    calls = []
    real = quality.exact_quantiles
    monkeypatch.setattr(quality, "exact_quantiles", lambda *how: (calls.append(how), real(*how))[1])
    rows = spark.range(40).selectExpr("date'2024-01-01' + int(id) AS date", "'store_0001' AS store_id", "if(id = 7, 9e5, 100.0 + id) AS sales", "10.0D AS customer_traffic", "0 AS has_promotion", "1 AS is_open", "0 AS is_holiday")
    report = quality.frame_report(rows)
    assert len(calls) == 1
    alone = quality.column_profile(quality.check_types(rows))
    assert sorted(map(str, report.profile.collect())) == sorted(map(str, alone.collect()))
    assert {r["column"]: r["outliers"] for r in report.profile.collect()}["sales"] == 1


def test_keys_with_the_date_are_aggregated_once(spark, capsys):
    checked = quality.check_types(spark.createDataFrame([*CLEAN_ROWS, *BAD_ROWS, *BAD_ROWS[:1]], SCHEMA))
    issues = quality.duplicate_key_issues(checked)
    for df in (issues, quality.cross_file_key_counts(checked)):
        capsys.readouterr()
        df.explain()
        lines = capsys.readouterr().out.splitlines()
        # One partial and one final aggregation.
        assert sum("Aggregate(keys=[" in line and "store_id" in line.split("functions")[0] for line in lines) == 2
    assert [(r["file_path"], r["count"]) for r in issues.collect()] == [(BAD, 2)]


def test_keys_without_the_date_add_up_its_days(spark):
    rows = [(CLEAN, "2024-01-01", "store_0001"), (CLEAN, "2024-01-02", "store_0001"), (BAD, "2024-01-03", "store_0001")]
    checked = quality.check_types(spark.createDataFrame(rows, "file_path string, date string, store_id string"), QualityRules().merged({"key": "store_id"}))
    assert [(r["file_path"], r["count"]) for r in quality.duplicate_key_issues(checked).collect()] == [(CLEAN, 1)]
    assert [(r["file_path"], r["count"]) for r in quality.cross_file_key_counts(checked).collect()] == [(BAD, 1)]
