"""The two files of the contract, and files that lack columns, rows or sound bytes."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import file_batch
from shelfspark.plans import storage
from shelfspark.sources import daily

COLUMNS = ["date", "store_id", "sales", "customer_traffic", "has_promotion", "is_open", "is_holiday"]
TODAY = dt.date(2025, 1, 1)
CLEAN = [("2024-01-01", "store_0001", 100.0, 10.0, 0, 1, 0), ("2024-01-01", "store_0002", 120.0, 12.0, 1, 1, 0)]
BAD = [
    ("not-a-date", "store_0001", 100.0, 10.0, 0, 1, 0),
    ("2024-01-03", "store_0002", -1.0, -5.0, 2, 1, 0),
    ("2024-01-03", "store_0002", 120.0, 12.0, 1, 1, 0),
]


def put(folder, day, rows, typed=False, drop=()):
    path = folder / f"sales/year=2024/month=01/day={day:02d}"
    path.mkdir(parents=True)
    df = pd.DataFrame(rows, columns=COLUMNS).drop(columns=list(drop))
    if typed:
        df["date"] = pd.to_datetime(df["date"]).dt.date
    df.to_parquet(path / f"sales_2024-01-{day:02d}.parquet")


def run(spark, folder, **limits):
    files = daily.list_files(spark, str(folder))
    issues, summaries, summary = file_batch.validate_files(spark, files, today=F.lit(TODAY), **limits)
    by_file = {r.file_path[-18:-8]: r for r in summaries.collect()}
    return [(None if r.file_path is None else r.file_path[-18:-8], r.check, r.column, r["count"]) for r in issues.collect()], by_file, summary.first()


def test_clean_and_bad(spark, tmp_path):
    put(tmp_path, 1, CLEAN, typed=True)
    issues, _, summary = run(spark, tmp_path)
    assert issues == [] and summary.total_rows == 2 and summary.validation_mode == "full"
    put(tmp_path, 2, BAD)
    issues, files, summary = run(spark, tmp_path)
    checks = [c for _, c, _, _ in issues]
    assert {c: checks.count(c) for c in ("schema", "nulls", "binary_domain", "unique_key", "file_partition", "time_series")} == {
        "schema": 1, "nulls": 1, "binary_domain": 1, "unique_key": 1, "file_partition": 1, "time_series": 1,
    }
    assert checks.count("value_range") >= 3 and summary.blocking_issues_found >= 7 and summary.warnings_found >= 1
    assert summary.total_rows == 5 and files["2024-01-01"].issues_found == 0


def test_lacking_empty_and_damaged(spark, tmp_path):
    put(tmp_path, 1, CLEAN, drop=["is_open", "store_id"])
    put(tmp_path, 2, [])
    put(tmp_path, 3, [(dt.date(2024, 1, 3), *r[1:]) for r in CLEAN])
    whole = next((tmp_path / "sales/year=2024/month=01/day=03").iterdir())
    damaged = tmp_path / "sales/year=2024/month=01/day=04"
    damaged.mkdir()
    (damaged / "sales_2024-01-04.parquet").write_bytes(whole.read_bytes()[:-40])
    issues, files, summary = run(spark, tmp_path)
    assert ("2024-01-01", "schema", None, 2) in issues
    assert ("2024-01-02", "data_quality", None, None) in issues
    assert ("2024-01-04", "file_read", None, None) in issues
    assert not [i for i in issues if i[0] == "2024-01-01" and i[1] != "schema"]
    assert len(files) == 4 and files["2024-01-04"].rows == 0 and summary.total_rows == 4


def test_limits_and_no_files(spark, tmp_path):
    for day in (1, 2, 3):
        put(tmp_path, day, [(f"2024-01-0{day}", *r[1:]) for r in CLEAN])
    _, files, summary = run(spark, tmp_path, max_training=2, max_validation=1)
    assert list(files) == ["2024-01-01"] and summary.validation_mode == "sample"
    assert (summary.total_files_available, summary.total_training_files_selected, summary.total_files_validated) == (3, 2, 1)
    assert len(summary.messages) == 2
    files = spark.createDataFrame([], "file_path string")
    issues, summaries, summary = file_batch.validate_files(spark, files, today=F.lit(TODAY))
    assert [r.check for r in issues.collect()] == ["file_selection"] and summaries.count() == 0
    assert summary.first().blocking_issues_found == 1 and summary.first().total_rows == 0


def test_limits_are_whole_numbers(spark):
    with pytest.raises(ValueError, match="MAX_SALES_FILES must be an integer"):
        file_batch.validate_files(spark, spark.createDataFrame([("a",)], "file_path string"), max_training="x")


def test_no_file_is_loaded_whole(spark, tmp_path):
    """Files beyond the length that one value may have, stood in for by a low limit; one has damaged pages and a sound footer."""
    put(tmp_path, 1, CLEAN, typed=True)
    put(tmp_path, 2, [(dt.date(2024, 1, 2), *r[1:]) for r in CLEAN] * 2000)
    broken = next((tmp_path / "sales/year=2024/month=01/day=02").iterdir())
    content = bytearray(broken.read_bytes())
    content[4:200] = b"\xff" * 196
    broken.write_bytes(content)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "100")
    try:
        issues, files, summary = run(spark, tmp_path)
        plan = file_batch.probe(spark, [str(broken)])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(limit)
    assert [i for i in issues if i[1] == "file_read"] == [("2024-01-02", "file_read", None, None)]
    assert files["2024-01-01"].rows == 2 and files["2024-01-02"].rows == 0 and summary.total_rows == 2
    assert "content" not in plan and "InArrow" not in plan


def test_a_sound_file_without_rows_is_not_unreadable(spark):
    """The events are one row group in the middle of the file, so the first of several tasks writes a file without rows."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "4096")
        got = storage.unreadable_files(spark, "/root/testdata/sf0.001").collect()
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)
    assert [(r.check, r.files, r.readable_rows) for r in got] == [("file_read", 3, spark.read.parquet("/root/testdata/sf0.001/events.parquet").count())]
