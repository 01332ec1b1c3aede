import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import clean, quality
from shelfspark.sources import daily, raw, sinks

DAY = dt.date(2024, 1, 1)


def sample(spark):
    rows = [(DAY + dt.timedelta(days=i % 3), f"s{i}", float(i)) for i in range(9)]
    return spark.createDataFrame(rows, "date date, store_id string, sales double")


def test_daily_partitions(spark, tmp_path):
    path = daily.write_daily_partitions(sample(spark), str(tmp_path), "sales")
    folders = sorted(os.path.relpath(p, path) for p in glob.glob(f"{path}/*/*/*") if os.path.isdir(p))
    assert folders == [f"year=2024/month=01/day=0{d}" for d in (1, 2, 3)]
    back = daily.read_daily_partitions(spark, path)
    assert back.count() == 9
    assert back.where(F.col("date") != daily.partition_date()).count() == 0
    named = daily.with_file(back)
    assert named.where(daily.path_date(F.col("file_path")) != F.col("date")).count() == 0


def test_tasks_follow_rows_and_not_the_estimate_of_a_join(spark, tmp_path, monkeypatch):
    spark.range(200_000).selectExpr("date_add(date '2024-01-01', int(id % 3)) AS date", "id % 50000 AS k").write.parquet(str(tmp_path / "rows"))
    spark.range(50_000).selectExpr("id AS k", "concat('s', id) AS store_id").write.parquet(str(tmp_path / "stores"))
    joined = spark.read.parquet(str(tmp_path / "rows")).join(spark.read.parquet(str(tmp_path / "stores")), "k", "left")
    path = daily.write_daily_partitions(joined, str(tmp_path), "sales")
    assert len(glob.glob(f"{path}/*/*/*/*.parquet")) <= spark.sparkContext.defaultParallelism + 2
    monkeypatch.setattr(daily, "ROWS_PER_TASK", 10_000)
    assert daily.write_tasks(joined) == 20


def test_pruning_of_daily_partitions(spark, tmp_path):
    path = daily.write_daily_partitions(sample(spark), str(tmp_path), "sales")
    plan = spark.read.parquet(path).where("year = 2024 AND month = 1 AND day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_no_files_is_an_error(spark):
    with pytest.raises(ValueError, match="No sales files"):
        daily.read_sales_files(spark, [])


def test_corrupt_files_are_reported(spark, tmp_path):
    path = daily.write_daily_partitions(sample(spark), str(tmp_path), "sales")
    broken = f"{path}/year=2024/month=01/day=03/part-broken.parquet"
    with open(broken, "wb") as out:
        out.write(b"not parquet at all")
    listed = daily.list_files(spark, path)
    assert listed.count() == len(glob.glob(f"{path}/*/*/*/*.parquet"))
    read = daily.with_file(spark.read.option("ignoreCorruptFiles", "true").schema("date date, store_id string, sales double").parquet(path))
    issues = quality.unreadable_files(listed, read.select("file_path")).collect()
    assert [(r["check"], os.path.basename(r["file_path"])) for r in issues] == [("file_read", "part-broken.parquet")]


def test_limits(spark):
    files = spark.createDataFrame([("b",), ("a",), ("c",)], "file string")
    chosen = daily.select_files(files, "2", 1)
    assert sorted(r[0] for r in chosen.training.collect()) == ["a", "b"]
    assert [r[0] for r in chosen.validation.collect()] == ["a"]
    assert chosen.mode == "sample" and len(chosen.messages()) == 2
    full = daily.select_files(files, -5, 7)
    assert full.training.count() == 3 and full.mode == "full" and full.training_limit == 0
    with pytest.raises(ValueError, match="MAX_SALES_FILES must be an integer"):
        daily.select_files(files, "many")


def test_metadata(spark):
    rows = [(DAY, "a", 1, 5.0), (DAY, "b", 0, 0.0), (DAY + dt.timedelta(days=1), "b", 1, 0.0)]
    df = spark.createDataFrame(rows, "date date, store_id string, is_open int, sales double")
    row = daily.dataset_metadata(df, clean.trading_rows(), "csv").first()
    assert (row["total_rows"], row["full_total_rows"], row["n_stores"], row["total_files"], row["full_total_files"]) == (1, 3, 1, 1, 2)
    assert row["start_date"] == row["end_date"] == DAY


def test_history_needs_its_columns(spark, tmp_path):
    (tmp_path / "h.csv").write_text("date,store_id,sales\n2024-01-01,s,1\n")
    with pytest.raises(ValueError, match="missing required columns: customer_traffic"):
        raw.read_history(spark, str(tmp_path / "h.csv"))


def test_generated_histories(spark):
    stores = spark.createDataFrame([("a",), ("b",)], "store_id string")
    plain = raw.default_history(stores, 3, "2024-01-03").orderBy("store_id", "date").collect()
    assert [(r["date"].day, r["sales"]) for r in plain[:3]] == [(1, 5000.0), (2, 5100.0), (3, 5200.0)]
    noisy = raw.sample_history(stores, 50, "2024-03-01", level=100.0, volatility=3.0)
    assert noisy.count() == 100 and noisy.where("sales < 0").count() == 0


def test_forecast_export_rounds(spark, tmp_path):
    df = spark.createDataFrame([(DAY, 1.23456)], "date date, predicted_sales double")
    sinks.write_forecast(df, str(tmp_path / "f"))
    assert spark.read.csv(str(tmp_path / "f"), header=True).first()["predicted_sales"] == "1.23"
