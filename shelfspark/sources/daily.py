"""Daily parquet partitions: write, read, cap and describe."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ("year", "month", "day")
ROWS_PER_FILE = 5_000_000
ROWS_PER_TASK = 1_000_000


def write_tasks(df: DataFrame) -> int:
    """One task for so many rows, and no fewer than there are cores. Rows are counted: the estimated bytes of a join are the
    product of its sides, which would be thousands of tasks for a table of some megabytes."""
    return max(-(-df.count() // ROWS_PER_TASK), df.sparkSession.sparkContext.defaultParallelism)


def write_daily_partitions(df: DataFrame, folder: str, kind: str, date_col: str = "date") -> str:
    """Write ``folder/kind/year=/month=/day=``; month and day have two digits.

    The rows are range-partitioned by date and a hash of the row, so that neighbouring days share
    a task while one very large day is spread over several tasks (and files). The number of tasks
    follows from the input's rows; small tables take one task a core, as one task would otherwise
    write them day after day.
    """
    path = f"{folder.rstrip('/')}/{kind}"
    day = F.to_date(date_col)
    spread = F.xxhash64(*df.columns)
    (
        df.withColumn("year", F.year(day).cast("string"))
        .withColumn("month", F.lpad(F.month(day).cast("string"), 2, "0"))
        .withColumn("day", F.lpad(F.dayofmonth(day).cast("string"), 2, "0"))
        .repartitionByRange(write_tasks(df), *PARTS, spread)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*PARTS)
        .parquet(path)
    )
    return path


def read_daily_partitions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_sales_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union of parquet files in one scan."""
    if not paths:
        raise ValueError("No sales files selected for training")
    return spark.read.parquet(*paths)


def partition_date() -> Column:
    """Day that the partition folder stands for."""
    return F.make_date(*[F.col(p).cast("int") for p in PARTS])


def path_date(path: Column) -> Column:
    """First ``YYYY-MM-DD`` in a path, else the year=/month=/day= folders, else null."""
    written = F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1)
    folders = F.concat_ws(
        "-", *[F.regexp_extract(path, rf"{part}=(\d+)", 1) for part in PARTS]
    )
    return F.coalesce(written.try_cast("date"), folders.try_cast("date"))


def with_file(df: DataFrame, name: str = "file_path") -> DataFrame:
    """Adds the file each row came from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file_path) of every file below a folder; names only, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return found.load(path).select(F.col("_metadata.file_path").alias("file_path"))


class FileLimit(int):
    """How many files a setting allows; 0 allows all, and so does whatever lies below."""

    def __new__(cls, setting: Any, name: str) -> FileLimit:
        whole = isinstance(setting, (int, float)) or isinstance(setting, str) and setting.strip().lstrip("+-").isdecimal()
        if not whole:
            # Fixed value: the text of this error.
            raise ValueError(f"{name} must be an integer, got {setting!r}")
        return super().__new__(cls, max(0, int(setting)))

    def of(self, files: int) -> int:
        return min(files, self or files)


# Fixed values: (whether a selection says it, what it says).
SELECTION_TEXTS = (
    (lambda s: s.training_limit > 0, "Training file cap enabled: using first {s.training_count} of {s.available} sales files."),
    (lambda s: s.mode == "sample", "Sample validation enabled: validating first {s.validation_count} of {s.training_count} files."),
    (lambda s: s.mode == "full", "Full validation enabled: validating all {s.validation_count} selected training files."),
)


@dataclass(frozen=True)
class Selection:
    """Days chosen for training and, among them, for validation."""

    available: int
    training: DataFrame
    training_count: int
    training_limit: int
    validation: DataFrame
    validation_count: int
    validation_limit: int
    mode: str

    def messages(self) -> list[str]:
        return [text.format(s=self) for applies, text in SELECTION_TEXTS if applies(self)]


def first_files(files: DataFrame, raw_limit: Any, name: str, order: str = "file") -> DataFrame:
    """The first N files in order; 0 keeps all. N is a setting, so the top N fits one task."""
    limit = FileLimit(raw_limit, name)
    return files.orderBy(order).limit(limit) if limit else files


def select_files(files: DataFrame, max_training: Any = 0, max_validation: Any = 0, order: str = "file") -> Selection:
    """Training cap first, validation cap inside it. ``files`` has one row per file."""
    training_limit = FileLimit(max_training, "MAX_SALES_FILES")
    validation_limit = FileLimit(max_validation, "VALIDATION_MAX_SALES_FILES")
    available = files.count()
    n_training = training_limit.of(available)
    n_validation = validation_limit.of(n_training)
    training = first_files(files, n_training, "MAX_SALES_FILES", order) if training_limit else files
    validation = (
        first_files(training, validation_limit, "VALIDATION_MAX_SALES_FILES", order)
        if validation_limit
        else training
    )
    sampled = validation_limit > 0 and n_validation < n_training
    return Selection(
        available,
        training,
        n_training,
        training_limit,
        validation,
        n_validation,
        validation_limit,
        "sample" if sampled else "full",
    )


def keep_files(df: DataFrame, files: DataFrame, on: str = "file") -> DataFrame:
    """Rows of the chosen files only; on a partition column this prunes whole folders."""
    return df.join(files.select(on), on, "left_semi")


def dataset_metadata(full: DataFrame, is_trading: Column, source: str) -> DataFrame:
    """One row that describes both row sets of one prepared table, from a single scan.

    Distinct counts come from a pre-aggregation by (day, store), so no distinct set is held in
    one task.
    """
    grain = full.groupBy(F.to_date("date").alias("day"), "store_id").agg(
        F.count("*").alias("rows"), F.count_if(is_trading).alias("trading_rows")
    )
    by_store = grain.groupBy("store_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("trading_rows").alias("trading_rows"),
    )
    by_day = grain.groupBy("day").agg(F.sum("trading_rows").alias("trading_rows"))
    traded = F.col("trading_rows") > 0
    stores = by_store.agg(
        F.sum("trading_rows").alias("total_rows"),
        F.sum("rows").alias("full_total_rows"),
        F.count_if(traded & F.col("store_id").isNotNull()).alias("n_stores"),
    )
    days = by_day.agg(
        F.min(F.when(traded, F.col("day"))).alias("start_date"),
        F.max(F.when(traded, F.col("day"))).alias("end_date"),
        F.count_if(traded & F.col("day").isNotNull()).alias("total_files"),
        F.count_if(F.col("day").isNotNull()).alias("full_total_files"),
    )
    one = F.lit(source).alias("source")
    return stores.select(one, "*").join(days.select(one, "*"), "source")
