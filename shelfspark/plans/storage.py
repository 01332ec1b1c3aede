"""Queries that write to the shared folder and read back, and queries on file selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.operators import clean, compare, file_batch, quality
from shelfspark.operators.panel import aggregate_store_days
from shelfspark.plans import evaluation as ev
from shelfspark.plans import quality_checks as checks
from shelfspark.plans import tables as t
from shelfspark.plans.catalog import query, rounded
from shelfspark.session import scratch_path
from shelfspark.sources import daily, raw, sinks, star_tables


@query("O1.1 O4.1", f"WITH {t.PREPARED_SQL} SELECT * FROM prepared")
def raw_csv_scan(spark, folder):
    """The raw tables as CSV files, read with a fixed schema and prepared."""
    sales, stores = scratch_path(spark, "sales-csv"), scratch_path(spark, "stores-csv")
    sinks.write_csv(star_tables.raw_sales(spark, folder), sales)
    sinks.write_csv(star_tables.raw_stores(spark, folder), stores)
    return clean.prepare_sales(clean.join_stores(raw.read_raw_sales(spark, sales), raw.read_raw_stores(spark, stores)))


@query(
    "O1.2 O1.4",
    f"""WITH {t.PREPARED_SQL} SELECT date, date AS folder_date, count(*) AS rows, sum(sales) AS sales FROM prepared
    WHERE is_open = 1 AND sales > 0 GROUP BY date""",
)
def daily_partitions(spark, folder):
    """Daily folders of trading rows, read back with the day each folder stands for."""
    trading = clean.select_rows(t.prepared(spark, folder))
    path = daily.write_daily_partitions(trading, scratch_path(spark, "daily"), "sales")
    back = daily.read_sales_files(spark, [path])
    return back.groupBy("date", daily.partition_date().alias("folder_date")).agg(
        F.count("*").alias("rows"), F.sum("sales").alias("sales")
    )


@query(
    "O5.2",
    f"""WITH {t.PANEL_SQL} SELECT date, store_id, sales, customer_traffic, has_promotion, store_type, state_holiday FROM panel""",
)
def training_panel_from_files(spark, folder):
    """Files to store-day panel: the whole training input."""
    trading = clean.select_rows(t.prepared(spark, folder))
    path = daily.write_daily_partitions(trading, scratch_path(spark, "training"), "sales")
    rows = daily.read_sales_files(spark, [path]).drop(*daily.PARTS)
    panel = aggregate_store_days(rows, t.PANEL_ORDER)
    return panel.select("date", "store_id", "sales", "customer_traffic", "has_promotion", "store_type", "state_holiday")


@query(
    "O1.5",
    f"""WITH {t.PREPARED_SQL}, trading AS (SELECT * FROM prepared WHERE is_open = 1 AND sales > 0)
    SELECT 'star' AS source, (SELECT count(*) FROM trading) AS total_rows, (SELECT count(*) FROM prepared) AS full_total_rows,
      (SELECT count(DISTINCT store_id) FROM trading) AS n_stores, (SELECT min(date) FROM trading) AS start_date,
      (SELECT max(date) FROM trading) AS end_date, (SELECT count(DISTINCT date) FROM trading) AS total_files,
      (SELECT count(DISTINCT date) FROM prepared) AS full_total_files""",
)
def dataset_metadata(spark, folder):
    return daily.dataset_metadata(t.prepared(spark, folder), clean.trading_rows(), "star")


@query(
    "O1.6",
    f"""WITH {t.PREPARED_SQL} SELECT date, count(*) AS rows, sum(sales) AS sales FROM prepared
    WHERE date IN (SELECT DISTINCT date FROM prepared ORDER BY date LIMIT 365) GROUP BY date""",
)
def first_year_of_files(spark, folder):
    """The file cap: rows of the first 365 days."""
    rows = t.prepared(spark, folder)
    files = daily.first_files(rows.select("date").distinct(), "365", "MAX_SALES_FILES", "date")
    return daily.keep_files(rows, files, "date").groupBy("date").agg(F.count("*").alias("rows"), F.sum("sales").alias("sales"))


@query(
    "O1.7",
    f"""WITH {t.PREPARED_SQL}, days AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM prepared))
    SELECT 'training' AS part, 'sample' AS mode, count(*) AS rows, min(date) AS first_day, max(date) AS last_day FROM prepared
      WHERE date IN (SELECT date FROM days WHERE n <= 500)
    UNION ALL SELECT 'validation', 'sample', count(*), min(date), max(date) FROM prepared
      WHERE date IN (SELECT date FROM days WHERE n <= 100)""",
)
def nested_file_selection(spark, folder):
    """The two caps: 500 days for training, the first 100 of them for validation."""
    rows = t.prepared(spark, folder)
    chosen = daily.select_files(rows.select("date").distinct(), 500, 100, "date")

    def part(name, files):
        return daily.keep_files(rows, files, "date").agg(
            F.lit(name).alias("part"),
            F.lit(chosen.mode).alias("mode"),
            F.count("*").alias("rows"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
        )

    return part("training", chosen.training).unionByName(part("validation", chosen.validation))


@query("O1.8", f"WITH {ev.COMPARED_SQL} SELECT variant, split, {ev.ROUNDED_METRICS}, beats_seasonal_naive_7 FROM compared")
def diagnostics_files(spark, folder):
    """Experiment results and verdict as CSV, JSON and text; the JSON is read back."""
    rows = rounded(ev.variant_metrics(spark, folder)).persist()
    verdict = compare.experiment_verdict(rows)
    paths = sinks.write_diagnostics(rows, verdict, compare.verdict_lines(verdict), scratch_path(spark, "diagnostics"))
    return spark.read.schema(rows.schema).json(paths["json"])


@query(
    "O3.26",
    """SELECT 'error' AS severity, 'file_read' AS "check", 'Could not read parquet file' AS message, CAST(3 AS BIGINT) AS files,
    count(*) AS readable_rows FROM events""",
)
def unreadable_files(spark, folder):
    """Events as parquet files, and once more as three text files that the scan has to skip."""
    events = star_tables.event_days(spark, folder)
    path = scratch_path(spark, "mixed")
    events.write.parquet(path)
    events.select(F.to_json(F.struct("*")).alias("value")).repartition(3).write.mode("append").text(path)
    read = daily.with_file(spark.read.schema(events.schema).option("ignoreCorruptFiles", "true").parquet(path))
    files = daily.list_files(spark, path, "part-*")
    # A task without rows may write a sound file without rows, which is readable but gives the scan nothing.
    silent = quality.unreadable_files(files, read)
    probed = file_batch.probe(spark, [r[0] for r in silent.select("file_path").collect()])
    issues = silent.join(probed.where("not readable"), "file_path", "left_semi")
    rows = read.agg(F.count("*").alias("n")).scalar()
    return issues.groupBy("severity", "check", "message").agg(F.count("*").alias("files")).select("*", rows.alias("readable_rows"))


NO_HOLIDAY_MONTH, TEXT_YEAR = "1995-06", "1996"
BATCH_SQL = checks.ALL_ISSUES.replace(
    "CAST(l_returnflag <> 'N' AS INTEGER) AS is_holiday",
    f"CASE WHEN strftime(l_shipdate, '%Y-%m') <> '{NO_HOLIDAY_MONTH}' THEN CAST(l_returnflag <> 'N' AS INTEGER) END AS is_holiday",
) + f""", whole AS (
    SELECT * FROM issues WHERE file_path IS NULL OR file_path <> 'sales/{NO_HOLIDAY_MONTH}-01.parquet' OR "column" IS DISTINCT FROM 'is_holiday'
    UNION ALL SELECT DISTINCT file_path, 'error', 'schema', CAST(NULL AS VARCHAR), CAST(1 AS BIGINT), 'Missing required columns: [''is_holiday'']'
      FROM dirty WHERE file_path = 'sales/{NO_HOLIDAY_MONTH}-01.parquet'
    UNION ALL SELECT 'sales/1980-01-01.parquet', 'error', 'data_quality', NULL, NULL, 'File contains no rows' FROM dirty HAVING count(*) > 0
    UNION ALL SELECT 'sales/1980-02-01.parquet', 'error', 'file_read', NULL, NULL, 'Could not read parquet file' FROM dirty HAVING count(*) > 0)"""


def monthly_files(spark, folder):
    """Order lines with faults as one parquet file a month: one month lacks a column, one year has another type of it,
    one file has no rows, one is damaged."""
    rows = star_tables.dirty_sales(spark, folder)
    path = scratch_path(spark, "monthly")
    month = F.regexp_extract("file_path", r"(\d{4}-\d{2})", 1)
    rows = rows.withColumn("file", F.concat(F.lit("sales-"), month, F.lit("-01"))).drop("file_path")

    def write(part, how):
        part.repartition("file").write.mode("append").partitionBy("file").parquet(path) if how == "parquet" else part.write.mode("append").partitionBy("file").text(path)

    of_month = F.substring("file", 7, 7)
    lacks, text = of_month == NO_HOLIDAY_MONTH, F.substring("file", 7, 4) == TEXT_YEAR
    write(rows.where(~lacks & ~text), "parquet")
    write(rows.where(text).withColumn("is_holiday", F.col("is_holiday").cast("string")), "parquet")
    write(rows.where(lacks).drop("is_holiday"), "parquet")
    rows.where("false").drop("file").coalesce(1).write.parquet(f"{path}/file=sales-1980-01-01")
    write(spark.range(1).select(F.lit("no parquet").alias("value"), F.lit("sales-1980-02-01").alias("file")), "text")
    return daily.list_files(spark, path, "part-*")


def _labelled(df):
    return df.withColumn("file_path", F.concat(F.lit("sales/"), F.regexp_extract("file_path", r"(\d{4}-\d{2}-\d{2})", 1), F.lit(".parquet")))


@query("O3.2 O3.3 O3.24 O3.26 O1.6", f"{BATCH_SQL} SELECT * FROM whole")
def validated_files(spark, folder):
    """All issues of a batch of real files."""
    issues, _, _ = file_batch.validate_files(spark, monthly_files(spark, folder), today=checks.today())
    return _labelled(issues)


@query(
    "O3.23 O3.24 O3.26",
    f"""{BATCH_SQL}, files AS (SELECT file_path, count(*) AS rows FROM dirty GROUP BY 1
      UNION ALL SELECT 'sales/1980-01-01.parquet', 0 UNION ALL SELECT 'sales/1980-02-01.parquet', 0)
    SELECT f.file_path, f.rows, coalesce(n, 0) AS issues_found, coalesce(e, 0) AS blocking_issues_found, coalesce(w, 0) AS warnings_found,
      coalesce(c, '') AS checks_failed
    FROM files f LEFT JOIN (SELECT file_path, count(*) AS n, count(*) FILTER (WHERE severity = 'error') AS e,
      count(*) FILTER (WHERE severity = 'warning') AS w, string_agg(DISTINCT "check", ',' ORDER BY "check") AS c
      FROM whole WHERE file_path IS NOT NULL GROUP BY 1) i ON f.file_path = i.file_path""",
)
def validated_file_summaries(spark, folder):
    """One row for each file of the batch, the empty and the damaged one too."""
    _, summaries, _ = file_batch.validate_files(spark, monthly_files(spark, folder), today=checks.today())
    return _labelled(summaries)


@query(
    "O3.24 O3.25 O1.6",
    f"""{BATCH_SQL}, files AS (SELECT DISTINCT file_path FROM dirty)
    SELECT 'full' AS validation_mode, f.n + 2 AS total_files_validated, f.n + 2 AS total_files_available, f.n + 2 AS total_training_files_selected,
      CAST(0 AS BIGINT) AS max_sales_files, CAST(0 AS BIGINT) AS validation_max_sales_files, r.rows AS total_rows,
      (SELECT count(DISTINCT file_path) FROM whole) AS total_files_with_issues, f.n + 2 > 25 AS file_summaries_truncated,
      i.n AS issues_found, i.e AS blocking_issues_found, i.w AS warnings_found, i.n > 25 AS issues_truncated, r.lo AS first_date, r.hi AS last_date,
      'Full validation enabled: validating all ' || (f.n + 2) || ' selected training files.' AS messages
    FROM (SELECT count(*) AS n FROM files) f, (SELECT count(*) AS rows, min(date) AS lo, max(date) AS hi FROM typed) r,
      (SELECT count(*) AS n, count(*) FILTER (WHERE severity = 'error') AS e, count(*) FILTER (WHERE severity = 'warning') AS w FROM whole) i""",
)
def validated_batch(spark, folder):
    """The totals of the batch, with its selection, dates and messages."""
    _, _, summary = file_batch.validate_files(spark, monthly_files(spark, folder), today=checks.today())
    return summary.withColumn("messages", F.array_join("messages", "; "))


@query("O1.9", ev.REPORT_SQL)
def performance_report_file(spark, folder):
    rows = ev.performance_rows(spark, folder)
    path = sinks.write_json(rows, scratch_path(spark, "performance"))
    return spark.read.schema(rows.schema).json(path)


@query(
    "O1.10",
    f"""WITH {t.DAILY_BASELINES_SQL} SELECT ds AS date, round(yhat_naive_yesterday, 2) AS predicted_sales,
    round(yhat_naive_yesterday * 0.9::DOUBLE, 2) AS lower_bound, round(yhat_naive_yesterday * 1.1::DOUBLE, 2) AS upper_bound
    FROM guessed WHERE yhat_naive_yesterday IS NOT NULL""",
)
def forecast_file(spark, folder):
    from shelfspark.operators.baselines import add_baselines
    from shelfspark.operators.forecast import with_bounds

    guessed = add_baselines(t.labelled_daily(spark, folder)).where("yhat_naive_yesterday IS NOT NULL")
    rows = with_bounds(guessed.select(F.col("ds").alias("date"), F.col("yhat_naive_yesterday").alias("predicted_sales")))
    path = sinks.write_forecast(rows, scratch_path(spark, "forecast"))
    return spark.read.schema(rows.schema).csv(path, header=True)


@query(
    "O1.11 O3.2",
    f"WITH {t.PANEL_SQL} SELECT {', '.join(config.HISTORY_COLUMNS)} FROM panel",
)
def uploaded_history(spark, folder):
    """A history of all stores as CSV, read with its required columns."""
    path = scratch_path(spark, "history")
    sinks.write_csv(t.store_days(spark, folder).select(*config.HISTORY_COLUMNS), path)
    return raw.read_history(spark, path).select(*config.HISTORY_COLUMNS)


ATTRIBUTES_SQL = ", ".join(
    f"CAST({value!r} AS {'DOUBLE' if isinstance(value, float) else 'INTEGER' if isinstance(value, int) else 'VARCHAR'}) AS {name}"
    for name, value in raw.DEFAULT_ATTRIBUTES.items()
)


def store_ids(spark, folder):
    return star_tables.raw_stores(spark, folder).select(F.concat(F.lit("store_"), F.col("Store").cast("string")).alias("store_id"))


@query(
    "O1.14",
    f"""SELECT DATE '2024-06-30' + CAST(k - 89 AS INTEGER) AS date, 'store_' || s_suppkey AS store_id,
    round(greatest(0, 5000 + k * (500.0::DOUBLE / 89) + sin(k * (2 * pi() / 7)) * 1000), 4) AS sales, {ATTRIBUTES_SQL}
    FROM (SELECT s_suppkey, unnest(generate_series(0, 89)) AS k FROM supplier)""",
)
def generated_history(spark, folder):
    """90 days per supplier: level, trend and weekly season, without noise."""
    return rounded(raw.sample_history(store_ids(spark, folder), 90, "2024-06-30", volatility=0.0))


@query("O1.14")
def generated_noisy_history(spark, folder):
    return raw.sample_history(store_ids(spark, folder), 90, "2024-06-30")


@query(
    "O1.15",
    f"""SELECT DATE '2024-06-30' + CAST(k - 6 AS INTEGER) AS date, 'store_' || s_suppkey AS store_id,
    CAST(5000 + k * 100 AS DOUBLE) AS sales, {ATTRIBUTES_SQL} FROM (SELECT s_suppkey, unnest(generate_series(0, 6)) AS k FROM supplier)""",
)
def default_history(spark, folder):
    return raw.default_history(store_ids(spark, folder), 7, "2024-06-30")
