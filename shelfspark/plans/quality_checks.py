"""Queries on data checks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.config import QualityRules
from shelfspark.operators import quality
from shelfspark.operators.quantiles import exact_quantiles
from shelfspark.plans import tables as t
from shelfspark.plans.catalog import query, rounded
from shelfspark.sources import star_tables

RULES = QualityRules()
TODAY = "2001-01-01"
NUMBERS = t.NUMERIC_COLUMNS
FINITE = "CASE WHEN abs({0}) < CAST('Infinity' AS DOUBLE) THEN {0} END"


def today():
    return F.lit(datetime.date.fromisoformat(TODAY))


def checked(spark, folder):
    return quality.check_types(star_tables.dirty_sales(spark, folder))


def _count_issue(severity: str, check: str, column: str, condition: str, text: str) -> str:
    return f"""SELECT file_path, '{severity}' AS severity, '{check}' AS "check", '{column}' AS "column",
    count(*) AS count, count(*) || '{text}' AS message FROM typed WHERE {condition} GROUP BY file_path"""


def _count_issue_sql() -> str:
    parts = [
        _count_issue("error", "schema", "date", "date IS NULL AND date_text IS NOT NULL", " value(s) cannot be parsed as datetime"),
        _count_issue("error", "schema", "sales", "sales IS NULL AND sales_text IS NOT NULL", " value(s) cannot be converted to float64"),
        _count_issue("error", "schema", "is_open", "is_open <> floor(is_open)", " non-integer value(s) found"),
        _count_issue("warning", "time_series", "date", f"date > DATE '{TODAY}'", " future-dated row(s)"),
        _count_issue("error", "numeric_values", "sales", "abs(sales) = CAST('Infinity' AS DOUBLE)", " infinite value(s)"),
    ]
    parts += [_count_issue("error", "nulls", c, f"{c} IS NULL", " null value(s) in required column") for c in RULES.non_null]
    for c in NUMBERS:
        low, high = RULES.ranges[c]
        if low is not None:
            parts.append(_count_issue("error", "value_range", c, f"{FINITE.format(c)} < {low}", f" value(s) below minimum {low}"))
        if high is not None:
            parts.append(_count_issue("error", "value_range", c, f"{FINITE.format(c)} > {high}", f" value(s) above maximum {high}"))
    parts.append(
        """SELECT file_path, 'error', 'file_partition', 'date', NULL, 'File partition date does not match row date ('
        || substr(file_path, 7, 10) || ' != ' || min(date) || ')' FROM typed GROUP BY file_path
        HAVING min(date) = max(date) AND min(date) <> CAST(substr(file_path, 7, 10) AS DATE)"""
    )
    return " UNION ALL ".join(parts)


COUNT_ISSUES = _count_issue_sql()
DUPLICATE_ROWS = """SELECT file_path, 'warning' AS severity, 'duplicate_rows' AS "check", CAST(NULL AS VARCHAR) AS "column",
  CAST(sum(n - 1) AS BIGINT) AS count, 'Found ' || CAST(sum(n - 1) AS BIGINT) || ' exact duplicate row(s)' AS message
  FROM (SELECT file_path, count(*) AS n FROM typed GROUP BY file_path, date, store_id, sales, customer_traffic, has_promotion,
    is_open, is_holiday HAVING count(*) > 1) GROUP BY file_path"""
DUPLICATE_KEYS = """SELECT file_path, 'error' AS severity, 'unique_key' AS "check", CAST(NULL AS VARCHAR) AS "column",
  CAST(sum(n - 1) AS BIGINT) AS count,
  'Found ' || CAST(sum(n - 1) AS BIGINT) || ' duplicate row(s) at grain [''date'', ''store_id'']' AS message
  FROM (SELECT file_path, count(*) AS n FROM typed GROUP BY file_path, date, store_id HAVING count(*) > 1) GROUP BY file_path"""
BINARY = """SELECT file_path, 'error' AS severity, 'binary_domain' AS "check", c AS "column", CAST(sum(n) AS BIGINT) AS count,
  CAST(sum(n) AS BIGINT) || ' non-binary value(s); examples=[' || string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) || ']' AS message
  FROM (SELECT file_path, c, v, count(*) AS n FROM (
      SELECT file_path, 'has_promotion' AS c, has_promotion AS v FROM typed UNION ALL SELECT file_path, 'is_open', is_open FROM typed
      UNION ALL SELECT file_path, 'is_holiday', is_holiday FROM typed)
    WHERE v NOT IN (0, 1) GROUP BY ALL) GROUP BY file_path, c"""
MANY_DAYS = """SELECT file_path, 'error' AS severity, 'file_partition' AS "check", 'date' AS "column", count(DISTINCT date) AS count,
  'Sales parquet files should contain one sales date; found ' || count(DISTINCT date) AS message
  FROM typed GROUP BY file_path HAVING count(DISTINCT date) > 1"""
LONG = "long AS (" + " UNION ALL ".join(f"SELECT file_path, '{c}' AS c, {FINITE.format(c)} AS v FROM typed" for c in NUMBERS) + ")"


def outlier_sql(keys: str) -> str:
    return f"""SELECT {keys}, count(*) FILTER (WHERE q3 <> q1 AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))) AS outliers
  FROM (SELECT *, quantile_cont(v, 0.25) OVER (PARTITION BY {keys}) AS q1, quantile_cont(v, 0.75) OVER (PARTITION BY {keys}) AS q3
    FROM long WHERE v IS NOT NULL) GROUP BY {keys}"""


OUTLIER_ISSUES = f"""SELECT o.file_path, 'warning' AS severity, 'outliers' AS "check", o.c AS "column", o.outliers AS count,
  o.outliers || ' outlier value(s), above 10.0% threshold' AS message FROM ({outlier_sql('file_path, c')}) o
  JOIN (SELECT file_path, count(*) AS n FROM typed GROUP BY 1) r ON o.file_path = r.file_path WHERE o.outliers * 100.0 / r.n > 10"""
CROSS_FILE = """SELECT file_path, CAST(sum(n) AS BIGINT) AS count FROM (
  SELECT file_path, n, min(file_path) OVER (PARTITION BY {key}) AS earliest
  FROM (SELECT file_path, {key}, count(*) AS n FROM {source} GROUP BY ALL)) WHERE earliest < file_path GROUP BY file_path"""
GAPS = """SELECT NULL AS file_path, 'warning' AS severity, 'time_series' AS "check", NULL AS "column", count(*) AS count,
  'Missing ' || count(*) || ' date(s) between selected validation files; sample=['
  || string_agg(CAST(d AS VARCHAR), ', ' ORDER BY d) FILTER (WHERE place <= 10) || ']' AS message
  FROM (SELECT d, row_number() OVER (ORDER BY d) AS place FROM (
    SELECT CAST(unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM typed)
    WHERE d NOT IN (SELECT date FROM typed WHERE date IS NOT NULL)) HAVING count(*) > 0"""
FILE_ISSUES = " UNION ALL ".join([COUNT_ISSUES, DUPLICATE_ROWS, DUPLICATE_KEYS, BINARY, MANY_DAYS, OUTLIER_ISSUES])
BASE = f"WITH {t.DIRTY_SQL}, {LONG}"
ALL_ISSUES = f"{BASE}, issues AS ({FILE_ISSUES} UNION ALL {GAPS})"
SUMMARIES = f"""{ALL_ISSUES}, summaries AS (
  SELECT f.file_path, f.rows, coalesce(i.n, 0) AS issues_found, coalesce(i.e, 0) AS blocking_issues_found,
    coalesce(i.w, 0) AS warnings_found, coalesce(i.c, '') AS checks_failed
  FROM (SELECT file_path, count(*) AS rows FROM typed GROUP BY 1) f LEFT JOIN (
    SELECT file_path, count(*) AS n, count(*) FILTER (WHERE severity = 'error') AS e,
      count(*) FILTER (WHERE severity = 'warning') AS w, string_agg(DISTINCT "check", ',' ORDER BY "check") AS c
    FROM issues WHERE file_path IS NOT NULL GROUP BY 1) i ON f.file_path = i.file_path)"""


@query("O3.1 O3.7 O3.8 O3.9 O3.13 O3.14 O3.16", f"{BASE} {COUNT_ISSUES}")
def counted_issues(spark, folder):
    return quality.count_issues(checked(spark, folder), today())


@query("O3.4", f"{BASE} {DUPLICATE_ROWS}")
def duplicate_row_issues(spark, folder):
    return quality.duplicate_row_issues(checked(spark, folder))


@query("O3.5", f"{BASE} {DUPLICATE_KEYS}")
def duplicate_key_issues(spark, folder):
    return quality.duplicate_key_issues(checked(spark, folder))


@query(
    "O3.6 O4.6",
    """WITH typed AS (SELECT 'orders/' || strftime(o_orderdate, '%Y-%m') || '-01.parquet' AS file_path,
      CAST('2000-01-01' AS DATE) + CAST(o_custkey % 28 AS INTEGER) AS date, o_orderpriority || o_custkey AS store_id FROM orders) """
    + CROSS_FILE.format(key="date, store_id", source="typed"),
)
def cross_file_keys(spark, folder):
    """Orders by month with a key that comes back in later months."""
    orders = star_tables.read_table(spark, folder, "orders")
    rows = orders.select(
        F.concat(F.lit("orders/"), F.date_format("o_orderdate", "yyyy-MM"), F.lit("-01.parquet")).alias("file_path"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("o_custkey") % 28).cast("int")).alias("date"),
        F.concat("o_orderpriority", F.col("o_custkey").cast("string")).alias("store_id"),
    )
    return quality.cross_file_key_counts(quality.check_types(rows))


@query("O3.10", f"""{BASE} SELECT file_path, c AS "column", outliers FROM ({outlier_sql('file_path, c')})""")
def iqr_outliers(spark, folder):
    return quality.outlier_counts(checked(spark, folder).rows, NUMBERS)


@query(
    "O3.11",
    f"""{BASE} SELECT c AS "column", count(*) FILTER (WHERE s > 0 AND abs(v - m) / s > 3) AS outliers FROM (
      SELECT c, v, avg(v) OVER (PARTITION BY c) AS m, stddev_samp(v) OVER (PARTITION BY c) AS s FROM long WHERE v IS NOT NULL)
    GROUP BY c""",
)
def zscore_outliers(spark, folder):
    return quality.outlier_counts(checked(spark, folder).rows, NUMBERS, method="zscore", keys=())


@query(
    "O3.10 O5.8",
    f"""{BASE} SELECT c AS "column", count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2,
    quantile_cont(v, 0.75) AS q3 FROM long GROUP BY c""",
)
def column_quartiles(spark, folder):
    finite = checked(spark, folder).rows.select(*[quality.finite(F.col(c)).alias(c) for c in NUMBERS])
    return exact_quantiles(finite, [], NUMBERS, {"q1": 0.25, "q2": 0.5, "q3": 0.75})


@query("O3.12", f"{BASE} {BINARY}")
def binary_domain_issues(spark, folder):
    return quality.binary_issues(checked(spark, folder))


@query("O3.15", f"{BASE} {MANY_DAYS}")
def many_days_issues(spark, folder):
    return quality.many_days_issues(checked(spark, folder))


@query(
    "O3.16",
    """WITH f AS (SELECT 'sales/year=' || year(ts) || '/month=' || lpad(CAST(month(ts) AS VARCHAR), 2, '0') || '/day='
      || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || '/' || event_type AS file_path, CAST(ts AS DATE) AS named,
      CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS date FROM events)
    SELECT file_path, 'File partition date does not match row date (' || named || ' != ' || min(date) || ')' AS message
    FROM f GROUP BY file_path, named HAVING min(date) = max(date) AND min(date) <> named""",
)
def misplaced_files(spark, folder):
    """One file per day and type; the rows of one type are a day off their folder."""
    events = star_tables.event_days(spark, folder)
    rows = events.select(
        F.concat(F.lit("sales/"), F.date_format("date", "'year='yyyy'/month='MM'/day='dd"), F.lit("/"), "kind").alias("file_path"),
        F.date_add("date", F.when(F.col("kind") == "error", 1).otherwise(0)).alias("date"),
        "store_id",
        "sales",
    )
    issues = quality.count_issues(quality.check_types(rows), F.lit("2100-01-01").cast("date"))
    return issues.where(F.col("check") == "file_partition").select("file_path", "message")


@query(
    "O3.2",
    """SELECT 'frame' AS file_path, 'error' AS severity, 'schema' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(4 AS BIGINT) AS count,
    'Missing required columns: [''customer_traffic'', ''has_promotion'', ''is_holiday'', ''is_open'']' AS message
    FROM events HAVING count(*) > 0""",
)
def missing_required_columns(spark, folder):
    events = quality.check_types(star_tables.event_days(spark, folder))
    return quality.missing_column_issues(events, quality.rows_per_file(events))


@query(
    "O3.3",
    """SELECT CAST(NULL AS VARCHAR) AS file_path, 'error' AS severity, 'data_quality' AS "check", CAST(NULL AS VARCHAR) AS "column",
    CAST(NULL AS BIGINT) AS count, 'File contains no rows' AS message FROM events WHERE value IS NULL HAVING count(*) = 0""",
)
def empty_input(spark, folder):
    return quality.empty_input_issue(star_tables.event_days(spark, folder).where(F.col("sales").isNull()))


@query(
    "O3.17",
    f"""{BASE}, stats AS (SELECT c, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max FROM long GROUP BY c),
    out AS ({outlier_sql('c')}), base AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, count(*) - count({c}) AS nulls, count(*) AS n, count(DISTINCT {c}) AS uniq FROM typed"
        for c in ("date", "store_id", *NUMBERS)
    )
    + """) SELECT base.c AS "column", nulls AS null_count, round(nulls * 100.0 / n, 6) AS null_percentage, uniq AS unique_values,
    round(mean, 6) AS mean, round(std, 6) AS std, min, max, outliers
    FROM base LEFT JOIN stats ON base.c = stats.c LEFT JOIN out ON base.c = out.c""",
)
def column_profile(spark, folder):
    return rounded(quality.column_profile(checked(spark, folder)), 6)


@query(
    "O3.18 O4.4 O8.2",
    f"""WITH {t.PANEL_SQL}, calendar AS (SELECT CAST(unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP,
      INTERVAL 1 DAY)) AS DATE) AS date FROM panel) SELECT date FROM calendar WHERE date NOT IN (SELECT date FROM panel)""",
)
def missing_dates(spark, folder):
    return quality.missing_dates(t.store_days(spark, folder))


GROUP_GAPS = """SELECT store_id, date_diff('day', min(date), max(date)) + 1 - count(*) AS gap_count, max(step) AS max_gap_days FROM (
  SELECT *, date_diff('day', lag(date) OVER (PARTITION BY store_id ORDER BY date), date) AS step
  FROM (SELECT DISTINCT store_id, date FROM {source})) GROUP BY store_id
  HAVING date_diff('day', min(date), max(date)) + 1 - count(*) > 0"""
GAP_CASTS = "SELECT store_id, CAST(gap_count AS BIGINT) AS gap_count, CAST(max_gap_days AS INTEGER) AS max_gap_days FROM ({0})"


@query("O3.19 O6.7", f"WITH {t.PANEL_SQL} " + GAP_CASTS.format(GROUP_GAPS.format(source="panel")))
def store_gaps(spark, folder):
    return quality.group_gaps(t.store_days(spark, folder), limit=None)


@query(
    "O3.19",
    "WITH d AS (SELECT CAST(user_id AS VARCHAR) AS store_id, CAST(ts AS DATE) AS date FROM events) "
    + GAP_CASTS.format(GROUP_GAPS.format(source="d")),
)
def user_gap_report(spark, folder):
    """All users with missing days."""
    return quality.group_gaps(star_tables.event_days(spark, folder))


@query(
    "O3.20",
    """SELECT min(CAST(ts AS DATE)) AS start, max(CAST(ts AS DATE)) AS "end",
    CAST(date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) AS INTEGER) AS days,
    count(DISTINCT CAST(ts AS DATE)) AS unique_dates FROM events""",
)
def date_range(spark, folder):
    return quality.date_range(star_tables.event_days(spark, folder))


@query(
    "O3.21",
    f"""WITH {t.PANEL_SQL}, s AS (SELECT store_type <> 'a' AS train, sales, customer_traffic,
      CASE WHEN store_type = 'a' THEN is_holiday + 9 ELSE is_holiday END AS is_holiday FROM panel),
    l AS (SELECT train, 'sales' AS c, sales AS v FROM s UNION ALL SELECT train, 'customer_traffic', customer_traffic FROM s
      UNION ALL SELECT train, 'is_holiday', is_holiday FROM s)
    SELECT c AS "column", round(avg(v) FILTER (WHERE train), 4) AS train_mean, round(stddev_samp(v) FILTER (WHERE train), 4) AS train_std,
      round(avg(v) FILTER (WHERE NOT train), 4) AS pred_mean FROM l GROUP BY c
    HAVING stddev_samp(v) FILTER (WHERE train) <> 0 AND abs(avg(v) FILTER (WHERE NOT train) - avg(v) FILTER (WHERE train))
      > 3 * stddev_samp(v) FILTER (WHERE train)""",
)
def prediction_data_shift(spark, folder):
    days = t.store_days(spark, folder)
    scored = days.where(F.col("store_type") == "a").withColumn("is_holiday", F.col("is_holiday") + 9)
    train = days.where(F.col("store_type") != "a")
    return rounded(quality.prediction_shift(scored, train, ["sales", "customer_traffic", "is_holiday"]))


def _rule_sql() -> str:
    bad = {
        "date": "date IS NULL AND date_text IS NOT NULL",
        "sales": "sales IS NULL AND sales_text IS NOT NULL",
        "is_open": "is_open <> floor(is_open)",
    }
    parts = []
    for c in ("date", "store_id", *NUMBERS):
        parts.append(f"""SELECT '{c}' AS "column", 'type' AS rule, count(*) FILTER (WHERE {bad.get(c, 'false')}) AS violations FROM typed""")
        low, high = RULES.ranges.get(c, (None, None))
        if low is not None:
            parts.append(f"SELECT '{c}', 'min', count(*) FILTER (WHERE {c} < {low}) FROM typed")
        if high is not None:
            parts.append(f"SELECT '{c}', 'max', count(*) FILTER (WHERE {c} > {high}) FROM typed")
    return " UNION ALL ".join(parts)


@query("O3.22", f"{BASE} {_rule_sql()}")
def rule_table_violations(spark, folder):
    return quality.apply_rule_table(checked(spark, folder), quality.rule_table())


@query(
    "O3.22",
    f"""WITH {t.PREPARED_SQL} """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", 'domain' AS rule, count(*) FILTER (WHERE {c} NOT IN ({', '.join(f"'{v}'" for v in allowed)}))
        AS violations FROM prepared"""
        for c, allowed in config.CATEGORY_DOMAINS.items()
    ),
)
def category_domain_violations(spark, folder):
    rows = quality.check_types(t.prepared(spark, folder))
    table = [r for r in quality.rule_table(domains=config.CATEGORY_DOMAINS) if r[1] == "domain"]
    return quality.apply_rule_table(rows, table)


@query("O3.24 O3.25", f"{ALL_ISSUES} SELECT * FROM issues")
def batch_issues(spark, folder):
    return quality.batch_issues(checked(spark, folder), today())


@query("O3.23", f"{SUMMARIES} SELECT * FROM summaries")
def file_summaries(spark, folder):
    return quality.validate_batch(star_tables.dirty_sales(spark, folder), today=today())[1]


@query(
    "O3.24",
    f"""{SUMMARIES} SELECT 'full' AS validation_mode, f.*, i.* FROM (
      SELECT count(*) AS total_files_validated, CAST(sum(rows) AS BIGINT) AS total_rows,
        count(*) FILTER (WHERE issues_found > 0) AS total_files_with_issues, count(*) > 25 AS file_summaries_truncated FROM summaries) f,
      (SELECT count(*) AS issues_found, count(*) FILTER (WHERE severity = 'error') AS blocking_issues_found,
        count(*) FILTER (WHERE severity = 'warning') AS warnings_found, count(*) > 25 AS issues_truncated FROM issues) i""",
)
def batch_summary(spark, folder):
    return quality.validate_batch(star_tables.dirty_sales(spark, folder), today=today())[2]


@query(
    "O3.24",
    f"""{ALL_ISSUES} SELECT 'check' AS kind, "check" AS label, count(*) AS issues FROM issues GROUP BY ALL
    UNION ALL SELECT 'severity', severity, count(*) FROM issues GROUP BY ALL""",
)
def issue_counts(spark, folder):
    issues = quality.validate_batch(star_tables.dirty_sales(spark, folder), today=today())[0]
    by_check = quality.issue_counts(issues, "check").select(F.lit("check").alias("kind"), F.col("check").alias("label"), "issues")
    by_severity = quality.issue_counts(issues, "severity").select(F.lit("severity").alias("kind"), F.col("severity").alias("label"), "issues")
    return by_check.unionByName(by_severity)


@query(
    "O3.24 O3.28",
    f"""{ALL_ISSUES} SELECT upper(severity) || ' ' || "check" || coalesce(' [' || file_path || ']', '')
      || coalesce(' column=' || "column", '') || ': ' || message AS issue FROM (
    SELECT * FROM issues)""",
)
def issue_examples(spark, folder):
    """All issues as text."""
    issues = quality.validate_batch(star_tables.dirty_sales(spark, folder), today=today())[0]
    return quality.issue_examples(issues).select(quality.format_issue().alias("issue"))


@query(
    "O3.25",
    f"""WITH {t.DIRTY_SQL.replace("'sales/' || strftime(l_shipdate, '%Y-%m') || '-01.parquet'", "'frame'")}, {LONG},
    issues AS ({FILE_ISSUES}) SELECT severity, "check", "column", count, message FROM issues WHERE "check" <> 'file_partition'""",
)
def frame_report_issues(spark, folder):
    report = quality.frame_report(star_tables.dirty_sales(spark, folder), today=today())
    return report.issues.drop("file_path")


@query(
    "O3.27",
    f"""WITH {t.PANEL_SQL} SELECT store_id, count(*) AS rows FROM panel GROUP BY 1 HAVING count(*) < 300""",
)
def stores_short_of_history(spark, folder):
    from shelfspark.operators.forecast import stores_short_of_rows

    days = t.store_days(spark, folder)
    config.require_columns(days.columns, config.HISTORY_COLUMNS, "Historical input data")
    return stores_short_of_rows(days, 300)
