"""Rule-driven data checks over many files at once.

Every check counts per file with partial aggregation; the results are issue rows
(file_path, severity, check, column, count, message). A file is any label on the rows: a parquet
path, a day partition, or one constant for a whole frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.config import QualityRules
from shelfspark.functions.dates import parsed_date
from shelfspark.functions.text import finite
from shelfspark.operators.joins import sized
from shelfspark.operators.metrics import QUARTILES, iqr_bounds
from shelfspark.operators.quantiles import exact_quantiles, unpivot_numbers
from shelfspark.sources.daily import path_date

RULES = QualityRules()
FILE = "file_path"
ISSUE_FIELDS = ("file_path", "severity", "check", "column", "count", "message")
EXAMPLES = 5
SAMPLE_DATES = 10


# --- typing -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Checked:
    """Rows with typed columns; ``_bad_``/``_frac_`` columns mark what did not fit the type."""

    rows: DataFrame
    columns: tuple[str, ...]
    numeric: tuple[str, ...]
    rules: QualityRules
    missing: tuple[str, ...]


def check_types(df: DataFrame, rules: QualityRules = RULES) -> Checked:
    """Coerces every column to its expected type; what does not fit becomes null."""
    out: list[Column] = []
    numeric: list[str] = []
    columns = [c for c in df.columns if c != FILE]
    for field in df.schema.fields:
        name, raw = field.name, F.col(field.name)
        if name == FILE:
            out.append(raw)
            continue
        kind = rules.types.get(name)
        if kind == "datetime":
            typed = parsed_date(raw, isinstance(field.dataType, T.StringType))
        elif kind in ("float", "int"):
            typed = raw.try_cast("double")
            typed = F.when(~F.isnan(typed), typed)
            numeric.append(name)
        else:
            typed = raw
            if isinstance(field.dataType, T.NumericType):
                numeric.append(name)
        out.append(typed.alias(name))
        if kind in ("datetime", "float", "int"):
            present = ~F.isnan(raw) & raw.isNotNull() if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else raw.isNotNull()
            out.append((present & typed.isNull()).alias(f"_bad_{name}"))
        if kind == "int":
            # Infinity has no whole-number form either.
            fractional = typed.isNotNull() & ((typed % 1 != 0) | F.isnan(typed % 1))
            out.append(fractional.alias(f"_frac_{name}"))
    if FILE not in df.columns:
        out.append(F.lit("frame").alias(FILE))
    missing = tuple(sorted(set(rules.required) - set(df.columns)))
    return Checked(df.select(*out), tuple(columns), tuple(numeric), rules, missing)


# --- issue rows ---------------------------------------------------------------------------


def _issue(severity: str, check: str, column: str | None, count: Column, message: Column) -> Column:
    return F.struct(
        F.lit(severity).alias("severity"),
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        count.cast("long").alias("count"),
        message.alias("message"),
    )


def _said(count: Column, text: str) -> Column:
    return F.concat(count.cast("string"), F.lit(text))


def _explode_issues(wide: DataFrame, issues: list[Column], fires: list[Column]) -> DataFrame:
    kept = [F.when(fire, issue) for fire, issue in zip(fires, issues)]
    return wide.select(FILE, F.inline(F.array_compact(F.array(*kept))))


def _number_text(value: float) -> str:
    return str(int(value)) if float(value).is_integer() else str(value)


def count_issues(checked: Checked, today: Column | None = None) -> DataFrame:
    """All checks that are plain counts, from one aggregation per file.

    Covers types, nulls, infinite values, ranges, binary domains, empty date columns, future
    dates, and whether a file holds the one day its path names.
    """
    rules, present = checked.rules, set(checked.columns)
    counts: dict[str, Column] = {"rows": F.count("*")}
    issues: list[Column] = []
    fires: list[Column] = []

    def add(name: str, condition: Column, severity: str, check: str, column: str, text: str) -> None:
        counts[name] = F.count_if(condition)
        issues.append(_issue(severity, check, column, F.col(name), _said(F.col(name), text)))
        fires.append(F.col(name) > 0)

    for name, kind in rules.types.items():
        if name not in present or kind == "text":
            continue
        what = "cannot be parsed as datetime" if kind == "datetime" else f"cannot be converted to {kind}64"
        add(f"bad_{name}", F.col(f"_bad_{name}"), "error", "schema", name, f" value(s) {what}")
        if kind == "int":
            add(f"frac_{name}", F.col(f"_frac_{name}"), "error", "schema", name, " non-integer value(s) found")
    for name in rules.non_null:
        if name in present:
            add(f"null_{name}", F.col(name).isNull(), "error", "nulls", name, " null value(s) in required column")
    for name in checked.numeric:
        value = F.col(name)
        add(f"inf_{name}", F.abs(value) == float("inf"), "error", "numeric_values", name, " infinite value(s)")
        low, high = rules.ranges.get(name, (None, None))
        if low is not None:
            add(f"low_{name}", finite(value) < low, "error", "value_range", name, f" value(s) below minimum {_number_text(low)}")
        if high is not None:
            add(f"high_{name}", finite(value) > high, "error", "value_range", name, f" value(s) above maximum {_number_text(high)}")
    if rules.date_column in present:
        day = F.col(rules.date_column)
        if rules.warn_on_future:
            severity = "error" if rules.fail_on_future else "warning"
            add("future", day > (F.current_date() if today is None else today), severity, "time_series", rules.date_column, " future-dated row(s)")
        counts["first_day"] = F.min(day)
        counts["last_day"] = F.max(day)
        issues.append(_issue("error", "time_series", rules.date_column, F.lit(None), F.lit(f"No valid values in date column {rules.date_column}")))
        fires.append(F.col("last_day").isNull())
        named = path_date(F.col(FILE))
        issues.append(
            _issue(
                "error",
                "file_partition",
                rules.date_column,
                F.lit(None),
                F.concat(
                    F.lit("File partition date does not match row date ("),
                    named.cast("string"),
                    F.lit(" != "),
                    F.col("first_day").cast("string"),
                    F.lit(")"),
                ),
            )
        )
        fires.append((F.col("first_day") == F.col("last_day")) & (F.col("first_day") != named))
    wide = checked.rows.groupBy(FILE).agg(*[c.alias(name) for name, c in counts.items()])
    return _explode_issues(wide, issues, fires)


def missing_column_issues(checked: Checked, files: DataFrame) -> DataFrame:
    """One schema error per file while required columns are absent."""
    missing = list(checked.missing)
    return files.where(F.lit(bool(missing))).select(
        FILE, F.inline(F.array(_issue("error", "schema", None, F.lit(len(missing)), F.lit(f"Missing required columns: {missing}"))))
    )


def binary_issues(checked: Checked) -> DataFrame:
    """Values outside 0/1, with the five smallest distinct ones as examples.

    Values are counted before they are ranked, so a value that fills a file is one row.
    """
    columns = [c for c in checked.rules.binary if c in checked.columns]
    if not columns:
        return _no_issues(checked.rows)
    long = unpivot_numbers(checked.rows, [FILE], columns)
    wrong = long.where(F.col("value").isNotNull() & ~F.col("value").isin(0.0, 1.0))
    values = wrong.groupBy(FILE, "column", "value").count()
    place = F.row_number().over(W.partitionBy(FILE, "column").orderBy("value"))
    total = values.groupBy(FILE, "column").agg(F.sum("count").alias("count"))
    examples = (
        values.withColumn("_place", place)
        .where(F.col("_place") <= EXAMPLES)
        .groupBy(FILE, "column")
        .agg(F.array_sort(F.collect_list("value")).alias("_examples"))
    )
    return total.join(examples, [FILE, "column"]).select(
        FILE,
        F.lit("error").alias("severity"),
        F.lit("binary_domain").alias("check"),
        "column",
        "count",
        F.concat(
            F.col("count").cast("string"),
            F.lit(" non-binary value(s); examples=["),
            F.array_join(F.col("_examples").cast("array<string>"), ", "),
            F.lit("]"),
        ).alias("message"),
    )


def key_counts(checked: Checked) -> DataFrame:
    """(file_path, key columns and date, rows): the basis of all checks on keys and days.

    Reports that run several of those checks persist it once and pass it to each.
    """
    wanted = [*checked.rules.key, checked.rules.date_column]
    columns = [c for c in dict.fromkeys(wanted) if c in checked.columns]
    return checked.rows.groupBy(FILE, *columns).agg(F.count("*").alias("rows"))


def _keys(checked: Checked, keys: DataFrame | None) -> DataFrame:
    return key_counts(checked) if keys is None else keys


def _has_key(checked: Checked) -> bool:
    return set(checked.rules.key) <= set(checked.columns)


def _rows_per_key(checked: Checked, keys: DataFrame | None) -> DataFrame:
    """(file_path, key columns, rows).

    Key counts already are that where the date is part of the key: a second aggregation by the same
    columns would hold all keys of a task once more.
    """
    counted = _keys(checked, keys)
    if checked.rules.date_column in checked.rules.key or checked.rules.date_column not in checked.columns:
        return counted
    return counted.groupBy(FILE, *checked.rules.key).agg(F.sum("rows").alias("rows"))


def rows_per_file(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    return _keys(checked, keys).groupBy(FILE).agg(F.sum("rows").alias("rows"))


def file_day_counts(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    """(file_path, days): distinct days per file."""
    day = checked.rules.date_column
    pairs = _keys(checked, keys).where(F.col(day).isNotNull()).select(FILE, day).distinct()
    return pairs.groupBy(FILE).agg(F.count("*").alias("days"))


def many_days_issues(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    """Files that hold more than one day."""
    many = file_day_counts(checked, keys).where("days > 1")
    text = F.concat(F.lit("Sales parquet files should contain one sales date; found "), F.col("days").cast("string"))
    return many.select(FILE, F.inline(F.array(_issue("error", "file_partition", checked.rules.date_column, F.col("days"), text))))


def duplicate_row_issues(checked: Checked) -> DataFrame:
    """Rows beyond the first of each exact copy; nulls count as equal."""
    copies = checked.rows.groupBy(FILE, *checked.columns).count().where("count > 1")
    extra = copies.groupBy(FILE).agg(F.sum(F.col("count") - 1).alias("count"))
    text = F.concat(F.lit("Found "), F.col("count").cast("string"), F.lit(" exact duplicate row(s)"))
    return extra.select(FILE, F.inline(F.array(_issue("warning", "duplicate_rows", None, F.col("count"), text))))


def duplicate_key_issues(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    """Repeated keys inside one file; null keys count as equal."""
    if not _has_key(checked):
        return _no_issues(checked.rows)
    key = list(checked.rules.key)
    per_key = _rows_per_key(checked, keys).where("rows > 1")
    extra = per_key.groupBy(FILE).agg(F.sum(F.col("rows") - 1).alias("count"))
    text = F.concat(F.lit("Found "), F.col("count").cast("string"), F.lit(f" duplicate row(s) at grain {key}"))
    return extra.select(FILE, F.inline(F.array(_issue("error", "unique_key", None, F.col("count"), text))))


def cross_file_key_counts(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    """(file_path, count): rows whose key is already in an earlier file, by file name.

    Keys are compared exactly; rows without a full key are left out. Keys are counted per file
    first, so the window sees each key at most once per file.
    """
    key = list(checked.rules.key)
    per_file = _rows_per_key(checked, keys).dropna(subset=key)
    earliest = F.min(FILE).over(W.partitionBy(*key))
    return (
        per_file.withColumn("_earliest", earliest)
        .where(F.col("_earliest") < F.col(FILE))
        .groupBy(FILE)
        .agg(F.sum("rows").alias("count"))
    )


def cross_file_key_issues(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    if not _has_key(checked):
        return _no_issues(checked.rows)
    text = F.concat(
        F.lit("Found "),
        F.col("count").cast("string"),
        F.lit(f" row(s) at grain {list(checked.rules.key)} already present in earlier files"),
    )
    return cross_file_key_counts(checked, keys).select(
        FILE, F.inline(F.array(_issue("error", "unique_key", None, F.col("count"), text)))
    )


# --- outliers -----------------------------------------------------------------------------


def outlier_counts(rows: DataFrame, columns: Sequence[str], method: str = "iqr", keys: Sequence[str] = (FILE,)) -> DataFrame:
    """(keys, column, outliers) over finite values.

    ``iqr``: outside 1.5 spreads around the quartiles, none without spread. ``zscore``: more than
    three sample deviations from the mean. All columns are counted in one pass per step.
    """
    numbers = rows.select(*keys, *[finite(F.col(c)).alias(c) for c in columns])
    if method == "iqr":
        quartiles = iqr_bounds(exact_quantiles(numbers, keys, columns, QUARTILES))
        spread = F.col("q3") != F.col("q1")
        limits = quartiles.select(
            *keys, "column", F.struct(F.when(spread, F.col("lower_bound")).alias("low"), F.when(spread, F.col("upper_bound")).alias("high")).alias("_limits")
        )
    elif method == "zscore":
        moments = unpivot_numbers(numbers, keys, columns).groupBy(*keys, "column").agg(
            F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_std")
        )
        reach = 3 * F.when(F.col("_std") > 0, F.col("_std"))
        limits = moments.select(*keys, "column", F.struct((F.col("_mean") - reach).alias("low"), (F.col("_mean") + reach).alias("high")).alias("_limits"))
    else:
        raise ValueError(f"Unknown outlier method {method!r}")
    # One row per key: the limits of its columns.
    anchor = [*keys] or [F.lit(0).alias("_all")]
    per_key = limits.groupBy(*anchor).agg(F.map_from_entries(F.collect_list(F.struct("column", "_limits"))).alias("_by_column"))
    names = [*keys] or ["_all"]
    joined = numbers.select(*anchor, *columns).join(sized(per_key), names)

    def outside(c: str) -> Column:
        limit = F.col("_by_column")[c]
        return (F.col(c) < limit["low"]) | (F.col(c) > limit["high"])

    counts = joined.groupBy(*names).agg(*[F.when(F.count(c) > 0, F.count_if(outside(c))).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers")) for c in columns])
    return counts.select(*keys, F.inline(pairs)).where(F.col("outliers").isNotNull())


def outlier_issues(checked: Checked, rows_per_file: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Warns where outliers exceed the allowed share of a file's rows. ``counts`` are those of ``outlier_counts``, if known."""
    limit = checked.rules.max_outlier_share
    counts = outlier_counts(checked.rows, checked.numeric) if counts is None else counts
    over = counts.join(rows_per_file, FILE).where(F.col("outliers") / F.col("rows") * 100 > limit)
    return over.select(
        FILE,
        F.lit("warning").alias("severity"),
        F.lit("outliers").alias("check"),
        "column",
        F.col("outliers").alias("count"),
        F.concat(F.col("outliers").cast("string"), F.lit(f" outlier value(s), above {limit:.1f}% threshold")).alias("message"),
    )


# --- dates --------------------------------------------------------------------------------


def missing_dates(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Days between the first and last day that do not occur. ``dates`` may repeat days."""
    days = dates.where(F.col(date_col).isNotNull()).select(F.to_date(date_col).alias("date")).distinct()
    expected = days.agg(F.min("date").alias("low"), F.max("date").alias("high")).where("low IS NOT NULL")
    calendar = expected.select(F.explode(F.sequence("low", "high", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar.join(days, "date", "left_anti")


def date_range(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One row: first and last day, days between them, distinct days."""
    days = df.where(F.col(date_col).isNotNull()).select(F.to_date(date_col).alias("d")).distinct()
    return days.agg(
        F.min("d").alias("start"),
        F.max("d").alias("end"),
        F.datediff(F.max("d"), F.min("d")).alias("days"),
        F.count("*").alias("unique_dates"),
    )


def batch_gap_issue(checked: Checked, keys: DataFrame | None = None) -> DataFrame:
    """One warning for all missing days, with the first ten as a sample."""
    day = checked.rules.date_column
    gaps = missing_dates(_keys(checked, keys).select(F.col(day).alias("date")))
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("date"))
    sample = F.array_sort(F.collect_list(F.when(F.col("_place") <= SAMPLE_DATES, F.col("date").cast("string"))))
    summary = gaps.withColumn("_place", place).agg(F.count("*").alias("count"), sample.alias("_sample")).where("count > 0")
    text = F.concat(
        F.lit("Missing "),
        F.col("count").cast("string"),
        F.lit(" date(s) between selected validation files; sample=["),
        F.array_join("_sample", ", "),
        F.lit("]"),
    )
    return summary.select(
        F.lit(None).cast("string").alias(FILE),
        F.inline(F.array(_issue("warning", "time_series", None, F.col("count"), text))),
    )


def group_gaps(df: DataFrame, groups: Sequence[str] = ("store_id",), date_col: str = "date", limit: int | None = None) -> DataFrame:
    """Groups with missing days: how many, and the longest step. A ``limit`` shows the first groups only,
    with the number of all of them beside each."""
    days = (
        df.where(F.col(date_col).isNotNull())
        .dropna(subset=list(groups))
        .select(*groups, F.to_date(date_col).alias("_d"))
        .distinct()
    )
    step = F.datediff("_d", F.lag("_d").over(W.partitionBy(*groups).orderBy("_d")))
    report = (
        days.withColumn("_step", step)
        .groupBy(*groups)
        .agg(
            (F.datediff(F.max("_d"), F.min("_d")) + 1 - F.count("*")).alias("gap_count"),
            F.max("_step").alias("max_gap_days"),
        )
        .where("gap_count > 0")
    )
    if limit is None:
        return report
    total = report.agg(F.count("*").alias("n")).scalar()
    return report.orderBy(*groups).limit(limit).withColumn("groups_with_gaps", total)


# --- profile ------------------------------------------------------------------------------


def column_profile(checked: Checked, outliers: DataFrame | None = None) -> DataFrame:
    """One row per column: nulls, distinct values, moments and outliers of finite numbers.

    Distinct values are counted on (column, value) pairs after a partial aggregation, not held
    as one set per column.
    """
    columns = list(checked.columns)

    def shown(c: str) -> Column:
        # Adding zero makes minus zero and zero the same value.
        value = F.col(c) + F.lit(0.0) if c in checked.numeric else F.col(c)
        return value.cast("string")

    texts = F.array(*[F.struct(F.lit(c).alias("column"), shown(c).alias("text")) for c in columns])
    pairs = checked.rows.select(F.inline(texts)).groupBy("column", "text").count()
    base = pairs.groupBy("column").agg(
        F.sum(F.when(F.col("text").isNull(), F.col("count")).otherwise(0)).alias("null_count"),
        F.sum("count").alias("_rows"),
        F.count("text").alias("unique_values"),
    )
    numbers = unpivot_numbers(checked.rows, [], checked.numeric)
    value = finite(F.col("value"))
    moments = numbers.groupBy("column").agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    outliers = outlier_counts(checked.rows, checked.numeric, keys=()) if outliers is None else outliers
    return (
        base.join(F.broadcast(moments), "column", "left")
        .join(F.broadcast(outliers), "column", "left")
        .select(
            "column",
            "null_count",
            (F.col("null_count") / F.col("_rows") * 100).alias("null_percentage"),
            "unique_values",
            "mean",
            "std",
            "min",
            "max",
            "outliers",
        )
    )


def prediction_shift(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns whose mean moved by more than three train deviations."""
    def stats(frame: DataFrame, names: tuple[str, str]) -> DataFrame:
        return unpivot_numbers(frame, [], columns).groupBy("column").agg(
            F.avg("value").alias(names[0]), F.stddev_samp("value").alias(names[1])
        )

    both = stats(df, ("pred_mean", "_s")).join(stats(train, ("train_mean", "train_std")), "column")
    moved = (F.col("train_std") != 0) & (F.abs(F.col("pred_mean") - F.col("train_mean")) > 3 * F.col("train_std"))
    return both.where(moved).select("column", "train_mean", "train_std", "pred_mean")


def schema_issues(checked: Checked) -> DataFrame:
    """Absent columns and values that do not fit their type."""
    missing = missing_column_issues(checked, rows_per_file(checked))
    misfits = count_issues(checked).where(F.col("check") == "schema")
    return missing.unionByName(misfits).select(*ISSUE_FIELDS)


def prediction_data_issues(df: DataFrame, train: DataFrame, rules: QualityRules = RULES) -> DataFrame:
    """Schema issues of rows to be scored, and columns whose mean left the train range."""
    checked = check_types(df, rules)
    known = check_types(train, rules)
    columns = [c for c in checked.numeric if c in known.numeric]
    text = F.format_string("Potential distribution shift: mean changed from %.2f to %.2f", "train_mean", "pred_mean")
    shifts = prediction_shift(checked.rows, known.rows, columns).select(
        F.lit(None).cast("string").alias(FILE),
        F.lit("error").alias("severity"),
        F.lit("distribution_shift").alias("check"),
        "column",
        F.lit(None).cast("long").alias("count"),
        text.alias("message"),
    )
    return schema_issues(checked).unionByName(shifts)


# --- declarative rules --------------------------------------------------------------------


def rule_table(rules: QualityRules = RULES, domains: dict[str, tuple[str, ...]] | None = None) -> list[tuple[str, str, object]]:
    """(column, rule, limit) for every type, bound and domain; nulls always pass."""
    table: list[tuple[str, str, object]] = []
    for column, kind in rules.types.items():
        table.append((column, "type", kind))
        low, high = rules.ranges.get(column, (None, None))
        if low is not None:
            table.append((column, "min", low))
        if high is not None:
            table.append((column, "max", high))
    for column, allowed in (domains or {}).items():
        table.append((column, "domain", allowed))
    return table


def apply_rule_table(checked: Checked, table: list[tuple[str, str, object]]) -> DataFrame:
    """(column, rule, violations) of each rule, all from one aggregation."""
    def breaks(column: str, rule: str, limit: object) -> Column:
        value = F.col(column)
        if rule == "type":
            if limit == "text":
                return F.lit(False)
            bad = F.col(f"_bad_{column}")
            return bad | F.col(f"_frac_{column}") if limit == "int" else bad
        if rule == "min":
            return value < limit
        if rule == "max":
            return value > limit
        return ~value.isin(*limit)

    usable = [r for r in table if r[0] in checked.columns]
    wide = checked.rows.agg(*[F.count_if(breaks(*r)).alias(f"r{i}") for i, r in enumerate(usable)])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (c, rule, _) in enumerate(usable)
        ]
    )
    return wide.select(F.inline(rows))


# --- whole reports ------------------------------------------------------------------------


def _no_issues(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "file_path string, severity string, check string, column string, count long, message string"
    )


def file_issues(checked: Checked, today: Column | None = None, keys: DataFrame | None = None, outliers: DataFrame | None = None) -> DataFrame:
    """All issues that belong to a file."""
    keys = key_counts(checked).persist() if keys is None else keys
    rows = sized(rows_per_file(checked, keys))
    parts = [
        missing_column_issues(checked, rows),
        count_issues(checked, today),
        binary_issues(checked),
        duplicate_row_issues(checked),
        duplicate_key_issues(checked, keys),
        outlier_issues(checked, rows, outliers),
    ]
    if checked.rules.date_column in checked.columns:
        parts.append(many_days_issues(checked, keys))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*ISSUE_FIELDS)


def batch_issues(checked: Checked, today: Column | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Issues of every file, keys repeated across files, and days missing from the batch."""
    keys = key_counts(checked).persist() if keys is None else keys
    out = file_issues(checked, today, keys).unionByName(cross_file_key_issues(checked, keys).select(*ISSUE_FIELDS))
    if checked.rules.date_column in checked.columns:
        out = out.unionByName(batch_gap_issue(checked, keys).select(*ISSUE_FIELDS))
    return out


def empty_input_issue(df: DataFrame) -> DataFrame:
    """One error when there are no rows at all."""
    one = df.agg(F.count("*").alias("rows")).where("rows = 0")
    return one.select(
        F.lit(None).cast("string").alias(FILE),
        F.inline(F.array(_issue("error", "data_quality", None, F.lit(None), F.lit("File contains no rows")))),
    )


def unreadable_files(listed: DataFrame, read: DataFrame) -> DataFrame:
    """Listed files that gave no rows when corrupt files were skipped."""
    gone = listed.select(FILE).distinct().join(read.select(FILE).distinct(), FILE, "left_anti")
    return gone.select(
        FILE, F.inline(F.array(_issue("error", "file_read", None, F.lit(None), F.lit("Could not read parquet file"))))
    )


def file_summaries(issues: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per file, also for clean ones. The set of checks is bounded by the rules."""
    per_file = issues.groupBy(FILE).agg(
        F.count("*").alias("issues_found"),
        F.count_if(F.col("severity") == "error").alias("blocking_issues_found"),
        F.count_if(F.col("severity") == "warning").alias("warnings_found"),
        F.array_join(F.array_sort(F.collect_set("check")), ",").alias("checks_failed"),
    )
    return rows.join(per_file, FILE, "left").select(
        FILE,
        "rows",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("issues_found", "blocking_issues_found", "warnings_found")],
        F.coalesce("checks_failed", F.lit("")).alias("checks_failed"),
    )


def issue_counts(issues: DataFrame, by: str) -> DataFrame:
    return issues.groupBy(by).agg(F.count("*").alias("issues"))


def issue_examples(issues: DataFrame, limit: int | None = None) -> DataFrame:
    """Issues in order of their file. A ``limit`` shows the first ones only, with the number of all beside each."""
    ordered = issues.orderBy(F.asc_nulls_last(FILE), "check", F.asc_nulls_first("column"), "message")
    if limit is None:
        return ordered
    total = issues.agg(F.count("*").alias("n")).scalar()
    return ordered.limit(limit).withColumn("issues_found", total)


def batch_summary(issues: DataFrame, summaries: DataFrame, mode: str = "full", available: int | None = None, limit: int = RULES.max_examples) -> DataFrame:
    """One row of totals for a validated batch."""
    files = summaries.agg(
        F.count("*").alias("total_files_validated"),
        F.sum("rows").alias("total_rows"),
        F.count_if(F.col("issues_found") > 0).alias("total_files_with_issues"),
        (F.count("*") > limit).alias("file_summaries_truncated"),
    )
    found = issues.agg(
        F.count("*").alias("issues_found"),
        F.count_if(F.col("severity") == "error").alias("blocking_issues_found"),
        F.count_if(F.col("severity") == "warning").alias("warnings_found"),
        (F.count("*") > limit).alias("issues_truncated"),
    )
    mode_col = F.lit(mode).alias("validation_mode")
    out = files.select(mode_col, "*").join(found.select(mode_col, "*"), "validation_mode")
    if available is not None:
        out = out.withColumn("total_files_available", F.lit(available).cast("long"))
    return out


def format_issue() -> Column:
    """``SEVERITY check [file] column=c: message`` on issue rows."""
    return F.concat(
        F.upper("severity"),
        F.lit(" "),
        F.col("check"),
        F.coalesce(F.concat(F.lit(" ["), F.col(FILE), F.lit("]")), F.lit("")),
        F.coalesce(F.concat(F.lit(" column="), F.col("column")), F.lit("")),
        F.lit(": "),
        F.col("message"),
    )


@dataclass(frozen=True)
class FrameReport:
    """Result tables for one frame; ``is_valid`` is one row."""

    issues: DataFrame
    profile: DataFrame
    date_range: DataFrame
    gaps: DataFrame
    is_valid: DataFrame


def frame_report(df: DataFrame, rules: QualityRules = RULES, today: Column | None = None) -> FrameReport:
    """Schema, quality and time-series results of a whole frame, with the verdict."""
    # A frame is one unit here, so the per-path checks do not apply.
    checked = check_types(df.drop(FILE), rules)
    # Issues and profile count the same outliers: their quartiles are found once.
    outliers = outlier_counts(checked.rows, checked.numeric)
    issues = file_issues(checked, today, outliers=outliers).where(F.col("check") != "file_partition").unionByName(
        empty_input_issue(df).select(*ISSUE_FIELDS)
    )
    verdict = issues.agg(
        (F.count_if(F.col("severity") == "error") == 0).alias("is_valid"), F.count("*").alias("issues_found")
    )
    day = rules.date_column
    dated = checked.rows.select(F.col(day).alias("date")) if day in checked.columns else None
    empty = df.sparkSession.createDataFrame([], "date date")
    return FrameReport(
        issues,
        column_profile(checked, outliers.drop(FILE)),
        date_range(empty if dated is None else dated),
        missing_dates(empty if dated is None else dated),
        verdict,
    )


def validate_batch(df: DataFrame, rules: QualityRules = RULES, today: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(issues, file summaries, one-row summary) of rows that carry their file."""
    checked = check_types(df, rules)
    keys = key_counts(checked).persist()
    issues = batch_issues(checked, today, keys).persist()
    summaries = file_summaries(issues, rows_per_file(checked, keys))
    return issues, summaries, batch_summary(issues, summaries, limit=rules.max_examples)


def is_blocking(issues: DataFrame) -> bool:
    return not issues.where(F.col("severity") == "error").isEmpty()

