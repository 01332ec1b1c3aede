"""Checks of a batch of parquet files, each with columns and types of its own."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.config import QualityRules
from shelfspark.operators import quality
from shelfspark.operators.quality import FILE, ISSUE_FIELDS
from shelfspark.sources.daily import select_files

PROBED_SQL = f"{FILE} string, readable boolean, rows long, columns array<string>, layout string"
FOOTERS_SQL = f"{FILE} string, footer_rows long, columns array<string>, layout string"


def footers(spark: SparkSession, names: list[str]) -> list[tuple]:
    """(file_path, rows, columns, layout) from the end of each file, without its pages; nulls where it has no sound footer."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()

    def footer(name: str) -> tuple:
        try:
            file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        except Py4JJavaError:
            return name, None, None, None
        try:
            schema = reader.getFooter().getFileMetaData().getSchema()
            return name, reader.getRecordCount(), [schema.getFieldName(i) for i in range(schema.getFieldCount())], schema.toString()
        finally:
            reader.close()

    with ThreadPoolExecutor(8) as threads:
        return list(threads.map(footer, names))


def _decoded(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, rows) that files of one layout give when every column of theirs is decoded; a file ends where it is damaged."""
    frame = spark.read.option("ignoreCorruptFiles", "true").parquet(*paths)
    columns = [F.col(f"`{c}`").cast("string") if "map<" in kind else F.col(f"`{c}`") for c, kind in frame.dtypes]
    # The hash is there so that no column is left out of the scan.
    sums = frame.groupBy(F.col("_metadata.file_path").alias(FILE)).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("hash"))
    return sums.select(FILE, F.when(F.col("hash").isNotNull(), F.col("n")).alias("n"))


def probe(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, readable, rows, columns, layout) of each file.

    Footers are read on the driver, as a scan's schema is; rows are counted by scans that can split a file. A file is
    readable if it gives as many rows as its footer says: one that breaks off in its middle has a sound footer.
    """
    names = [r[0] for r in spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path")).collect()]
    ends = footers(spark, names)
    layouts: dict[str, list[str]] = {}
    for name, _, _, layout in ends:
        if layout is not None:
            layouts.setdefault(layout, []).append(name)
    counted = spark.createDataFrame([], f"{FILE} string, n long")
    for _, group in sorted(layouts.items()):
        counted = counted.unionByName(_decoded(spark, group))
    found = spark.createDataFrame(ends, FOOTERS_SQL).join(counted, FILE, "left")
    readable = F.col("footer_rows").isNotNull() & (F.coalesce("n", F.lit(0)) == F.col("footer_rows"))
    found = found.withColumn("readable", F.coalesce(readable, F.lit(False)))
    kept = [F.when(F.col("readable"), F.col(c)).alias(c) for c in ("columns", "layout")]
    return found.select(FILE, "readable", F.when(F.col("readable"), F.col("footer_rows")).otherwise(0).alias("rows"), *kept)


def _common(kinds: list[T.DataType], c: Column, kind: T.DataType) -> Column:
    """A column in the form that suits all files: double where all are numbers, else text."""
    if all(isinstance(k, T.NumericType) for k in kinds):
        return c.cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c).cast("string")
    return c.cast("string")


def read_files(spark: SparkSession, probed: DataFrame) -> DataFrame | None:
    """Rows of all readable files with their file. Files of one layout are one scan; what a file lacks is null."""
    layouts: dict[str, list[str]] = {}
    for r in probed.where("readable").select(FILE, "layout").collect():  # one row a selected file
        layouts.setdefault(r.layout, []).append(r[FILE])
    frames = [spark.read.parquet(*paths) for _, paths in sorted(layouts.items())]
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            kinds.setdefault(field.name, []).append(field.dataType)
    out = None
    for frame in frames:
        columns = [_common(kinds[f.name], F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in frame.schema.fields]
        part = frame.select(*columns, F.col("_metadata.file_path").alias(FILE))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _of_file(probed: DataFrame, condition: Column, check: str, text: Column, count: Column) -> DataFrame:
    found = F.inline(F.array(quality._issue("error", check, None, count, text)))
    return probed.where(condition).select(FILE, found).select(*ISSUE_FIELDS)


def file_level_issues(probed: DataFrame, rules: QualityRules) -> DataFrame:
    """Files that cannot be read, hold no rows, or lack required columns."""
    required = F.array(*[F.lit(c) for c in sorted(rules.required)])
    lacking = F.array_except(required, F.col("columns"))
    # The texts of these issues.
    listed = F.concat(F.lit("Missing required columns: ['"), F.array_join(lacking, "', '"), F.lit("']"))
    none = F.lit(None)
    parts = [
        _of_file(probed, ~F.col("readable"), "file_read", F.lit("Could not read parquet file"), none),
        _of_file(probed, F.col("readable") & (F.col("rows") == 0), "data_quality", F.lit("File contains no rows"), none),
        _of_file(probed, F.col("readable") & (F.size(lacking) > 0), "schema", listed, F.size(lacking)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def no_files_issue(spark: SparkSession) -> DataFrame:
    found = F.inline(F.array(quality._issue("error", "file_selection", None, F.lit(None), F.lit("No sales files selected for validation"))))
    return spark.range(1).select(F.lit(None).cast("string").alias(FILE), found).select(*ISSUE_FIELDS)


def validate_files(
    spark: SparkSession, files: DataFrame, max_training: Any = 0, max_validation: Any = 0, rules: QualityRules = quality.RULES, today: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(issues, file summaries, one-row summary) of parquet files (file_path): the first ones within both limits.

    Each file is checked against its own columns: one that lacks a column has a schema error, and no further issue of
    that column. Unreadable files and files without rows have a summary too. The names of the selected files, a setting
    that bounds them, are listed on the driver, as a scan needs them.
    """
    chosen = select_files(files, max_training, max_validation, FILE)
    paths = [r[0] for r in chosen.validation.select(FILE).collect()]
    about = {
        "total_files_available": chosen.available,
        "total_training_files_selected": chosen.training_count,
        "max_sales_files": int(chosen.training_limit),
        "validation_max_sales_files": int(chosen.validation_limit),
    }
    empty = spark.createDataFrame([], PROBED_SQL)
    probed = probe(spark, paths).persist() if paths else empty
    issues = file_level_issues(probed, rules) if paths else no_files_issue(spark)
    rows = read_files(spark, probed) if paths else None
    days = spark.createDataFrame([], "date date")
    if rows is not None:
        checked = quality.check_types(rows, rules)
        # What no file has is a matter of the files, not of their values.
        checked = quality.Checked(checked.rows, checked.columns, checked.numeric, rules, ())
        found = quality.batch_issues(checked, today)
        lacking = probed.select(FILE, F.col("columns").alias("_has"))
        found = found.join(lacking, FILE, "left")
        keyless = F.col("check").isin("unique_key", "cross_file_key") & F.col("column").isNull()
        has_keys = F.size(F.array_except(F.array(*[F.lit(c) for c in rules.key]), F.col("_has"))) == 0
        own = F.col("_has").isNull() | ((F.col("column").isNull() | F.array_contains("_has", F.col("column"))) & (~keyless | has_keys))
        issues = issues.unionByName(found.where(own).select(*ISSUE_FIELDS))
        if rules.date_column in checked.columns:
            days = checked.rows.select(F.col(rules.date_column).alias("date"))
    issues = issues.persist()
    summaries = quality.file_summaries(issues, probed.select(FILE, "rows"))
    summary = quality.batch_summary(issues, summaries, chosen.mode, limit=rules.max_examples)
    summary = summary.withColumn("total_rows", F.coalesce("total_rows", F.lit(0).cast("long")))
    summary = summary.withColumns({k: F.lit(v).cast("long") for k, v in about.items()})
    span = quality.date_range(days).select(F.lit(chosen.mode).alias("validation_mode"), F.col("start").alias("first_date"), F.col("end").alias("last_date"))
    return issues, summaries, summary.join(span, "validation_mode").withColumn("messages", F.array(*map(F.lit, chosen.messages())))
