"""Joining and cleaning raw rows, and normalising forecast inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.functions import text


def join_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales with store attributes; sales without a known store stay.

    No broadcast hint: the optimizer broadcasts the store table only when its size allows it.
    """
    return sales.join(stores, "Store", "left")


def unique_stores(stores: DataFrame) -> DataFrame:
    """``stores``, checked while it is read: a store number that occurs twice is an error."""
    names = [c for c in stores.columns if c != "Store"]
    once = stores.groupBy("Store").agg(F.count("*").alias("_times"), F.any_value(F.struct(*names)).alias("_row"))
    fault = F.raise_error(F.concat(F.lit("Store occurs more than once in the store table: "), F.col("Store").cast("string")))
    checked = F.when(F.col("_times") > 1, fault.cast(once.schema["_row"].dataType)).otherwise(F.col("_row"))
    return once.select("Store", checked.alias("_row")).select("Store", "_row.*")


def _filled(name: str, kind: str, default: object) -> Column:
    value = text.number(F.col(name)) if kind == "double" else F.col(name).cast(kind)
    return F.coalesce(value, F.lit(default).cast(kind))


def sales_fields() -> dict[str, Column]:
    """Prepared fields that come from the sales table."""
    school = _filled("SchoolHoliday", "int", 0)
    return {
        "date": F.to_date("Date"),
        "store_id": text.store_key(F.col("Store")),
        "sales": text.number(F.col("Sales")),
        "customer_traffic": _filled("Customers", "double", 0),
        "has_promotion": _filled("Promo", "int", 0),
        "is_open": _filled("Open", "int", 1),
        "state_holiday": text.state_holiday_code(F.col("StateHoliday")),
        "school_holiday": school,
        "is_holiday": text.holiday_flag(F.col("StateHoliday"), school),
    }


def store_fields() -> dict[str, Column]:
    """Prepared fields that come from the store table."""
    return {
        "store_type": _filled("StoreType", "string", "unknown"),
        "assortment": _filled("Assortment", "string", "unknown"),
        "competition_distance": _filled("CompetitionDistance", "double", 0),
        "promo2": _filled("Promo2", "int", 0),
        "promo_interval": _filled("PromoInterval", "string", "none"),
    }


def prepare_sales(joined: DataFrame) -> DataFrame:
    """Snake-case names, fixed types and default fills. Order is left to the consumers."""
    return joined.select(*[c.alias(name) for name, c in {**sales_fields(), **store_fields()}.items()])


def prepare_sales_only(sales: DataFrame) -> DataFrame:
    """The fields of the sales table alone; daily totals need no store attributes and no join."""
    return sales.select(*[c.alias(name) for name, c in sales_fields().items()])


def trading_rows() -> Column:
    """Condition for open stores with sales, on prepared rows."""
    return (F.col("is_open") == 1) & (F.col("sales") > 0)


def select_rows(prepared: DataFrame, include_closed_zero_sales: bool = False) -> DataFrame:
    return prepared if include_closed_zero_sales else prepared.where(trading_rows())


def combined_holiday(df: DataFrame, date_col: str = "date") -> DataFrame:
    """``is_holiday`` from the holiday columns at hand, else from the German calendar."""
    from shelfspark.functions.dates import german_public_holiday

    flags: list[Column] = []
    if "is_holiday" in df.columns:
        flags.append(text.binary_indicator(F.col("is_holiday")) == 1)
    if "state_holiday" in df.columns:
        flags.append(text.state_holiday_indicator(F.col("state_holiday")) == 1)
    if "school_holiday" in df.columns:
        flags.append(text.binary_indicator(F.col("school_holiday")) == 1)
    flag = text.any_of(flags) if flags else german_public_holiday(F.to_date(date_col))
    return df.withColumn("is_holiday", flag.cast("int"))


def categorical_columns(df: DataFrame) -> list[str]:
    return [c for c in config.CATEGORICAL_COLUMNS if c in df.columns]


def _with_derived_holiday(df: DataFrame) -> DataFrame:
    if not {"state_holiday", "school_holiday"} <= set(df.columns):
        return df
    return df.withColumn(
        "is_holiday", text.holiday_flag(F.col("state_holiday"), F.col("school_holiday"))
    )


def input_violations(df: DataFrame) -> DataFrame:
    """One row (column, rule, rows) for each forecast-input rule that is broken."""
    rules: list[tuple[str, str, Column]] = []
    for name in config.BINARY_INPUTS:
        if name in df.columns:
            value = F.col(name).try_cast("int")
            rules.append((name, "must contain only 0/1 values", ~F.coalesce(value.isin(0, 1), F.lit(False))))
    for name in config.NON_NEGATIVE_INPUTS:
        if name in df.columns:
            value = F.col(name).try_cast("double")
            bad = (value < 0) | (value.isNull() & F.col(name).isNotNull())
            rules.append((name, "cannot be negative", F.coalesce(bad, F.lit(False))))
    if not rules:
        return df.sparkSession.createDataFrame([], "column string, rule string, rows long")
    counts = df.agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), F.col(f"v{i}").alias("rows"))
            for i, (name, rule, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows)).where("rows > 0")


def normalise_inputs(df: DataFrame, check: bool = True) -> DataFrame:
    """Forecast inputs with fixed types and a derived holiday flag; broken rules raise."""
    if check:
        # At most one row per rule.
        broken = input_violations(df).collect()
        if broken:
            raise ValueError("; ".join(f"{r['column']} {r['rule']} ({r['rows']} rows)" for r in broken))
    out = df
    for name in config.BINARY_INPUTS:
        if name in df.columns:
            out = out.withColumn(name, F.col(name).cast("int"))
    for name in config.NON_NEGATIVE_INPUTS:
        if name in df.columns:
            out = out.withColumn(name, F.col(name).cast("double"))
    for name in categorical_columns(df):
        out = out.withColumn(name, F.coalesce(F.col(name).cast("string"), F.lit("none")))
    return _with_derived_holiday(out)


def to_labels(df: DataFrame) -> DataFrame:
    """0/1 inputs as No/Yes."""
    for name in config.BINARY_INPUTS:
        if name in df.columns:
            df = df.withColumn(name, text.yes_no_label(F.col(name)))
    return df


def from_labels(df: DataFrame) -> DataFrame:
    """No/Yes inputs as 0/1, with the holiday flag derived again."""
    for name in config.BINARY_INPUTS:
        if name in df.columns:
            df = df.withColumn(name, text.yes_no_value(F.col(name)))
    return _with_derived_holiday(df)


def drop_unusable(df: DataFrame, target: str = "sales", date_col: str = "date") -> DataFrame:
    """Date and target as proper types; rows without either are dropped."""
    from shelfspark.functions.dates import parsed_date

    is_text = dict(df.dtypes)[date_col] == "string"
    return (
        df.withColumn(date_col, parsed_date(F.col(date_col), is_text))
        .withColumn(target, text.number(F.col(target)))
        .dropna(subset=[date_col, target])
    )
