"""Queries on cleaning, flags, calendar and interaction columns."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.functions import dates, text
from shelfspark.operators import clean, features
from shelfspark.plans import tables as t
from shelfspark.plans.catalog import query, rounded
from shelfspark.sources import star_tables


@query("O2.1 O2.2 O2.3 O2.4 O4.1", f"WITH {t.PREPARED_SQL} SELECT * FROM prepared")
def prepared_sales(spark, folder):
    return t.prepared(spark, folder)


@query("O1.3", f"WITH {t.PREPARED_SQL} SELECT * FROM prepared WHERE is_open = 1 AND sales > 0")
def trading_sales(spark, folder):
    return clean.select_rows(t.prepared(spark, folder))


@query("O1.3", f"WITH {t.PREPARED_SQL} SELECT date, count(*) AS rows, sum(sales) AS sales FROM prepared GROUP BY date")
def full_rows_per_day(spark, folder):
    rows = clean.select_rows(t.prepared(spark, folder), include_closed_zero_sales=True)
    return rows.groupBy("date").agg(F.count("*").alias("rows"), F.sum("sales").alias("sales"))


@query(
    "O2.2",
    "SELECT p_partkey * p_size AS number, "
    + t.STORE_ID_SQL.format("p_partkey * p_size")
    + " AS store_id FROM part",
)
def store_keys(spark, folder):
    number = F.col("p_partkey") * F.col("p_size")
    return star_tables.read_table(spark, folder, "part").select(
        number.alias("number"), text.store_key(number).alias("store_id")
    )


@query(
    "O2.3 O2.5",
    f"""WITH {t.RAW_SALES_SQL}
    SELECT StateHoliday AS raw, {t.STATE_SQL.format('StateHoliday')} AS code,
      CAST({t.STATE_SQL.format('StateHoliday')} <> 'none' AS INTEGER) AS indicator, count(*) AS rows
    FROM raw_sales GROUP BY ALL""",
)
def state_holiday_codes(spark, folder):
    raw = F.col("StateHoliday")
    return (
        star_tables.raw_sales(spark, folder)
        .select(raw.alias("raw"), text.state_holiday_code(raw).alias("code"), text.state_holiday_indicator(raw).alias("indicator"))
        .groupBy("raw", "code", "indicator")
        .agg(F.count("*").alias("rows"))
    )


@query(
    "O2.6",
    """WITH flags AS (SELECT CASE l_linenumber WHEN 1 THEN ' Yes' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN '2.5'
      WHEN 5 THEN 'n' WHEN 6 THEN NULL ELSE 'y' END AS raw, l_quantity FROM lineitem)
    SELECT raw, CAST(coalesce(TRY_CAST(raw AS DOUBLE), 0) <> 0
        OR lower(trim(coalesce(raw, ''))) IN ('true', 'yes', 'y') AS INTEGER) AS flag,
      count(*) AS rows, sum(l_quantity) AS quantity FROM flags GROUP BY ALL""",
)
def binary_flags(spark, folder):
    c = F.col("l_linenumber")
    raw = (
        F.when(c == 1, " Yes").when(c == 2, "TRUE").when(c == 3, "0").when(c == 4, "2.5").when(c == 5, "n").when(c != 6, "y")
    )
    line = star_tables.read_table(spark, folder, "lineitem")
    return (
        line.select(raw.alias("raw"), "l_quantity")
        .groupBy("raw", text.binary_indicator(F.col("raw")).alias("flag"))
        .agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))
    )


@query(
    "O2.7",
    f"""WITH {t.PREPARED_SQL}
    SELECT state_holiday, school_holiday, CAST(is_holiday <> 0 OR state_holiday <> 'none' OR school_holiday <> 0 AS INTEGER)
      AS is_holiday, count(*) AS rows FROM prepared GROUP BY ALL""",
)
def combined_holidays(spark, folder):
    return (
        clean.combined_holiday(t.prepared(spark, folder))
        .groupBy("state_holiday", "school_holiday", "is_holiday")
        .agg(F.count("*").alias("rows"))
    )


EASTER_SQL = """years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
a AS (SELECT y, y % 19 AS g, y // 100 AS c FROM years),
b AS (SELECT *, (c - c // 4 - (8 * c + 13) // 25 + 19 * g + 15) % 30 AS h FROM a),
d AS (SELECT *, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - g) // 11)) AS i FROM b),
e AS (SELECT *, i - (y + y // 4 + i + 2 - c + c // 4) % 7 AS l FROM d),
easter AS (SELECT y, make_date(y, 3 + (l + 40) // 44, l + 28 - 31 * ((3 + (l + 40) // 44) // 4)) AS sunday FROM e)"""


@query(
    "O2.7",
    f"""WITH {EASTER_SQL}, days AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1)
    SELECT date, orders, CAST((month(date), day(date)) IN ((1, 1), (5, 1), (12, 25), (12, 26))
        OR ((month(date), day(date)) = (10, 3) AND y >= 1990) OR ((month(date), day(date)) = (10, 31) AND y = 2017)
        OR (month(date) = 11 AND day(date) BETWEEN 16 AND 22 AND isodow(date) = 3 AND y BETWEEN 1990 AND 1994)
        OR date_diff('day', sunday, date) IN (-2, 1, 39, 50) AS INTEGER) AS is_holiday
    FROM days JOIN easter ON year(date) = y""",
)
def german_holidays(spark, folder):
    days = (
        star_tables.read_table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(F.count("*").alias("orders"))
    )
    return clean.combined_holiday(days)


@query(
    "O2.8",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
      CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek,
      CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(week(o_orderdate) AS INTEGER) AS weekofyear,
      CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend FROM orders""",
)
def calendar_parts(spark, folder):
    orders = star_tables.read_table(spark, folder, "orders")
    return features.date_features(orders, "o_orderdate").select("o_orderkey", *config.DATE_PARTS)


@query(
    "O2.9",
    "SELECT o_orderkey, "
    + ", ".join(
        f"round({fn}(2 * pi() * {part}(o_orderdate){shift} / {n}), 6) AS {name}_{fn}"
        for name, part, shift, n in (("month", "month", "", 12), ("day", "day", "", 31))
        for fn in ("sin", "cos")
    )
    + ", "
    + ", ".join(f"round({fn}(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) AS dayofweek_{fn}" for fn in ("sin", "cos"))
    + " FROM orders",
)
def cyclical_parts(spark, folder):
    orders = star_tables.read_table(spark, folder, "orders")
    return rounded(features.cyclical_features(orders, "o_orderdate").select("o_orderkey", *dates.cyclical_parts(F.lit(None).cast("date"))), 6)


PAIRS = list(itertools.combinations(config.CATEGORICAL_COLUMNS, 2))


@query(
    "O2.10 O2.14",
    f"WITH {t.PANEL_SQL} SELECT date, store_id, "
    + ", ".join(f"{a} || '_' || {b} AS {a}_{b}_interaction" for a, b in PAIRS)
    + " FROM panel",
)
def category_interactions(spark, folder):
    days = t.store_days(spark, folder)
    crossed = features.interaction_features(days, clean.categorical_columns(days))
    return crossed.select("date", "store_id", *[f"{a}_{b}_interaction" for a, b in PAIRS])


@query(
    "O2.11",
    f"""WITH {t.PANEL_SQL}, gaps AS (SELECT date, store_id, CASE WHEN customer_traffic <> 20 THEN customer_traffic END
        AS customer_traffic, lag(sales, 7) OVER (PARTITION BY store_id ORDER BY date) AS sales_lag_7,
        CAST(CASE WHEN state_holiday <> 'a' THEN is_holiday END AS INTEGER) AS state_holiday_flag FROM panel)
    SELECT date, store_id, round(coalesce(customer_traffic, (SELECT avg(customer_traffic) FROM gaps)), 4) AS customer_traffic,
      coalesce(sales_lag_7, 0) AS sales_lag_7,
      round(coalesce(state_holiday_flag, (SELECT avg(state_holiday_flag) FROM gaps)), 4) AS state_holiday_flag
    FROM gaps""",
)
def imputed_features(spark, folder):
    days = t.store_days(spark, folder)
    lagged = features.lag_features(days, cfg=config.FeatureConfig(lags=(7,)))
    gaps = lagged.select(
        "date",
        "store_id",
        F.when(F.col("customer_traffic") != 20, F.col("customer_traffic")).alias("customer_traffic"),
        "sales_lag_7",
        F.when(F.col("state_holiday") != "a", F.col("is_holiday")).alias("state_holiday_flag"),
    )
    return rounded(features.impute(gaps))


@query(
    "O2.12",
    f"""WITH {t.PREPARED_SQL}
    SELECT date, store_id, sales, has_promotion, is_open, school_holiday, state_holiday, promo2, competition_distance,
      CAST(state_holiday <> 'none' OR school_holiday = 1 AS INTEGER) AS is_holiday
    FROM prepared""",
)
def normalised_inputs(spark, folder):
    rows = clean.normalise_inputs(t.prepared(spark, folder).drop("is_holiday"))
    return rows.select(
        "date", "store_id", "sales", "has_promotion", "is_open", "school_holiday", "state_holiday", "promo2", "competition_distance", "is_holiday"
    )


@query(
    "O2.12",
    f"""WITH {t.DIRTY_SQL}
    SELECT 'has_promotion' AS "column", 'must contain only 0/1 values' AS rule, count(*) AS rows FROM dirty
      WHERE NOT coalesce(trunc(has_promotion) IN (0, 1), false) HAVING count(*) > 0
    UNION ALL SELECT 'is_open', 'must contain only 0/1 values', count(*) FROM dirty
      WHERE NOT coalesce(trunc(is_open) IN (0, 1), false) HAVING count(*) > 0
    UNION ALL SELECT 'sales', 'cannot be negative', count(*) FROM dirty WHERE coalesce(TRY_CAST(sales AS DOUBLE) < 0,
      sales IS NOT NULL) HAVING count(*) > 0
    UNION ALL SELECT 'customer_traffic', 'cannot be negative', count(*) FROM dirty WHERE customer_traffic < 0
      HAVING count(*) > 0""",
)
def input_violations(spark, folder):
    return clean.input_violations(star_tables.dirty_sales(spark, folder))


LABEL_SQL = "CASE WHEN {0} = 1 THEN 'Yes' ELSE 'No' END AS {0}"


@query(
    "O2.13",
    f"""WITH {t.PREPARED_SQL} SELECT {', '.join(LABEL_SQL.format(c) for c in config.BINARY_INPUTS)}, count(*) AS rows
    FROM prepared GROUP BY ALL""",
)
def yes_no_labels(spark, folder):
    labelled = clean.to_labels(t.prepared(spark, folder))
    return labelled.groupBy(*config.BINARY_INPUTS).agg(F.count("*").alias("rows"))


@query(
    "O2.13",
    f"""WITH {t.PREPARED_SQL} SELECT {', '.join(config.BINARY_INPUTS)}, state_holiday, is_holiday, count(*) AS rows
    FROM prepared GROUP BY ALL""",
)
def yes_no_values(spark, folder):
    back = clean.from_labels(clean.to_labels(t.prepared(spark, folder)).drop("is_holiday"))
    return back.groupBy(*config.BINARY_INPUTS, "state_holiday", "is_holiday").agg(F.count("*").alias("rows"))


@query(
    "O2.15 O2.16",
    f"""WITH {t.DIRTY_SQL} SELECT date, store_id, sales FROM typed WHERE date IS NOT NULL AND sales IS NOT NULL
    AND sales < CAST('Infinity' AS DOUBLE)""",
)
def usable_rows(spark, folder):
    rows = clean.drop_unusable(star_tables.dirty_sales(spark, folder))
    return rows.where(F.col("sales") < float("inf")).select("date", "store_id", "sales")


@query("O8.3", f"WITH {t.PREPARED_SQL} SELECT DISTINCT date, store_id FROM prepared")
def distinct_store_days(spark, folder):
    return t.prepared(spark, folder).select("date", "store_id").distinct()


@query(
    "O5.13",
    f"""WITH {t.PREPARED_SQL}
    SELECT count(*) AS full_rows, count(*) FILTER (WHERE NOT (is_open = 1 AND sales > 0)) AS closed_or_zero_rows,
      count(*) FILTER (WHERE is_open = 0) AS closed_rows, count(*) FILTER (WHERE sales = 0) AS zero_sales_rows,
      min(date) AS start_date, max(date) AS end_date FROM prepared""",
)
def row_set_summary(spark, folder):
    from shelfspark.operators.metrics import row_set_summary as summary

    return summary(t.prepared(spark, folder), clean.trading_rows())


