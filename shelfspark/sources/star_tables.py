"""Maps a star schema of order lines and suppliers to the raw sales and store tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as raw sales rows; some fields are left null so that fills are used."""
    line = read_table(spark, folder, "lineitem")
    c = F.col
    net = F.floor(c("l_extendedprice") * (1 - c("l_discount")))
    return line.select(
        c("l_suppkey").cast("int").alias("Store"),
        F.to_date("l_shipdate").alias("Date"),
        F.when(c("l_quantity") < 3, 0).otherwise(net).cast("double").alias("Sales"),
        F.when(c("l_quantity") != 50, c("l_quantity")).alias("Customers"),
        F.when(c("l_tax") != 0.08, (c("l_linestatus") == "O").cast("int")).alias("Open"),
        F.when(c("l_discount") != 0, (c("l_discount") >= 0.05).cast("int")).alias("Promo"),
        F.when(c("l_returnflag") == "N", "0")
        .when(c("l_returnflag") == "A", " A ")
        .when(c("l_linenumber") != 7, "b")
        .alias("StateHoliday"),
        (c("l_tax") >= 0.06).cast("int").alias("SchoolHoliday"),
    )


def raw_stores(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as the store dimension."""
    s = read_table(spark, folder, "supplier")
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return s.select(
        key.cast("int").alias("Store"),
        F.when(nation != 24, F.substring(F.lit("abcd"), nation % 4 + 1, F.lit(1))).alias("StoreType"),
        F.substring(F.lit("abc"), nation % 3 + 1, F.lit(1)).alias("Assortment"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("CompetitionDistance"),
        (key % 2).cast("int").alias("Promo2"),
        F.when(key % 6 == 1, "Jan,Apr,Jul,Oct")
        .when(key % 6 == 3, "Feb,May,Aug,Nov")
        .when(key % 6 == 5, "Mar,Jun,Sept,Dec")
        .alias("PromoInterval"),
    )


def event_days(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a second panel: users play stores, values play sales."""
    e = read_table(spark, folder, "events")
    return e.select(
        F.to_date("ts").alias("date"),
        F.col("user_id").cast("string").alias("store_id"),
        F.col("value").alias("sales"),
        F.col("event_type").alias("kind"),
    )


def dirty_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as untyped sales rows with faults of every kind, one file per month."""
    c = F.col
    line = read_table(spark, folder, "lineitem")
    net = F.floor(c("l_extendedprice") * (1 - c("l_discount")))
    iso = F.date_format("l_shipdate", "yyyy-MM-dd")
    return line.select(
        F.concat(F.lit("sales/"), F.date_format("l_shipdate", "yyyy-MM"), F.lit("-01.parquet")).alias("file_path"),
        F.when((c("l_quantity") == 50) & (c("l_tax") == 0.08), "not-a-date").otherwise(iso).alias("date"),
        F.when(c("l_linenumber") != 6, F.concat(F.lit("store_"), F.lpad(c("l_suppkey").cast("string"), 6, "0"))).alias("store_id"),
        F.when((c("l_linenumber") == 7) & (c("l_quantity") == 1), "n/a")
        .when((c("l_linenumber") == 7) & (c("l_quantity") == 2), "Infinity")
        .otherwise(net.cast("string"))
        .alias("sales"),
        F.when(c("l_quantity") != 10, c("l_quantity") - 3).alias("customer_traffic"),
        F.when(c("l_discount") == 0.1, 2.0)
        .otherwise((c("l_discount") >= 0.05).cast("double"))
        .alias("has_promotion"),
        F.when(c("l_tax") == 0.03, 0.5)
        .otherwise((c("l_linestatus") == "O").cast("double"))
        .alias("is_open"),
        (c("l_returnflag") != "N").cast("int").alias("is_holiday"),
    )
