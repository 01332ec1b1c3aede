"""Chronological splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.config import SplitConfig
from shelfspark.operators import clean

SPLITS = ("train", "validation", "test")
DIRECT_SORT_ROWS = 200_000


def _cut_key(rows: DataFrame, position: int, order: Sequence[str]):
    """The row at a 0-based position in the order of ``order``, without sorting the frame.

    Range-partitions give counts of consecutive key ranges (one row per task on the driver); only
    the range that holds the position is sorted, by its key limits, so a recomputed stage cannot
    move it. Repeats until that range is small.
    """
    keys = F.struct(*order).alias("_key")
    remaining, offset = rows.select(keys), position
    while remaining.count() > DIRECT_SORT_ROWS:
        ranges = (
            remaining.repartitionByRange("_key")
            .groupBy(F.spark_partition_id().alias("_task"))
            .agg(F.count("*").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high"))
            .orderBy("low")
            .collect()
        )
        if len(ranges) == 1:
            break
        for piece in ranges:
            if offset < piece["n"]:
                low, high = [F.struct(*[F.lit(v).alias(c) for c, v in zip(order, edge)]) for edge in (piece["low"], piece["high"])]
                remaining = remaining.where((F.col("_key") >= low) & (F.col("_key") <= high))
                break
            offset -= piece["n"]
    found = remaining.orderBy("_key").offset(offset).limit(1).collect()
    return found[0]["_key"] if found else None


def split_by_rows(
    df: DataFrame,
    target: str = "sales",
    date_col: str = "date",
    tie_break: Sequence[str] = ("store_id",),
    cfg: SplitConfig = SplitConfig(),
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Adds ``split``: first 70 % of the rows in time train, next 10 % validation, rest test.

    Order is (date, tie_break), which must be unique. Instead of ranking every row, the two cut
    rows are located (per-day counts, then the cut day only) and each row is compared with them:
    the frame itself is not shuffled or sorted. ``count_on`` may name a narrower frame with the
    same rows, such as the panel before features were added. Rows without a target are dropped
    after the cuts are fixed.
    """
    order = [date_col, *tie_break]
    basis = (df if count_on is None else count_on).select(*order)
    # One row per day: bounded by the length of the history.
    days = basis.groupBy(date_col).count().orderBy(date_col).collect()
    train, validation = cfg.sizes(sum(d["count"] for d in days))

    def cut(position: int):
        seen = 0
        for day in days:
            if position < seen + day["count"]:
                rows = basis.where(F.col(date_col).eqNullSafe(F.lit(day[date_col])))
                return _cut_key(rows, position - seen, order)
            seen += day["count"]
        return None

    def before(key) -> Column:
        if key is None:
            return F.lit(True)
        edge = F.struct(*[F.lit(v).alias(c) for c, v in zip(order, key)])
        return F.struct(*[F.col(c) for c in order]) < edge

    label = (
        F.when(before(cut(train)), SPLITS[0])
        .when(before(cut(train + validation)), SPLITS[1])
        .otherwise(SPLITS[2])
    )
    return df.withColumn("split", label).where(F.col(target).isNotNull())


def date_splits(df: DataFrame, date_col: str = "date", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """(date, split): the distinct days in order, 70 / 10 / 20 by number of days.

    The window runs over distinct days only, which are bounded by the length of the history.
    """
    days = df.where(F.col(date_col).isNotNull()).select(F.to_date(date_col).alias(date_col)).distinct()
    return label_days(days, date_col, cfg)


def label_days(days: DataFrame, date_col: str = "date", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Adds ``split`` to a frame of one row per day."""
    ordered = W.partitionBy(F.lit(0)).orderBy(date_col)
    rank = F.row_number().over(ordered) - 1
    n = F.count("*").over(W.partitionBy(F.lit(0))).cast("double")
    train = F.floor(n * F.lit(1 - cfg.test_size - cfg.validation_size))
    validation = F.floor(n * F.lit(cfg.validation_size))
    label = (
        F.when(rank < train, SPLITS[0]).when(rank < train + validation, SPLITS[1]).otherwise(SPLITS[2])
    )
    return days.withColumn("split", label)


def split_by_dates(df: DataFrame, target: str = "sales", date_col: str = "date", cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Adds ``split`` so that whole days stay together; unusable rows are dropped."""
    rows = clean.drop_unusable(df, target, date_col)
    # One row per day: small enough to broadcast for any history.
    return rows.join(F.broadcast(date_splits(rows, date_col, cfg)), date_col)


def rows_of_split(df: DataFrame, splits: DataFrame, split: str, date_col: str = "date") -> DataFrame:
    """Rows whose day belongs to a split."""
    days = splits.where(F.col("split") == split).select(date_col)
    return df.join(F.broadcast(days), date_col, "left_semi")
