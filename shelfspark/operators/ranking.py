"""Ranks that do not put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.operators.joins import sized
from shelfspark.session import shared_folder

# monotonically_increasing_id keeps the partition number above this bit.
_ROW_BITS = 33


def grouped_rank(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Adds the 1-based rank within each group, and the group size as ``<name>_of``.

    A window over the group would sort one group in one task. Here the rows are range-sorted by
    (groups, order) over many tasks; the rank is the position within the task plus the number of
    rows of the group in earlier tasks. The sorted rows are checkpointed first, so that both
    passes see the same positions even if an executor is lost. A hash of the row breaks ties, so
    that many rows with equal keys are spread too.
    """
    shared_folder(df.sparkSession)
    keys = [*groups, *order, F.xxhash64(*df.columns)]
    located = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", _ROW_BITS))
        .checkpoint(eager=True)
    )
    # One row per (group, task): bounded by groups + tasks.
    pieces = located.groupBy(*groups, "_task").agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first")
    )
    within = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    before = within.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_task").alias("_task_of_piece"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(within).alias(f"{name}_of"),
    )
    pieces = sized(pieces)
    same = located["_task"] == pieces["_task_of_piece"]
    for i, g in enumerate(groups):
        same = same & located[g].eqNullSafe(pieces[f"_g{i}"])
    return located.join(pieces, same).select(
        *df.columns,
        (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(name),
        f"{name}_of",
    )
