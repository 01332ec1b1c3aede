"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.operators.joins import sized
from shelfspark.session import shared_folder

BINS = 4096
# A cell with at most so many rows is counted value by value.
COUNTED_ROWS = 1_000_000


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    bins: int = BINS,
) -> DataFrame:
    """(groups, column, n, one quantile per name) of each numeric column, nulls left out.

    The built-in ``percentile`` merges all distinct values of a group in one task, a sketch one
    digest of every map task. Here the values of a group lie in cells, at first one from minimum
    to maximum. A round deals the values of each cell to bins whose counts are added up like those
    of any other key, and keeps as cells the bins that hold a wanted rank, cut to the values in
    them. It is repeated while a cell of unlike values has more than COUNTED_ROWS rows; then the
    few values left in cells are counted one by one. Columns whose cells hold one value each are
    known by then and are not read again. Only cells, at most two for each
    probability, are kept between rounds. NaN is the greatest value. Quantiles are interpolated
    linearly between ranks.
    """
    group_names = [*groups] if groups else ["_all"]
    source = df if groups else df.withColumn("_all", F.lit(0))
    # Adding zero makes minus zero and zero the same value.
    rows = source.select(*group_names, *[(F.col(c).cast("double") + F.lit(0.0)).alias(f"_v{i}") for i, c in enumerate(columns)])
    wide = range(len(columns))
    names = F.array(*[F.lit(c) for c in columns])

    def rank(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_n") - 1)

    ranks = [edge(rank(p)) for p in probabilities.values() for edge in (F.floor, F.ceil)]

    def in_cells(cells: DataFrame, most: int, wide: Sequence[int] = wide) -> DataFrame:
        """(groups, _i, _n, _value, _cell) of the values of column number _i inside cells, of which a group has at most ``most``."""
        left = rows.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(group_names)})
        same = [left[f"_g{i}"].eqNullSafe(cells[g]) for i, g in enumerate(group_names)]
        structs = []
        for i in wide:
            value = F.col(f"_v{i}")
            cell = [F.get(f"_c{i}", F.lit(k)) for k in range(most)]
            holds = F.coalesce(*[F.when(value.between(c["low"], c["high"]), c) for c in cell])
            structs.append(F.struct(F.lit(i).alias("_i"), F.col(f"_n{i}").alias("_n"), value.alias("_value"), holds.alias("_cell")))
        joined = left.join(sized(cells), same)
        if len(structs) == 1:
            # Without an array that is made and taken apart for every row.
            long = joined.select(*group_names, structs[0].alias("_one")).select(*group_names, "_one.*")
        else:
            long = joined.select(*group_names, F.inline(F.array(*structs)))
        return long.where("_cell is not null")

    def settled(cells: DataFrame, numbers: Sequence[int]) -> DataFrame:
        """What counting would give for columns whose cells hold one value each."""
        def rows_of(i: int) -> Column:
            return F.transform(f"_c{i}", lambda c: F.struct(F.lit(i).alias("_i"), F.col(f"_n{i}").alias("_n"), c["before"].alias("_before"), c["low"].alias("_value"), c["rows"].alias("_rows")))

        return cells.select(*group_names, F.inline(F.concat(*[rows_of(i) for i in numbers]))).where("_rows > 0")

    def unlike(cells: DataFrame) -> list[int]:
        """The columns that have a cell of unlike values in any group."""
        found = cells.agg(*[F.max(F.exists(f"_c{i}", lambda c: c["low"] < c["high"])).alias(f"_{i}") for i in wide]).first()
        return [i for i in wide if found[i]]

    def ranked(counted: DataFrame, order: str) -> DataFrame:
        """``counted`` with the ranks from ``_from`` to below ``_through`` that its rows hold."""
        cell = W.partitionBy(*group_names, "_i", "_before").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
        through = F.col("_before") + F.sum("_rows").over(cell)
        return counted.withColumn("_through", through).withColumn("_from", through - F.col("_rows"))

    def holds(r: Column) -> Column:
        return (r >= F.col("_from")) & (r < F.col("_through"))

    def narrowed(cells: DataFrame, most: int) -> DataFrame:
        place = _bin(F.col("_value"), F.col("_cell.low"), F.col("_cell.high"), bins)
        keys = [*group_names, "_i", "_n", F.col("_cell.before").alias("_before"), place.alias("_bin")]
        counted = in_cells(cells, most).groupBy(*keys).agg(
            F.min("_value").alias("_least"), F.max("_value").alias("_most"), F.count("*").alias("_rows")
        )
        wanted = F.lit(False)
        for r in ranks:
            wanted = wanted | holds(r)
        cell = F.struct(F.col("_least").alias("low"), F.col("_most").alias("high"), F.col("_from").alias("before"), F.col("_rows").alias("rows"))
        found = ranked(counted, "_least").where(wanted)
        own = [(F.when(F.col("_i") == i, cell), F.when(F.col("_i") == i, F.col("_n"))) for i in wide]
        return found.groupBy(*group_names).agg(
            *[F.max(n).alias(f"_n{i}") for i, (_, n) in enumerate(own)], *[F.collect_list(c).alias(f"_c{i}") for i, (c, _) in enumerate(own)]
        )

    def widest(cells: DataFrame) -> int:
        """Rows of the largest cell of unlike values."""
        sizes = [F.array_max(F.transform(F.filter(f"_c{i}", lambda c: c["low"] < c["high"]), lambda c: c["rows"])) for i in wide]
        return cells.agg(F.max(F.array_max(F.array(*sizes))).alias("n")).first()["n"] or 0

    values = [F.col(f"_v{i}") for i in wide]
    whole = [F.struct(F.min(v).alias("low"), F.max(v).alias("high"), F.lit(0).cast("long").alias("before"), F.count(v).alias("rows")) for v in values]
    cells = rows.groupBy(*group_names).agg(
        *[F.count(v).alias(f"_n{i}") for i, v in enumerate(values)], *[F.array(c).alias(f"_c{i}") for i, c in enumerate(whole)]
    )
    shared_folder(df.sparkSession)
    cells, most = cells.checkpoint(), 1
    while widest(cells) > COUNTED_ROWS:
        cells, most = narrowed(cells, most).checkpoint(), len(ranks)

    keys = [*group_names, "_i", "_n", F.col("_cell.before").alias("_before"), "_value"]
    left = unlike(cells)
    known = [i for i in wide if i not in left]
    parts = [in_cells(cells, most, left).groupBy(*keys).agg(F.count("*").alias("_rows"))] if left else []
    parts += [settled(cells, known).select(*group_names, "_i", "_n", "_before", "_value", "_rows")] if known else []
    counted = ranked(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "_value")
    found = counted.groupBy(*group_names, "_i", "_n").agg(*[F.max(F.when(holds(r), F.col("_value"))).alias(f"_r{k}") for k, r in enumerate(ranks)])
    out: list[Column] = []
    for k, (name, p) in enumerate(probabilities.items()):
        low, high = F.col(f"_r{2 * k}"), F.col(f"_r{2 * k + 1}")
        part = rank(p) - F.floor(rank(p))
        out.append(F.when(part > 0, low + part * (high - low)).otherwise(low).alias(name))
    return found.select(*groups, F.get(names, F.col("_i")).alias("column"), F.col("_n").alias("n"), *out)


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """A number that never falls as ``value`` rises from ``low`` to ``high``.

    Both ends have bins of their own, so that each round leaves fewer values. Between them widths
    are equal on a logarithmic scale where the ends are far apart, else on a plain one; a cell
    around zero is halved there first. So a handful of rounds reaches any double.
    """
    top = F.when(F.isnan(high), F.lit(float("inf"))).otherwise(high)

    def logarithmic(x: Column, a: Column, b: Column) -> Column:
        return (F.ln(x) - F.ln(a)) / (F.ln(b) - F.ln(a))

    around_zero = F.when(value < 0, (1 - value / low) / 2).otherwise((1 + value / top) / 2)
    plain = (value / 2 - low / 2) / F.nullif(top / 2 - low / 2, F.lit(0.0))
    share = (
        F.when((low < 0) & (top > 0), around_zero)
        .when((low > 0) & (top / 4 > low), logarithmic(value, low, top))
        .when((top < 0) & (low / 4 < top), 1 - logarithmic(-value, -top, -low))
        .otherwise(plain)
    )
    # Without a number: infinity over infinity, beyond all finite values, or a width below the least double.
    inner = F.when(F.isnan(share), F.lit(bins - 1)).otherwise(F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0)))
    return F.when(value == low, F.lit(-1)).when(value == high, F.lit(bins)).otherwise(inner).cast("int")


def unpivot_numbers(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (keys, column, value) of numeric columns."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*keys, F.inline(pairs))
