"""Calendar, lag, rolling and interaction features that only look at the past."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.config import FeatureConfig
from shelfspark.functions.dates import calendar_parts, cyclical_parts
from shelfspark.operators import clean
from shelfspark.operators.ranking import grouped_rank

DEFAULTS = FeatureConfig()
BLOCK_ROWS = 20_000


def date_features(df: DataFrame, date_col: str = "date", cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    parts = calendar_parts(F.to_date(date_col))
    df = df.withColumns({name: parts[name] for name in cfg.date_parts if name in parts})
    return clean.combined_holiday(df, date_col) if "is_holiday" in cfg.date_parts else df


def cyclical_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns(cyclical_parts(F.to_date(date_col)))


def interaction_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a_b_interaction`` for every pair, in list order; null prints as ``nan``."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("nan"))

    return df.withColumns(
        {
            f"{a}_{b}_interaction": F.concat_ws("_", shown(a), shown(b))
            for a, b in itertools.combinations(columns, 2)
        }
    )


def _known(target: str) -> Column:
    """The target as a number; NaN counts as missing."""
    value = F.col(target).cast("double")
    return F.when(~F.isnan(value), value)


def _history_columns(target: str, window, cfg: FeatureConfig, rolling: bool, lags: bool) -> dict[str, Column]:
    """Window columns over one (partition, order): a single sort serves all of them."""
    out: dict[str, Column] = {}
    if lags:
        out.update({f"{target}_lag_{n}": F.lag(target, n).over(window) for n in cfg.lags})
    if rolling:
        for n in cfg.windows:
            frame = window.rowsBetween(-n, -1)
            if "mean" in cfg.stats:
                out[f"{target}_rolling_{n}_mean"] = F.avg(_known(target)).over(frame)
            if "std" in cfg.stats:
                out[f"{target}_rolling_{n}_std"] = F.stddev_samp(_known(target)).over(frame)
            out[f"_known_{n}"] = F.count(_known(target)).over(frame)
        if set(cfg.stats) & {"min", "max", "median"}:
            # Missing values keep their place as NaN, which sorts last.
            widest = window.rowsBetween(-max(cfg.windows), -1)
            out["_recent"] = F.collect_list(F.coalesce(_known(target), F.lit(float("nan")))).over(widest)
    return out


def _sorted_windows(cfg: FeatureConfig) -> dict[str, Column]:
    """The values of each window in order. A step of its own: each is used several times."""
    recent = F.col("_recent")
    return {
        f"_sorted_{n}": F.sort_array(
            F.slice(recent, F.greatest(F.lit(1), F.size(recent) - (n - 1)), F.lit(n))
        )
        for n in cfg.windows
    }


def _order_statistics(target: str, cfg: FeatureConfig) -> dict[str, Column]:
    """Min, max and median of each window, read from its sorted values."""
    out: dict[str, Column] = {}
    for n in cfg.windows:
        values, known = F.col(f"_sorted_{n}"), F.col(f"_known_{n}").cast("int")
        if "min" in cfg.stats:
            out[f"{target}_rolling_{n}_min"] = F.when(known > 0, F.get(values, F.lit(0)))
        if "max" in cfg.stats:
            out[f"{target}_rolling_{n}_max"] = F.when(known > 0, F.get(values, known - 1))
        if "median" in cfg.stats:
            low, high = F.shiftright(known - 1, 1), F.shiftright(known, 1)
            middle = (F.get(values, low) + F.get(values, high)) / 2
            out[f"{target}_rolling_{n}_median"] = F.when(known > 0, middle)
    return out


def _feature_names(target: str, cfg: FeatureConfig, rolling: bool, lags: bool) -> list[str]:
    names = [f"{target}_lag_{n}" for n in cfg.lags] if lags else []
    if rolling:
        names += [f"{target}_rolling_{n}_{s}" for n in cfg.windows for s in cfg.stats]
    return names


def history_features(
    df: DataFrame,
    target: str = "sales",
    date_col: str = "date",
    groups: Sequence[str] | None = ("store_id",),
    cfg: FeatureConfig = DEFAULTS,
    lags: bool = True,
    rolling: bool = True,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Lags count rows; rolling statistics cover the previous rows, never the current one.

    With groups the frame must have one row per group and day (the store-day panel), so a group
    is bounded by the number of days. Without groups the whole frame is one ordered series: it
    is cut into blocks of consecutive rows that carry the rows before them along, so no task
    ever holds the series as a whole.
    """
    names = _feature_names(target, cfg, rolling, lags)
    if groups:
        window = W.partitionBy(*groups).orderBy(date_col, *tie_break)
        source = df
    else:
        source = _overlapping_blocks(df, date_col, tie_break, cfg)
        window = W.partitionBy("_block").orderBy("_rank")
    out = source.withColumns(_history_columns(target, window, cfg, rolling, lags))
    if "_recent" in out.columns:
        out = out.withColumns(_sorted_windows(cfg)).withColumns(_order_statistics(target, cfg))
    if not groups:
        out = out.where(F.col("_own"))
    return out.select(*df.columns, *names)


def _overlapping_blocks(df: DataFrame, date_col: str, tie_break: Sequence[str], cfg: FeatureConfig) -> DataFrame:
    """Each row in the block of its rank, and again in the next block if it lies in its reach.

    A block is at least as long as the longest reach, so no row reaches beyond the next block.
    """
    reach = max([*cfg.lags, *cfg.windows, 1])
    length = max(BLOCK_ROWS, reach)
    ranked = grouped_rank(df, [], [date_col, *tie_break], "_rank")
    block = F.floor((F.col("_rank") - 1) / length)
    place = (F.col("_rank") - 1) % length
    own = F.struct(block.alias("_block"), F.lit(True).alias("_own"))
    halo = F.struct((block + 1).alias("_block"), F.lit(False).alias("_own"))
    copies = F.when(place >= length - reach, F.array(own, halo)).otherwise(F.array(own))
    return ranked.select(*df.columns, "_rank", F.inline(copies))


def lag_features(df: DataFrame, target: str = "sales", groups: Sequence[str] | None = ("store_id",), cfg: FeatureConfig = DEFAULTS, date_col: str = "date", tie_break: Sequence[str] = ()) -> DataFrame:
    return history_features(df, target, date_col, groups, cfg, rolling=False, tie_break=tie_break)


def rolling_features(df: DataFrame, target: str = "sales", groups: Sequence[str] | None = ("store_id",), cfg: FeatureConfig = DEFAULTS, date_col: str = "date", tie_break: Sequence[str] = ()) -> DataFrame:
    return history_features(df, target, date_col, groups, cfg, lags=False, tie_break=tie_break)


def is_history_feature(name: str) -> bool:
    """Lag and rolling columns, by their full name part (``state_holiday_flag`` is none)."""
    return "_lag_" in name or "_rolling_" in name


def impute(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Lag and rolling columns get 0, other numeric columns the mean of the whole frame.

    The means come from one aggregation of ``source`` (default ``df``) as a scalar subquery.
    Columns that ``source`` lacks are left alone: pass the panel itself to spare the means of
    derived columns that cannot be null. Columns with a mean become double, as the mean of a
    whole-number column need not be whole.
    """
    basis = df if source is None else source
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    with_mean = [c for c in numeric if not is_history_feature(c) and c in basis.columns]
    fills: dict[str, Column] = {
        c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
        for c in numeric
        if is_history_feature(c)
    }
    if with_mean:
        means = basis.agg(F.struct(*[F.avg(c).alias(c) for c in with_mean]).alias("m")).scalar()
        fills.update({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in with_mean})
    return df.withColumns(fills)


def all_features(
    df: DataFrame,
    target: str = "sales",
    date_col: str = "date",
    groups: Sequence[str] | None = ("store_id",),
    categories: Sequence[str] | None = None,
    cfg: FeatureConfig = DEFAULTS,
) -> DataFrame:
    """Calendar, lags, rolling, cyclical, interactions and imputation, in that order."""
    calendar = date_features(df, date_col, cfg)
    out = history_features(calendar, target, date_col, groups, cfg)
    out = cyclical_features(out, date_col)
    if categories:
        out = interaction_features(out, categories)
    return impute(out, source=df)


def forecast_features(df: DataFrame, cfg: FeatureConfig = DEFAULTS) -> DataFrame:
    """The same features on the forecast path, for every store in the frame."""
    clean_rows = clean.normalise_inputs(df, check=False)
    if "sales" in df.columns:
        out = history_features(date_features(clean_rows, cfg=cfg), cfg=cfg)
        out = out.fillna(0, [c for c in out.columns if is_history_feature(c)])
    else:
        out = date_features(clean_rows, cfg=cfg)
    return interaction_features(cyclical_features(out), clean.categorical_columns(out))
