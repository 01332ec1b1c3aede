"""Aggregate and statistical expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import finite


def first_present(value: Column, order: Column) -> Column:
    """First non-null value in the given row order."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def error_metrics(y: Column, yhat: Column) -> dict[str, Column]:
    """MAE, RMSE, MAPE and R squared as aggregates; pairs that are not finite are left out.

    Zero actuals do not count for MAPE (0 if nothing else is left). Without variance in the
    actuals R squared is 1 for a perfect forecast, else 0. Without any pair all four are null.
    """
    fy, fp = finite(y), finite(yhat)
    paired = fy.isNotNull() & fp.isNotNull()
    actual = F.when(paired, fy)
    error = F.when(paired, fy - fp)
    pairs = F.count(actual)
    squares = F.sum(error * error)
    spread = F.var_pop(actual) * pairs
    flat = F.min(actual) == F.max(actual)
    mape = F.avg(F.when(actual != 0, F.abs(error / actual))) * 100
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.when(pairs > 0, F.coalesce(mape, F.lit(0.0))),
        "r2": F.when(flat, F.when(squares == 0, 1.0).otherwise(0.0)).otherwise(
            1 - F.try_divide(squares, spread)
        ),
    }


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation, null where a side does not vary (``corr`` fails there in ANSI mode)."""
    a = F.when(b.isNotNull(), a)
    b = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


# Coefficients of Acklam's rational approximation of the inverse normal.
_A = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
_B = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0)
_C = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
_D = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0)
_TAIL = 0.02425


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal for 0 < p < 1, relative error about 1e-9."""
    centre = p - 0.5
    square = centre * centre
    middle = centre * _poly(_A, square) / _poly(_B, square)
    low = F.sqrt(-2 * F.log(p))
    high = F.sqrt(-2 * F.log(1 - p))
    return (
        F.when(p < _TAIL, _poly(_C, low) / _poly(_D, low))
        .when(p > 1 - _TAIL, -_poly(_C, high) / _poly(_D, high))
        .otherwise(middle)
    )


def normal_order_median(rank: Column, n: Column) -> Column:
    """Plotting position of the rank-th of n ordered values (Filliben)."""
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return (
        F.when(rank == n, last)
        .when(rank == 1, 1 - last)
        .otherwise((rank - 0.3175) / (n + 0.365))
    )
