"""The query catalogue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Registers a function under its own name. ``covers`` lists ids of the operator inventory."""

    def add(build: Build) -> Build:
        name = build.__name__
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(name, tuple(covers.split()), build, sql)
        return build

    return add


def load() -> dict[str, Query]:
    """All queries; importing the modules registers them."""
    from shelfspark.plans import (  # noqa: F401
        cleaning,
        evaluation,
        forecasting,
        quality_checks,
        series,
        storage,
        training,
    )

    return CATALOG


def rounded(df: DataFrame, digits: int = 4, only: list[str] | None = None) -> DataFrame:
    """Doubles rounded for comparison: the order of a sum may change its last bits."""
    def shown(name: str, kind: str) -> Column:
        if kind == "double" and (only is None or name in only):
            return F.round(name, digits).alias(name)
        return F.col(name)

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def integers(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("int") for n in names})
