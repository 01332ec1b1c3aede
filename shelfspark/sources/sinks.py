"""Result writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_diagnostics(metrics: DataFrame, verdict: DataFrame, verdict_lines: DataFrame, folder: str) -> dict[str, str]:
    """Experiment results as CSV and JSON, the verdict as JSON and as text."""
    root = folder.rstrip("/")
    paths = {
        "csv": write_csv(metrics, f"{root}/experiment_results_csv"),
        "json": write_json(metrics, f"{root}/experiment_results_json"),
        "verdict_json": write_json(verdict, f"{root}/verdict_json"),
        "verdict_text": f"{root}/verdict_text",
    }
    lines = verdict_lines.orderBy("position").select(F.col("line").alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(paths["verdict_text"])
    return paths


def write_forecast(forecast: DataFrame, path: str) -> str:
    """Forecast export: amounts rounded to two places, as CSV."""
    rounded = [
        F.round(c, 2).alias(c) if kind == "double" else F.col(c) for c, kind in forecast.dtypes
    ]
    return write_csv(forecast.select(*rounded), path)
