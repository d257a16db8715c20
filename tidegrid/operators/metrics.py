"""Errors of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression(df: DataFrame, actual: str, predicted: str, suffix: str = "eur_mwh") -> DataFrame:
    """One row: mean absolute and root mean squared error."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(F.abs(error)).alias(f"mae_{suffix}"), F.sqrt(F.avg(error * error)).alias(f"rmse_{suffix}"))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the exact interpolated median of each column, nulls left out."""
    return df.agg(*[F.median(c).alias(c) for c in columns])
