"""Rows of the hours to forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators import features

KEY = "timestamp_utc"


def horizon(history: DataFrame, hours: int = 24, value: str = "price_eur_mwh", prefix: str = "price_lag") -> DataFrame:
    """The ``hours`` after the last known one, without values, with all features from the history."""
    last = history.agg(F.max(KEY).alias("_last")).filter("_last IS NOT NULL")
    steps = history.sparkSession.range(1, hours + 1)
    future = last.crossJoin(steps).select((F.col("_last") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias(KEY), F.lit(None).cast("double").alias(value))
    whole = history.select(KEY, F.col(value).cast("double").alias(value)).unionByName(future)
    out = features.prepare(whole, value, prefix=prefix)
    return out.crossJoin(F.broadcast(last)).filter(F.col(KEY) > F.col("_last")).drop("_last")
