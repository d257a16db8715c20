"""Chronological train, validation and test parts without leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "timestamp_utc"
PARTS = ("train", "validation", "test")


def positions(df: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` with its row's place in order of time, from 0, and the number of rows.

    Rows are ranked within their day; the days' counts, of which there are few whatever the rows, give the offset.
    So no window sees the whole table.
    """
    day = F.date_trunc("day", F.col(key))
    days = df.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = days.select("_day", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_offset"), F.sum("_n").over(whole).alias("_total"))
    ranked = df.withColumn("_day", day).withColumn("_rank", F.row_number().over(Window.partitionBy("_day").orderBy(key)) - 1)
    return ranked.join(offsets, "_day").withColumn("_position", F.col("_offset") + F.col("_rank")).drop("_day", "_offset", "_rank")


def chronological(df: DataFrame, train_fraction: float = 0.6, validation_fraction: float = 0.2, purge_hours: int = 0, key: str = KEY) -> DataFrame:
    """``df`` with its column split; rows within ``purge_hours`` before the next part begins are left out."""
    if not (0 < train_fraction < 1 and 0 < validation_fraction < 1 and train_fraction + validation_fraction < 1):
        raise ValueError("fractions must be between 0 and 1, and their sum below 1")
    if purge_hours < 0:
        raise ValueError("purge_hours must not be negative")
    a, b = F.floor(F.col("_total") * F.lit(train_fraction)), F.floor(F.col("_total") * F.lit(train_fraction + validation_fraction))
    part = F.when(F.col("_position") < a, PARTS[0]).when(F.col("_position") < b, PARTS[1]).otherwise(PARTS[2])
    out = positions(df, key).withColumn("split", part).drop("_position", "_total")
    if not purge_hours:
        return out
    # the first time of each later part, one row in all
    begins = out.agg(*[F.min(F.when(F.col("split") == p, F.col(key))).alias(f"_{p}") for p in PARTS[1:]])
    gap = F.expr(f"INTERVAL {purge_hours} HOURS")
    early = F.when(F.col("split") == PARTS[0], F.col(key) < F.col("_validation") - gap).when(F.col("split") == PARTS[1], F.col(key) < F.col("_test") - gap).otherwise(True)
    return out.crossJoin(F.broadcast(begins)).filter(early).drop("_validation", "_test")


def check(df: DataFrame, key: str = KEY) -> None:
    """Raise unless times are known and unique."""
    if df.filter(F.col(key).isNull()).limit(1).count() or df.groupBy(key).count().filter("count > 1").limit(1).count():
        raise ValueError("a chronological split needs known, unique timestamps")


def bounds(parts: DataFrame, key: str = KEY) -> DataFrame:
    """Rows and first and last time of each part."""
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("start"), F.max(key).alias("end"))


def check_sizes(parts: DataFrame) -> None:
    """Raise unless each part has two rows at least."""
    sizes = {r["split"]: r["rows"] for r in bounds(parts).collect()}
    if any(sizes.get(p, 0) < 2 for p in PARTS):
        raise ValueError("each chronological part needs at least two rows")
