"""Calendar, cyclical and exact-lag features of an hourly series."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "timestamp_utc"


def calendar(df: DataFrame, zone: str = "Europe/Berlin") -> DataFrame:
    """hour, day_of_week (Monday 0), month and is_weekend of the local time of delivery."""
    local = F.from_utc_timestamp(KEY, zone)
    day = F.weekday(local)
    return df.withColumns({"hour": F.hour(local), "day_of_week": day, "month": F.month(local), "is_weekend": (day >= 5).cast("int")})


def cyclical(df: DataFrame) -> DataFrame:
    """hour_sin and hour_cos of the column hour."""
    angle = F.col("hour") * (2 * math.pi / 24)
    return df.withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)})


def exact_lag(df: DataFrame, value: str, hours: int, alias: str, history: DataFrame | None = None) -> DataFrame:
    """The value exactly ``hours`` earlier, by elapsed time and not by position; null over gaps."""
    known = (df if history is None else history).select(F.col(KEY).alias("_then"), F.col(value).alias(alias))
    return df.join(known, F.col(KEY) == F.col("_then") + F.make_dt_interval(hours=F.lit(hours)), "left").drop("_then")


def exact_lags_within(df: DataFrame, value: str, by: str, hours: dict[str, int]) -> DataFrame:
    """Exact lags within each series of ``by``: one exchange for all lags, and no join.

    Where one series holds a large share of all rows ``exact_lag`` is better: its join spreads over the hours.
    """
    epoch = F.unix_seconds(KEY)
    out = {}
    for alias, h in hours.items():
        frame = Window.partitionBy(by).orderBy(epoch).rangeBetween(-3600 * h, -3600 * h)
        out[alias] = F.max(value).over(frame)
    return df.withColumns(out)


def prepare(joined: DataFrame, value: str = "price_eur_mwh", lags: tuple[int, ...] = (24, 48), prefix: str = "price_lag") -> DataFrame:
    """All features of a joined series."""
    out = cyclical(calendar(joined))
    for h in lags:
        out = exact_lag(out, value, h, f"{prefix}_{h}h", joined)
    return out


def verify(saved: DataFrame, joined: DataFrame, value: str = "price_eur_mwh", lags: tuple[int, ...] = (24, 48), prefix: str = "price_lag") -> DataFrame:
    """One row: null and wrong lags, rows off the unit circle, and null lags of the last day."""
    df = saved
    for h in lags:
        df = exact_lag(df, value, h, f"_again_{h}", joined)
    last = df.agg(F.max(KEY).alias("_last"))
    df = df.crossJoin(F.broadcast(last))
    checks = [F.count_if(F.col(f"{prefix}_{h}h").isNull()).alias(f"null_lag_{h}h") for h in lags]
    checks += [F.count_if(~F.col(f"{prefix}_{h}h").eqNullSafe(F.col(f"_again_{h}"))).alias(f"mismatch_{h}h") for h in lags]
    off = F.abs(F.pow("hour_sin", F.lit(2)) + F.pow("hour_cos", F.lit(2)) - 1) > 1e-10
    recent = F.col(KEY) > F.col("_last") - F.expr("INTERVAL 24 HOURS")
    missing = F.lit(False)
    for h in lags:
        missing = missing | F.col(f"{prefix}_{h}h").isNull()
    return df.agg(*checks, F.count_if(off).alias("off_circle"), F.count_if(recent & missing).alias("recent_null_lags"))
