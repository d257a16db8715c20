"""Profiles of a series and the gate that decides on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME = "timestamp_utc"


def scalars(df: DataFrame, measures: list[str], step_seconds: int = 3600) -> DataFrame:
    """One row: rows, bounds, rows off the step, nulls and negatives of each measure."""
    off = F.pmod(F.unix_seconds(TIME), F.lit(step_seconds)) != 0
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(TIME).alias("start_utc"), F.max(TIME).alias("end_utc"), F.count_if(off).alias("off_hour_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in [TIME, *measures]],
        *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in measures],
    )


def duplicates(df: DataFrame, key: str = TIME) -> DataFrame:
    """Keys that occur more than once, with their count; null keys are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def duplicate_extra(df: DataFrame, key: str = TIME) -> DataFrame:
    """One row: by how many rows the table exceeds its distinct keys."""
    return duplicates(df, key).agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_extra_rows"))


def missing_intervals(df: DataFrame, step_seconds: int = 3600, block: int = 4096) -> DataFrame:
    """Times of the grid between the first and the last one that no row has.

    The grid is made in blocks that are dealt out, so a stray time far off makes many tasks' work and not one long array.
    """
    steps = (F.unix_seconds("high") - F.unix_seconds("low")) / step_seconds
    bounds = df.agg(F.min(TIME).alias("low"), F.max(TIME).alias("high")).filter("low IS NOT NULL").withColumn("last", F.floor(steps).cast("long"))
    blocks = bounds.select("low", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / block).cast("long"))).alias("block")).repartition("block")
    inside = F.sequence(F.col("block") * block, F.least("last", (F.col("block") + 1) * block - 1))
    grid = blocks.select("low", F.explode(inside).alias("i")).select(F.timestamp_micros(F.unix_micros("low") + F.col("i") * (step_seconds * 1_000_000)).alias(TIME))
    return grid.join(df.select(TIME).distinct(), TIME, "left_anti")


def error_histogram(df: DataFrame) -> DataFrame:
    """How often each conversion error occurs."""
    return df.select(F.explode("_errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("count"))


def chronology(df: DataFrame, step_seconds: int = 3600, block: int = 65_536) -> DataFrame:
    """One row: how many rows of a file don't follow the one before by a step; unknown times are passed over.

    Rows are compared within ranges of ``block`` row numbers, and the first of each range with the last of the one before.
    """
    rows = df.select("_source_file", "_source_row", F.floor(F.col("_source_row") / block).alias("range"), F.unix_seconds(TIME).alias("at"))
    before = F.lag("at").over(Window.partitionBy("_source_file", "range").orderBy("_source_row"))
    ranges = rows.withColumn("before", before).groupBy("_source_file", "range").agg(
        F.count_if(F.col("at") - F.col("before") != step_seconds).alias("wrong"), F.min_by("at", "_source_row").alias("first"), F.max_by("at", "_source_row").alias("last")
    )
    carried = F.lag("last").over(Window.partitionBy("_source_file").orderBy("range"))
    ranges = ranges.withColumn("wrong", F.col("wrong") + F.when(F.col("first") - carried != step_seconds, 1).otherwise(0))
    return ranges.agg(F.coalesce(F.sum("wrong"), F.lit(0)).cast("long").alias("chronology_failures"))


def measured(df: DataFrame, measures: list[str], step_seconds: int = 3600) -> DataFrame:
    """One row with the columns of ``scalars``, ``duplicate_extra`` and the number of missing intervals, from one pass.

    Rows are added up by time, times by their place within a step; the place of the first time is that of the grid.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in measures]
    by_time = df.groupBy(TIME).agg(F.count(F.lit(1)).alias("rows"), *nulls, *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in measures])
    sums = [c for c in by_time.columns if c not in (TIME, "rows")]
    known = F.col(TIME).isNotNull()
    place = F.pmod(F.unix_micros(TIME), F.lit(step_seconds * 1_000_000))
    by_place = by_time.groupBy(place.alias("place")).agg(
        F.sum("rows").alias("rows"), F.min(TIME).alias("low"), F.max(TIME).alias("high"), F.count(TIME).alias("times"), F.sum(F.when(known, F.col("rows") - 1)).alias("extra"), *[F.sum(c).alias(c) for c in sums]
    )
    off = F.col("place") >= 1_000_000
    total = by_place.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min("low").alias("start_utc"), F.max("high").alias("end_utc"), F.coalesce(F.sum(F.when(off, F.col("rows"))), F.lit(0)).alias("off_hour_rows"),
        F.coalesce(F.sum(F.when(F.col("place").isNull(), F.col("rows"))), F.lit(0)).alias(f"null_{TIME}"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_extra_rows"), F.min(F.when(F.col("low").isNotNull(), F.struct("low", "times"))).alias("of_first"),
    )
    grid = F.floor((F.unix_micros("end_utc") - F.unix_micros("start_utc")) / (step_seconds * 1_000_000)) + 1
    return total.withColumn("missing_hourly_intervals", F.coalesce(grid - F.col("of_first.times"), F.lit(0)).cast("long")).drop("of_first")


def profile(df: DataFrame, measures: list[str], nonnegative: list[str] = (), nullable: list[str] = (), chronological: bool = False) -> DataFrame:
    """The whole report as one row, with ``passed``."""
    errors = error_histogram(df.filter(F.size("_errors") > 0))
    listed = errors.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("error", "count")))).alias("conversion_errors"))
    row = measured(df, measures).crossJoin(F.broadcast(listed))
    zero = ["duplicate_extra_rows", "missing_hourly_intervals", "off_hour_rows", *[f"null_{c}" for c in [TIME, *measures] if c not in nullable], *[f"negative_{c}" for c in nonnegative]]
    if chronological:
        row = row.crossJoin(F.broadcast(chronology(df)))
        zero.append("chronology_failures")
    exempt = [f"{c}:missing" for c in nullable]
    blocking = F.map_filter("conversion_errors", lambda k, v: ~k.isin(*exempt) if exempt else F.lit(True))
    passed: Column = (F.col("rows") > 0) & (F.size(blocking) == 0)
    for c in zero:
        passed = passed & (F.col(c) == 0)
    return row.withColumn("passed", passed)


class GateFailed(RuntimeError):
    """At least one dataset doesn't pass its contract."""


def gate(profiles: dict[str, DataFrame]) -> None:
    """Raise unless every profile has passed."""
    failed = [name for name, p in profiles.items() if not p.select("passed").first()[0]]
    if failed:
        raise GateFailed(f"quality gate: {', '.join(failed)}")
