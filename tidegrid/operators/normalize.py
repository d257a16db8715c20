"""Raw strings to typed measures, with all conversion errors of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.contract import DatasetContract, java_pattern
from tidegrid.functions.parsing import parse_number, parse_time

LINEAGE = ("_source_file", "_source_row", "_ingested_at")


def quoted(name: str) -> Column:
    """A column by its literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold_of_pairs(wall: str) -> Column:
    """0 for the first, 1 for the second of exactly two rows of a file with the same wall time, else null."""
    same = Window.partitionBy("_source_file", wall)
    place = F.row_number().over(same.orderBy("_source_row")) - 1
    return F.when(F.count(wall).over(same) == 2, place)


def timed(cells: DataFrame, contract: DatasetContract) -> DataFrame:
    """``cells`` with _time, read from _wall.

    Only rows whose local time occurs twice, two hours of a year, are paired by their order, so only they are shuffled.
    """
    read = lambda fold=None: parse_time(F.col("_wall"), java_pattern(contract.timestamp_format), contract.timezone, fold)
    if contract.dst_policy != "ordered_pair":
        return cells.withColumn("_time", read())
    twice = F.coalesce(read()["error"] == "ambiguous_local_time", F.lit(False))
    paired = cells.filter(twice).withColumn("_fold", fold_of_pairs("_wall"))
    return cells.filter(~twice).withColumn("_time", read()).unionByName(paired.withColumn("_time", read(F.col("_fold"))).drop("_fold"))


def normalize(raw: DataFrame, contract: DatasetContract) -> DataFrame:
    """timestamp_utc, the measures, _errors and the lineage columns that ``raw`` has."""
    lineage = [c for c in LINEAGE if c in raw.columns]
    if contract.dst_policy == "ordered_pair" and not {"_source_file", "_source_row"} <= set(lineage):
        raise ValueError("ordered_pair needs the columns _source_file and _source_row")
    wall = quoted(contract.timestamp_columns[0])
    for name in contract.timestamp_columns[1:]:
        wall = F.concat(wall, F.lit(" "), quoted(name))
    # each measure under a name that no other column has
    cells = raw.select(wall.alias("_wall"), *[parse_number(quoted(header), contract.locale).alias(f"_cell_{m}") for header, m in contract.numeric_columns.items()], *lineage)
    reasons = [F.concat(F.lit(m + ":"), F.col(f"_cell_{m}.error")) for m in contract.measures]
    values = [F.col(f"_cell_{m}.value").alias(m) for m in contract.measures]
    rows = timed(cells, contract)
    return rows.select(F.timestamp_seconds("_time.epoch").alias("timestamp_utc"), *values, F.array_compact(F.array("_time.error", *reasons)).alias("_errors"), *lineage)
