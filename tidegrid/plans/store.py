"""Run-stamped snapshots, manifests and the guards that keep stages of one run together."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.contract import Contract

MANIFEST = "pipeline_manifest"


class StaleRun(RuntimeError):
    """A table belongs to another run, or none."""


def run_ids(df: DataFrame) -> DataFrame:
    """One row: the run ids in a table, null as an empty text, in order."""
    return df.agg(F.sort_array(F.collect_set(F.coalesce("_pipeline_run_id", F.lit("")))).alias("run_ids"))


def as_report(rows: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """Each row as sorted JSON in report_json; the columns of ``beside`` stay outside."""
    return rows.select(*beside, F.to_json(F.struct(*sorted(c for c in rows.columns if c not in beside)), {"ignoreNullFields": "false"}).alias("report_json"))


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, and how many different keys they have."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"))


@dataclass(frozen=True)
class RunContext:
    """Tables of one run under ``root``: each a Parquet snapshot that a rerun replaces as a whole."""

    spark: SparkSession
    root: str
    run_id: str
    contract: Contract

    def __post_init__(self):
        if not re.fullmatch("[A-Za-z0-9_-]+", self.run_id):
            raise ValueError("run ids are of letters, digits, _ and -")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def save(self, df: DataFrame, name: str, schema_may_change: bool = False) -> None:
        """Replace a snapshot; unless allowed, its schema must stay as it was."""
        stamped = df.withColumn("_pipeline_run_id", F.lit(self.run_id))
        if not schema_may_change and self.exists(name):
            old = [(f.name, f.dataType) for f in self.spark.read.parquet(self.path(name)).schema]
            new = [(f.name, f.dataType) for f in stamped.schema]
            if old != new:
                raise ValueError(f"{name}: schema drift between runs")
        stamped.write.mode("overwrite").parquet(self.path(name))

    def report(self, name: str, content: dict) -> None:
        """A one-row audit table of sorted JSON."""
        row = self.spark.createDataFrame([(json.dumps(content, sort_keys=True, default=str),)], "report_json string")
        self.save(row.withColumn("checked_at", F.current_timestamp()), name)

    def report_row(self, name: str, row: DataFrame) -> None:
        """The same of a one-row table, without a way over the driver."""
        self.save(as_report(row).withColumn("checked_at", F.current_timestamp()), name)

    def promote(self, passed: dict[str, bool], staged: str, final: str) -> list[str]:
        """All staged tables under their final names if every one has passed, else none; the names that failed."""
        failed = [name for name, ok in passed.items() if not ok]
        for name in passed if not failed else ():
            self.save(self.table(f"{staged}{name}").drop("_pipeline_run_id"), f"{final}{name}", schema_may_change=True)
        return failed

    def write_manifest(self) -> None:
        """Written after the raw tables: a run that broke off before leaves no valid one."""
        row = [(self.contract.sha256, json.dumps(self.contract.source, sort_keys=True))]
        df = self.spark.createDataFrame(row, "config_sha256 string, config_json string").withColumn("ingested_at", F.current_timestamp())
        self.save(df, MANIFEST)

    def verify(self) -> None:
        """Raise unless the manifest is this run's and of the same contract."""
        row = self.spark.read.parquet(self.path(MANIFEST)).first()
        if row is None or row["_pipeline_run_id"] != self.run_id or row["config_sha256"] != self.contract.sha256:
            raise StaleRun("the manifest is of another run or contract")

    def table(self, name: str) -> DataFrame:
        """A snapshot of this run; empty tables and those with other or null run ids are refused."""
        df = self.spark.read.parquet(self.path(name))
        if run_ids(df).first()[0] != [self.run_id]:
            raise StaleRun(f"{name} isn't of run {self.run_id}")
        return df
