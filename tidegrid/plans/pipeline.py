"""The stages from files to forecasts; the first failure ends a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.contract import DatasetContract
from tidegrid.operators import features, forecast, joins, model, normalize, quality
from tidegrid.plans.store import RunContext
from tidegrid.sources import csv

DATASETS = ("generation", "consumption", "price")


def ingest(run: RunContext) -> None:
    """Raw strings with lineage; the manifest last."""
    for name, contract in run.contract.datasets.items():
        raw = csv.read(run.spark, contract)
        if contract.dst_policy == "ordered_pair":
            renamed = {c: csv.safe_header(c) for c in contract.expected_columns}
            raw = csv.ordered(run.spark, contract, safe=True)
            raw = raw.select(*[F.col(s).alias(s, metadata={"header": h}) for h, s in renamed.items()], "_source_row", "_source_file", "_ingested_at")
        else:
            lineage = [c for c in raw.columns if c not in contract.expected_columns]
            raw = raw.select(*[normalize.quoted(h).alias(csv.safe_header(h), metadata={"header": h}) for h in contract.expected_columns], *lineage)
        run.save(raw, f"raw_{name}", schema_may_change=True)
    run.write_manifest()


def original_headers(raw: DataFrame, contract: DatasetContract) -> DataFrame:
    """A raw table under the headers that its columns' metadata hold, which must be all of the contract's, once each."""
    held = {f.name: f.metadata["header"] for f in raw.schema if "header" in f.metadata}
    if sorted(held.values()) != sorted(contract.expected_columns):
        raise ValueError(f"{contract.name}: the stored headers aren't those of the contract")
    if any(safe != csv.safe_header(header) for safe, header in held.items()):
        raise ValueError(f"{contract.name}: a stored header doesn't belong to its column")
    return raw.withColumnsRenamed(held)


def clean(run: RunContext) -> None:
    """Typed staging tables, an audit that always is kept, then all tables or none."""
    run.verify()
    profiles = {}
    for name, contract in run.contract.datasets.items():
        raw = original_headers(run.table(f"raw_{name}"), contract)
        typed = joins.interval_end(normalize.normalize(raw, contract))
        run.save(typed, f"staging_cleaned_{name}", schema_may_change=True)
        staged = run.table(f"staging_cleaned_{name}")
        run.save(staged.drop("_pipeline_run_id").filter(F.size("_errors") > 0), f"cleaned_conversion_audit_{name}", schema_may_change=True)
        profiles[name] = quality.profile(staged, contract.measures, contract.nonnegative, contract.nullable, "_source_row" in staged.columns)
    rows = [{"dataset": n} | p.first().asDict(recursive=True) for n, p in profiles.items()]
    run.report("cleaned_quality_report", {"datasets": rows})
    if failed := run.promote({r["dataset"]: r["passed"] for r in rows}, "staging_cleaned_", "cleaned_"):
        raise quality.GateFailed(f"quality gate: {', '.join(failed)}")


def join(run: RunContext) -> None:
    run.verify()
    series = {n: run.table(f"cleaned_{n}").drop("_pipeline_run_id") for n in run.contract.datasets}
    joined = joins.full_outer_audit(series)
    run.save(joins.interval_end(joined), "cleaned_joined")
    run.report_row("join_quality_report", joins.unmatched(run.table("cleaned_joined"), list(series)))


def prepare(run: RunContext) -> None:
    run.verify()
    joined = run.table("cleaned_joined").drop("_pipeline_run_id")
    run.save(features.prepare(joined), "features_hourly")
    found = features.verify(run.table("features_hourly"), joined).first().asDict()
    run.report("feature_quality_report", found)
    wrong = [k for k, v in found.items() if v and not k.startswith("null_lag")]
    if wrong:
        raise quality.GateFailed(f"features: {', '.join(wrong)}")


def train(run: RunContext) -> None:
    run.verify()
    report, output = model.evaluate(run.table("features_hourly"), run.contract.model, run.path("model"))
    run.report("model_evaluation", report)
    run.save(output.withColumn("forecast_origin_utc", F.col("timestamp_utc") - F.expr("INTERVAL 24 HOURS")), "predictions_test")


def predict(run: RunContext) -> None:
    run.verify()
    history = run.table("cleaned_joined")
    rows = model.predict(forecast.horizon(history), run.path("model"))
    finite = F.abs("predicted_price_eur_mwh") < F.lit(float("inf"))
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(finite).alias("finite")).first()
    if found["rows"] != 24 or found["finite"] != 24:
        raise quality.GateFailed("a forecast has 24 finite rows")
    run.save(rows.withColumn("forecast_type", F.lit("next24h")), "predictions_next24h")
    run.table("predictions_next24h").select("timestamp_utc", "predicted_price_eur_mwh").orderBy("timestamp_utc").coalesce(1).write.mode("overwrite").option("header", True).csv(run.path("predictions_csv"))


STAGES: tuple[Callable[[RunContext], None], ...] = (ingest, clean, join, prepare, train, predict)


def run_all(run: RunContext, stages: tuple[Callable[[RunContext], None], ...] = STAGES) -> list[str]:
    """Run the stages in order; returns their names."""
    for stage in stages:
        stage(run)
    return [s.__name__ for s in stages]
