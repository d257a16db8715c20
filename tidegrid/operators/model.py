"""Candidate selection on validation rows, one test score, and prediction from the stored model."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.contract import TARGET, ModelContract
from tidegrid.operators import metrics, split

LAGS = ("price_lag_24h", "price_lag_48h")


def impute(df: DataFrame, medians: dict[str, float], marked: list[str]) -> DataFrame:
    """Nulls replaced by medians, with an indicator for each of ``marked``."""
    flags = {f"_{c}_missing": F.col(c).isNull().cast("double") for c in marked}
    return df.withColumns(flags).withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()})


def _scored(model: PipelineModel, df: DataFrame, meta: dict) -> DataFrame:
    return model.transform(impute(df, meta["medians"], meta["marked"]))


def evaluate(frame: DataFrame, contract: ModelContract, path: str) -> tuple[dict, DataFrame]:
    """Report and test predictions; the chosen model is stored at ``path``.

    Only training rows are fitted on, medians included; candidates compete on validation rows; the test
    rows are scored once, by the chosen model.
    """
    spark, features = frame.sparkSession, list(contract.features)
    if TARGET in features:
        raise ValueError("the target can't be a predictor")
    if not contract.candidates:
        raise ValueError("at least one candidate is needed")
    counts = frame.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(TARGET).isNull()).alias("nulls")).first()
    if counts["nulls"]:
        raise ValueError("rows of null target can't be scored")
    if counts["rows"] > contract.max_rows:
        raise ValueError(f"more than {contract.max_rows} rows")
    known = frame.dropna(subset=list(LAGS))
    split.check(known)
    parts = session.written(split.chronological(known, contract.train_fraction, contract.validation_fraction, contract.purge_hours), "split")
    split.check_sizes(parts)
    train, validation, test = (parts.filter(F.col("split") == p) for p in split.PARTS)
    stats = train.agg(*[F.median(c).alias(c) for c in features], *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in features]).first()
    if any(stats[c] is None for c in features):
        raise ValueError("a feature has no value in the training rows")
    meta = {"medians": {c: float(stats[c]) for c in features}, "marked": [c for c in features if stats[f"null_{c}"]], "features": features}
    inputs = [f"_{c}" for c in features] + [f"_{c}_missing" for c in meta["marked"]]
    assembler = VectorAssembler(inputCols=inputs, outputCol="_vector")
    ready = impute(train, meta["medians"], meta["marked"])
    fitted = []
    for params in contract.candidates:
        gbt = GBTRegressor(featuresCol="_vector", labelCol=TARGET, predictionCol="predicted", maxIter=params["n_estimators"], maxDepth=params["max_depth"], stepSize=0.05, seed=42)
        model = PipelineModel([assembler, gbt.fit(assembler.transform(ready))])
        mae = metrics.regression(_scored(model, validation, meta), TARGET, "predicted").first()[0]
        fitted.append((mae, model, params))
    mae, model, params = min(fitted, key=lambda x: x[0])
    output = _scored(model, test, meta).select("timestamp_utc", TARGET, F.col("predicted").alias("predicted_price_eur_mwh"), F.col(LAGS[0]).alias("baseline_24h_eur_mwh"))
    output = session.written(output, "test")
    sizes = {r["split"]: {"rows": r["rows"], "start": str(r["start"]), "end": str(r["end"])} for r in split.bounds(parts).collect()}
    report = {
        "selected_parameters": params, "validation_mae_eur_mwh": mae, "input_rows": counts["rows"], "warmup_rows_dropped": counts["rows"] - known.count(), "purge_hours": contract.purge_hours,
        "validation_candidates": [{"parameters": p, "mae_eur_mwh": m} for m, _, p in fitted], "splits": {p: sizes[p] for p in split.PARTS},
        "test": metrics.regression(output, TARGET, "predicted_price_eur_mwh").first().asDict(),
        "baseline_24h_test": metrics.regression(output, TARGET, "baseline_24h_eur_mwh").first().asDict(),
    }
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "report string").coalesce(1).write.mode("overwrite").parquet(f"{path}/report")
    return report, output


def predict(frame: DataFrame, path: str) -> DataFrame:
    """timestamp_utc and the prediction of the model stored at ``path``; incomplete rows are refused."""
    spark: SparkSession = frame.sparkSession
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()[0])
    gaps = F.lit(False)
    for c in meta["features"]:
        gaps = gaps | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    if frame.filter(gaps).limit(1).count():
        raise ValueError("rows to predict must have all features, exact lags included")
    return _scored(PipelineModel.load(f"{path}/model"), frame, meta).select("timestamp_utc", F.col("predicted").alias("predicted_price_eur_mwh"))
