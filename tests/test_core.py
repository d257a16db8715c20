import math
import random
import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidegrid import contract, session
from tidegrid.functions.parsing import MISSING, parse_number, parse_time
from tidegrid.operators import features, forecast, joins, metrics, model, normalize, quality, split
from tidegrid.plans import pipeline, store
from tidegrid.sources import csv

HOUR = timedelta(hours=1)
T0 = datetime(2024, 1, 1)


def price(**changes):
    return contract.DatasetContract(
        **{"name": "price", "expected_columns": ("Start date", "End date", "Price"), "timestamp_columns": ("Start date",), "timestamp_format": "%b %d, %Y %I:%M %p", "numeric_columns": {"Price": "price_eur_mwh"}, "locale": "en", "dst_policy": "ordered_pair"} | changes
    )


def numbers(spark, rows, locale):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [(r["n"]["value"], r["n"]["error"]) for r in df.select(parse_number(F.col("x"), locale).alias("n")).collect()]


def test_numbers(spark):
    assert numbers(spark, ["1.234,56", "-23,50", "0"], "de") == [(1234.56, None), (-23.5, None), (0.0, None)]
    assert numbers(spark, ["4,815.25", "-4.08", "-", None, " n/a\t"], "en") == [(4815.25, None), (-4.08, None), *[(None, "missing")] * 3]
    assert numbers(spark, ["NaN", "Infinity", "12watts", "1,23.50", "1.2.3", "1e309", "9" * 400], "en") == [(None, "invalid_number")] * 7
    with pytest.raises(ValueError, match="locale"):
        parse_number(F.col("x"), "fr")


def test_numbers_against_scalar_rules(spark):
    rng = random.Random(1)
    letters = "0123456789" * 2 + ",.,.-+ \t\n e—\x1c \x85"
    rows = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    for locale, group, point in (("de", ".", ","), ("en", ",", ".")):
        shape = re.compile(rf"[+-]?(?:[0-9]+|[0-9]{{1,3}}(?:{re.escape(group)}[0-9]{{3}})+)(?:{re.escape(point)}[0-9]+)?")
        for text, got in zip(rows, numbers(spark, rows, locale)):
            outer = text.strip()
            bare = outer.replace(" ", "").replace(" ", "")
            if outer.lower() in MISSING:
                expected = (None, "missing")
            elif shape.fullmatch(bare):
                expected = (float(bare.replace(group, "").replace(point, ".")), None)
            else:
                expected = (None, "invalid_number")
            assert got == expected, (text, locale)


def test_every_berlin_half_hour(spark):
    zone = ZoneInfo("Europe/Berlin")
    walls = [datetime(2024, 1, 1) + timedelta(minutes=30 * i) for i in range(366 * 48)]
    df = spark.createDataFrame([(w.strftime("%Y-%m-%d %H:%M"), i % 2) for i, w in enumerate(walls)], "x string, f int")
    plain, fold = (parse_time(F.col("x"), "yyyy-MM-dd HH:mm", fold=f).alias("p") for f in (None, F.col("f")))
    for i, (w, a, b) in enumerate(zip(walls, df.select(plain).collect(), df.select(fold).collect())):
        ok = sorted({int(c.timestamp()) for f in (0, 1) if (c := w.replace(tzinfo=zone, fold=f)).astimezone(timezone.utc).astimezone(zone).replace(tzinfo=None) == w})
        error = "nonexistent_local_time" if not ok else "ambiguous_local_time" if len(ok) > 1 else None
        assert (a["p"]["epoch"], a["p"]["error"]) == (None if error else ok[0], error)
        assert b["p"]["epoch"] == (None if not ok else ok[i % 2] if len(ok) > 1 else ok[0])


def test_times_with_offset_and_broken(spark):
    df = spark.createDataFrame([("2024-10-27T02:00+0200",), (" ",), (None,), ("x",)], "x string")
    got = [(r["p"]["epoch"], r["p"]["error"]) for r in df.select(parse_time(F.col("x"), contract.java_pattern("%Y-%m-%dT%H:%M%z")).alias("p")).collect()]
    assert got == [(1729987200, None), (None, "missing_timestamp"), (None, "missing_timestamp"), (None, "invalid_timestamp")]
    with pytest.raises(ValueError, match="directive"):
        contract.java_pattern("%Q")


def write(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_corrupt_file_fails_the_gate(spark, tmp_path):
    rows = ["Jan 1, 2024 12:00 AM;x;-15.00", "Jan 1, 2024 1:00 AM;x;20.00", "Jan 1, 2024 1:00 AM;x;21.00", "Jan 1, 2024 3:00 AM;x;broken", "Jan 1, 2024 4:00 AM;x;-", "not-a-date;x;25.00"]
    c = price(path=write(tmp_path, "a.csv", ["﻿Start date;End date;Price", *rows]))
    df = normalize.normalize(csv.read(spark, c), c)
    got = quality.profile(df, c.measures, c.nonnegative, c.nullable).first()
    assert (got["rows"], got["duplicate_extra_rows"], got["missing_hourly_intervals"], got["null_price_eur_mwh"], got["negative_price_eur_mwh"], got["passed"]) == (6, 1, 1, 2, 1, False)
    assert got["conversion_errors"] == {"price_eur_mwh:invalid_number": 1, "price_eur_mwh:missing": 1, "invalid_timestamp": 1}
    assert [r["_source_row"] for r in df.orderBy("_source_row").collect()] == [2, 3, 4, 5, 6, 7]
    with pytest.raises(quality.GateFailed):
        quality.gate({"price": quality.profile(df, c.measures)})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "BatchEvalPython" not in plan


def test_header_drift_and_malformed_records(spark, tmp_path):
    c = price(path=write(tmp_path, "b.csv", ["Start date;End date;Renamed Price", "2024;2025;1"]))
    with pytest.raises(Exception, match="Schema drift"):
        csv.read(spark, c).collect()
    with pytest.raises(csv.SchemaDrift):
        csv.strict(spark, c)
    for bad in ("a;b", "", "a;b;c;d"):
        c = price(path=write(tmp_path, "c.csv", ["Start date;End date;Price", "x;y;1", bad, "x;y;2"]))
        with pytest.raises(Exception, match="record 3 of .* has [0-9]+ fields, not 3"):
            csv.read(spark, c).collect()
    with pytest.raises(Exception, match="limit of 3 bytes"):
        csv.read(spark, price(path=c.path, max_file_bytes=3)).collect()


def test_autumn_pair_and_lone_row(spark):
    c = price()
    rows = [("Oct 27, 2024 2:00 AM", "", "10", "f", 2), ("Oct 27, 2024 2:00 AM", "", "11", "f", 3)]
    schema = "`Start date` string, `End date` string, Price string, _source_file string, _source_row long"
    a, b = normalize.normalize(spark.createDataFrame(rows, schema), c).orderBy("timestamp_utc").collect()
    assert b["timestamp_utc"] - a["timestamp_utc"] == HOUR and a["price_eur_mwh"] == 10
    lone = normalize.normalize(spark.createDataFrame(rows[:1], schema), c).first()
    assert lone["timestamp_utc"] is None and lone["_errors"] == ["ambiguous_local_time"]
    with pytest.raises(ValueError, match="_source_row"):
        normalize.normalize(spark.createDataFrame(rows, schema).drop("_source_row"), c)


def hourly(spark, n, skip=(), value=float):
    rows = [(T0 + i * HOUR, value(i)) for i in range(n) if i not in skip]
    return spark.createDataFrame(rows, "timestamp_utc timestamp, price_eur_mwh double")


def test_lags_dont_cross_gaps(spark):
    df = hourly(spark, 75, skip={1})
    got = {r["timestamp_utc"]: r for r in features.prepare(df).collect()}
    assert got[T0 + 25 * HOUR]["price_lag_24h"] is None
    late = got[T0 + 72 * HOUR]
    assert (late["price_lag_24h"], late["price_lag_48h"], late["hour"]) == (48.0, 24.0, 1)
    within = features.exact_lags_within(df.withColumn("k", F.lit(1)), "price_eur_mwh", "k", {"a": 24, "b": 48}).collect()
    assert all((r["a"], r["b"]) == (got[r["timestamp_utc"]]["price_lag_24h"], got[r["timestamp_utc"]]["price_lag_48h"]) for r in within)
    assert features.verify(features.prepare(df), df).first().asDict() == {"null_lag_24h": 24, "null_lag_48h": 48, "mismatch_24h": 0, "mismatch_48h": 0, "off_circle": 0, "recent_null_lags": 0}


def test_full_outer_audit(spark):
    make = lambda rows, name: spark.createDataFrame(rows, f"timestamp_utc timestamp, {name} double")
    series = {"generation": make([(T0, 1.0)], "g"), "consumption": make([(T0, 2.0), (T0 + HOUR, 3.0)], "c"), "price": make([(T0, -5.0)], "p")}
    joined = joins.full_outer_audit(series)
    assert joined.count() == 2 and joined.transform(joins.unmatched, list(series)).first().asDict() == {"generation": 1, "consumption": 0, "price": 1}
    nulls = make([(None, 1.0)], "g")
    assert joins.full_outer_audit({"a": nulls, "b": make([(None, 1.0)], "h")}).count() == 2


def test_null_policy_and_empty_input(spark):
    schema = "timestamp_utc timestamp, x double, _errors array<string>"
    passed = lambda rows, *a: quality.profile(spark.createDataFrame(rows, schema), ["x"], *a).first()["passed"]
    assert passed([(T0, -4.08, [])]) and not passed([(T0, -4.08, [])], ["x"])
    assert not passed([(T0, None, ["x:missing"])]) and passed([(T0, None, ["x:missing"])], [], ["x"])
    assert not passed([(T0, None, ["x:invalid_number"])], [], ["x"]) and not passed([])
    empty = quality.profile(spark.createDataFrame([], schema), ["x"]).first()
    assert empty["rows"] == 0 and empty["duplicate_extra_rows"] == 0 and empty["missing_hourly_intervals"] == 0


def test_split(spark):
    parts = split.chronological(hourly(spark, 20).orderBy(F.desc("timestamp_utc")))
    assert {r["split"]: (r["rows"], r["start"]) for r in split.bounds(parts).collect()} == {"train": (12, T0), "validation": (4, T0 + 12 * HOUR), "test": (4, T0 + 16 * HOUR)}
    purged = {r["split"]: r for r in split.bounds(split.chronological(hourly(spark, 500), purge_hours=24)).collect()}
    assert purged["train"]["end"] < purged["validation"]["start"] - 24 * HOUR and purged["validation"]["end"] < purged["test"]["start"] - 24 * HOUR
    assert (purged["train"]["rows"], purged["validation"]["rows"], purged["test"]["rows"]) == (276, 76, 100)
    with pytest.raises(ValueError, match="unique"):
        split.check(hourly(spark, 3).union(hourly(spark, 1)))
    with pytest.raises(ValueError, match="fractions"):
        split.chronological(hourly(spark, 3), 0.9, 0.2)
    assert "SinglePartition" not in split.positions(hourly(spark, 20)).select("timestamp_utc", "_position")._jdf.queryExecution().optimizedPlan().toString()


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 0.0), (5.0, 5.0)], "y double, p double")
    assert metrics.regression(df, "y", "p").first() == (4 / 3, math.sqrt(10 / 3))
    assert metrics.medians(df, ["y", "p"]).first() == (3.0, 2.0)


def test_model_is_fitted_on_training_rows_only(spark, tmp_path):
    rows = [(T0 + i * HOUR, 20 * math.sin(i), None if i < 48 else float(i), None if i < 48 else float(i), None if i == 53 else 1.0 if i < 108 else 999.0) for i in range(148)]
    df = spark.createDataFrame(rows, "timestamp_utc timestamp, price_eur_mwh double, price_lag_24h double, price_lag_48h double, hour double")
    spec = contract.ModelContract(features=("hour", "price_lag_24h", "price_lag_48h"), candidates=({"n_estimators": 2, "max_depth": 2}, {"n_estimators": 3, "max_depth": 2}), purge_hours=0)
    report, output = model.evaluate(df, spec, f"file://{tmp_path}/m")
    assert report["warmup_rows_dropped"] == 48 and report["splits"]["train"]["start"] == str(T0 + 48 * HOUR) and output.count() == 20
    meta = spark.read.parquet(f"file://{tmp_path}/m/meta").first()[0]
    assert '"hour": 1.0' in meta and '"marked": ["hour"]' in meta
    assert report["validation_mae_eur_mwh"] == min(c["mae_eur_mwh"] for c in report["validation_candidates"])
    ahead = df.filter("price_lag_24h IS NOT NULL AND hour IS NOT NULL").limit(24)
    assert model.predict(ahead, f"file://{tmp_path}/m").count() == 24
    with pytest.raises(ValueError, match="all features"):
        model.predict(df, f"file://{tmp_path}/m")
    with pytest.raises(ValueError, match="null target"):
        model.evaluate(df.withColumn("price_eur_mwh", F.lit(None).cast("double")), spec, "unused")


def test_horizon(spark):
    rows = forecast.horizon(hourly(spark, 100)).orderBy("timestamp_utc").collect()
    assert [r["timestamp_utc"] for r in rows] == [T0 + (100 + i) * HOUR for i in range(24)]
    assert [r["price_lag_24h"] for r in rows] == [float(76 + i) for i in range(24)] and rows[0]["price_eur_mwh"] is None
    assert forecast.horizon(hourly(spark, 0)).count() == 0


def test_contract_rules():
    base = {"expected_columns": ["t", "x"], "timestamp_columns": ["t"], "timestamp_format": "%Y", "numeric_columns": {"x": "price_eur_mwh"}}
    names = ("generation", "consumption", "price")
    make = lambda **c: {"datasets": {n: base | {"numeric_columns": {"x": "price_eur_mwh" if n == "price" else n}} | c.get(n, {}) for n in names}, "model": {"features": ["hour"]}}
    assert contract.parse(make()).sha256 == contract.parse(make()).sha256
    for broken in ({"price": {"numeric_columns": {"y": "z"}}}, {"price": {"locale": "fr"}}, {"price": {"numeric_columns": {"x": "generation"}}}, {"price": {"numeric_columns": {"x": "Bad"}}}, {"price": {"nonnegative": ["nope"]}}):
        with pytest.raises(ValueError):
            contract.parse(make(**broken))
    with pytest.raises(ValueError, match="forecast time"):
        contract.parse(make() | {"model": {"features": ["price_eur_mwh"]}})


def test_stages_end_to_end(spark, tmp_path):
    """Hourly files that span both clock changes run from ingestion to the forecast; a bad file stops at the gate."""
    zone = ZoneInfo("Europe/Berlin")
    first = datetime(2024, 3, 20, tzinfo=timezone.utc)
    names = {"generation": "solar_mwh", "consumption": "consumption_mwh", "price": "price_eur_mwh"}
    spec = {"datasets": {}, "model": {"features": list(contract.FEATURES), "candidates": [{"n_estimators": 2, "max_depth": 2}], "purge_hours": 24}}
    for name, alias in names.items():
        lines = ["Start date;End date;Value"]
        for i in range(24 * 20):
            at = (first + i * HOUR).astimezone(zone)
            lines.append(f"{at.strftime('%b %d, %Y %I:%M %p')};x;{50 + 20 * math.sin(i / 4):.2f}")
        path = write(tmp_path, f"{name}.csv", lines)
        spec["datasets"][name] = {"path": path, "expected_columns": ["Start date", "End date", "Value"], "timestamp_columns": ["Start date"], "timestamp_format": "%b %d, %Y %I:%M %p", "locale": "en", "dst_policy": "ordered_pair", "numeric_columns": {"Value": alias}}
    run = store.RunContext(spark, f"file://{tmp_path}/out", "run-1", contract.parse(spec))
    assert pipeline.run_all(run) == ["ingest", "clean", "join", "prepare", "train", "predict"]
    assert run.table("predictions_next24h").count() == 24 and run.table("cleaned_joined").count() == 480
    later = store.RunContext(spark, run.root, "run-2", run.contract)
    for stage in (pipeline.clean, pipeline.join):
        with pytest.raises(store.StaleRun):
            stage(later)
    with open(spec["datasets"]["price"]["path"], "a") as file:
        file.write("not-a-date;x;1\n")
    pipeline.ingest(later)
    with pytest.raises(quality.GateFailed, match="price"):
        pipeline.clean(later)
    assert later.table("cleaned_conversion_audit_price").count() == 1
    with pytest.raises(store.StaleRun):
        later.table("cleaned_price")
    with pytest.raises(ValueError, match="run ids"):
        store.RunContext(spark, run.root, "a b", run.contract)


def test_shared_folder_and_written_tables(spark):
    df = session.written(spark.range(5).toDF("x"), "t")
    assert df._tidegrid_path.startswith(session.shared_dir(spark)) and df.count() == 5
    session.discard(df)


def test_strict_scan_reads_every_record(spark, tmp_path):
    """A short record fails a query that needs no column of it."""
    c = price(path=write(tmp_path, "s.csv", ["Start date;End date;Price", "x;y;-1,000", "x;y;2"]), dst_policy="strict")
    assert csv.read(spark, c).count() == 2
    got = csv.setup_report(spark, c, "Price").first()
    assert (got["rows"], got["columns"], got["negative"]) == (2, 3, 1) and len(got["sha256"]) == 64
    c = price(path=write(tmp_path, "t.csv", ["Start date;End date;Price", "x;y;1", "a;b"]), dst_policy="strict")
    with pytest.raises(Exception):
        csv.read(spark, c).count()


def test_profile_in_one_pass_equals_its_parts(spark):
    rng = random.Random(3)
    for offset in (0, 7, 0.25):
        rows = [(T0 + timedelta(seconds=offset) + rng.randrange(40) * HOUR, rng.choice([None, -1.0, 2.0]), rng.choice([[], ["x:missing"]])) for _ in range(50)]
        rows += [(None, 1.0, ["invalid_timestamp"]), (T0 + 20 * HOUR + timedelta(minutes=3), 1.0, [])]
        df = spark.createDataFrame(rows, "timestamp_utc timestamp, x double, _errors array<string>")
        got = quality.profile(df, ["x"]).first().asDict()
        parts = quality.scalars(df, ["x"]).first().asDict() | quality.duplicate_extra(df).first().asDict() | {"missing_hourly_intervals": quality.missing_intervals(df, block=7).count()}
        assert {k: got[k] for k in parts} == parts


def test_chronology_over_ranges(spark):
    rng = random.Random(8)
    rows, expected = [], 0
    for file in ("a", "b"):
        before = None
        for i in range(100):
            at = rng.choice([None, T0 + i * HOUR, T0 + i * HOUR, T0 + i * HOUR])
            rows.append((at, file, 3 * i - 20))
            expected += before is not None and at is not None and at - before != HOUR
            before = at
    df = spark.createDataFrame(rows, "timestamp_utc timestamp, _source_file string, _source_row long")
    for block in (1, 10, 65_536):
        assert quality.chronology(df.withColumn("timestamp_utc", F.col("timestamp_utc")), block=block).first()[0] == expected
    steps = spark.createDataFrame([(T0, "a", 2), (T0 + 2 * HOUR, "a", 3), (T0 + 3 * HOUR, "a", 40)], "timestamp_utc timestamp, _source_file string, _source_row long")
    assert quality.chronology(steps, block=10).first()[0] == 1


def test_only_ambiguous_rows_are_paired(spark):
    """The plan shuffles what lies behind the filter of ambiguous times, and nothing else."""
    schema = "`Start date` string, `End date` string, Price string, _source_file string, _source_row long"
    plan = normalize.normalize(spark.createDataFrame([(None, "", "1", "f", 2), ("x", "", "2", "f", 3)], schema), price())
    assert [r["_errors"] for r in plan.orderBy("_source_row").collect()] == [["missing_timestamp"], ["invalid_timestamp"]]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    window = text[text.index("Window ") :]
    assert text.count("Window ") <= 2 and "Filter" in window


def test_stored_headers_are_checked(spark):
    c = price()
    make = lambda *pairs: spark.range(1).select(*[F.lit("x").alias(safe, metadata={"header": h}) for safe, h in pairs])
    good = make(("start_date", "Start date"), ("end_date", "End date"), ("price", "Price"))
    assert pipeline.original_headers(good, c).columns == list(c.expected_columns)
    for bad in (make(("start_date", "Start date")), make(("start_date", "End date"), ("end_date", "Start date"), ("price", "Price"))):
        with pytest.raises(ValueError, match="stored header"):
            pipeline.original_headers(bad, c)


def test_shared_folder_is_needed_on_a_cluster(monkeypatch, spark):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
