"""Registered queries of the time-series operators and their SQL counterparts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.contract import FEATURES, DatasetContract, ModelContract, parse
from tidegrid.functions.parsing import negative_text, parse_number, parse_time, safe_name
from tidegrid.operators import features, forecast, joins, metrics, model, normalize, quality, split
from tidegrid.plans import store
from tidegrid.sources import csv

QUERIES: dict = {}
ORACLES: dict = {}
KEY = "timestamp_utc"
PATTERN = "MMM d, yyyy h:mm a"


def query(sql: str | None = None):
    """Register a function (spark, tables) under its name, with its SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def series(t, kind: str | None, value: str = "price_eur_mwh") -> DataFrame:
    """The hourly sums of the events of one kind, or of all."""
    df = t("events")
    if kind:
        df = df.filter(F.col("event_type") == kind)
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return df.groupBy(hour.alias(KEY)).agg(F.round(F.sum("value"), 4).alias(value))


def hourly(kind: str | None, value: str = "price_eur_mwh") -> str:
    where = f"WHERE event_type = '{kind}'" if kind else ""
    return f"(SELECT date_trunc('hour', ts) AS timestamp_utc, round(sum(value), 4) AS {value} FROM events {where} GROUP BY 1)"


# --- numbers and times


def number_text(locale: str):
    """Prices as grouped text, with broken cases by the order's key."""
    whole = F.format_number(F.col("l_extendedprice").cast("bigint"), 0)
    if locale == "de":
        whole = F.translate(whole, ",", ".")
    cents = F.lpad(F.pmod(F.col("l_orderkey") * 7, F.lit(100)).cast("string"), 2, "0")
    text = F.concat(whole, F.lit("," if locale == "de" else "."), cents)
    case = F.pmod("l_orderkey", F.lit(50))
    return (
        F.when(case == 0, "-").when(case == 1, "broken").when(case == 2, "NaN").when(case == 3, F.concat(F.lit("  "), text, F.lit("\t")))
        .when(case == 4, "1,23.50").when(case == 5, F.lit(None)).when(case == 6, F.concat(F.lit("-"), text)).when(case == 7, " N/A ").when(case == 8, "1.2.3").otherwise(text)
    )


def number_sql(locale: str) -> str:
    whole = "format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT))"
    group, point = (".", ",") if locale == "de" else (",", ".")
    if locale == "de":
        whole = f"translate({whole}, ',', '.')"
    g = "\\." if group == "." else ","
    p = "\\." if point == "." else ","
    plain = f"replace(replace(b, '{group}', ''), '{point}', '.')"
    return f"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_orderkey % 50 AS c,
  {whole} || '{point}' || lpad(CAST((l_orderkey * 7) % 100 AS VARCHAR), 2, '0') AS t FROM lineitem),
b AS (SELECT l_orderkey, l_linenumber, CASE c WHEN 0 THEN '-' WHEN 1 THEN 'broken' WHEN 2 THEN 'NaN' WHEN 3 THEN '  ' || t || chr(9)
  WHEN 4 THEN '1,23.50' WHEN 5 THEN NULL WHEN 6 THEN '-' || t WHEN 7 THEN ' N/A ' WHEN 8 THEN '1.2.3' ELSE t END AS raw FROM a),
d AS (SELECT *, trim(raw, ' ' || chr(9)) AS o, replace(trim(raw, ' ' || chr(9)), ' ', '') AS b FROM b),
e AS (SELECT *, raw IS NULL OR lower(o) IN ('', '-', '—', 'n/a', 'na', 'null') AS missing,
  regexp_full_match(b, '[+-]?([0-9]+|[0-9]{{1,3}}({g}[0-9]{{3}})+)({p}[0-9]+)?') AS ok FROM d)
SELECT l_orderkey, l_linenumber, CASE WHEN NOT missing AND ok THEN TRY_CAST({plain} AS DOUBLE) END AS value,
  CASE WHEN missing THEN 'missing' WHEN NOT ok THEN 'invalid_number' END AS error FROM e"""


def parsed_numbers(t, locale: str) -> DataFrame:
    rows = t("lineitem").select("l_orderkey", "l_linenumber", number_text(locale).alias("raw"))
    return rows.select("l_orderkey", "l_linenumber", parse_number(F.col("raw"), locale).alias("n")).select("l_orderkey", "l_linenumber", "n.value", "n.error")


@query(number_sql("en"))
def parse_number_en(spark, t):
    return parsed_numbers(t, "en")


@query(number_sql("de"))
def parse_number_de(spark, t):
    return parsed_numbers(t, "de")


def wall_times(t) -> DataFrame:
    """Local half-hours of the orders' days, as text, some of it broken."""
    wall = F.date_trunc("day", F.col("o_orderdate").cast("timestamp")) + F.make_dt_interval(mins=(F.pmod("o_orderkey", F.lit(48)) * 30).cast("int"))
    case = F.pmod("o_orderkey", F.lit(97))
    text = F.when(case == 0, "not-a-date").when(case == 1, " ").when(case == 2, F.lit(None)).otherwise(F.date_format(wall, PATTERN))
    return t("orders").select("o_orderkey", text.alias("text"))


WALL = """w AS (SELECT o_orderkey, o_orderkey % 97 AS c, date_trunc('day', o_orderdate) + to_minutes(CAST((o_orderkey % 48) * 30 AS BIGINT)) AS wall FROM orders)"""
#: The two instants that a local time may be: those that show the wall time when read in the zone.
INSTANTS = """, k AS (SELECT *, CAST(epoch(timezone('Europe/Berlin', wall)) AS BIGINT) AS e FROM w),
g AS (SELECT *, list_sort(list_distinct(list_filter([e - 3600, e, e + 3600], lambda x: timezone('Europe/Berlin', to_timestamp(x)) = wall))) AS ok FROM k)"""


@query(f"""WITH {WALL}{INSTANTS}
SELECT o_orderkey, CASE WHEN c > 2 AND len(ok) = 1 THEN ok[1] END AS epoch,
  CASE WHEN c = 0 THEN 'invalid_timestamp' WHEN c IN (1, 2) THEN 'missing_timestamp' WHEN len(ok) = 0 THEN 'nonexistent_local_time' WHEN len(ok) = 2 THEN 'ambiguous_local_time' END AS error FROM g""")
def parse_local_time(spark, t):
    return wall_times(t).select("o_orderkey", parse_time(F.col("text"), PATTERN).alias("p")).select("o_orderkey", "p.epoch", "p.error")


def transition_rows(t) -> DataFrame:
    """For each order day the hours around two o'clock, the hour from two to three twice, in file order."""
    days = t("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    rows = days.select("day", F.posexplode(F.array(*[F.lit(x) for x in (60, 90, 120, 150, 120, 150, 180)])).alias("at", "minutes"))
    wall = F.date_format(F.col("day").cast("timestamp") + F.make_dt_interval(mins=F.col("minutes")), PATTERN)
    row = F.unix_date("day") * 10 + F.col("at")
    return rows.filter("at IN (2, 3, 4, 5) AND month(day) IN (3, 10) OR at IN (0, 1, 6)").select(
        wall.alias("Start date"), F.concat(F.lit(""), (F.pmod(row, F.lit(1000))).cast("string"), F.lit(".5")).alias("Price"), F.lit("f").alias("_source_file"), row.cast("long").alias("_source_row")
    )


def price_contract(**changes) -> DatasetContract:
    return DatasetContract(
        **{"name": "price", "expected_columns": ("Start date", "Price"), "timestamp_columns": ("Start date",), "timestamp_format": "%b %d, %Y %I:%M %p", "numeric_columns": {"Price": "price_eur_mwh"}, "locale": "en", "dst_policy": "ordered_pair"} | changes
    )


@query("""WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
r AS (SELECT day, u.pos, [60, 90, 120, 150, 120, 150, 180][u.pos + 1] AS minutes FROM days, (SELECT unnest(range(0, 7)) AS pos) u
  WHERE u.pos IN (0, 1, 6) OR month(day) IN (3, 10)),
w AS (SELECT CAST(day AS TIMESTAMP) + to_minutes(minutes) AS wall, CAST(date_diff('day', DATE '1970-01-01', day) AS BIGINT) * 10 + pos AS _source_row FROM r),
k AS (SELECT *, CAST(epoch(timezone('Europe/Berlin', wall)) AS BIGINT) AS e, count(*) OVER (PARTITION BY wall) AS n, min(_source_row) OVER (PARTITION BY wall) AS f FROM w),
g AS (SELECT *, list_sort(list_distinct(list_filter([e - 3600, e, e + 3600], lambda x: timezone('Europe/Berlin', to_timestamp(x)) = wall))) AS ok FROM k)
SELECT _source_row, CASE WHEN len(ok) = 1 THEN ok[1] WHEN len(ok) = 2 AND n = 2 THEN ok[CASE WHEN f = _source_row THEN 1 ELSE 2 END] END AS epoch,
  CASE WHEN len(ok) = 0 THEN 'nonexistent_local_time' WHEN len(ok) = 2 AND n <> 2 THEN 'ambiguous_local_time' ELSE '' END AS errors,
  (_source_row % 1000) + 0.5::DOUBLE AS price_eur_mwh FROM g""")
def dst_fold_pairs(spark, t):
    out = normalize.normalize(transition_rows(t), price_contract())
    return out.select("_source_row", F.unix_seconds(KEY).alias("epoch"), F.array_join("_errors", ",").alias("errors"), "price_eur_mwh")


def raw_orders(t) -> DataFrame:
    """Orders as raw strings, with broken numbers and times."""
    case = F.pmod("o_orderkey", F.lit(31))
    price = F.when(case == 0, "-").when(case == 1, "x1").otherwise(F.col("o_totalprice").cast("bigint").cast("string"))
    return wall_times(t).join(t("orders").select("o_orderkey", price.alias("Price")), "o_orderkey").select(
        F.col("text").alias("Start date"), "Price", F.lit("f").alias("_source_file"), F.col("o_orderkey").alias("_source_row")
    )


ERRORS = f"""WITH {WALL}{INSTANTS},
m AS (SELECT g.o_orderkey, CASE WHEN c = 0 THEN 'invalid_timestamp' WHEN c IN (1, 2) THEN 'missing_timestamp' WHEN len(ok) = 0 THEN 'nonexistent_local_time' WHEN len(ok) = 2 THEN 'ambiguous_local_time' END AS a,
  CASE o.o_orderkey % 31 WHEN 0 THEN 'price_eur_mwh:missing' WHEN 1 THEN 'price_eur_mwh:invalid_number' END AS b FROM g JOIN orders o USING (o_orderkey))"""


@query(ERRORS + " SELECT o_orderkey AS _source_row, concat_ws(',', a, b) AS errors FROM m")
def normalize_errors(spark, t):
    out = normalize.normalize(raw_orders(t), price_contract(dst_policy="strict"))
    return out.select("_source_row", F.array_join("_errors", ",").alias("errors"))


@query(ERRORS + ' SELECT error, count(*) AS "count" FROM (SELECT a AS error FROM m UNION ALL SELECT b FROM m) WHERE error IS NOT NULL GROUP BY 1')
def error_histogram(spark, t):
    return quality.error_histogram(normalize.normalize(raw_orders(t), price_contract(dst_policy="strict")))


@query("""SELECT count(*) AS rows, min(ts) AS start_utc, max(ts) AS end_utc, count(*) FILTER (WHERE CAST(floor(epoch(ts)) AS BIGINT) % 3600 <> 0) AS off_hour_rows,
  count(*) FILTER (WHERE ts IS NULL) AS null_timestamp_utc, count(*) FILTER (WHERE value IS NULL) AS null_value, count(*) FILTER (WHERE value < 0) AS negative_value FROM events""")
def profile_scalars(spark, t):
    df = t("events").select(F.col("ts").cast("timestamp").alias(KEY), "value")
    out = quality.scalars(df, ["value"])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_utc", "end_utc")})


@query("""WITH d AS (SELECT l_shipdate, count(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT l_shipdate, n AS "count", CAST((SELECT sum(n - 1) FROM d) AS BIGINT) AS duplicate_extra_rows FROM d""")
def duplicate_keys(spark, t):
    df = t("lineitem")
    return quality.duplicates(df, "l_shipdate").crossJoin(F.broadcast(quality.duplicate_extra(df, "l_shipdate")))


@query(f"""WITH s AS (SELECT timestamp_utc FROM {hourly('purchase')}), b AS (SELECT min(timestamp_utc) AS lo, max(timestamp_utc) AS hi FROM s)
SELECT g.t AS timestamp_utc FROM b, LATERAL (SELECT unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS t) g WHERE g.t NOT IN (SELECT timestamp_utc FROM s)""")
def missing_intervals(spark, t):
    return quality.missing_intervals(series(t, "purchase")).select(F.col(KEY).cast("timestamp_ntz").alias(KEY))


@query(f"""WITH s AS (SELECT epoch(timestamp_utc) - lag(epoch(timestamp_utc)) OVER (ORDER BY timestamp_utc) AS d FROM {hourly('purchase')})
SELECT count(*) FILTER (WHERE d <> 3600) AS chronology_failures FROM s""")
def chronology_failures(spark, t):
    df = series(t, "purchase")
    return quality.chronology(df.select(KEY, F.lit("f").alias("_source_file"), F.unix_seconds(KEY).alias("_source_row")))


def gated(t, kind: str) -> DataFrame:
    df = series(t, kind, "value").withColumn("_errors", F.expr("CAST(array() AS array<string>)"))
    out = quality.profile(df, ["value"], ["value"])
    return out.select(F.lit(kind).alias("dataset"), "rows", "duplicate_extra_rows", "missing_hourly_intervals", "off_hour_rows", "negative_value", "passed")


def gate_sql(kind: str) -> str:
    s = f"{hourly(kind, 'value')}"
    return f"""SELECT '{kind}' AS dataset, count(*) AS rows, count(timestamp_utc) - count(DISTINCT timestamp_utc) AS duplicate_extra_rows,
  CAST((epoch(max(timestamp_utc)) - epoch(min(timestamp_utc))) / 3600 + 1 - count(*) AS BIGINT) AS missing_hourly_intervals, count(*) FILTER (WHERE CAST(epoch(timestamp_utc) AS BIGINT) % 3600 <> 0) AS off_hour_rows, count(*) FILTER (WHERE value < 0) AS negative_value,
  (epoch(max(timestamp_utc)) - epoch(min(timestamp_utc))) / 3600 + 1 = count(*) AND count(*) FILTER (WHERE value < 0) = 0 AND count(*) FILTER (WHERE value IS NULL) = 0 AS passed FROM {s}"""


KINDS = ("click", "view", "purchase")


@query(" UNION ALL ".join(gate_sql(k) for k in KINDS))
def quality_gate(spark, t):
    a, b, c = (gated(t, k) for k in KINDS)
    return a.unionByName(b).unionByName(c)


def three(t) -> dict[str, DataFrame]:
    return {k: series(t, k, f"{k}_value") for k in KINDS}


FULL = " FULL JOIN ".join(f"{hourly(k, f'{k}_value')} {k[0]}" + (" USING (timestamp_utc)" if i else "") for i, k in enumerate(KINDS))


@query(f"""SELECT timestamp_utc, click_value, c.timestamp_utc IS NOT NULL AS _click_present, view_value, v.timestamp_utc IS NOT NULL AS _view_present,
  purchase_value, p.timestamp_utc IS NOT NULL AS _purchase_present FROM {FULL}""")
def full_outer_audit(spark, t):
    out = joins.full_outer_audit(three(t))
    flags = {f"_{k}_present": F.coalesce(f"_{k}_present", F.lit(False)) for k in KINDS}
    return out.withColumns(flags).withColumn(KEY, F.col(KEY).cast("timestamp_ntz"))


@query(f"SELECT count(*) FILTER (WHERE c.timestamp_utc IS NULL) AS click, count(*) FILTER (WHERE v.timestamp_utc IS NULL) AS view, count(*) FILTER (WHERE p.timestamp_utc IS NULL) AS purchase FROM {FULL}")
def unmatched_counts(spark, t):
    return joins.unmatched(joins.full_outer_audit(three(t)), list(KINDS))


@query(f"SELECT timestamp_utc, price_eur_mwh, timestamp_utc + INTERVAL 1 HOUR AS timestamp_end_utc FROM {hourly('view')}")
def interval_end(spark, t):
    out = joins.interval_end(series(t, "view"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (KEY, "timestamp_end_utc")})


@query("""WITH l AS (SELECT o_orderkey, timezone('Europe/Berlin', timezone('UTC', o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)))) AS x FROM orders)
SELECT o_orderkey, CAST(hour(x) AS INTEGER) AS hour, CAST(isodow(x) - 1 AS INTEGER) AS day_of_week, CAST(month(x) AS INTEGER) AS month, CAST(isodow(x) >= 6 AS INTEGER) AS is_weekend FROM l""")
def calendar_features(spark, t):
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.pmod("o_orderkey", F.lit(24)).cast("int"))
    return features.calendar(t("orders").select("o_orderkey", at.alias(KEY))).drop(KEY)


@query("SELECT event_id, round(sin(hour(ts) * 2 * pi() / 24), 9) AS hour_sin, round(cos(hour(ts) * 2 * pi() / 24), 9) AS hour_cos FROM events")
def cyclical_hour(spark, t):
    out = features.cyclical(t("events").select("event_id", F.hour("ts").alias("hour")))
    return out.select("event_id", F.round("hour_sin", 9).alias("hour_sin"), F.round("hour_cos", 9).alias("hour_cos"))


LAGS = "LEFT JOIN s a ON a.timestamp_utc = s.timestamp_utc - INTERVAL 24 HOUR LEFT JOIN s b ON b.timestamp_utc = s.timestamp_utc - INTERVAL 48 HOUR"


@query(f"WITH s AS {hourly('purchase')} SELECT s.timestamp_utc, s.price_eur_mwh, a.price_eur_mwh AS price_lag_24h, b.price_eur_mwh AS price_lag_48h FROM s {LAGS}")
def exact_lags(spark, t):
    df = series(t, "purchase")
    out = features.exact_lag(features.exact_lag(df, "price_eur_mwh", 24, "price_lag_24h"), "price_eur_mwh", 48, "price_lag_48h", df)
    return out.withColumn(KEY, F.col(KEY).cast("timestamp_ntz"))


@query("""WITH s AS (SELECT event_type, date_trunc('hour', ts) AS timestamp_utc, round(sum(value), 4) AS value FROM events GROUP BY 1, 2)
SELECT s.event_type, s.timestamp_utc, s.value, a.value AS lag_24h, b.value AS lag_48h FROM s LEFT JOIN s a ON a.event_type = s.event_type AND a.timestamp_utc = s.timestamp_utc - INTERVAL 24 HOUR
LEFT JOIN s b ON b.event_type = s.event_type AND b.timestamp_utc = s.timestamp_utc - INTERVAL 48 HOUR""")
def exact_lags_by_type(spark, t):
    df = t("events").groupBy("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias(KEY)).agg(F.round(F.sum("value"), 4).alias("value"))
    out = features.exact_lags_within(df, "value", "event_type", {"lag_24h": 24, "lag_48h": 48})
    return out.withColumn(KEY, F.col(KEY).cast("timestamp_ntz"))


@query(f"""WITH s AS {hourly('purchase')}, f AS (SELECT s.timestamp_utc AS t, a.price_eur_mwh AS x, b.price_eur_mwh AS y, sin(hour(s.timestamp_utc) * 2 * pi() / 24) AS si, cos(hour(s.timestamp_utc) * 2 * pi() / 24) AS co,
  (SELECT max(z.price_eur_mwh) FROM s z WHERE epoch(z.timestamp_utc) + 86400 = epoch(s.timestamp_utc)) AS x2, (SELECT max(z.price_eur_mwh) FROM s z WHERE epoch(z.timestamp_utc) + 172800 = epoch(s.timestamp_utc)) AS y2 FROM s {LAGS})
SELECT count(*) FILTER (WHERE x IS NULL) AS null_lag_24h, count(*) FILTER (WHERE y IS NULL) AS null_lag_48h, count(*) FILTER (WHERE x IS DISTINCT FROM x2) AS mismatch_24h, count(*) FILTER (WHERE y IS DISTINCT FROM y2) AS mismatch_48h,
  count(*) FILTER (WHERE abs(si * si + co * co - 1) > 1e-10) AS off_circle,
  count(*) FILTER (WHERE t > (SELECT max(t) FROM f) - INTERVAL 24 HOUR AND (x IS NULL OR y IS NULL)) AS recent_null_lags FROM f""")
def lag_verification(spark, t):
    df = series(t, "purchase")
    return features.verify(features.prepare(df), df)


@query(f"""WITH s AS {hourly('purchase')} SELECT s.timestamp_utc, a.price_eur_mwh AS price_lag_24h, b.price_eur_mwh AS price_lag_48h FROM s {LAGS}
WHERE a.price_eur_mwh IS NOT NULL AND b.price_eur_mwh IS NOT NULL""")
def warmup_drop(spark, t):
    out = features.prepare(series(t, "purchase")).dropna(subset=["price_lag_24h", "price_lag_48h"])
    return out.select(F.col(KEY).cast("timestamp_ntz").alias(KEY), "price_lag_24h", "price_lag_48h")


SPLIT = f"""WITH s AS {hourly(None)}, n AS (SELECT *, row_number() OVER (ORDER BY timestamp_utc) - 1 AS i, count(*) OVER () AS n FROM s),
p AS (SELECT timestamp_utc, price_eur_mwh, CASE WHEN i < CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN i < CAST(floor(n * (0.6::DOUBLE + 0.2::DOUBLE)) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM n),
q AS (SELECT * FROM p WHERE split = 'test' OR timestamp_utc < (SELECT min(timestamp_utc) FROM p z WHERE z.split = CASE p.split WHEN 'train' THEN 'validation' ELSE 'test' END) - INTERVAL 24 HOUR)"""


@query(SPLIT + " SELECT timestamp_utc, price_eur_mwh, split FROM q")
def chrono_split(spark, t):
    out = split.chronological(series(t, None), purge_hours=24)
    return out.withColumn(KEY, F.col(KEY).cast("timestamp_ntz"))


@query(SPLIT + ' SELECT split, count(*) AS rows, min(timestamp_utc) AS start, max(timestamp_utc) AS "end" FROM q GROUP BY 1')
def split_bounds(spark, t):
    out = split.bounds(split.chronological(series(t, None), purge_hours=24))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(f"""WITH s AS {hourly(None)}, f AS (SELECT s.price_eur_mwh AS y, a.price_eur_mwh AS p FROM s JOIN s a ON a.timestamp_utc = s.timestamp_utc - INTERVAL 24 HOUR)
SELECT round(avg(abs(y - p)), 6) AS mae_eur_mwh, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse_eur_mwh FROM f""")
def baseline_metrics(spark, t):
    df = features.prepare(series(t, None)).dropna(subset=["price_lag_24h"])
    out = metrics.regression(df, "price_eur_mwh", "price_lag_24h")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(SPLIT + " SELECT round(quantile_cont(price_eur_mwh, 0.5), 6) AS price_eur_mwh FROM q WHERE split = 'train'")
def train_median(spark, t):
    train = split.chronological(series(t, None), purge_hours=24).filter("split = 'train'")
    return metrics.medians(train, ["price_eur_mwh"]).select(F.round("price_eur_mwh", 6).alias("price_eur_mwh"))


@query(f"""WITH s AS {hourly('view')}, h AS (SELECT (SELECT max(timestamp_utc) FROM s) + to_hours(k) AS t FROM (SELECT unnest(range(1, 25)) AS k)),
l AS (SELECT t, timezone('Europe/Berlin', timezone('UTC', t)) AS x FROM h)
SELECT l.t AS timestamp_utc, CAST(hour(x) AS INTEGER) AS hour, CAST(isodow(x) - 1 AS INTEGER) AS day_of_week, a.price_eur_mwh AS price_lag_24h, b.price_eur_mwh AS price_lag_48h
FROM l LEFT JOIN s a ON a.timestamp_utc = l.t - INTERVAL 24 HOUR LEFT JOIN s b ON b.timestamp_utc = l.t - INTERVAL 48 HOUR""")
def horizon_features(spark, t):
    out = forecast.horizon(series(t, "view"))
    return out.select(F.col(KEY).cast("timestamp_ntz").alias(KEY), "hour", "day_of_week", "price_lag_24h", "price_lag_48h")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def latest_rows(spark, t):
    return t("orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10)


@query("""SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(trunc(c_acctbal) AS BIGINT) < 0 END AS negative FROM customer""")
def negative_diagnostic(spark, t):
    text = F.when(F.pmod("c_custkey", F.lit(17)) == 0, "n/a").otherwise(F.format_number(F.col("c_acctbal").cast("bigint"), 0))
    return t("customer").select("c_custkey", negative_text(text).alias("negative"))


@query("""SELECT count(DISTINCT run) = 1 AND bool_and(run = 'r1') AS current, list_sort(list_distinct(list(coalesce(run, ''))))::VARCHAR[] AS run_ids
FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'r1' WHEN 1 THEN 'r2' END AS run FROM orders)""")
def run_guard(spark, t):
    case = F.pmod("o_orderkey", F.lit(3))
    out = store.run_ids(t("orders").select(F.when(case == 0, "r1").when(case == 1, "r2").alias("_pipeline_run_id")))
    return out.select((F.col("run_ids") == F.array(F.lit("r1"))).alias("current"), "run_ids")


@query("SELECT DISTINCT p_name, trim(regexp_replace(lower(p_name || ' [' || p_brand || ']'), '[^a-z0-9]+', '_', 'g'), '_') AS safe FROM part")
def safe_headers(spark, t):
    name = F.concat("p_name", F.lit(" ["), "p_brand", F.lit("]"))
    return t("part").select("p_name", safe_name(name).alias("safe")).distinct()


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def row_checksums(spark, t):
    return t("documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("""SELECT event_type, count(*) AS n, '{"negatives":' || count(*) FILTER (WHERE value < 0) || ',"rows":' || count(*) || '}' AS report_json FROM events GROUP BY 1""")
def report_json(spark, t):
    out = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < 0).alias("bad"))
    return store.as_report(out.select("event_type", "n", F.col("bad").alias("negatives"), F.col("n").alias("rows")), ("event_type", "n"))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber FROM lineitem) SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM a)) AS keys FROM a""")
def lineage_keys(spark, t):
    return store.key_counts(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT event_type, o_orderpriority, n FROM (SELECT event_type, NULL AS o_orderpriority, count(*) AS n FROM events GROUP BY 1)
UNION ALL SELECT NULL, o_orderpriority, count(*) FROM orders GROUP BY 2""")
def union_by_name(spark, t):
    a = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(t("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), allowMissingColumns=True).select("event_type", "o_orderpriority", "n")


# --- models and files


def scratch(spark, name: str) -> str:
    """A folder of its own for each run of a query, in the shared one."""
    return f"{session.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def modelled(spark, t) -> tuple[dict, DataFrame, str]:
    path = scratch(spark, "gbt")
    contract = ModelContract(features=FEATURES, candidates=({"n_estimators": 10, "max_depth": 2}, {"n_estimators": 20, "max_depth": 3}))
    report, output = model.evaluate(features.prepare(series(t, None)), contract, path)
    return report, output, path


@query()
def candidate_selection(spark, t):
    report, _, _ = modelled(spark, t)
    rows = [(json.dumps(c["parameters"], sort_keys=True), float(c["mae_eur_mwh"]), c["parameters"] == report["selected_parameters"]) for c in report["validation_candidates"]]
    return spark.createDataFrame(rows, "parameters string, mae_eur_mwh double, selected boolean")


@query()
def gbt_predictions(spark, t):
    _, output, _ = modelled(spark, t)
    return output.withColumn(KEY, F.col(KEY).cast("timestamp_ntz"))


def csv_files(spark, t) -> str:
    """The orders of each priority as a CSV file in order of keys."""
    out = scratch(spark, "csv")
    rows = t("orders").select("o_orderkey", F.date_format("o_orderdate", PATTERN).alias("Start date"), F.format_number("o_totalprice", 2).alias("Price"), "o_orderpriority")
    rows = rows.repartition("o_orderpriority").sortWithinPartitions("o_orderpriority", "o_orderkey").drop("o_orderkey")
    rows.write.partitionBy("o_orderpriority").option("header", True).option("sep", ";").csv(out)
    return out + "/*/*.csv"


def file_of():
    return F.regexp_extract(F.regexp_replace("_source_file", "%20", " "), "o_orderpriority=([^/]+)", 1).alias("file")


ORDER_TEXT = """strftime(o_orderdate, '%b %-d, %Y %-I:%M %p') AS "Start date", format('{:,.2f}', o_totalprice) AS "Price", o_orderpriority AS file"""


@query(f"SELECT {ORDER_TEXT}, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) + 1 AS _source_row FROM orders")
def ordered_csv_scan(spark, t):
    """The orders of each priority as a CSV file in the shared folder, read back in order."""
    out = csv.read(spark, price_contract(path=csv_files(spark, t)))
    return out.select("Start date", "Price", "_source_row", file_of())


@query(f"SELECT {ORDER_TEXT} FROM orders")
def strict_csv_scan(spark, t):
    """The same files by the strict scan."""
    out = csv.read(spark, price_contract(path=csv_files(spark, t), dst_policy="strict"))
    return out.select("Start date", "Price", file_of())


@query("""SELECT o_orderpriority AS file, count(*) AS rows, CAST(2 AS INTEGER) AS columns, CAST(0 AS BIGINT) + count(*) FILTER (WHERE o_totalprice < 0) AS negative,
  CAST(17 + sum(strlen(strftime(o_orderdate, '%b %-d, %Y %-I:%M %p') || format('{:,.2f}', o_totalprice)) + 2) AS BIGINT) AS bytes FROM orders GROUP BY 1""")
def setup_report(spark, t):
    """Rows, columns, bytes and negative values of each file."""
    out = csv.setup_report(spark, price_contract(path=csv_files(spark, t)), "Price")
    return out.withColumnRenamed("path", "_source_file").select(file_of(), "rows", "columns", "negative", "bytes")


def a_run(spark, run_id: str) -> store.RunContext:
    source = {"datasets": {k: {"expected_columns": ["t", k], "timestamp_columns": ["t"], "timestamp_format": "%Y", "numeric_columns": {k: k}} for k in KINDS}}
    return store.RunContext(spark, scratch(spark, "run"), run_id, parse(source, profile=None))


@query("""SELECT DISTINCT o_orderstatus AS run_id, o_orderstatus = (SELECT min(o_orderstatus) FROM orders) AS accepted FROM orders""")
def manifest_guard(spark, t):
    """Of runs named by order statuses the first writes the manifest; only it is let through."""
    ids = [r[0] for r in t("orders").select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]
    first, rows = a_run(spark, ids[0]), []
    first.write_manifest()
    for run_id in ids:
        try:
            store.RunContext(spark, first.root, run_id, first.contract).verify()
            rows.append((run_id, True))
        except store.StaleRun:
            rows.append((run_id, False))
    return spark.createDataFrame(rows, "run_id string, accepted boolean")


PASSED = " UNION ALL ".join(f"SELECT '{k}' AS dataset, passed FROM ({gate_sql(k)})" for k in KINDS)


@query(f"WITH p AS ({PASSED}) SELECT dataset, passed, CASE WHEN (SELECT bool_and(passed) FROM p) THEN (SELECT count(*) FROM p) ELSE 0 END AS promoted FROM p")
def promotion(spark, t):
    """Series by kind of event: staged, gated, and promoted together or not at all."""
    run, passed = a_run(spark, "r1"), {}
    for kind in KINDS:
        run.save(series(t, kind, "value").withColumn("_errors", F.expr("CAST(array() AS array<string>)")), f"staging_{kind}")
        passed[kind] = quality.profile(run.table(f"staging_{kind}"), ["value"], ["value"]).first()["passed"]
    run.promote(passed, "staging_", "final_")
    promoted = sum(run.exists(f"final_{kind}") for kind in KINDS)
    return spark.createDataFrame([(k, ok, promoted) for k, ok in passed.items()], "dataset string, passed boolean, promoted long")
