"""Registered queries: time-series metrics (A6, A9-A17, W10, W11, T8 batch twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.config import LATENCY_BUCKETS
from riskline.functions.exprs import MICROS
from riskline.operators import metrics as M
from riskline.plans import views as V
from riskline.plans.oracle_views import view, with_views
from riskline.plans.registry import register
from riskline.sources import fixtures as fx


def slide_sql(src: str, us: str, size_s: int, slide_s: int, labels: str = "") -> str:
    """Rows expanded into their sliding windows [start, start + size)."""
    size, slide = size_s * MICROS, slide_s * MICROS
    k = size_s // slide_s
    lab = f", {labels}" if labels else ""
    return f"""SELECT CAST(floor({us} / {slide}) * {slide} - j * {slide} AS BIGINT) AS window_start_us{lab}
  FROM {src}, range(0, {k}) t(j)
  WHERE floor({us} / {slide}) * {slide} - j * {slide} + {size} > {us}"""


@register("tx_volume_day", with_views("""
SELECT CAST(floor(us / 86400000000) * 86400000000 AS BIGINT) AS bucket_us,
  CAST(count(*) AS BIGINT) AS tx_count FROM txn GROUP BY 1""", "txn"))
def tx_volume_day(spark, sf_dir):
    """A6 (as coded): transactions per day."""
    return M.volume_by_day(fx.txn(spark, sf_dir))


@register("tx_volume_5min", with_views("""
SELECT CAST(floor(us / 300000000) * 300000000 AS BIGINT) AS window_start_us,
  CAST(count(*) AS BIGINT) AS n FROM txn GROUP BY 1""", "txn"))
def tx_volume_5min(spark, sf_dir):
    """A6 (as titled): transactions per 5-minute tumbling window."""
    return M.windowed_counts(fx.txn(spark, sf_dir), "us", 300)


@register("ingest_rate", with_views(f"""
SELECT window_start_us, status, count(*) / 60.0 AS rate FROM (
  {slide_sql('ops_log', 'us', 60, 15, 'status')}) x GROUP BY 1, 2""", "ops_log"))
def ingest_rate(spark, sf_dir):
    """Events per second by status, 1-minute windows sliding every 15 s."""
    return M.windowed_counts(fx.ops_log(spark, sf_dir), "us", 60, 15, ("status",), True)


@register("flag_rate", with_views(f"""
SELECT window_start_us, rule_name, count(*) / 60.0 AS rate FROM (
  {slide_sql('flags', 'flagged_us', 60, 15, 'rule_name')}) x GROUP BY 1, 2""", "flags"))
def flag_rate(spark, sf_dir):
    """A10: flags per second by rule, 1-minute windows sliding every 15 s."""
    return M.windowed_counts(V.flags(spark, sf_dir), "flagged_us", 60, 15, ("rule_name",),
                             True)


@register("flag_increase", with_views(f"""
SELECT window_start_us, rule_name, CAST(count(*) AS BIGINT) AS n FROM (
  {slide_sql('flags', 'flagged_us', 300, 15, 'rule_name')}) x GROUP BY 1, 2""", "flags"))
def flag_increase(spark, sf_dir):
    """Flags per rule over 5-minute windows sliding every 15 s (increase)."""
    return M.windowed_counts(V.flags(spark, sf_dir), "flagged_us", 300, 15, ("rule_name",))


@register("fraud_rate", with_views("""
SELECT coalesce(p.w, f.w) AS window_start_us, CAST(coalesce(f.n, 0) AS BIGINT) AS flags,
  CAST(coalesce(p.n, 0) AS BIGINT) AS processed,
  round(CASE WHEN coalesce(p.n, 0) = 0 THEN NULL ELSE coalesce(f.n, 0) * 100.0 / p.n END, 6)
    AS fraud_rate_pct
FROM (SELECT CAST(floor(created_us / 300000000) * 300000000 AS BIGINT) AS w, count(*) AS n
      FROM txn GROUP BY 1) p
FULL JOIN (SELECT CAST(floor(flagged_us / 300000000) * 300000000 AS BIGINT) AS w, count(*) AS n
      FROM flags GROUP BY 1) f ON p.w = f.w""", "flags", "txn"))
def fraud_rate(spark, sf_dir):
    """Flags / processed x 100 per 5-minute window (can exceed 100, as the
    reference's gauge)."""
    return M.fraud_rate(V.flags(spark, sf_dir), fx.txn(spark, sf_dir), 300)


_BOUNDS = list(LATENCY_BUCKETS)


def _hist_sql() -> str:
    case = "CASE " + " ".join(f"WHEN latency_s <= {b} THEN {i}" for i, b in enumerate(_BOUNDS)) \
        + f" ELSE {len(_BOUNDS)} END"
    les = ", ".join(f"({i}, {float(b)})" for i, b in enumerate(_BOUNDS)) \
        + f", ({len(_BOUNDS)}, 'inf'::DOUBLE)"
    return f"""
SELECT g.service, CAST(g.b AS INTEGER) AS b, g.le,
  CAST(sum(coalesce(c.c, 0)) OVER (PARTITION BY g.service ORDER BY g.b
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM (SELECT s.service, l.b, l.le FROM (SELECT DISTINCT service FROM ops_log) s,
      (VALUES {les}) l(b, le)) g
LEFT JOIN (SELECT service, {case} AS b, count(*) AS c FROM ops_log GROUP BY 1, 2) c
  ON g.service = c.service AND g.b = c.b"""


view("latency_hist", ("ops_log",), _hist_sql())


@register("latency_histogram", with_views("SELECT * FROM latency_hist", "latency_hist"))
def latency_histogram(spark, sf_dir):
    """Cumulative latency buckets per service (fixed bounds + Inf)."""
    return M.latency_histogram(fx.ops_log(spark, sf_dir)).withColumn(
        "b", F.col("b").cast("int")).withColumn("cumulative", F.col("cumulative").cast("bigint"))


def _hq_sql(q: float) -> str:
    return f"""
SELECT s.service, CAST({q} AS DOUBLE) AS q, CASE WHEN f.fb IS NULL THEN t.top_le ELSE
  x.prev_le + (x.le - x.prev_le) * ((x.total * {q} - x.prev_c) / (x.cumulative - x.prev_c)) END AS value
FROM (SELECT DISTINCT service FROM latency_hist) s
LEFT JOIN (SELECT service, min(b) AS fb FROM hx WHERE le <> 'inf'::DOUBLE
             AND cumulative >= total * {q} GROUP BY service) f ON s.service = f.service
LEFT JOIN hx x ON x.service = s.service AND x.b = f.fb
LEFT JOIN (SELECT service, max(le) AS top_le FROM latency_hist WHERE le <> 'inf'::DOUBLE
           GROUP BY service) t ON s.service = t.service"""


view("hx", ("latency_hist",), """
SELECT *, coalesce(lag(cumulative) OVER (PARTITION BY service ORDER BY b), 0) AS prev_c,
  coalesce(lag(le) OVER (PARTITION BY service ORDER BY b), 0.0) AS prev_le,
  max(cumulative) OVER (PARTITION BY service) AS total
FROM latency_hist""")


@register("histogram_quantile", with_views(
    " UNION ALL ".join(f"SELECT * FROM ({_hq_sql(q)})" for q in (0.5, 0.95, 0.99)),
    "hx"))
def histogram_quantile(spark, sf_dir):
    """p50 / p95 / p99 per service from the cumulative buckets (linear in bucket,
    censored at the top finite bound)."""
    h = M.latency_histogram(fx.ops_log(spark, sf_dir))
    return M.histogram_quantile(h, [0.5, 0.95, 0.99])


@register("period_stats", with_views("""
SELECT service, CAST(floor(us / 300000000) * 300000000 AS BIGINT) AS period_us,
  quantile_cont(latency_s, 0.5) AS p50, quantile_cont(latency_s, 0.95) AS p95,
  sum(latency_s) AS total, CAST(count(*) AS BIGINT) AS n
FROM ops_log GROUP BY 1, 2""", "ops_log"))
def period_stats(spark, sf_dir):
    """Per service and 300 s period: p50 / p95 latency, sum, count."""
    return M.period_stats(fx.ops_log(spark, sf_dir))


# Alarm rules (configuration): the shipped error alarms (sum of errors over 300 s > 5 for
# 2 periods, one per service) plus a sensitive one that fires on the test tables.
ALARM_RULES = [
    ("ingest-errors", "ingest", 300, 5.0, 2),
    ("processor-errors", "processor", 300, 5.0, 2),
    ("eval-errors", "eval", 300, 5.0, 2),
    ("ingest-any-error", "ingest", 300, 0.0, 2),
]


def alarm_sql(periods: str = "range(min(period_us), max(period_us) + 1, 300000000)") -> str:
    rules = ", ".join(f"('{a}', '{s}', {p}, {t}, {n})" for a, s, p, t, n in ALARM_RULES)
    return f"""
WITH rules(alarm, service, period_s, threshold, n_periods) AS (VALUES {rules}),
vals AS (SELECT service, CAST(floor(us / 300000000) * 300000000 AS BIGINT) AS period_us,
           CAST(count(*) FILTER (WHERE status = 'failure') AS DOUBLE) AS value
         FROM ops_log GROUP BY 1, 2),
j AS (SELECT r.alarm, v.period_us, v.value FROM vals v JOIN rules r ON v.service = r.service),
grid AS (SELECT alarm, unnest({periods}) AS period_us
         FROM j GROUP BY alarm),
d AS (SELECT g.alarm, g.period_us, coalesce(j.value, 0.0) AS value, r.threshold, r.n_periods,
        coalesce(j.value, 0.0) > r.threshold AS breaching
      FROM grid g LEFT JOIN j ON g.alarm = j.alarm AND g.period_us = j.period_us
      JOIN rules r ON g.alarm = r.alarm),
k AS (SELECT *, row_number() OVER (PARTITION BY alarm ORDER BY period_us) AS k FROM d),
i AS (SELECT *, k - row_number() OVER (PARTITION BY alarm, breaching ORDER BY k) AS g FROM k),
s AS (SELECT *, CASE WHEN breaching THEN row_number() OVER (PARTITION BY alarm, breaching, g ORDER BY k)
        ELSE 0 END AS streak FROM i)
SELECT alarm, period_us, value, breaching, CAST(streak AS INTEGER) AS streak,
  streak >= n_periods AS in_alarm FROM s"""


@register("alarm_states", with_views(alarm_sql(), "ops_log"))
def alarm_states(spark, sf_dir):
    """A17 + W10: error alarms per 300 s period, missing data = not breaching, in alarm
    after n consecutive breaching periods; every period of every alarm."""
    ops = fx.ops_log(spark, sf_dir)
    vals = ops.groupBy("service", (F.floor(F.col("us") / 300_000_000) * 300_000_000)
                       .cast("bigint").alias("period_us")).agg(
        F.count_if(F.col("status") == "failure").cast("double").alias("value"))
    rules = spark.createDataFrame(
        ALARM_RULES, "alarm string, service string, period_s int, threshold double, "
                     "n_periods int")
    return M.alarm_states(vals, rules)


view("metric_samples", ("ops_log",), """
SELECT service, ts_us, CAST(sum(n) OVER (PARTITION BY service, epoch ORDER BY ts_us
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS value
FROM (SELECT service, CAST(floor(us / 15000000) * 15000000 AS BIGINT) AS ts_us,
        CAST(floor(us / 21600000000) AS BIGINT) AS epoch, count(*) AS n
      FROM ops_log GROUP BY 1, 2, 3) x""")


def metric_samples(spark, sf_dir) -> DataFrame:
    """A counter per service scraped every 15 s (buckets with events), restarting from 0
    every 6 h: the cumulative count within each restart epoch."""
    from pyspark.sql import Window

    ops = fx.ops_log(spark, sf_dir)
    g = ops.groupBy("service",
                    (F.floor(F.col("us") / 15_000_000) * 15_000_000).cast("bigint")
                    .alias("ts_us"),
                    F.floor(F.col("us") / 21_600_000_000).cast("bigint").alias("epoch")) \
        .agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("service", "epoch").orderBy("ts_us").rowsBetween(
        Window.unboundedPreceding, 0)
    return g.select("service", "ts_us", F.sum("n").over(w).cast("bigint").alias("value"))


@register("counter_increase", with_views("""
SELECT service, ts_us, value, CASE WHEN prev IS NULL THEN NULL WHEN value < prev THEN value
  ELSE value - prev END AS increase
FROM (SELECT *, lag(value) OVER (PARTITION BY service ORDER BY ts_us) AS prev
      FROM metric_samples) x""", "metric_samples"))
def counter_increase(spark, sf_dir):
    """Reset-aware increase between consecutive samples of each counter."""
    return M.counter_increase(metric_samples(spark, sf_dir))


def _range_sql(width_s: int, step_s: int) -> str:
    """The range evaluation written out over the samples of each step."""
    w, st = width_s * MICROS, step_s * MICROS
    return f"""
WITH deltas AS (
  SELECT service, ts_us, value, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS inc
  FROM (SELECT *, lag(value) OVER (PARTITION BY service ORDER BY ts_us) AS prev FROM metric_samples) x),
steps AS (SELECT service, unnest(range(lo, hi + {w} + {st}, {st})) AS at_us FROM (
  SELECT service, CAST(ceil(min(ts_us) / {st}) * {st} AS BIGINT) AS lo, max(ts_us) AS hi FROM deltas GROUP BY 1) y),
seen AS (SELECT s.service, s.at_us, d.ts_us, d.value, d.inc,
    row_number() OVER (PARTITION BY s.service, s.at_us ORDER BY d.ts_us) AS k
  FROM steps s JOIN deltas d ON d.service = s.service AND d.ts_us > s.at_us - {w} AND d.ts_us <= s.at_us),
r AS (SELECT service, at_us, count(*) AS n, (max(ts_us) - min(ts_us)) / 1e6 AS span,
    (min(ts_us) - at_us + {w}) / 1e6 AS a, (at_us - max(ts_us)) / 1e6 AS b,
    CAST(sum(CASE WHEN k > 1 THEN inc ELSE 0 END) AS DOUBLE) AS raw, CAST(min(CASE WHEN k = 1 THEN value END) AS DOUBLE) AS v0
  FROM seen GROUP BY service, at_us HAVING count(*) > 1),
e AS (SELECT *, CASE WHEN a >= 1.1 * (span / (n - 1)) THEN span / (n - 1) / 2 ELSE a END AS a2,
    CASE WHEN b >= 1.1 * (span / (n - 1)) THEN span / (n - 1) / 2 ELSE b END AS b2 FROM r),
f AS (SELECT *, raw * (span + CASE WHEN raw > 0 THEN least(a2, span * v0 / raw) ELSE a2 END + b2) / span AS increase FROM e)
SELECT service, at_us, CAST(n AS BIGINT) AS n, increase, increase / {float(width_s)} AS rate FROM f"""


@register("rate_range", with_views(_range_sql(21_600, 3_600), "metric_samples"))
def rate_range(spark, sf_dir):
    """A9 + A11 over scraped counters (W11): increase and rate per service in ranges of 6 hours
    (the test tables have an event or two an hour), evaluated every hour, with counter restarts
    and extrapolation to the range's ends."""
    return M.range_rate(metric_samples(spark, sf_dir), 21_600, 3_600)
