"""Time-series metrics: A6, A9-A17, W10, W11.

Windows use ``F.window`` (tumbling or sliding, ``[start, end)``), the same operator a
Structured Streaming query uses with a watermark (T8). A sliding window expands each row
into ``size / slide`` windows before the partial aggregation, so the shuffle carries at
most that many partial counts per key and window, never raw rows.
Histogram and alarm densification run on the aggregated table (one row per series and
bucket / period), never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.config import LATENCY_BUCKETS
from riskline.functions.exprs import MICROS, from_micros, micros


def _win(us: str, size_s: int, slide_s: int | None = None) -> Column:
    ts = from_micros(us)
    if slide_s:
        return F.window(ts, f"{size_s} seconds", f"{slide_s} seconds")
    return F.window(ts, f"{size_s} seconds")


def windowed_counts(df: DataFrame, us: str, size_s: int, slide_s: int | None = None,
                    by: tuple[str, ...] = (), per_second: bool = False) -> DataFrame:
    """Count per window (and labels); ``per_second`` divides by the window length
    (a PromQL ``rate``; ``increase`` is the plain count)."""
    if slide_s and size_s % slide_s == 0:
        # Batch form of a sliding window: count per slide slot first (partial aggregate,
        # one row per label and slot), then expand only the slot counts into the
        # size / slide windows that contain the slot -- the raw rows are never copied.
        slide = slide_s * MICROS
        k = size_s // slide_s
        slots = df.groupBy(*by, F.floor(F.col(us) / F.lit(slide)).cast("bigint")
                           .alias("_slot")).agg(F.count(F.lit(1)).alias("_c"))
        g = slots.select(*by, "_slot", "_c", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
                         .alias("_j")) \
            .withColumn("window_start_us", (F.col("_slot") - F.col("_j")) * F.lit(slide)) \
            .drop("_slot", "_j") \
            .groupBy("window_start_us", *by).agg(F.sum("_c").alias("n"))
    else:
        g = df.groupBy(_win(us, size_s, slide_s).alias("w"), *by).agg(
            F.count(F.lit(1)).alias("n")) \
            .select(micros(F.col("w.start")).alias("window_start_us"), *by, "n")
    val = (F.col("n") / F.lit(float(size_s))) if per_second else F.col("n")
    return g.select("window_start_us", *by, val.cast("double" if per_second else "bigint")
                    .alias("rate" if per_second else "n"))


def volume_by_day(df: DataFrame, us: str = "us") -> DataFrame:
    """A6 as coded: transactions per day (``date_trunc('day')``)."""
    day = F.date_trunc("day", from_micros(us))
    return df.groupBy(micros(day).alias("bucket_us")).agg(F.count(F.lit(1)).alias("tx_count"))


def fraud_rate(flags: DataFrame, processed: DataFrame, size_s: int = 300) -> DataFrame:
    """Flags / processed events x 100 per window; windows without processed events
    give null (``try_divide``). Both sides are aggregated before the join."""
    f = windowed_counts(flags, "flagged_us", size_s).withColumnRenamed("n", "flags")
    p = windowed_counts(processed, "created_us", size_s).withColumnRenamed("n", "processed")
    j = p.join(f, "window_start_us", "full")
    return j.select("window_start_us",
                    F.coalesce("flags", F.lit(0)).alias("flags"),
                    F.coalesce("processed", F.lit(0)).alias("processed"),
                    F.round(F.try_divide(F.coalesce("flags", F.lit(0)) * 100.0,
                                         F.col("processed")), 6).alias("fraud_rate_pct"))


def latency_histogram(samples: DataFrame, value: str = "latency_s", series: str = "service",
                      bounds: tuple[float, ...] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative bucket counts ``count(x <= le)`` per series, ``le = +Inf`` last.

    Each sample gets its bucket index by a CASE over the fixed bounds (no join with the
    bounds table); the per-(series, bucket) counts are then densified over the bounds and
    accumulated -- all on the small aggregated table.
    """
    idx = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        idx = F.when(F.col(value) <= F.lit(bounds[i]), F.lit(i)).otherwise(idx)
    counts = samples.groupBy(series, idx.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    les = F.array(*[F.struct(F.lit(i).alias("b"), F.lit(float(b)).alias("le"))
                    for i, b in enumerate(list(bounds) + [float("inf")])])
    grid = counts.select(series).distinct().select(series, F.inline(les))
    dense = grid.join(counts, [series, "b"], "left").fillna(0, ["c"])
    w = Window.partitionBy(series).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    return dense.select(series, "b", "le", F.sum("c").over(w).alias("cumulative"))


def histogram_quantile(hist: DataFrame, qs: float | list[float], series: str = "service"
                       ) -> DataFrame:
    """Prometheus ``histogram_quantile`` over cumulative buckets: the first finite
    bucket whose cumulative count reaches ``q * total``, linear interpolation inside it
    (lower bound 0 for the first bucket); if only ``+Inf`` reaches it, the largest finite
    bound is reported (censored, Q15). All quantiles in one pass over one histogram."""
    qs = [qs] if isinstance(qs, (int, float)) else list(qs)
    w = Window.partitionBy(series).orderBy("b")
    per = Window.partitionBy(series)
    h = hist.select(
        series, "b", "le", "cumulative",
        F.coalesce(F.lag("cumulative").over(w), F.lit(0)).alias("prev_c"),
        F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("prev_le"),
        F.max("cumulative").over(per).alias("total"),
        F.max(F.when(F.col("le") != float("inf"), F.col("le"))).over(per).alias("top_le"))
    # the quantiles fan out only after the bucket windows (lag must see one row per bucket)
    h = h.select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    reach = (F.col("le") != float("inf")) & (F.col("cumulative") >= F.col("total") * F.col("q"))
    interp = F.col("h.prev_le") + (F.col("h.le") - F.col("h.prev_le")) * (
        (F.col("h.total") * F.col("q") - F.col("h.prev_c"))
        / (F.col("h.cumulative") - F.col("h.prev_c")))
    best = h.groupBy(series, "q").agg(
        F.min_by(F.when(reach, F.struct("le", "prev_le", "cumulative", "prev_c", "total")),
                 F.when(reach, F.col("b"))).alias("h"),
        F.first("top_le").alias("top_le"))
    return best.select(series, "q", F.when(F.col("h").isNull(), F.col("top_le"))
                       .otherwise(interp).alias("value"))


def period_stats(samples: DataFrame, us: str = "us", value: str = "latency_s",
                 series: str = "service", period_s: int = 300) -> DataFrame:
    """p50 / p95 (exact, continuous), sum and count per series and period.

    The percentiles come from running counts over distinct values (no group is sorted or
    buffered in one task); sum and count are ordinary partial aggregates. Both sides are
    keyed by (series, period) and joined.
    """
    from riskline.operators.ordinal import grouped_exact_percentiles

    per = F.floor(F.col(us) / F.lit(period_s * MICROS)) * F.lit(period_s * MICROS)
    s = samples.select(series, per.cast("bigint").alias("period_us"), value)
    pct = grouped_exact_percentiles(s, [series, "period_us"], value, {"p50": 0.5, "p95": 0.95})
    tot = s.groupBy(series, "period_us").agg(F.sum(value).alias("total"),
                                              F.count(F.lit(1)).alias("n"))
    return tot.join(pct, [series, "period_us"]).select(series, "period_us", "p50", "p95",
                                                       "total", "n")


def alarm_states(values: DataFrame, rules: DataFrame, series: str = "service") -> DataFrame:
    """A17 + W10: per alarm, the statistic of each period (missing periods count as not
    breaching), ``breaching = value > threshold`` and ``in_alarm`` when the last
    ``n_periods`` periods all breach.

    ``values``: (series, period_us, value) already aggregated per period; ``rules``:
    (alarm, series, period_s, threshold, n_periods), a configuration table. Periods are
    densified per alarm with ``sequence`` between its first and last period.
    """
    r = F.broadcast(rules)
    j = values.join(r, series)
    span = j.groupBy("alarm", "period_s").agg(F.min("period_us").alias("lo"),
                                              F.max("period_us").alias("hi"))
    grid = span.select("alarm", F.explode(F.sequence(
        "lo", "hi", (F.col("period_s") * MICROS).cast("bigint"))).alias("period_us"))
    dense = grid.join(j.select("alarm", "period_us", "value"), ["alarm", "period_us"], "left") \
        .join(r.drop(series), "alarm")
    breach = F.coalesce(F.col("value"), F.lit(0.0)) > F.col("threshold")
    w = Window.partitionBy("alarm").orderBy("period_us")
    runs = dense.withColumn("breaching", breach).withColumn("_k", F.row_number().over(w))
    # gaps and islands: consecutive breaching periods share k - rank-among-breaching
    isl = Window.partitionBy("alarm", "breaching").orderBy("_k")
    runs = runs.withColumn("_g", F.col("_k") - F.row_number().over(isl))
    streak = Window.partitionBy("alarm", "breaching", "_g").orderBy("_k")
    runs = runs.withColumn("streak", F.when(F.col("breaching"), F.row_number().over(streak))
                           .otherwise(F.lit(0)))
    return runs.select("alarm", "period_us", F.coalesce("value", F.lit(0.0)).alias("value"),
                       "breaching", F.col("streak").cast("int").alias("streak"),
                       (F.col("streak") >= F.col("n_periods")).alias("in_alarm"))


def counter_increase(samples: DataFrame, series: str = "service", ts: str = "ts_us",
                     value: str = "value") -> DataFrame:
    """Reset-aware delta per series: a drop means the counter restarted, so the new
    value itself is the increase."""
    w = Window.partitionBy(series).orderBy(ts)
    prev = F.lag(value).over(w)
    return samples.select(series, ts, value,
                          F.when(prev.isNull(), F.lit(None))
                           .when(F.col(value) < prev, F.col(value))
                           .otherwise(F.col(value) - prev).alias("increase"))


def range_rate(samples: DataFrame, width_s: int, step_s: int, *, series: str = "service", ts: str = "ts_us",
               value: str = "value") -> DataFrame:
    """A9-A12 over scraped counters: at every step T (multiples of ``step_s``) the increase and
    the rate of each series over the samples in (T - width, T].

    The increase adds the deltas between the range's own samples (a drop restarts the counter at
    the new value) and is extrapolated to the range's ends: by the gap to an end, or by half the
    mean distance of samples where that gap is 1.1 times the distance or more, and at the start
    never below zero of the counter. A step needs two samples of a series in its range.

    A sample is sent to the ``width / step`` steps that see it, combined before the shuffle; the
    rows of a step are one aggregate, so no range is sorted or held.
    """
    step, width = step_s * MICROS, width_s * MICROS
    t = F.col(ts)
    deltas = counter_increase(samples.select(series, ts, value), series, ts, value) \
        .withColumn("increase", F.coalesce("increase", F.lit(0)).cast("double"))
    first_step = (F.ceil(t / F.lit(step)) * F.lit(step)).cast("long")
    last_step = (F.ceil((t + F.lit(width)) / F.lit(step)) * F.lit(step) - F.lit(step)).cast("long")
    seen = deltas.filter(first_step <= last_step).select(
        series, ts, value, "increase", F.explode(F.sequence(first_step, last_step, F.lit(step).cast("long"))).alias("at_us"))
    g = seen.groupBy(series, "at_us").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.sum("increase").alias("_sum"),
        F.min_by(F.struct(F.col(value).cast("double").alias("v"), "increase"), ts).alias("_first"))
    second = lambda us: us.cast("double") / F.lit(float(MICROS))
    inner = second(F.col("_hi") - F.col("_lo"))
    gap = inner / (F.col("n") - 1)
    far = gap * 1.1
    to_start = second(F.col("_lo") - F.col("at_us") + F.lit(width))
    to_end = second(F.col("at_us") - F.col("_hi"))
    raw = F.col("_sum") - F.col("_first.increase")          # the first sample's delta lies before the range
    to_start = F.when(to_start >= far, gap / 2).otherwise(to_start)
    to_zero = F.when(F.col("_raw") > 0, inner * F.col("_first.v") / F.col("_raw"))
    grown = F.col("_raw") * (inner + F.coalesce(F.least(to_start, to_zero), to_start)
                             + F.when(to_end >= far, gap / 2).otherwise(to_end)) / inner
    got = g.filter("n > 1").withColumn("_raw", raw).withColumn("increase", grown)
    return got.select(series, "at_us", "n", "increase", (F.col("increase") / F.lit(float(width_s))).alias("rate"))


def mean_depth(arrivals: DataFrame, us: str, period_s: int = 300, sample_s: int = 60) -> DataFrame:
    """Mean queue depth per period of a queue that nothing leaves: the mean over the period's
    samples (its depth at the end of each ``sample_s``), for every period from the first arrival
    to the last. An arrival counts in its own and all later samples, so a period needs the depth
    before it and a weighted count, never the samples themselves."""
    from riskline.operators.ordinal import global_prefix_sums

    period, sample = period_s * MICROS, sample_s * MICROS
    k = period_s // sample_s
    start = (F.floor(F.col(us) / F.lit(period)) * F.lit(period)).cast("long")
    nth = F.floor((F.col(us) - start) / F.lit(sample))
    per = arrivals.filter(F.col(us).isNotNull()).groupBy(start.alias("period_us")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum((F.lit(k) - nth).cast("long")).alias("_w"))
    run = global_prefix_sums(per, ["period_us"], {"_end": F.col("_n")})
    # a row per period: bounded by the time covered, whatever the number of arrivals
    w = Window.orderBy("period_us")
    upto = F.coalesce(F.lead("period_us").over(w), F.col("period_us") + F.lit(period))
    spans = run.withColumn("_next", upto).select(
        "period_us", "_end", "_n", "_w", F.explode(F.sequence("period_us", F.col("_next") - F.lit(period),
                                                             F.lit(period).cast("long"))).alias("_at"))
    depth = F.when(F.col("_at") == F.col("period_us"), F.col("_end") - F.col("_n") + F.col("_w") / F.lit(float(k))) \
        .otherwise(F.col("_end").cast("double"))
    return spans.select(F.col("_at").alias("period_us"), depth.cast("double").alias("value"))
