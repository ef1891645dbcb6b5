"""Point-in-time (as-of) per-user features: W1-W5, P19, J7-J9.

The reference runs 5-6 correlated SQL statements per event. Here the features are range
frames over one window spec, so all of them share one exchange.

Frames only ever grow: Spark evaluates a frame that starts at UNBOUNDED PRECEDING with one
update per row, but a sliding frame by aggregating its whole buffer again for every row,
which is quadratic in a burst of one user. Counts and sums of ``(t - w, t]`` are therefore the
difference of the running values at ``t`` and at ``t - w``. The maximum has no difference: the
time axis is cut into blocks of the window's width, so a window lies in two of them; it is the
larger of the running maximum of its own block and the maximum of the later part of the block
before, both growing frames (the latter in descending time).

Skew: a window partitioned by user alone puts a hot user (e.g. the ``unknown`` card) in
one task. Rows are therefore partitioned by ``(user, time bucket)`` where the bucket is
at least the widest window; the tail of bucket ``b-1`` that any frame of bucket ``b`` can
reach is replicated into ``b``'s partition. Frames are then exact, and a hot user is cut
into one task per bucket. The unlimited look-back of "previous event" (Q2) is completed
from a per-(user, bucket) max table, which has at most one row per user and bucket. A task
holds the rows of its partition in several sorts at once, so the number of partitions follows
the number of rows, not the session's setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.config import FeatureConfig
from riskline.functions.exprs import MICROS
from riskline.operators import dominance
from riskline.operators.ordinal import global_prefix_sums, part_count
from riskline.session import written

_B, _HOME = "_bucket", "_home"


def _bucketed(df: DataFrame, user: str, order_us: str, bucket_us: int,
              reach_us: int) -> DataFrame:
    """Assign each row to its home bucket and replicate rows within ``reach_us`` of the
    next bucket's start into that bucket as non-home (history-only) rows."""
    if reach_us > bucket_us:
        raise ValueError("time bucket must be at least as wide as the widest window")
    b = F.floor(F.col(order_us) / F.lit(bucket_us)).cast("bigint")
    home = F.struct(b.alias("b"), F.lit(True).alias("h"))
    copy = F.struct((b + 1).alias("b"), F.lit(False).alias("h"))
    near_end = F.col(order_us) >= (b + 1) * F.lit(bucket_us) - F.lit(reach_us)
    copies = F.when(near_end, F.array(home, copy)).otherwise(F.array(home))
    return (df.withColumn("_bh", F.explode(copies))
              .withColumn(_B, F.col("_bh.b")).withColumn(_HOME, F.col("_bh.h"))
              .drop("_bh"))


def _prev_fallback(df: DataFrame, user: str, order_us: str, bucket_us: int, parts: int) -> DataFrame:
    """Latest event time of each user strictly before each bucket (one row per bucket).

    There are nearly as many buckets as rows, so the rows are dealt first: an aggregate in the
    scan would hold every bucket of an input split, however large, and save little."""
    per_bucket = (df.select(user, F.floor(F.col(order_us) / F.lit(bucket_us)).cast("bigint")
                            .alias(_B), order_us)
                    .repartition(parts, user, _B)
                    .groupBy(user, _B).agg(F.max(order_us).alias("_bmax")))
    w = Window.partitionBy(user).orderBy(_B).rangeBetween(Window.unboundedPreceding, -1)
    return per_bucket.repartition(parts, user).select(user, _B, F.max("_bmax").over(w).alias("_prev_before"))


def asof_features(df: DataFrame, *, user: str = "user_id", time_us: str = "us",
                  amount: str = "amount", cfg: FeatureConfig = FeatureConfig(),
                  skew_safe: bool = True, parts: int | None = None) -> DataFrame:
    """Add, per row, the user's as-of aggregates over event time ``time_us`` (µs):

    * ``velocity_<w>s``: events with ``t - w < ts <= t`` (half-open, ties at t included)
    * ``user_amt_sum_<s>s`` / ``user_amt_max_<s>s``: sum / max amount in the same frame
      (0 when empty)
    * ``prev_us``: latest event time strictly before t (null if none)
    * ``secs_since_prev``: (t - prev) in seconds, -1.0 when none

    Rows with a null ``time_us`` get null aggregates. ``parts`` is the number of partitions
    (by default chosen by a count of the rows).
    """
    bucket_us = cfg.bucket_s * MICROS
    widest_us = max(max(cfg.count_windows_s), cfg.stats_window_s) * MICROS

    up_to_now = (Window.unboundedPreceding, 0)
    stats_us = cfg.stats_window_s * MICROS

    def since(agg: Column, spec: Window, w_us: int) -> Column:
        """``agg`` over (t - w, t]: running value at t less that at t - w."""
        gone = agg.over(spec.rangeBetween(Window.unboundedPreceding, -w_us))
        return agg.over(spec.rangeBetween(*up_to_now)) - F.coalesce(gone, F.lit(0))

    def frames(spec: Window) -> list[Column]:
        cols = [since(F.count(F.lit(1)), spec, s * MICROS).cast("bigint").alias(f"velocity_{s}s")
                for s in cfg.count_windows_s]
        cols.append(F.coalesce(since(F.sum(amount), spec, stats_us), F.lit(0))
                    .cast("decimal(28,2)").alias(f"user_amt_sum_{cfg.stats_window_s}s"))
        cols.append(F.max(time_us).over(spec.rangeBetween(Window.unboundedPreceding, -1))
                    .alias("prev_us"))
        return cols

    max_col = f"user_amt_max_{cfg.stats_window_s}s"

    def with_max(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Add the maximum over the stats window; every row also appears, as history only,
        in the block after its own, shifted by one window."""
        block = F.floor(F.col(time_us) / F.lit(stats_us)).cast("bigint")
        own = F.struct(block.alias("b"), F.lit(True).alias("own"))
        after = F.struct((block + 1).alias("b"), F.lit(False).alias("own"))
        x = rows.withColumn("_x", F.explode(F.array(own, after)))
        x = x.withColumn("_blk", F.col("_x.b")).withColumn("_own", F.col("_x.own")).drop("_x")
        x = x.withColumn("_key", F.col(time_us) + F.when(F.col("_own"), 0).otherwise(stats_us))
        w = Window.partitionBy(*keys, "_blk")
        here = F.max(F.when(F.col("_own"), F.col(amount))).over(
            w.orderBy("_key").rangeBetween(*up_to_now))
        before = F.max(F.when(~F.col("_own"), F.col(amount))).over(
            w.orderBy(F.desc("_key")).rangeBetween(Window.unboundedPreceding, -1))
        best = F.coalesce(F.greatest(here, before), F.lit(0)).cast("decimal(18,2)")
        return x.withColumn(max_col, best).filter("_own").drop("_blk", "_own", "_key")

    timed = df.filter(F.col(time_us).isNotNull())
    if not skew_safe:
        spec = Window.partitionBy(user).orderBy(time_us)
        out = with_max(timed.select("*", *frames(spec)), [user])
    else:
        if parts is None:
            parts = part_count(df.sparkSession, df.count())
        rows = _bucketed(timed, user, time_us, bucket_us, widest_us).repartition(parts, user, _B)
        spec = Window.partitionBy(user, _B).orderBy(time_us)
        win = with_max(rows.select("*", *frames(spec)), [user, _B]).filter(F.col(_HOME))
        fb = _prev_fallback(timed, user, time_us, bucket_us, parts)
        out = (win.join(fb, [user, _B], "left")
                  .withColumn("prev_us", F.coalesce("prev_us", "_prev_before"))
                  .drop(_B, _HOME, "_prev_before"))
    out = out.withColumn(
        "secs_since_prev",
        F.when(F.col("prev_us").isNull(), F.lit(-1.0))
         .otherwise((F.col(time_us) - F.col("prev_us")).cast("double") / MICROS))
    untimed = df.filter(F.col(time_us).isNull())
    return out.unionByName(untimed, allowMissingColumns=True)


def arrival_velocity(df: DataFrame, window_s: int, *, user: str = "user_id",
                     arrival_us: str = "created_us", out: str = "velocity_count",
                     skew_safe: bool = True, bucket_s: int | None = None,
                     counted: str | None = None) -> DataFrame:
    """Events of the user that *arrived* in ``[c - w, c]`` (closed lower bound).

    With ``counted`` (a boolean column) only those rows are counted; the other rows
    still pass through (with ``out`` computed over the counted ones).
    """
    w_us = window_s * MICROS
    one = F.when(F.col(counted), F.lit(1)) if counted else F.lit(1)

    def in_window(spec: Window) -> Column:
        """Running count at c less the one just before c - w: frames that only grow."""
        n = F.count(one)
        return (n.over(spec.rangeBetween(Window.unboundedPreceding, 0))
                - n.over(spec.rangeBetween(Window.unboundedPreceding, -w_us - 1))).cast("bigint")

    if not skew_safe:
        return df.withColumn(out, in_window(Window.partitionBy(user).orderBy(arrival_us)))
    bucket_us = max(bucket_s or 86400, window_s) * MICROS
    rows = _bucketed(df, user, arrival_us, bucket_us, w_us)
    spec = Window.partitionBy(user, _B).orderBy(arrival_us)
    return rows.withColumn(out, in_window(spec)).filter(F.col(_HOME)).drop(_B, _HOME)


def reachable(history: DataFrame, probes: DataFrame, width_us: int, *, user: str = "user_id",
              time_us: str = "created_us") -> DataFrame:
    """The rows of ``history`` within ``width_us`` before a row of ``probes`` of the same user, or
    nearly so: time is cut into bins of that width, and a probe asks for its own bin and the one
    before. The probes' least and greatest times bound the scan (the filter reaches Parquet's
    row groups), their (user, bin) pairs what leaves it, so the cost is that of the probes'
    windows, not of the store."""
    def bin_of(t: Column) -> Column:
        return F.floor(t / F.lit(width_us)).cast("long")

    wanted = probes.select(F.col(user).alias("_u"), F.explode(F.array(
        bin_of(F.col(time_us)), bin_of(F.col(time_us)) - 1)).alias("_b")).distinct()
    ends = probes.agg(F.min(time_us).alias("lo"), F.max(time_us).alias("hi"))
    t = F.col(time_us)
    cut = history.filter((t >= ends.select(F.col("lo") - F.lit(width_us)).scalar()) & (t <= ends.select("hi").scalar()))
    return cut.join(wanted, cut[user].eqNullSafe(F.col("_u")) & (bin_of(cut[time_us]) == F.col("_b")), "left_semi")


def arrival_features(df: DataFrame, *, user: str = "user_id", cfg: FeatureConfig = FeatureConfig(),
                     leaf_bits: int = dominance.LEAF_BITS, fan_bits: int = dominance.FAN_BITS) -> DataFrame:
    """T4: the as-of aggregates an online service sees: of the events up to ``us``, only those
    that had arrived (``created_us``) when the event itself arrived, however late they were.

    Two times bound each answer, which no window frame expresses. Events get their place in the
    global order (user, time); the ends of every window are places too, found by running counts
    over events and window ends in that same order. What had arrived of a range of places is
    answered by :mod:`riskline.operators.dominance`. The previous event is first looked for in
    the leaf before the event's own time, and only where that holds none that had arrived, up to
    the user's first event. No step groups by user.
    """
    spans = sorted({w * MICROS for w in (*cfg.count_windows_s, cfg.stats_window_s)})
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "arrivals")
    timed = rows.filter("us IS NOT NULL AND created_us IS NOT NULL").select(
        "_row", F.col(user).alias("_user"), "us", F.col("created_us").alias("arrival"),
        F.coalesce(F.col("amount") * 100, F.lit(0)).cast("bigint").alias("cents"))

    total = rows.count()

    def mark(name: str, time: Column, side: int) -> Column:
        """A row in the order: before (0), among (1) or behind (2) the events of its time."""
        own = name == "pos"
        return F.struct(F.lit(name).alias("_mark"), time.alias("_time"), F.lit(side).alias("_side"),
                        *[(F.col(c) if own else F.lit(None).cast("long")).alias(c) for c in ("us", "arrival", "cents")])

    marks = [mark("pos", F.col("us"), 1), mark("start", F.lit(None).cast("long"), 0),
             mark("before", F.col("us"), 0), mark("hi", F.col("us"), 2)]
    marks += [mark(f"lo{w}", F.col("us") - F.lit(w), 2) for w in spans]
    order = timed.select("_row", "_user", F.explode(F.array(*marks)).alias("m")).select("_row", "_user", "m.*")
    counted = global_prefix_sums(order, ["_user", "_time", "_side", "_row", "_mark"],
                                 {"_n": (F.col("_mark") == "pos").cast("long")},
                               part_count(df.sparkSession, len(marks) * total))
    at = lambda name: F.max(F.when(F.col("_mark") == name, F.col("_n")))
    placed = written(counted.repartition(part_count(df.sparkSession, len(marks) * total), "_row").groupBy("_row").agg(
        (at("pos") - 1).alias("pos"), *[at(m).alias(m) for m in ("start", "before", "hi", *[f"lo{w}" for w in spans])],
        *[F.max(c).alias(c) for c in ("us", "arrival", "cents")]), "places")
    n = placed.count()

    def answers(asked: DataFrame) -> DataFrame:
        return dominance.range_values(placed, written(asked, "pieces"), leaf_bits=leaf_bits, fan_bits=fan_bits)

    ranges = F.array(*[F.struct(F.lit(i).alias("_which"), F.col(f"lo{w}").alias("lo"), "hi") for i, w in enumerate(spans)])
    windows = placed.select("_row", "arrival", F.explode(ranges).alias("r")).select("_row", "arrival", "r.*")
    prev = F.lit(-1)
    leaf = F.shiftright(F.col("before") - 1, leaf_bits)
    base = F.shiftleft(leaf, leaf_bits)
    near = placed.filter("before > start").select(
        "_row", prev.alias("_which"), "arrival", F.lit(0).alias("tier"), leaf.alias("node"),
        (F.greatest("start", base) - base).cast("int").alias("c1"), (F.col("before") - base).cast("int").alias("c2"))
    asked = dominance.pieces(windows, n, leaf_bits, fan_bits)
    got = answers(asked.unionByName(near))
    value = lambda f, i, c: f(F.when(F.col("_which") == i, F.col(c)))
    stats = spans.index(cfg.stats_window_s * MICROS)
    got = written(got.groupBy("_row").agg(
        *[value(F.sum, spans.index(w * MICROS), "n").alias(f"velocity_{w}s") for w in cfg.count_windows_s],
        value(F.sum, stats, "total").alias("_sum"), value(F.max, stats, "largest").alias("_max"),
        F.nullif(value(F.max, -1, "latest"), F.lit(dominance.NONE)).alias("_near")), "answers")
    # none in the leaf that had arrived: the rest of the user's events
    far = placed.filter("before > start").join(got.filter("_near IS NULL").select("_row"), "_row").select(
        "_row", prev.alias("_which"), "arrival", F.col("start").alias("lo"), base.alias("hi")).filter("lo < hi")
    older = answers(dominance.pieces(far, n, leaf_bits, fan_bits)).groupBy("_row").agg(
        F.nullif(F.max("latest"), F.lit(dominance.NONE)).alias("_far"))
    money = lambda c, t: (F.col(c).cast("decimal(28,0)") / 100).cast(t)
    s = cfg.stats_window_s
    got = got.join(older, "_row", "left").select(
        "_row", *[f"velocity_{w}s" for w in cfg.count_windows_s], money("_sum", "decimal(28,2)").alias(f"user_amt_sum_{s}s"),
        money("_max", "decimal(18,2)").alias(f"user_amt_max_{s}s"), F.coalesce("_near", "_far").alias("prev_us"))
    out = rows.join(got, "_row", "left").drop("_row")
    return out.withColumn("secs_since_prev", F.when(F.col("prev_us").isNull(), F.lit(-1.0)).otherwise(
        (F.col("us") - F.col("prev_us")).cast("double") / MICROS))


def feature_vector(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), *,
                   metadata_col: str | None = None, skew_safe: bool = True,
                   precomputed: bool = False) -> DataFrame:
    """The 12 raw model features in the reference's header order.

    Currency and merchant are lower-cased here; product code, card network and e-mail
    domain are taken as given (the encoder lower-cases them, Q7). With ``metadata_col``
    (a VARIANT), the three categoricals are read from it and only JSON strings count.
    """
    f = df if precomputed else asof_features(df, cfg=cfg, skew_safe=skew_safe)
    if metadata_col:
        def meta(k: str) -> Column:
            v = F.variant_get(F.col(metadata_col), f"$.{k}", "variant")
            return F.when(F.schema_of_variant(v) == "STRING",
                          F.variant_get(F.col(metadata_col), f"$.{k}", "string")) \
                .otherwise(F.lit(""))
        cats = [meta("product_code").alias("product_code"),
                meta("card_network").alias("card_network"),
                meta("email_domain").alias("email_domain")]
    else:
        cats = [F.coalesce("product_code", F.lit("")).alias("product_code"),
                F.coalesce("card_network", F.lit("")).alias("card_network"),
                F.coalesce("email_domain", F.lit("")).alias("email_domain")]
    s = cfg.stats_window_s
    return f.select(
        "event_id", "user_id", "us",
        F.col("amount").cast("double").alias("amount"),
        *[F.col(f"velocity_{w}s") for w in cfg.count_windows_s],
        "secs_since_prev",
        F.col(f"user_amt_sum_{s}s").cast("double").alias(f"user_amt_sum_{s}s"),
        F.col(f"user_amt_max_{s}s").cast("double").alias(f"user_amt_max_{s}s"),
        F.lower("currency").alias("currency"),
        cats[0], cats[1],
        F.lower("merchant").alias("merchant"),
        cats[2],
        *[c for c in ("label",) if c in f.columns],
    )


def asof_probe(probes: DataFrame, history: DataFrame, cfg: FeatureConfig = FeatureConfig(),
               skew_safe: bool = True) -> DataFrame:
    """Features of new probe events against stored history (probe set != history).

    Probes not yet stored are added to the history (insert-if-absent), the same windows
    run once over the union, and only probe rows are kept: one shuffle, no range join.
    """
    cols = ["event_id", "user_id", "us", "amount"]
    # Only the probes' users matter, and of their history only what a window can reach; of
    # everything older, "previous event" needs the latest time per user.
    reach = max(max(cfg.count_windows_s), cfg.stats_window_s) * MICROS
    oldest = probes.agg(F.min("us")).scalar() - F.lit(reach)
    own = history.select(*cols).join(probes.select("user_id").distinct(), "user_id", "left_semi")
    recent = own.filter((F.col("us") > oldest) | F.col("us").isNull())
    last_seen = own.filter(F.col("us") <= oldest).groupBy("user_id").agg(F.max("us").alias("us")) \
        .select(F.lit(None).cast("string").alias("event_id"), "user_id", "us",
                F.lit(None).cast(probes.schema["amount"].dataType).alias("amount"))
    probe_ids = probes.select("event_id").distinct().withColumn("_probe", F.lit(True))
    # Probes already stored are marked in place (first writer wins, Q10) ...
    hist = (recent.select(*cols).unionByName(last_seen).join(probe_ids, "event_id", "left")
                  .withColumn("_probe", F.coalesce("_probe", F.lit(False))))
    # ... the others are added once.
    new = (probes.select(*cols).dropDuplicates(["event_id"])
                 .join(history.select("event_id"), "event_id", "left_anti")
                 .withColumn("_probe", F.lit(True)))
    allrows = hist.unionByName(new)
    parts = part_count(history.sparkSession, history.count())
    return asof_features(allrows, cfg=cfg, skew_safe=skew_safe, parts=parts).filter("_probe").drop("_probe")
