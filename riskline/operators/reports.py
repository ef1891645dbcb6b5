"""Feed and operational reports: K1-K3, A1-A4, A13, A18-A22, W6.

Top-k reads are ``orderBy(...).limit(n)``, which Spark plans as TakeOrderedAndProject:
each task keeps its own n best rows and only n x tasks rows reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.config import FEED_LIMIT_DEFAULT, FEED_LIMIT_MAX


def feed_limit(n: int | None) -> int:
    """The feed's limit rule: 1..500 accepted, anything else means 50."""
    return n if n is not None and 1 <= n <= FEED_LIMIT_MAX else FEED_LIMIT_DEFAULT


def recent_flags(flag_events: DataFrame, n: int | None = None) -> DataFrame:
    """K1: latest ``n`` flags newest first, ties broken by flag_id."""
    return flag_events.orderBy(F.desc("flagged_us"), F.desc("flag_id")).limit(feed_limit(n))


def flags_since(flag_events: DataFrame, cursor_us: Column, cursor_id: Column) -> DataFrame:
    """K2: flags strictly after the (flagged_us, flag_id) cursor, oldest first.

    The reference's cursor is the timestamp alone and loses ties (all flags of an event
    share one time); the pair cursor does not.
    """
    after = (F.col("flagged_us") > cursor_us) | (
        (F.col("flagged_us") == cursor_us) & (F.col("flag_id") > cursor_id))
    return flag_events.filter(after).orderBy("flagged_us", "flag_id")


def feed_replay(flag_events: DataFrame, n: int | None = None) -> DataFrame:
    """K3: the latest ``n`` flags, replayed oldest first."""
    return recent_flags(flag_events, n).orderBy("flagged_us", "flag_id")


def status_share(ledger: DataFrame) -> DataFrame:
    """A1 + W6: events per status and their share of all events (2 decimals).

    The share's window runs over the aggregated result (one row per status), never
    over the raw rows.
    """
    counts = ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n_events"))
    everything = F.sum("n_events").over(Window.partitionBy())
    return counts.withColumn("share_pct", F.round(F.col("n_events") * 100.0 / everything, 2))


def failure_pareto(ledger: DataFrame) -> DataFrame:
    """A2: failure reasons of failed events, most frequent first."""
    return (ledger.filter(F.col("status") == "failed")
            .groupBy(F.col("error_reason").alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_failed"))
            .orderBy(F.desc("n_failed"), "reason"))


def activity_by_minute(ledger: DataFrame, now_us: Column, horizon_us: int = 3_600_000_000
                       ) -> DataFrame:
    """A4: processed events per minute and status over the last hour before ``now``."""
    minute = F.floor(F.col("last_seen_us") / 60_000_000) * 60_000_000
    return (ledger.filter(F.col("last_seen_us") > now_us - F.lit(horizon_us))
            .groupBy(minute.cast("bigint").alias("minute_us"), "status")
            .agg(F.count(F.lit(1)).alias("n_events"))
            .orderBy(F.desc("minute_us"), "status"))


def get_event(stored: DataFrame, event_id: str) -> DataFrame:
    """S7 point lookup: an equality filter on the key, pushed to the Parquet scan (min/max
    statistics and bloom filters prune row groups); empty result = NotFound."""
    return stored.filter(F.col("event_id") == F.lit(event_id))


def lookup_events(stored: DataFrame, ids: DataFrame) -> DataFrame:
    """S7 batch form: many lookups at once as one left join on the key; ``found`` is
    false for ids the store does not hold."""
    s = stored.withColumn("_hit", F.lit(True))
    return (ids.select("event_id").distinct().join(s, "event_id", "left")
               .withColumn("found", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))
