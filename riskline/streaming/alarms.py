"""A17 as a stream: alarms that also close the periods in which nothing arrived.

Key = alarm; state = the running value of every open period, the next period to close and the
current streak of breaching periods. An event-time timer stands at the end of the next period;
when the watermark passes it, that period and all others it has passed are closed in order, with
0 where nothing arrived (missing data is not breaching), and the next timer is set. So an alarm
goes back to normal by itself when its service falls silent.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT_SCHEMA = ("alarm string, period_us long, value double, breaching boolean, streak int, in_alarm boolean")


class AlarmPeriods(StatefulProcessor):
    """transformWithStateInPandas over (alarm)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "period long", "value double")
        self.run = handle.getValueState("run", "next long, streak int, period_us long, threshold double, n_periods int")

    @staticmethod
    def _end_ms(period: int, period_us: int) -> int:
        return -(-(period + period_us) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums: dict[int, float] = {}
        rule = None
        for pdf in rows:
            rule = (int(pdf["period_us"].iat[0]), float(pdf["threshold"].iat[0]), int(pdf["n_periods"].iat[0]))
            at = pdf["us"].to_numpy() // rule[0] * rule[0]
            for p, v in pdf["value"].groupby(at).sum().items():
                sums[int(p)] = sums.get(int(p), 0.0) + float(v)
        if not sums:
            return
        for p, v in sums.items():
            was = self.open.getValue((p,))[0] if self.open.containsKey((p,)) else 0.0
            self.open.updateValue((p,), (was + v,))
        if not self.run.exists():
            self.run.update((min(sums), 0, *rule))
            self.handle.registerTimer(self._end_ms(min(sums), rule[0]))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        nxt, streak, period_us, threshold, n_periods = self.run.get()
        mark, out = timerValues.getCurrentWatermarkInMs(), []
        while self._end_ms(nxt, period_us) <= mark:
            value = 0.0
            if self.open.containsKey((nxt,)):
                value = self.open.getValue((nxt,))[0]
                self.open.removeKey((nxt,))
            breaching = value > threshold
            streak = streak + 1 if breaching else 0
            out.append((key[0], nxt, value, breaching, streak, streak >= n_periods))
            nxt += period_us
        if out:
            self.run.update((nxt, streak, period_us, threshold, n_periods))
            self.handle.registerTimer(self._end_ms(nxt, period_us))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


def stream_alarms(events: DataFrame, rules: DataFrame, failed: str = "status = 'failure'",
                  disorder: str = "1 second") -> DataFrame:
    """A row per closed period of each alarm. ``events``: service, us, status; ``rules``: alarm,
    service, period_s, threshold, n_periods (configuration). Events that come later than
    ``disorder`` are dropped by the watermark."""
    r = F.broadcast(rules.select("alarm", "service", (F.col("period_s").cast("long") * 1_000_000).alias("period_us"),
                                 "threshold", "n_periods"))
    timed = events.withColumn("at_ts", F.timestamp_micros("us")).withWatermark("at_ts", disorder)
    rows = timed.join(r, "service").select("alarm", "us", "period_us", "threshold", "n_periods",
                                           F.expr(failed).cast("double").alias("value"), "at_ts")
    return rows.groupBy("alarm").transformWithStateInPandas(AlarmPeriods(), OUT_SCHEMA, "Append", "EventTime")
