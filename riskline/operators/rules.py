"""All-match fraud rules, ML blend and decisions: P10-P16, J3, J11.

Each rule is a ``(name, predicate, text)`` triple of column expressions. Evaluation builds
one array of nullable ``struct(rule_name, rule_value)`` per event, drops the nulls and
explodes: a single pass over the input instead of one scan per rule. Disabled rules
(zero / empty configuration) are not added to the plan at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.config import RULE_ORDER, SERVICE_VERSION, RulesConfig
from riskline.functions.exprs import MICROS, fixed2, fixed4, flag_id, go_quote
from riskline.operators.features import arrival_velocity, reachable

FLAG_TYPE = "struct<rule_name:string,rule_value:string>"


def _membership(col: Column, values: tuple[str, ...]) -> Column:
    """Exact, case-sensitive membership. Rule lists are configuration (a handful of
    values), so an ``IN`` list stays inside whole-stage codegen; a list of data size
    belongs in :func:`membership_join`."""
    return col.isin(list(values))


def rule_triples(cfg: RulesConfig, *, amount: str = "amount", merchant: str = "merchant",
                 currency: str = "currency", velocity: str = "velocity_count"
                 ) -> list[tuple[str, Column, Column]]:
    """The enabled rules in evaluation order."""
    out: list[tuple[str, Column, Column]] = []
    if cfg.amount_threshold > 0:
        thr = f"{cfg.amount_threshold:.2f}"
        out.append(("amount_threshold",
                    F.col(amount) > F.lit(thr).cast("decimal(18,2)"),
                    F.concat(F.lit("amount="), fixed2(F.col(amount)),
                             F.lit(f" > threshold={thr}"))))
    if cfg.velocity_window_seconds > 0 and cfg.velocity_max_count > 0:
        out.append(("velocity",
                    F.col(velocity) >= cfg.velocity_max_count,
                    F.concat(F.lit("count="), F.col(velocity).cast("string"),
                             F.lit(f" in {cfg.velocity_window_seconds}s >= "
                                   f"max={cfg.velocity_max_count}"))))
    if cfg.blocked_merchants:
        out.append(("blocked_merchant",
                    _membership(F.col(merchant), cfg.blocked_merchants),
                    F.concat(F.lit("merchant="), go_quote(F.col(merchant)),
                             F.lit(" is blocked"))))
    if cfg.high_risk_currencies:
        out.append(("high_risk_currency",
                    _membership(F.col(currency), cfg.high_risk_currencies),
                    F.concat(F.lit("currency="), go_quote(F.col(currency)),
                             F.lit(" is high-risk"))))
    return out


def ml_triple(cfg: RulesConfig, score: str = "ml_score",
              version: str = "model_version") -> tuple[str, Column, Column] | None:
    """``ml_risk`` when tau > 0 and the score reaches it."""
    if cfg.tau <= 0:
        return None
    return ("ml_risk",
            F.col(score) >= F.lit(cfg.tau),
            F.concat(F.lit("ml_score="), fixed4(F.col(score)),
                     F.lit(f" >= tau={cfg.tau:.4f} (model="), F.col(version), F.lit(")")))


def with_velocity(events: DataFrame, cfg: RulesConfig, history: DataFrame | None = None,
                  skew_safe: bool = True) -> DataFrame:
    """Attach the arrival-time velocity count (W1) the velocity rule reads. Of ``history`` only
    what the window of an event can reach is read (see :func:`reachable`); an event stored there
    keeps its stored arrival if that lies within reach."""
    if not (cfg.velocity_window_seconds > 0 and cfg.velocity_max_count > 0):
        return events
    if history is None:
        return arrival_velocity(events, cfg.velocity_window_seconds, skew_safe=skew_safe)
    cols = ["event_id", "user_id", "created_us"]
    ids = events.select("event_id").distinct().withColumn("_probe", F.lit(True))
    near = reachable(history.select(*cols), events, cfg.velocity_window_seconds * MICROS)
    h = (near.join(ids, "event_id", "left")
             .withColumn("_probe", F.coalesce("_probe", F.lit(False))))
    new = (events.select(*cols).dropDuplicates(["event_id"])
                 .join(near.select("event_id"), "event_id", "left_anti")
                 .withColumn("_probe", F.lit(True)))
    counted = arrival_velocity(h.unionByName(new), cfg.velocity_window_seconds,
                               skew_safe=skew_safe).filter("_probe")
    return events.join(counted.select("event_id", "velocity_count"), "event_id", "left")


def flag_array(triples: list[tuple[str, Column, Column]]) -> Column:
    """array(struct or null per rule) -> non-null flags, in rule order."""
    if not triples:
        return F.array().cast(f"array<{FLAG_TYPE}>")
    elems = [F.when(pred, F.struct(F.lit(name).alias("rule_name"), text.alias("rule_value")))
             for name, pred, text in triples]
    return F.filter(F.array(*elems), lambda x: x.isNotNull())


def evaluate_rules(events: DataFrame, cfg: RulesConfig, *, with_score: bool = False,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """P14 (and P15 with ``with_score``): one row per fired rule.

    Output: flag_id, event_id, user_id, rule_name, rule_value, flagged_us[, ml_score], keep...
    Every flag of an event carries the event's score, also below tau (Q12).
    """
    triples = rule_triples(cfg)
    if with_score:
        ml = ml_triple(cfg)
        if ml is not None:
            triples.append(ml)
    extra = ["ml_score"] if with_score else []
    flagged = events.select(
        "event_id", "user_id", F.col("created_us").alias("flagged_us"), *extra, *keep,
        F.explode(flag_array(triples)).alias("f"))
    return flagged.select(
        flag_id(F.col("event_id"), F.col("f.rule_name")).alias("flag_id"),
        "event_id", "user_id",
        F.col("f.rule_name").alias("rule_name"), F.col("f.rule_value").alias("rule_value"),
        "flagged_us", *extra, *keep)


def attach_scores(events: DataFrame, scores: DataFrame | None,
                  model_version: str) -> DataFrame:
    """J11 fail-open left join: a missing score means rules only, score 0 and
    ``model_version = 'unavailable'`` (Q13)."""
    if scores is None:
        return events.withColumn("ml_score", F.lit(0.0)) \
                     .withColumn("model_version", F.lit("unavailable"))
    s = scores.select("event_id", F.col("ml_score").alias("_s"))
    return (events.join(s, "event_id", "left")
                  .withColumn("model_version",
                              F.when(F.col("_s").isNull(), F.lit("unavailable"))
                               .otherwise(F.lit(model_version)))
                  .withColumn("ml_score", F.coalesce(F.col("_s"), F.lit(0.0)))
                  .drop("_s"))


def decisions(events: DataFrame, flags: DataFrame) -> DataFrame:
    """One row per event: ALLOW without flags, else FLAG, with the ordered flag list
    and ``evaluated_by`` = version[+ml-<model>].

    Flags are pre-aggregated per event (bounded by the 5 rules) before the join.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in RULE_ORDER]), F.col("rule_name"))
    per_event = (flags.groupBy("event_id")
                 .agg(F.array_sort(F.collect_list(F.struct(
                     rank.alias("rank"), F.col("rule_name"), F.col("rule_value")))).alias("_f")))
    joined = events.join(per_event, "event_id", "left")
    fl = F.coalesce(F.transform("_f", lambda x: x.dropFields("rank")),
                    F.array().cast(f"array<{FLAG_TYPE}>"))
    by = F.when(F.col("model_version") == "unavailable", F.lit(SERVICE_VERSION)) \
        .otherwise(F.concat(F.lit(SERVICE_VERSION + "+ml-"), F.col("model_version")))
    return joined.select(
        "event_id", "user_id",
        F.when(F.size(fl) == 0, F.lit("ALLOW")).otherwise(F.lit("FLAG")).alias("decision"),
        fl.alias("flags"), F.size(fl).cast("bigint").alias("n_flags"),
        by.alias("evaluated_by"), "ml_score")


def membership_join(df: DataFrame, values: DataFrame, col: str, value_col: str) -> DataFrame:
    """J3 for lists of data size: semi join; Spark broadcasts the list side only when
    its measured size is under ``spark.sql.autoBroadcastJoinThreshold``."""
    return df.join(values.select(F.col(value_col).alias(col)).distinct(), col, "left_semi")


def evaluate_decisions(scored: DataFrame, cfg: RulesConfig, with_score: bool = True
                       ) -> DataFrame:
    """P16 in one pass over the scored events: the per-event flag array is already in
    rule order, so the decision needs neither a group-by of flags nor a join back to the
    events (use :func:`decisions` when flags come from a store)."""
    triples = rule_triples(cfg)
    if with_score:
        ml = ml_triple(cfg)
        if ml is not None:
            triples.append(ml)
    fl = flag_array(triples)
    by = F.when(F.col("model_version") == "unavailable", F.lit(SERVICE_VERSION)) \
        .otherwise(F.concat(F.lit(SERVICE_VERSION + "+ml-"), F.col("model_version")))
    return scored.select(
        "event_id", "user_id",
        F.when(F.size(fl) == 0, F.lit("ALLOW")).otherwise(F.lit("FLAG")).alias("decision"),
        fl.alias("flags"), F.size(fl).cast("bigint").alias("n_flags"),
        by.alias("evaluated_by"), "ml_score")
