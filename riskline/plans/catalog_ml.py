"""Registered queries: ML dataflow (M2-M13, M15, A20). Evaluation keys use the proxy
score of the fixtures (no trained model ships with the reference); keys that train a
model are rows-only checks."""

from __future__ import annotations

import hashlib
import inspect
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.config import TEST_RULES as C
from riskline.operators import encode as EN
from riskline.operators import evaluation as EV
from riskline.operators import keystore as S
from riskline.operators import modeldata as MD
from riskline.operators import training as TR
from riskline.operators.features import feature_vector
from riskline.operators.ordinal import part_count
from riskline.plans import views as V
from riskline.plans.oracle_views import view, with_views
from riskline.plans.registry import register
from riskline.session import checkpoint_path, written
from riskline.sources import fixtures as fx
from riskline.sources import wire


def split_df(spark, sf_dir) -> DataFrame:
    return MD.temporal_split(MD.feature_export(fx.txn_meta(spark, sf_dir), feature_vector))


def _scored_split(spark, sf_dir, which: str) -> DataFrame:
    s = split_df(spark, sf_dir).filter(F.col("split") == which)
    sc = fx.scores(spark, sf_dir).select("event_id", "ml_score")
    parts = part_count(spark, sc.count())       # the sorts of the join hold a task's share of both
    return s.repartition(parts, "event_id").join(sc.repartition(parts, "event_id"), "event_id")


view("scored_split", ("split", "scores"), """
SELECT s.*, c.ml_score FROM split s JOIN scores c ON s.event_id = c.event_id""")

view("vocab", ("split",), """
SELECT "column", CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER)
  AS position, value FROM (
  SELECT DISTINCT 'currency' AS "column", lower(coalesce(currency, '')) AS value FROM split WHERE split = 'train'
  UNION ALL SELECT DISTINCT 'product_code', lower(coalesce(product_code, '')) FROM split WHERE split = 'train'
  UNION ALL SELECT DISTINCT 'card_network', lower(coalesce(card_network, '')) FROM split WHERE split = 'train') v""")

view("freqs", ("split",), """
SELECT "column", value, round(c / (SELECT count(*) FROM split WHERE split = 'train'), 8) AS freq FROM (
  SELECT 'merchant' AS "column", lower(coalesce(merchant, '')) AS value, count(*) AS c
  FROM split WHERE split = 'train' GROUP BY 2
  UNION ALL SELECT 'email_domain', lower(coalesce(email_domain, '')), count(*)
  FROM split WHERE split = 'train' GROUP BY 2) f""")


# Uniforms of the replicates of each (score, label) group, and the Poisson distribution of
# every count that occurs (counts up to 512, the operator's part size)
view("boot_groups", ("scored_split",), """
SELECT ml_score AS score, CASE WHEN label = '1' THEN 1 ELSE 0 END AS y, count(*) AS c,
  CAST(CAST(floor(ml_score * 1e12 + 0.5) AS BIGINT) AS VARCHAR) AS k
FROM scored_split WHERE split = 'test' GROUP BY 1, 2, 4""")
view("uniforms", ("boot_groups",), """
SELECT rep, score, y, c, CAST('0x' || substr(md5(k || '|' || y || '|' || (rep // 4)), CAST(1 + 8 * (rep % 4) AS BIGINT), 8) AS BIGINT)
  / CAST(4294967296 AS DOUBLE) AS u FROM boot_groups, range(1000) r(rep)""")
view("poisson", ("boot_groups",), """
SELECT c, 0 AS k, exp(-c) AS p, exp(-c) AS cdf FROM (SELECT DISTINCT CAST(c AS DOUBLE) AS c FROM boot_groups) x
UNION ALL
SELECT c, k + 1, p * c / (k + 1), cdf + p * c / (k + 1) FROM poisson WHERE k < c + 40 + 12 * floor(sqrt(c))""")


def _train(spark, sf_dir) -> DataFrame:
    return split_df(spark, sf_dir).filter(F.col("split") == "train")


@register("onehot_vocab", with_views("SELECT * FROM vocab", "vocab"))
def onehot_vocab(spark, sf_dir):
    """M2 + K5: sorted lower-cased vocabulary per one-hot column, fitted on train only."""
    return EN.fit_vocab(_train(spark, sf_dir))


@register("freq_table", with_views("SELECT * FROM freqs", "freqs"))
def freq_table(spark, sf_dir):
    """M2: frequency encoding tables (count / n, 8 places), fitted on train only."""
    return EN.fit_frequencies(_train(spark, sf_dir))


def _onehot_sql(col: str) -> str:
    return (f"list_transform((SELECT list(value ORDER BY value) FROM vocab WHERE \"column\" = "
            f"'{col}'), lambda v: CAST(lower(coalesce(s.{col}, '')) = v AS FLOAT))")


@register("encoded_features", with_views(f"""
SELECT event_id, CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS position,
  unnest(features) AS value FROM (
SELECT s.event_id, list_concat(
  [CAST(s.amount AS FLOAT), CAST(s.velocity_60s AS FLOAT), CAST(s.velocity_3600s AS FLOAT),
   CAST(s.velocity_86400s AS FLOAT), CAST(s.secs_since_prev AS FLOAT),
   CAST(s.user_amt_sum_3600s AS FLOAT), CAST(s.user_amt_max_3600s AS FLOAT)],
  {_onehot_sql('currency')}, {_onehot_sql('product_code')}, {_onehot_sql('card_network')},
  [CAST(coalesce(m.freq, 0.0) AS FLOAT), CAST(coalesce(e.freq, 0.0) AS FLOAT)]) AS features
FROM split s
LEFT JOIN (SELECT value, freq FROM freqs WHERE "column" = 'merchant') m
  ON lower(coalesce(s.merchant, '')) = m.value
LEFT JOIN (SELECT value, freq FROM freqs WHERE "column" = 'email_domain') e
  ON lower(coalesce(s.email_domain, '')) = e.value) enc""", "vocab", "freqs"))
def encoded_features(spark, sf_dir):
    """M3 + J6: float32 vector in column order for every split row (unseen -> zeros),
    listed as (event_id, position, value)."""
    s = split_df(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    enc = EN.encode(s, EN.fit_vocab(train), EN.fit_frequencies(train))
    return enc.select("event_id", F.posexplode("features").alias("position", "value"))


@register("class_weight", with_views("""
SELECT CAST(count(*) FILTER (WHERE label = '1') AS BIGINT) AS pos,
  CAST(count(*) FILTER (WHERE label <> '1') AS BIGINT) AS neg,
  count(*) FILTER (WHERE label <> '1') / greatest(count(*) FILTER (WHERE label = '1'), 1) AS weight
FROM split WHERE split = 'train'""", "split"))
def class_weight(spark, sf_dir):
    """M6: neg / max(pos, 1) on the training split."""
    return TR.class_weight(_train(spark, sf_dir))


def _grid_sql() -> str:
    return ", ".join(f"CAST('{t!r}' AS DOUBLE)" for t in EV.linspace_grid())


@register("select_tau", with_views(f"""
SELECT coalesce(round(min(t), 4), 1.0) AS tau
FROM (SELECT unnest([{_grid_sql()}]) AS t) g
WHERE (SELECT count(*) FROM scored_split WHERE split = 'val' AND label <> '1' AND ml_score >= g.t)
  / greatest((SELECT count(*) FROM scored_split WHERE split = 'val' AND label <> '1'), 1) <= 0.01""",
                                   "scored_split"))
def select_tau(spark, sf_dir):
    """M5: smallest grid threshold with validation FPR <= 1 % (else 1.0)."""
    return EV.select_tau(_scored_split(spark, sf_dir, "val"))


view("curve", ("scored_split",), """
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CAST(sum(tp) OVER w AS BIGINT) AS tp_cum, CAST(sum(fp) OVER w AS BIGINT) AS fp_cum,
  sum(tp) OVER w / (sum(tp) OVER w + sum(fp) OVER w) AS precision,
  CASE WHEN (SELECT count(*) FROM scored_split WHERE split = 'test' AND label = '1') = 0 THEN 0.0
    ELSE sum(tp) OVER w / (SELECT count(*) FROM scored_split WHERE split = 'test' AND label = '1') END AS recall
FROM (SELECT ml_score AS score, count(*) FILTER (WHERE label = '1') AS tp,
        count(*) FILTER (WHERE label <> '1') AS fp
      FROM scored_split WHERE split = 'test' GROUP BY 1) s
WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")


def _curve(spark, sf_dir) -> DataFrame:
    return EV.pr_curve(_scored_split(spark, sf_dir, "test"))


@register("pr_curve", with_views("SELECT * FROM curve", "curve"))
def pr_curve(spark, sf_dir):
    """M12 + W8: PR-curve points of the test split (range-partitioned prefix sums)."""
    return _curve(spark, sf_dir)


@register("average_precision", with_views("""
SELECT round(sum(tp / (SELECT sum(tp) FROM curve) * precision), 9) AS average_precision
FROM curve""", "curve"))
def average_precision(spark, sf_dir):
    """M9 (Q14): step-sum average precision on the test split."""
    return EV.average_precision(_curve(spark, sf_dir))


_RULE_PRED = f"amount > {C.amount_threshold}"
view("rules_pr", ("scored_split",), f"""
SELECT CAST(count(*) FILTER (WHERE {_RULE_PRED} AND label = '1') AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE {_RULE_PRED} AND label <> '1') AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE NOT ({_RULE_PRED}) AND label = '1') AS BIGINT) AS fn
FROM scored_split WHERE split = 'test'""")


@register("recall_at_precision", with_views("""
SELECT coalesce(max(recall), 0.0) AS recall_at_precision FROM curve
WHERE precision >= (SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END FROM rules_pr)""",
                                            "curve", "rules_pr"))
def recall_at_precision(spark, sf_dir):
    """Best ML recall at the precision of the amount rule."""
    test = _scored_split(spark, sf_dir, "test")
    rp = EV.confusion(test, F.col("amount") > C.amount_threshold).select("precision")
    return EV.recall_at_precision(EV.pr_curve(test), rp.scalar())


_SAFE = "CASE WHEN {1} = 0 THEN 0.0 ELSE {0} / ({1}) END"


@register("model_report", with_views(f"""
SELECT approach, precision, recall, average_precision, base_rate,
  CASE WHEN base_rate > 0 THEN round(average_precision / base_rate, 6) END AS lift
FROM (
  SELECT 'rules' AS approach, {_SAFE.format('tp', 'tp + fp')} AS precision,
    {_SAFE.format('tp', 'tp + fn')} AS recall, NULL::DOUBLE AS average_precision FROM rules_pr
  UNION ALL
  SELECT 'blend', {_SAFE.format('tp', 'tp + fp')}, {_SAFE.format('tp', 'tp + fn')}, NULL::DOUBLE FROM (
    SELECT count(*) FILTER (WHERE p AND label = '1') AS tp, count(*) FILTER (WHERE p AND label <> '1') AS fp,
      count(*) FILTER (WHERE NOT p AND label = '1') AS fn
    FROM (SELECT *, ({_RULE_PRED}) OR ml_score >= {C.tau} AS p FROM scored_split WHERE split = 'test') x) b
  UNION ALL
  SELECT 'ml', {_SAFE.format('tp', 'tp + fp')},
    (SELECT coalesce(max(recall), 0.0) FROM curve
     WHERE precision >= (SELECT {_SAFE.format('tp', 'tp + fp')} FROM rules_pr)),
    (SELECT round(sum(tp / (SELECT sum(tp) FROM curve) * precision), 9) FROM curve) FROM rules_pr
  UNION ALL
  SELECT 'amount', NULL, NULL, round(sum(tp / t * (ct / (ct + cf))), 9) FROM (
    SELECT tp, sum(tp) OVER () AS t, sum(tp) OVER w AS ct, sum(fp) OVER w AS cf FROM (
      SELECT amount, count(*) FILTER (WHERE label = '1') AS tp, count(*) FILTER (WHERE label <> '1') AS fp
      FROM scored_split WHERE split = 'test' GROUP BY 1) g
    WINDOW w AS (ORDER BY amount DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) a) r
CROSS JOIN (SELECT avg(CASE WHEN label = '1' THEN 1.0 ELSE 0.0 END) AS base_rate
            FROM scored_split WHERE split = 'test') b""",
                                     "curve", "rules_pr"))
def model_report(spark, sf_dir):
    """Per approach: rules alone and blend (rules OR score >= tau) with precision and
    recall; the model with its average precision and its recall at the rules' precision;
    the amount alone as a score; base rate and lift (average precision / base rate). The
    interval of the average precision is ``bootstrap_ci``."""
    test = written(_scored_split(spark, sf_dir, "test"), "test-split")
    rules_pred = F.col("amount") > C.amount_threshold
    none = F.lit(None).cast("double")
    base = test.agg(F.avg((F.col("label") == "1").cast("double"))).scalar()

    def confusion(name: str, pred) -> DataFrame:
        return EV.confusion(test, pred).select(F.lit(name).alias("approach"), "precision", "recall",
                                               none.alias("average_precision"))

    rules = confusion("rules", rules_pred)
    blend = confusion("blend", rules_pred | (F.col("ml_score") >= C.tau))
    curve = EV.pr_curve(test)
    at = EV.recall_at_precision(curve, rules.select("precision").scalar()).scalar()
    ml = EV.average_precision(curve).select(
        F.lit("ml").alias("approach"), rules.select("precision").scalar().alias("precision"),
        at.alias("recall"), "average_precision")
    amount = EV.average_precision(EV.pr_curve(test, score="amount")).select(
        F.lit("amount").alias("approach"), none.alias("precision"), none.alias("recall"),
        "average_precision")
    out = rules.unionByName(blend).unionByName(ml).unionByName(amount).withColumn("base_rate", base)
    return out.withColumn("lift", F.when(F.col("base_rate") > 0,
                                         F.round(F.col("average_precision") / F.col("base_rate"), 6)))


@register("rule_quality", with_views("""
SELECT r.rule_name, CAST(coalesce(s.tp, 0) AS BIGINT) AS tp, CAST(coalesce(s.fp, 0) AS BIGINT) AS fp,
  CAST((SELECT count(*) FROM txn WHERE label = '1') - coalesce(s.tp, 0) AS BIGINT) AS fn,
  CASE WHEN coalesce(s.tp, 0) + coalesce(s.fp, 0) = 0 THEN 0.0
    ELSE coalesce(s.tp, 0) / (coalesce(s.tp, 0) + coalesce(s.fp, 0)) END AS precision,
  coalesce(s.tp, 0) / (SELECT count(*) FROM txn WHERE label = '1') AS recall
FROM (SELECT DISTINCT rule_name FROM flags UNION ALL SELECT 'ALL') r
LEFT JOIN (
  SELECT f.rule_name, count(*) FILTER (WHERE t.label = '1') AS tp,
    count(*) FILTER (WHERE t.label <> '1') AS fp
  FROM (SELECT DISTINCT event_id, rule_name FROM flags
        UNION ALL SELECT DISTINCT event_id, 'ALL' FROM flags) f
  JOIN txn t ON f.event_id = t.event_id GROUP BY 1) s ON r.rule_name = s.rule_name""",
                                     "flags", "txn"))
def rule_quality(spark, sf_dir):
    """Per rule and overall: TP / FP / FN, precision, recall against the label."""
    return EV.rule_quality(V.flags(spark, sf_dir), fx.txn(spark, sf_dir))


@register("bootstrap_ci", with_views("""
SELECT quantile_cont(ap, 0.025) AS ci_low, quantile_cont(ap, 0.975) AS ci_high, CAST(count(*) AS BIGINT) AS replicates FROM (
  SELECT rep, sum(t * CAST(ct AS DOUBLE) / greatest(ct + cf, 1)) / sum(t) AS ap FROM (
    SELECT rep, score, t, sum(t) OVER o AS ct, sum(f) OVER o AS cf FROM (
      SELECT rep, score, sum(CASE WHEN y = 1 THEN k ELSE 0 END) AS t, sum(CASE WHEN y = 0 THEN k ELSE 0 END) AS f FROM (
        SELECT u.rep, u.score, u.y, count(p.k) AS k FROM uniforms u LEFT JOIN poisson p ON p.c = u.c AND p.cdf <= u.u
        GROUP BY ALL) w GROUP BY rep, score) s
    WINDOW o AS (PARTITION BY rep ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) v
  GROUP BY rep HAVING sum(t) > 0) r""", "uniforms", "poisson"))
def bootstrap_ci(spark, sf_dir):
    """Poisson-bootstrap 95 % interval of the test average precision (1000
    replicates over distinct (score, label) groups; weights from digests both engines share)."""
    return EV.bootstrap_ap(_scored_split(spark, sf_dir, "test"))


def _encoded_splits(spark, sf_dir):
    s = split_df(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    return EN.encode(s, EN.fit_vocab(train), EN.fit_frequencies(train))


def _model_path(spark, sf_dir) -> str:
    """Where the model of M7 lies: by input, parameters and encoder."""
    text = repr(sorted(TR.GBT_PARAMS.items())) + inspect.getsource(EN) + inspect.getsource(TR)
    return checkpoint_path(spark, f"models/gbt-{wire.content_tag(spark, sf_dir)}-"
                                  f"{hashlib.sha256(text.encode()).hexdigest()[:12]}")


def _save(spark, model, path: str) -> None:
    """The marker is written last: a save that was lost half-way is no model."""
    model.write().overwrite().save(f"{path}/model")
    spark.range(1).write.mode("overwrite").parquet(f"{path}/complete")


def _fit(spark, sf_dir, enc: DataFrame):
    """Train the model of M7 and keep it beside the other derived tables."""
    model = TR.train_gbt(enc.filter(F.col("split") == "train"))
    _save(spark, model, _model_path(spark, sf_dir))
    return model


def _model(spark, sf_dir, enc: DataFrame):
    """The model of M7: the kept one, trained if there is none."""
    from pyspark.ml.classification import GBTClassificationModel

    path = _model_path(spark, sf_dir)
    if not S.exists(spark, f"{path}/complete/_SUCCESS"):
        return _fit(spark, sf_dir, enc)
    return GBTClassificationModel.load(f"{path}/model")


@register("train_gbt")
def train_gbt(spark, sf_dir):
    """M7 + M8 + M9: train the gradient-boosted model on the training split (always anew) and
    report average precision per split."""
    enc = written(_encoded_splits(spark, sf_dir), "encoded")
    # written: each curve samples its input before it reads it, and would score all rows again
    scored = written(TR.score(_fit(spark, sf_dir, enc), enc, "gbt-v1").join(
        enc.select("event_id", "split", "label"), "event_id").select("split", "label", "ml_score"), "scored")
    rows = None
    for part in ("train", "val", "test"):
        ap = EV.average_precision(EV.pr_curve(scored.filter(F.col("split") == part))) \
            .select(F.lit(part).alias("split"), "average_precision")
        rows = ap if rows is None else rows.unionByName(ap)
    return rows


@register("score_batch")
def score_batch(spark, sf_dir):
    """M8: batch scoring of the test split with the trained model."""
    enc = written(_encoded_splits(spark, sf_dir), "encoded")
    return TR.score(_model(spark, sf_dir, enc), enc.filter(F.col("split") == "test"), "gbt-v1")


@register("score_drift", with_views("""
SELECT scorer, true AS agrees, n AS rows FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM split WHERE split = 'test') t,
  (VALUES ('loaded'), ('nodes')) v(scorer)""", "split"))
def score_drift(spark, sf_dir):
    """A freshly fitted model (20 trees) against two other scorers of it: the model saved
    and loaded, and its node table walked by column expressions. Scores must agree to 1e-9."""
    from pyspark.ml.classification import GBTClassificationModel

    enc = written(_encoded_splits(spark, sf_dir), "encoded")
    fitted = TR.train_gbt(enc.filter(F.col("split") == "train"), maxIter=20)
    path = checkpoint_path(spark, f"models/again-{uuid.uuid4().hex}")
    _save(spark, fitted, path)
    test = enc.filter(F.col("split") == "test")
    own = TR.score(fitted, test, "fitted")
    others = {"loaded": TR.score(GBTClassificationModel.load(f"{path}/model"), test, "loaded"),
              "nodes": TR.score_by_nodes(TR.node_table(spark, f"{path}/model"), test, "nodes")}
    rows = [TR.score_drift(own, other).select(F.lit(k).alias("scorer"), (F.col("max_abs_diff") < 1e-9).alias("agrees"),
                                              "rows") for k, other in others.items()]
    return rows[0].unionByName(rows[1])


@register("freq_encode", with_views("""
SELECT s.event_id, coalesce(m.freq, 0.0) AS merchant_freq, coalesce(e.freq, 0.0) AS email_domain_freq
FROM split s
LEFT JOIN (SELECT value, freq FROM freqs WHERE "column" = 'merchant') m
  ON lower(coalesce(s.merchant, '')) = m.value
LEFT JOIN (SELECT value, freq FROM freqs WHERE "column" = 'email_domain') e
  ON lower(coalesce(s.email_domain, '')) = e.value""", "freqs"))
def freq_encode(spark, sf_dir):
    """Frequency encoding of every split row from the train-fitted tables (left join,
    unseen -> 0.0)."""
    s = split_df(spark, sf_dir)
    freq = EN.fit_frequencies(s.filter(F.col("split") == "train"))
    return EN.frequency_columns(s, freq).select("event_id", "merchant_freq",
                                                 "email_domain_freq")
