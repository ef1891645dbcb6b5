"""Registered queries: ingest, integrity and quarantine."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.config import MERCHANT_TABLE
from riskline.operators import ingest as I
from riskline.plans.oracle_views import view, with_views
from riskline.plans.registry import register
from riskline.session import checkpoint_path
from riskline.sources import fixtures as fx
from riskline.sources import wire

_NOW_SQL = "(SELECT max(created_us) FROM txn)"


# --- P1 / J4 / S1 ----------------------------------------------------------------------
_MAP_SQL = f"""
SELECT event_no,
  CASE WHEN coalesce(card1, '') = '' THEN 'unknown' ELSE card1 END AS user_id,
  CASE WHEN TRY_CAST(TransactionAmt AS DOUBLE) > 0 THEN TRY_CAST(TransactionAmt AS DOUBLE) ELSE 1.0 END AS amount,
  'USD' AS currency,
  CASE lower(ProductCD) || '+' || lower(card4)
    {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MERCHANT_TABLE)}
    ELSE 'merchant_' || ProductCD || '_' || card4 END AS merchant,
  coalesce(1704067200000000 + CAST(trunc(TRY_CAST(TransactionDT AS DOUBLE)) AS BIGINT) * 1000000,
           {_NOW_SQL}) AS us,
  coalesce(P_emaildomain, '') AS email_domain, coalesce(card4, '') AS card_network,
  coalesce(ProductCD, '') AS product_code,
  CASE WHEN isFraud = '1' THEN '1' ELSE '0' END AS is_fraud
FROM csv_rows"""


@register("map_transactions", with_views(_MAP_SQL, "csv_rows", "txn"))
def map_transactions(spark, sf_dir):
    """P1 + J4: IEEE-style CSV fields -> events (defaults for bad time / amount / card)."""
    now = fx.now_us(fx.txn(spark, sf_dir))
    return I.map_csv_rows(wire.csv_rows(spark, sf_dir), spark, now)


@register("merchant_lookup", with_views("""
SELECT DISTINCT product_code, card_network, merchant FROM txn_m""", "txn_m"))
def merchant_lookup(spark, sf_dir):
    """(product, network) -> merchant via a broadcast 8-row table, default name."""
    t = fx.txn(spark, sf_dir).select("product_code", "card_network").distinct()
    m = I.lookup_merchant(t, spark, "product_code", "card_network")
    return m.select("product_code", "card_network", "merchant")


def _write_csv(spark, sf_dir) -> str:
    """Write the CSV rows as a headered CSV file set in the shared checkpoint folder; rows
    at ``event_no % 59 = 0`` carry an unquoted comma (one field too many). The file has two
    further columns and another column order than the reader's list."""
    rows = wire.csv_rows(spark, sf_dir)
    card1 = F.when(F.col("event_no") % 59 == 0, F.concat(F.col("card1"), F.lit(",x"))) \
        .otherwise(F.col("card1"))
    out = rows.withColumn("card1", card1).drop("event_no")
    out = out.select("isFraud", F.lit("x").alias("V1"), *[c for c in out.columns if c != "isFraud"],
                     F.lit("9").alias("TransactionID"))
    path = checkpoint_path(spark, f"csv_source/{uuid.uuid4().hex}")
    (out.write.option("header", True).option("quote", "\u0000")
        .option("emptyValue", "").csv(path))
    return path


@register("csv_ingest", with_views(f"""
SELECT user_id, amount, currency, merchant, us, email_domain, card_network, product_code,
  is_fraud FROM ({_MAP_SQL}) m WHERE event_no % 59 <> 0""", "csv_rows", "txn"))
def csv_ingest(spark, sf_dir):
    """S1 + P1: headered CSV read by column name; rows with a wrong field count are split
    off as failed; the rest is mapped to events."""
    path = _write_csv(spark, sf_dir)
    good, _bad = I.read_transactions_csv(spark, path)
    now = fx.now_us(fx.txn(spark, sf_dir))
    return I.map_csv_rows(good, spark, now).drop("event_no")


# --- P2 / P9 ----------------------------------------------------------------------------
_VALIDATE_SQL = f"""
SELECT r.*, CASE
  WHEN coalesce(user_id, '') = '' THEN 'user_id|cannot be empty|MISSING_FIELD'
  WHEN coalesce(amount, 0) <= 0 THEN 'amount|must be greater than 0|INVALID_VALUE'
  WHEN coalesce(currency, '') = '' THEN 'currency|cannot be empty|MISSING_FIELD'
  WHEN coalesce(merchant, '') = '' THEN 'merchant|cannot be empty|MISSING_FIELD'
  WHEN us IS NULL THEN 'timestamp|must be set|MISSING_FIELD'
  WHEN us > {_NOW_SQL} + 300000000 THEN 'timestamp|cannot be in the future|INVALID_VALUE'
  WHEN coalesce(metadata_keys, 0) > 10 THEN 'metadata|too many keys (max 10)|INVALID_VALUE'
  END AS err
FROM raw_txn r"""
view("validated", ("raw_txn", "txn"), _VALIDATE_SQL)


def _validated(spark, sf_dir) -> DataFrame:
    now = fx.now_us(fx.txn(spark, sf_dir))
    return I.validate(fx.raw_txn(spark, sf_dir), now)


@register("validate_events", with_views("""
SELECT event_id, user_id, amount, currency, merchant, us FROM validated WHERE err IS NULL""",
                                        "validated"))
def validate_events(spark, sf_dir):
    """Events passing the ordered validation (Q8)."""
    return _validated(spark, sf_dir).filter(F.col("error").isNull()).select(
        "event_id", "user_id", "amount", "currency", "merchant", "us")


@register("validation_errors", with_views("""
SELECT event_id, split_part(err, '|', 1) AS field, split_part(err, '|', 2) AS reason,
  split_part(err, '|', 3) AS code,
  'invalid event: [' || split_part(err, '|', 3) || '] ' || split_part(err, '|', 1) || ' '
    || split_part(err, '|', 2) AS message
FROM validated WHERE err IS NOT NULL""", "validated"))
def validation_errors(spark, sf_dir):
    """The first failing check per invalid event: field, reason, code, message."""
    v = _validated(spark, sf_dir).filter(F.col("error").isNotNull())
    return v.select("event_id", F.col("error.field").alias("field"),
                    F.col("error.reason").alias("reason"), F.col("error.code").alias("code"),
                    I.error_text(F.col("error")).alias("message"))


@register("constraint_check", with_views("""
SELECT event_id, CASE
  WHEN event_id IS NULL OR length(event_id) > 255 THEN 'event_id'
  WHEN length(correlation_id) > 255 THEN 'correlation_id'
  WHEN user_id IS NULL OR length(user_id) > 255 THEN 'user_id'
  WHEN currency IS NULL OR length(currency) > 3 THEN 'currency'
  WHEN merchant IS NULL OR length(merchant) > 255 THEN 'merchant'
  WHEN amount IS NULL OR abs(amount) >= 10000000000000000 THEN 'amount' END AS column_name,
  'constraint_violation' AS reason
FROM validated WHERE err IS NULL AND (length(currency) > 3 OR length(user_id) > 255
  OR length(merchant) > 255 OR length(event_id) > 255 OR length(correlation_id) > 255)""",
                                         "validated"))
def constraint_check(spark, sf_dir):
    """Valid events the store would reject (VARCHAR lengths, NOT NULL, DECIMAL range)
    -> quarantine reason ``constraint_violation`` (non-retryable)."""
    v = _validated(spark, sf_dir).filter(F.col("error").isNull())
    col = I.constraint_violation({c: F.col(c) for c in (
        "event_id", "correlation_id", "user_id", "currency", "merchant", "amount")})
    return v.select("event_id", col.alias("column_name"),
                    F.lit("constraint_violation").alias("reason")) \
            .filter(F.col("column_name").isNotNull())


# --- P4 / P5 / J5 / P6 / S2 / P8 -----------------------------------------------------------
@register("build_envelopes", with_views("""
SELECT event_id, correlation_id, payload_mode, payload_sha256, payload_bytes, s3_key,
  received_us FROM built_envelopes""", "built_envelopes"))
def build_envelopes(spark, sf_dir):
    """P4 (+P3): SHA-256, byte size, INLINE vs object-store routing and key."""
    env = I.build_envelopes(wire.wire_events(spark, sf_dir), received_col="created_us")
    return env.select("event_id", "correlation_id", "payload_mode", "payload_sha256",
                      "payload_bytes", "s3_key", "received_us")


def _resolved(spark, sf_dir) -> DataFrame:
    return I.resolve_payloads(wire.envelopes(spark, sf_dir), wire.objects(spark, sf_dir))


@register("envelope_errors", with_views("""
SELECT event_id, fetch_error AS reason FROM resolved WHERE fetch_error IS NOT NULL""",
                                        "resolved"))
def envelope_errors(spark, sf_dir):
    """P5: unknown mode, missing inline payload, missing key, missing object."""
    return _resolved(spark, sf_dir).filter(F.col("fetch_error").isNotNull()).select(
        "event_id", F.col("fetch_error").alias("reason"))


@register("resolve_payloads", with_views("""
SELECT event_id, payload_mode, sha256(payload) AS payload_sha256_actual,
  CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes
FROM resolved WHERE fetch_error IS NULL""", "resolved"))
def resolve_payloads(spark, sf_dir):
    """INLINE bypasses, S3 envelopes join the object table by key."""
    r = _resolved(spark, sf_dir).filter(F.col("fetch_error").isNull())
    return r.select("event_id", "payload_mode",
                    F.sha2("payload", 256).alias("payload_sha256_actual"),
                    F.octet_length("payload").cast("bigint").alias("payload_bytes"))


@register("hash_verify", with_views("""
SELECT event_id, hash_ok FROM parsed WHERE fetch_error IS NULL""", "parsed"))
def hash_verify(spark, sf_dir):
    """P6 + P7: recomputed hash vs envelope hash; the envelope's event id is kept."""
    r = I.verify_hash(_resolved(spark, sf_dir).filter(F.col("fetch_error").isNull()))
    return r.select("event_id", "hash_ok")


@register("parse_events", with_views("""
SELECT event_id, parse_ok, p_user_id, p_amount, p_currency, p_merchant, p_us
FROM parsed WHERE fetch_error IS NULL AND hash_ok""", "parsed"))
def parse_events(spark, sf_dir):
    """JSON body -> event fields; malformed bodies flagged."""
    r = I.verify_hash(_resolved(spark, sf_dir).filter(F.col("fetch_error").isNull()))
    p = I.parse_events(r.filter("hash_ok"))
    return p.select("event_id", "parse_ok", "p_user_id", "p_amount", "p_currency",
                    "p_merchant", "p_us")


_QUARANTINE_SQL = f"""
SELECT event_id, reason, CASE WHEN reason IN ('idempotency_check_failed',
    'storage_fetch_failed', 'db_insert_failed') THEN 'retryable' ELSE 'non-retryable' END AS error_class,
  cause, received_us, delivery_no FROM (
  SELECT event_id, CASE
      WHEN fetch_error IS NOT NULL THEN fetch_error
      WHEN NOT hash_ok THEN 'hash_mismatch'
      WHEN NOT parse_ok THEN 'unmarshal_error'
      WHEN coalesce(p_user_id, '') = '' OR coalesce(p_amount, 0) <= 0 OR coalesce(p_currency, '') = ''
        OR coalesce(p_merchant, '') = '' OR p_us IS NULL OR p_us > {_NOW_SQL} + 300000000
        OR coalesce(p_metadata_keys, 0) > 10 THEN 'validation_error'
      WHEN length(p_currency) > 3 OR abs(p_amount) >= 1e16 THEN 'constraint_violation' END AS reason,
    CASE WHEN fetch_error IS NOT NULL OR NOT hash_ok THEN NULL
      WHEN NOT parse_ok THEN 'malformed JSON'
      WHEN coalesce(p_user_id, '') = '' THEN 'invalid event: [MISSING_FIELD] user_id cannot be empty'
      WHEN coalesce(p_amount, 0) <= 0 THEN 'invalid event: [INVALID_VALUE] amount must be greater than 0'
      WHEN coalesce(p_currency, '') = '' THEN 'invalid event: [MISSING_FIELD] currency cannot be empty'
      WHEN coalesce(p_merchant, '') = '' THEN 'invalid event: [MISSING_FIELD] merchant cannot be empty'
      WHEN p_us IS NULL THEN 'invalid event: [MISSING_FIELD] timestamp must be set'
      WHEN p_us > {_NOW_SQL} + 300000000 THEN 'invalid event: [INVALID_VALUE] timestamp cannot be in the future'
      WHEN coalesce(p_metadata_keys, 0) > 10 THEN 'invalid event: [INVALID_VALUE] metadata too many keys (max 10)'
      WHEN length(p_currency) > 3 THEN 'currency' WHEN abs(p_amount) >= 1e16 THEN 'amount'
    END AS cause, received_us, delivery_no
  FROM parsed) q
WHERE reason IS NOT NULL"""
view("quarantine", ("parsed", "txn"), _QUARANTINE_SQL)


def quarantine_df(spark, sf_dir) -> DataFrame:
    """All envelopes that fail a processing stage, with reason, class and cause."""
    from riskline.plans.views import processed

    return processed(spark, sf_dir).filter(F.col("reason").isNotNull()).select(
        "event_id", "reason", "error_class", "cause")


@register("quarantine", with_views("SELECT event_id, reason, error_class, cause FROM quarantine", "quarantine"))
def quarantine(spark, sf_dir):
    """Every failing envelope with its first failing stage (reason), class and
    cause; the ledger message is ``<class>: <reason>[: cause]``."""
    return quarantine_df(spark, sf_dir)


@register("error_taxonomy", with_views("""
SELECT reason, error_class, CAST(count(*) AS BIGINT) AS events,
  min(error_class || ': ' || reason || coalesce(': ' || cause, '')) AS sample_message
FROM quarantine GROUP BY reason, error_class""", "quarantine"))
def error_taxonomy(spark, sf_dir):
    """Quarantined events per reason and class with a sample ledger message."""
    q = quarantine_df(spark, sf_dir)
    msg = I.failure_message(F.col("reason"), F.col("error_class"), F.col("cause"))
    return q.groupBy("reason", "error_class").agg(
        F.count(F.lit(1)).alias("events"), F.min(msg).alias("sample_message"))
