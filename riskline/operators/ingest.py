"""Ingest and integrity: P1-P9, J4, J5, S2 (+ P3 default ids).

Every check is a column expression; a row's first failing check wins, exactly as the
reference's sequential early returns. Quarantined rows keep their reason and class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.config import (ERROR_REASON_MAX, FUTURE_DRIFT_S, INLINE_LIMIT_BYTES,
                             MAX_METADATA_KEYS, MERCHANT_TABLE, NON_RETRYABLE_REASONS,
                             RETRYABLE_REASONS)
from riskline.functions.exprs import MICROS, byte_cut, from_micros, micros
from riskline.session import written

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("payload_mode", T.StringType()),
    T.StructField("payload_inline", T.StringType()),
    T.StructField("payload_sha256", T.StringType()),
    T.StructField("s3_key", T.StringType()),
    T.StructField("received_at", T.StringType()),
])


# --- P3 / P4: ingest side ----------------------------------------------------------------
def default_ids(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Empty event / correlation ids get a deterministic id (sha256 of the payload) so
    a re-run produces the same ids (the reference draws random UUIDs)."""
    gen = F.sha2(F.col(payload), 256)
    return (df.withColumn("event_id", F.coalesce(F.nullif(F.col("event_id"), F.lit("")), gen))
              .withColumn("correlation_id",
                          F.coalesce(F.nullif(F.col("correlation_id"), F.lit("")), gen)))


def build_envelopes(df: DataFrame, payload: str = "payload",
                    received_col: str = "received_us") -> DataFrame:
    """Hash the payload, route it inline (<= 262144 bytes) or to the object store under
    ``raw/<receive date>/<event_id>.json``."""
    size = F.octet_length(F.col(payload))
    inline = size <= INLINE_LIMIT_BYTES
    day = F.date_format(from_micros(received_col), "yyyy-MM-dd")
    return df.select(
        "*",
        F.sha2(F.col(payload), 256).alias("payload_sha256"),
        size.cast("bigint").alias("payload_bytes"),
        F.when(inline, F.lit("INLINE")).otherwise(F.lit("S3")).alias("payload_mode"),
        F.when(inline, F.col(payload)).alias("payload_inline"),
        F.when(~inline, F.concat(F.lit("raw/"), day, F.lit("/"), F.col("event_id"),
                                 F.lit(".json"))).alias("s3_key"),
        *([F.col(received_col).alias("received_us")] if received_col != "received_us"
          else []),
    )


# --- P5 / J5 / P6 / S2: processor side ----------------------------------------------------
def resolve_payloads(env: DataFrame, objects: DataFrame) -> DataFrame:
    """P5 + J5: mode checks and claim-check resolution. Adds ``payload`` and
    ``fetch_error`` (the first failing reason, null when the payload is in hand).

    Only S3-mode rows take part in the join to the object table (inline rows bypass it);
    the object table is keyed by ``key`` and joined by a shuffle (objects are large), or
    broadcast by AQE when small.
    """
    mode = F.col("payload_mode")
    obj = objects.select(F.col("key").alias("s3_key"), F.col("content").alias("_content"),
                         F.lit(True).alias("_found"))
    is_s3 = env.filter((mode == "S3") & F.col("s3_key").isNotNull()).join(obj, "s3_key",
                                                                          "left")
    other = env.filter(~((mode == "S3") & F.col("s3_key").isNotNull()) | mode.isNull()) \
        .withColumn("_content", F.lit(None).cast("string")) \
        .withColumn("_found", F.lit(None).cast("boolean"))
    both = is_s3.unionByName(other)
    err = (F.when(mode == "INLINE",
                  F.when(F.col("payload_inline").isNull(), F.lit("missing_payload")))
            .when(mode == "S3",
                  F.when(F.col("s3_key").isNull(), F.lit("missing_s3_key"))
                   .when(F.col("_found").isNull(), F.lit("storage_fetch_failed")))
            .otherwise(F.lit("invalid_payload_mode")))
    payload = F.when(mode == "INLINE", F.col("payload_inline")).when(mode == "S3",
                                                                      F.col("_content"))
    return both.withColumn("fetch_error", err).withColumn(
        "payload", F.when(err.isNull(), payload)).drop("_content", "_found")


def verify_hash(df: DataFrame) -> DataFrame:
    """Recomputed SHA-256 hex of the payload must equal the envelope's."""
    return df.withColumn("hash_ok", F.sha2(F.col("payload"), 256) == F.col("payload_sha256"))


#: JSON types each field may have; a missing or null field keeps its zero value
FIELD_TYPES = {
    "event_id": ("STRING",), "user_id": ("STRING",), "currency": ("STRING",), "merchant": ("STRING",),
    "timestamp": ("STRING",), "amount": ("BIGINT", "DOUBLE", "DECIMAL"), "metadata": ("OBJECT",),
}
_RFC3339 = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2})(?:\.([0-9]{1,9}))?(Z|[+-][0-9]{2}:[0-9]{2})$"


def rfc3339_micros(text: Column) -> Column:
    """Zone-free µs of an RFC 3339 time with up to nine fraction digits (cut to µs) and any
    offset; null when it is none."""
    fraction = F.rpad(F.substring(F.regexp_extract(text, _RFC3339, 2), 1, 6), 6, "0")
    whole = F.concat(F.regexp_extract(text, _RFC3339, 1), F.lit("."), fraction,
                     F.regexp_extract(text, _RFC3339, 3))
    return micros(F.try_to_timestamp(whole, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
                  .cast("timestamp_ntz"))


def _type_of(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _keys_of(v: Column) -> Column:
    return F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))


def parse_events(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Decode the JSON body into event fields, by the rules of the reference's decoder:

    * field names match whatever their case; of repeated fields the last that is not null counts,
      repeated metadata objects are merged;
    * a field of a wrong type (in any of its places), a number beyond a double's range, or a
      timestamp that is not RFC 3339 makes the body undecodable, as do text behind the value and
      a body that is neither an object nor null.

    The body is parsed once into its ordered entries (a separate projection, so Catalyst does
    not re-inline the parser into every field access); fields are then read from them.
    """
    text = F.col(payload)
    whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    sound = F.coalesce(_type_of(F.try_variant_get(whole, "$[0]", "variant")).isin("OBJECT", "VOID")
                       & F.try_variant_get(whole, "$[1]", "variant").isNull(), F.lit(False))
    entries = F.map_entries(F.from_json(text, "map<string,variant>"))
    # names fold by case; two letters outside ASCII fold to ASCII ones
    folded = F.transform(entries, lambda e: F.struct(
        F.lower(F.translate(e["key"], "\u017f\u212a", "sk")).alias("k"), e["value"].alias("v"), _type_of(e["value"]).alias("t")))
    staged = df.select("*", sound.alias("_sound"), F.coalesce(folded, F.array().cast(
        "array<struct<k:string,v:variant,t:string>>")).alias("_e"))

    def places(name: str) -> Column:
        return F.filter("_e", lambda e: (e["k"] == name) & (e["t"] != "VOID"))

    def last(name: str, kind: str) -> Column:
        return F.try_variant_get(F.element_at(places(name), -1)["v"], "$", kind)

    def of_type(name: str, allowed: tuple[str, ...]) -> Column:
        return F.forall("_e", lambda e: (e["k"] != name) | e["t"].isin("VOID", *allowed))

    typed = F.col("_sound")
    for name, allowed in FIELD_TYPES.items():
        typed = typed & of_type(name, allowed)
    finite = F.forall(places("amount"), lambda e: F.abs(F.try_variant_get(e["v"], "$", "double")) < F.lit(float("inf")))
    keys = F.when(F.size(places("metadata")) > 0, F.size(F.array_distinct(F.flatten(
        F.transform(places("metadata"), lambda e: _keys_of(e["v"]))))))

    def read(name: str, kind: str) -> Column:
        """The last place of a field; through a guard, since element -1 of none is an error."""
        return F.when(F.size(places(name)) > 0, last(name, kind))

    fields = staged.select(
        *df.columns, (typed & F.coalesce(finite, F.lit(False))).alias("_typed"), read("timestamp", "string").alias("_ts"),
        *[read(c, k).alias(f"_{c}") for c, k in (("user_id", "string"), ("amount", "double"), ("currency", "string"),
                                                 ("merchant", "string"))], keys.alias("_keys"))
    fields = fields.select("*", rfc3339_micros(F.col("_ts")).alias("_us"))
    ok = F.coalesce(F.col("_typed"), F.lit(False)) & (F.col("_ts").isNull() | F.col("_us").isNotNull())
    staged = fields.withColumn("parse_ok", ok)
    ok = F.col("parse_ok")
    return staged.select(
        *df.columns, F.when(F.col(payload).isNotNull(), ok).alias("parse_ok"),
        F.when(ok, F.col("_user_id")).alias("p_user_id"),
        F.when(ok, F.col("_amount")).alias("p_amount"),
        F.when(ok, F.col("_currency")).alias("p_currency"),
        F.when(ok, F.col("_merchant")).alias("p_merchant"),
        F.when(ok, F.col("_us")).alias("p_us"),
        F.when(ok, F.col("_keys")).alias("p_metadata_keys"))


# --- P2: validation -------------------------------------------------------------------
def validation_error(user_id: Column, amount: Column, currency: Column, merchant: Column,
                     us: Column, metadata_keys: Column, now_us: Column) -> Column:
    """Q8: ordered checks, first failure wins -> struct(field, reason, code) or null."""

    def err(field: str, reason: str, code: str) -> Column:
        return F.struct(F.lit(field).alias("field"), F.lit(reason).alias("reason"),
                        F.lit(code).alias("code"))

    keys = F.coalesce(metadata_keys, F.lit(0))
    return (F.when(F.coalesce(user_id, F.lit("")) == "",
                   err("user_id", "cannot be empty", "MISSING_FIELD"))
             .when(F.coalesce(amount, F.lit(0)) <= 0,
                   err("amount", "must be greater than 0", "INVALID_VALUE"))
             .when(F.coalesce(currency, F.lit("")) == "",
                   err("currency", "cannot be empty", "MISSING_FIELD"))
             .when(F.coalesce(merchant, F.lit("")) == "",
                   err("merchant", "cannot be empty", "MISSING_FIELD"))
             .when(us.isNull(), err("timestamp", "must be set", "MISSING_FIELD"))
             .when(us > now_us + F.lit(FUTURE_DRIFT_S * MICROS),
                   err("timestamp", "cannot be in the future", "INVALID_VALUE"))
             .when(keys > MAX_METADATA_KEYS,
                   err("metadata", f"too many keys (max {MAX_METADATA_KEYS})",
                       "INVALID_VALUE")))


def error_text(e: Column) -> Column:
    """``invalid event: [CODE] field reason``."""
    return F.concat(F.lit("invalid event: ["), e["code"], F.lit("] "), e["field"], F.lit(" "),
                    e["reason"])


def validate(df: DataFrame, now_us: Column, *, user_id="user_id", amount="amount",
             currency="currency", merchant="merchant", us="us",
             metadata_keys="metadata_keys") -> DataFrame:
    """Adds ``error`` (null when valid)."""
    e = validation_error(F.col(user_id), F.col(amount), F.col(currency), F.col(merchant),
                         F.col(us), F.col(metadata_keys), now_us)
    return df.withColumn("error", e)


# --- P9: store constraints -------------------------------------------------------------
VARCHAR_LIMITS = (("event_id", 255), ("correlation_id", 255), ("user_id", 255),
                  ("currency", 3), ("merchant", 255))


def constraint_violation(columns: dict[str, Column]) -> Column:
    """First violated store constraint (column name) or null: VARCHAR lengths, NOT NULL
    and the DECIMAL(18,2) range. ``columns``: store column -> value, absent ones unchecked."""
    out = F.when(F.lit(False), F.lit(""))
    for c, n in VARCHAR_LIMITS:
        if c in columns:
            bad = F.coalesce(F.char_length(columns[c]) > n, F.lit(c != "correlation_id"))
            out = out.when(bad, F.lit(c))
    if "amount" in columns:
        out = out.when(F.coalesce(F.abs(columns["amount"]) >= F.lit(10 ** 16), F.lit(True)),
                       F.lit("amount"))
    return out


# --- P8: error taxonomy ------------------------------------------------------------------
def reason_classes(spark: SparkSession) -> DataFrame:
    """The fixed reason -> class table (9 rows), joined by broadcast."""
    rows = [(r, "retryable") for r in RETRYABLE_REASONS] + \
           [(r, "non-retryable") for r in NON_RETRYABLE_REASONS]
    return spark.createDataFrame(rows, "reason string, error_class string")


def failure_message(reason: Column, error_class: Column, cause: Column) -> Column:
    """``<class>: <reason>[: cause]`` cut to 500 bytes (the ledger's limit)."""
    msg = F.concat(error_class, F.lit(": "), reason,
                   F.when(cause.isNotNull(), F.concat(F.lit(": "), cause))
                    .otherwise(F.lit("")))
    return byte_cut(msg, ERROR_REASON_MAX)


# --- J4 / P1: CSV rows -> events --------------------------------------------------------
def merchant_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MERCHANT_TABLE), "lookup_key string, merchant string")


def lookup_merchant(df: DataFrame, spark: SparkSession, product: str = "ProductCD",
                    network: str = "card4") -> DataFrame:
    """(product, network) -> merchant by a broadcast left join of the 8-row table,
    default ``merchant_<P>_<N>`` in the original case."""
    key = F.concat(F.lower(F.col(product)), F.lit("+"), F.lower(F.col(network)))
    t = F.broadcast(merchant_table(spark))
    j = df.withColumn("lookup_key", key).join(t, "lookup_key", "left")
    return j.withColumn("merchant", F.coalesce(
        F.col("merchant"), F.concat(F.lit("merchant_"), F.col(product), F.lit("_"),
                                    F.col(network)))).drop("lookup_key")


def map_csv_rows(df: DataFrame, spark: SparkSession, now_us: Column,
                 epoch_us: int = 1_704_067_200_000_000) -> DataFrame:
    """IEEE-CIS row -> event fields. ts = epoch + whole seconds (fraction truncated,
    unparsable -> now); amount unparsable or <= 0 -> 1.0; empty card1 -> ``unknown``;
    currency USD; label "1" only if exactly "1"."""
    dt = F.col("TransactionDT").try_cast("double")
    secs = F.when(dt.isNotNull(), F.floor(F.abs(dt)) * F.signum(dt))
    amt = F.col("TransactionAmt").try_cast("double")
    m = lookup_merchant(df, spark)
    return m.select(
        *[c for c in ("event_no",) if c in df.columns],
        F.when(F.coalesce(F.col("card1"), F.lit("")) == "", F.lit("unknown"))
         .otherwise(F.col("card1")).alias("user_id"),
        F.when(amt > 0, amt).otherwise(F.lit(1.0)).alias("amount"),
        F.lit("USD").alias("currency"),
        "merchant",
        F.coalesce(F.lit(epoch_us) + secs.cast("bigint") * MICROS, now_us).alias("us"),
        F.coalesce(F.col("P_emaildomain"), F.lit("")).alias("email_domain"),
        F.coalesce(F.col("card4"), F.lit("")).alias("card_network"),
        F.coalesce(F.col("ProductCD"), F.lit("")).alias("product_code"),
        F.when(F.col("isFraud") == "1", F.lit("1")).otherwise(F.lit("0")).alias("is_fraud"),
    )


CSV_COLUMNS = ("TransactionDT", "TransactionAmt", "card1", "ProductCD", "card4",
               "P_emaildomain", "isFraud")


def read_transactions_csv(spark: SparkSession, path: str,
                          columns: tuple[str, ...] = CSV_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Header CSV read by column name, all strings; the file may hold any further
    columns in any order, and a column it lacks reads as ''. Rows whose field count differs
    from the header are split off as failed (``_corrupt_record``).

    Spark flags a wrong field count only when every column is parsed, so the reader's own
    column pruning is off.
    """
    header = spark.read.option("header", True).csv(path).columns
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("enforceSchema", False).option("columnPruning", False)
           .schema(T.StructType([T.StructField(c, T.StringType()) for c in header]
                                + [T.StructField("_corrupt_record", T.StringType())]))
           .csv(path))
    own = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in header
           else F.lit("").alias(c) for c in columns]
    # the failed rows are written, so that any later query on them (a count) is allowed
    bad = written(raw.filter(F.col("_corrupt_record").isNotNull()), "csv-failed")
    # a generator keeps later narrow queries (a count) from pruning the columns again
    good = raw.filter(F.col("_corrupt_record").isNull()).select(
        F.inline(F.array(F.struct(*own))))
    return good, bad


def request_to_event(req: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Synchronous evaluation requests -> events. ``event_id`` and the transaction
    time are required (rows without them are rejected with the reason); the string map
    metadata becomes JSON text, an empty map becomes null."""
    md = F.col("metadata")
    missing = (F.when(F.coalesce(F.col("event_id"), F.lit("")) == "",
                      F.lit("event_id is required"))
                .when(F.col("transaction_us").isNull(), F.lit("transaction_time is required")))
    return req.select(
        "event_id", "user_id", "amount", "currency", "merchant",
        F.col("transaction_us").alias("us"),
        F.when(F.coalesce(F.size(md), F.lit(0)) > 0, F.to_json(md)).alias("metadata_json"),
        F.coalesce(F.size(md), F.lit(0)).alias("metadata_keys"),
        missing.alias("invalid_argument"), *keep)
