"""DuckDB text of the shared views, pasted as leading CTEs of every oracle query.

Only the base tables are registered in the oracle engine; everything else is a CTE.
Views are listed in dependency order and pulled in transitively.
"""

from __future__ import annotations

US = "epoch_us(ts)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (deps, sql.strip())


view("txn", (), f"""
SELECT concat('evt-', CAST(event_id AS VARCHAR)) AS event_id, event_id AS event_no,
  concat('corr-', CAST(event_id AS VARCHAR)) AS correlation_id,
  concat('u', CAST(user_id AS VARCHAR)) AS user_id,
  CAST(value AS DECIMAL(18,2)) AS amount,
  CASE event_id % 20 WHEN 0 THEN 'XMR' WHEN 1 THEN 'ZEC' ELSE 'USD' END AS currency,
  CASE event_id % 5 WHEN 0 THEN 'W' WHEN 1 THEN 'C' WHEN 2 THEN 'R' WHEN 3 THEN 'H' ELSE 'S' END AS product_code,
  CASE user_id % 4 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'discover' ELSE 'american express' END AS card_network,
  CASE user_id % 3 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' ELSE '' END AS email_domain,
  CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN '1' ELSE '0' END AS label,
  {US} AS us,
  {US} + (event_id % 7) * 1000 + CASE WHEN event_id % 50 = 0 THEN 7200000000 ELSE 0 END AS created_us
FROM events""")

view("txn_m", ("txn",), """
SELECT t.*, CASE concat(lower(product_code), '+', lower(card_network))
  WHEN 'w+visa' THEN 'Amazon Marketplace' WHEN 'w+mastercard' THEN 'Walmart Online'
  WHEN 'c+mastercard' THEN 'Walmart' WHEN 'c+visa' THEN 'Target' WHEN 'r+discover' THEN 'Target RedCard'
  WHEN 'h+amex' THEN 'Best Buy' WHEN 's+visa' THEN 'Steam Games' WHEN 's+mastercard' THEN 'PlayStation Store'
  ELSE concat('merchant_', product_code, '_', card_network) END AS merchant
FROM txn t""")

view("late_txn", ("txn_m",), """
SELECT * REPLACE (CASE WHEN event_no % 3 = 0 THEN 'hot' ELSE user_id END AS user_id,
  created_us + CASE WHEN event_no % 50 = 10 THEN 259200000000 WHEN event_no % 70 = 20 THEN 93600000000 ELSE 0 END
    AS created_us) FROM txn_m""")

view("raw_txn", ("txn_m",), """
SELECT event_id, event_no, correlation_id,
  CASE WHEN event_no % 97 = 1 THEN '' ELSE user_id END AS user_id,
  CASE WHEN event_no % 97 = 2 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END AS amount,
  CASE WHEN event_no % 97 = 3 THEN '' WHEN event_no % 97 = 8 THEN 'DASH' ELSE currency END AS currency,
  CASE WHEN event_no % 97 = 4 THEN '' ELSE merchant END AS merchant,
  CASE WHEN event_no % 97 = 5 THEN NULL WHEN event_no % 97 = 6 THEN us + 86400000000000 ELSE us END AS us,
  CASE WHEN event_no % 97 = 7 THEN 11 ELSE 4 END AS metadata_keys
FROM txn_m""")

view("deliveries", ("txn",), """
SELECT event_id, event_no, created_us AS received_us, 1 AS delivery_no,
  CASE WHEN event_no % 10 = 0 THEN 'retryable' WHEN event_no % 25 = 3 THEN 'hash_mismatch'
       WHEN event_no % 70 = 11 THEN NULL ELSE 'ok' END AS outcome FROM txn
UNION ALL
SELECT event_id, event_no, created_us + CASE WHEN event_no % 20 = 0 THEN 5000000 ELSE 90000000 END, 2,
  CASE WHEN event_no % 100 = 10 THEN 'retryable' ELSE 'ok' END FROM txn WHERE event_no % 10 = 0
UNION ALL
SELECT event_id, event_no, created_us + 30000000, 2, 'ok' FROM txn WHERE event_no % 30 = 7
UNION ALL
SELECT event_id, event_no, created_us + 10000000, 2, 'ok' FROM txn WHERE event_no % 140 = 11
UNION ALL
SELECT event_id, event_no, created_us + CASE WHEN event_no % 400 = 10 THEN 100000000 ELSE 200000000 END, 3,
  CASE WHEN event_no % 200 = 10 THEN 'retryable' ELSE 'ok' END FROM txn WHERE event_no % 100 = 10
UNION ALL
SELECT event_id, event_no, created_us + 300000000, 4,
  CASE WHEN event_no % 600 = 10 THEN NULL ELSE 'ok' END FROM txn WHERE event_no % 200 = 10""")

view("scores", ("txn",), """
SELECT event_id, label, CAST(least(999, (event_no * 7919) % 800 + CASE WHEN label = '1' THEN 150 ELSE 0 END) AS DOUBLE) / 1000 AS ml_score FROM txn""")

view("ops_log", ("txn",), """
SELECT event_id, correlation_id, us, CASE event_no % 3 WHEN 0 THEN 'ingest' WHEN 1 THEN 'processor' ELSE 'eval' END AS service,
  CASE WHEN event_no % 40 = 9 THEN 'failure' ELSE 'success' END AS status, CAST(amount AS DOUBLE) / 100 AS latency_s FROM txn""")


def _closure(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of ``names`` and everything they depend on."""
    order = _closure(names)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][1]}\n)" for n in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":      # merge the body's own CTEs into the list
        return f"WITH RECURSIVE {ctes},\n{body[5:]}"
    return f"WITH RECURSIVE {ctes}\n{body}"


def claim_views(steps: str, prefix: str) -> None:
    """Views of the claim fold over ``steps`` (event_id, received_us, outcome, k): a recursive
    CTE that applies one delivery per step, and the ledger it ends in."""
    status = "CASE {0} WHEN 'ok' THEN 'success' WHEN 'retryable' THEN 'processing' ELSE 'failed' END"
    fold, result = f"{prefix}claim_steps", f"{prefix}ledger"
    view(fold, (steps,), f"""
SELECT event_id, k, {status.format('outcome')} AS status, received_us AS first_us, received_us AS last_us,
  k AS last_k, 1 AS tries, CASE WHEN outcome NOT IN ('ok', 'retryable') THEN 'non-retryable: ' || outcome END AS reason
FROM {steps} WHERE k = 1
UNION ALL
SELECT c.event_id, c.dk, CASE WHEN again THEN {status.format('c.outcome')} ELSE c.status END, c.first_us,
  CASE WHEN again THEN c.received_us ELSE c.last_us END, CASE WHEN again THEN c.dk ELSE c.last_k END,
  CASE WHEN again THEN c.tries + 1 ELSE c.tries END,
  CASE WHEN again AND c.outcome NOT IN ('ok', 'retryable') THEN 'non-retryable: ' || c.outcome ELSE c.reason END
FROM (SELECT s.*, d.k AS dk, d.received_us, d.outcome, s.status = 'failed' OR
             (s.status = 'processing' AND d.received_us - s.last_us >= 60000000) AS again
      FROM {fold} s JOIN {steps} d ON d.event_id = s.event_id AND d.k = s.k + 1) c""")
    view(result, (fold,), f"""
SELECT event_id, arg_max(status, k) AS status, min(first_us) AS first_seen_us,
  arg_max(last_us, k) AS last_seen_us, arg_max(last_k, k) AS last_k,
  CAST(arg_max(tries, k) AS INTEGER) AS attempts,
  arg_max(reason, k) FILTER (k = n) AS error_reason, CAST(arg_max(tries, k) AS BIGINT) AS claims,
  CAST(max(k) AS BIGINT) AS receives
FROM (SELECT *, max(k) OVER (PARTITION BY event_id) AS n FROM {fold}) c GROUP BY event_id""")


# --- derived views (DuckDB twins of riskline.plans.views) ------------------------------
def _flags_sql(src: str = "scored_txn") -> str:
    from riskline.config import TEST_RULES as C

    thr = f"{C.amount_threshold:.2f}"
    w, mx = C.velocity_window_seconds, C.velocity_max_count
    merch = ", ".join(f"'{m}'" for m in C.blocked_merchants)
    cur = ", ".join(f"'{c}'" for c in C.high_risk_currencies)
    q = "'\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"') || '\"'"
    cols = "event_id, user_id, created_us, ml_score"
    return f"""
SELECT sha256(event_id || '|' || rule_name) AS flag_id, event_id, user_id, rule_name,
  rule_value, created_us AS flagged_us, ml_score FROM (
  SELECT {cols}, 'amount_threshold' AS rule_name,
    'amount=' || CAST(amount AS VARCHAR) || ' > threshold={thr}' AS rule_value
  FROM {src} WHERE amount > {thr}
  UNION ALL
  SELECT {cols}, 'velocity', 'count=' || CAST(velocity_count AS VARCHAR) || ' in {w}s >= max={mx}'
  FROM {src} WHERE velocity_count >= {mx}
  UNION ALL
  SELECT {cols}, 'blocked_merchant', 'merchant=' || {q.format(c='merchant')} || ' is blocked'
  FROM {src} WHERE merchant IN ({merch})
  UNION ALL
  SELECT {cols}, 'high_risk_currency', 'currency=' || {q.format(c='currency')} || ' is high-risk'
  FROM {src} WHERE currency IN ({cur})
  UNION ALL
  SELECT {cols}, 'ml_risk', 'ml_score=' || CAST(CAST(round(ml_score, 4) AS DECIMAL(20,4)) AS VARCHAR)
    || ' >= tau={C.tau:.4f} (model=' || model_version || ')'
  FROM {src} WHERE ml_score >= {C.tau}
) f"""


def _scored_sql(src: str = "txn_m") -> str:
    from riskline.config import TEST_RULES as C

    w = C.velocity_window_seconds * 1_000_000
    return f"""
SELECT t.*, count(*) OVER (PARTITION BY t.user_id ORDER BY t.created_us
    RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS velocity_count,
  coalesce(s.ml_score, 0.0) AS ml_score,
  CASE WHEN s.ml_score IS NULL THEN 'unavailable' ELSE '{C.model_version}' END AS model_version
FROM {src} t LEFT JOIN (SELECT event_id, ml_score FROM scores) s ON t.event_id = s.event_id"""


view("scored_txn", ("txn_m", "scores"), _scored_sql())
view("flags", ("scored_txn",), _flags_sql())
view("flag_events", ("flags", "txn_m"), """
SELECT f.flag_id, f.event_id, e.correlation_id, f.user_id, e.amount, e.currency, e.merchant,
  f.rule_name, f.rule_value, f.flagged_us, f.ml_score
FROM flags f JOIN txn_m e ON f.event_id = e.event_id""")


def _features_sql(src: str = "txn_m") -> str:
    def frame(s: int) -> str:
        return f"RANGE BETWEEN {s * 1_000_000 - 1} PRECEDING AND CURRENT ROW"

    w = "PARTITION BY user_id ORDER BY us"
    return f"""
SELECT event_id, user_id, us, CAST(amount AS DOUBLE) AS amount,
  count(*) OVER ({w} {frame(60)}) AS velocity_60s,
  count(*) OVER ({w} {frame(3600)}) AS velocity_3600s,
  count(*) OVER ({w} {frame(86400)}) AS velocity_86400s,
  coalesce(CAST(us - max(us) OVER ({w} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) / 1000000, -1.0) AS secs_since_prev,
  CAST(coalesce(sum(amount) OVER ({w} {frame(3600)}), 0) AS DOUBLE) AS user_amt_sum_3600s,
  CAST(coalesce(max(amount) OVER ({w} {frame(3600)}), 0) AS DOUBLE) AS user_amt_max_3600s,
  lower(currency) AS currency, product_code, card_network, lower(merchant) AS merchant,
  email_domain, label
FROM {src} WHERE us IS NOT NULL"""


view("features", ("txn_m",), _features_sql())
view("late_features", ("late_txn",), _features_sql("late_txn"))

view("arrival_features", ("late_txn",), """
SELECT e.event_id, e.user_id, e.us, CAST(e.amount AS DOUBLE) AS amount, velocity_60s, velocity_3600s, velocity_86400s,
  coalesce(CAST(e.us - a.prev AS DOUBLE) / 1000000, -1.0) AS secs_since_prev,
  CAST(coalesce(a.s, 0) AS DOUBLE) AS user_amt_sum_3600s, CAST(coalesce(a.m, 0) AS DOUBLE) AS user_amt_max_3600s,
  lower(e.currency) AS currency, e.product_code, e.card_network, lower(e.merchant) AS merchant, e.email_domain, e.label
FROM late_txn e JOIN (
  SELECT e.event_id, count(*) FILTER (x.us > e.us - 60000000) AS velocity_60s,
    count(*) FILTER (x.us > e.us - 3600000000) AS velocity_3600s,
    count(*) FILTER (x.us > e.us - 86400000000) AS velocity_86400s, max(x.us) FILTER (x.us < e.us) AS prev,
    sum(x.amount) FILTER (x.us > e.us - 3600000000) AS s, max(x.amount) FILTER (x.us > e.us - 3600000000) AS m
  FROM late_txn e JOIN late_txn x ON x.user_id = e.user_id AND x.us <= e.us AND x.created_us <= e.created_us
  GROUP BY e.event_id) a ON a.event_id = e.event_id""")

view("txn_meta", ("txn_m",), """
SELECT t.*, '{"product_code":"' || product_code || '","card_network":'
  || CASE WHEN event_no % 17 = 0 THEN '4' ELSE '"' || card_network || '"' END
  || ',"email_domain":"' || email_domain || '"'
  || CASE WHEN event_no % 13 = 0 THEN ''
          WHEN event_no % 11 = 0 THEN ',"is_fraud_ground_truth":' || label
          WHEN event_no % 19 = 0 THEN ',"is_fraud_ground_truth":null'
          ELSE ',"is_fraud_ground_truth":"' || label || '"' END || '}' AS metadata_json
FROM txn_m t""")

view("labelled", ("txn_meta",), """
SELECT t.*, CASE WHEN json_type(metadata_json, '$.is_fraud_ground_truth') = 'VARCHAR'
    AND metadata_json->>'$.is_fraud_ground_truth' <> ''
    THEN metadata_json->>'$.is_fraud_ground_truth' ELSE '0' END AS gt_label
FROM txn_meta t WHERE metadata_json->>'$.is_fraud_ground_truth' IS NOT NULL""")


def _meta_str(k: str) -> str:
    return (f"CASE WHEN json_type(metadata_json, '$.{k}') = 'VARCHAR' "
            f"THEN metadata_json->>'$.{k}' ELSE '' END")


view("export_features", ("labelled", "features"), f"""
SELECT f.event_id, f.user_id, f.us, f.amount, f.velocity_60s, f.velocity_3600s,
  f.velocity_86400s, f.secs_since_prev, f.user_amt_sum_3600s, f.user_amt_max_3600s,
  f.currency, {_meta_str('product_code')} AS product_code,
  {_meta_str('card_network')} AS card_network, f.merchant,
  {_meta_str('email_domain')} AS email_domain, l.gt_label AS label
FROM features f JOIN labelled l ON f.event_id = l.event_id""")

view("split", ("export_features",), """
SELECT e.*, CASE WHEN rn < CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) THEN 'train'
                 WHEN rn < CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY us, event_id) - 1 AS rn,
        count(*) OVER () AS n FROM export_features) e""")

# --- wire fixtures (twins of riskline.sources.wire) -----------------------------------
view("wire_events", ("txn_m",), """
SELECT event_id, event_no, correlation_id, created_us,
  CASE WHEN event_no % 89 = 10 THEN '[]' ELSE '{"event_id":' || CASE WHEN event_no % 89 = 14 THEN CAST(event_no AS VARCHAR) ELSE '"' || event_id || '"' END
  || CASE event_no % 89 WHEN 15 THEN ',"User_ID":"' WHEN 16 THEN ',"USER_ID":"zzz","user_id":"' ELSE ',"user_id":"' END
  || user_id || '","amount":'
  || CASE event_no % 89 WHEN 7 THEN '0.00' WHEN 8 THEN '"5"' WHEN 13 THEN '100000000000000000' WHEN 17 THEN '1e400'
          ELSE CAST(amount AS VARCHAR) END
  || ',"currency":"' || currency || '","merchant":"' || merchant
  || '","timestamp":"' || CASE event_no % 89 WHEN 9 THEN 'yesterday'
       WHEN 11 THEN strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.123456789Z')
       WHEN 12 THEN strftime(make_timestamp(us + 7200000000), '%Y-%m-%dT%H:%M:%S+02:00')
       ELSE strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%SZ') END
  || '","metadata":{"product_code":"' || product_code || '","card_network":"' || card_network
  || '","email_domain":"' || email_domain || '"}'
  || CASE WHEN event_no % 997 = 0 THEN ',"pad":"' || repeat('x', 300000) || '"'
          WHEN event_no % 997 = 1 THEN ',"pad":"' || repeat('x', 250000) || '"' ELSE '' END
  || '}' || CASE WHEN event_no % 89 = 18 THEN ' x' ELSE '' END END AS payload
FROM txn_m""")

view("built_envelopes", ("wire_events",), """
SELECT *, sha256(payload) AS payload_sha256, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  CASE WHEN octet_length(encode(payload)) <= 262144 THEN 'INLINE' ELSE 'S3' END AS payload_mode,
  CASE WHEN octet_length(encode(payload)) <= 262144 THEN payload END AS payload_inline,
  CASE WHEN octet_length(encode(payload)) > 262144 THEN 'raw/' || strftime(make_timestamp(created_us), '%Y-%m-%d')
    || '/' || event_id || '.json' END AS s3_key,
  created_us AS received_us
FROM wire_events""")

view("first_envelopes", ("built_envelopes",), """
SELECT event_id, event_no, correlation_id,
  CASE WHEN event_no % 89 = 1 THEN 'BOGUS' WHEN event_no % 89 IN (3, 6) THEN 'S3' ELSE payload_mode END AS payload_mode,
  CASE WHEN event_no % 89 IN (2, 3, 6) THEN NULL WHEN event_no % 89 = 5 THEN '{not json' ELSE payload_inline END AS payload_inline,
  CASE WHEN event_no % 89 = 4 THEN 'bad-hash' WHEN event_no % 89 = 5 THEN sha256('{not json') ELSE payload_sha256 END AS payload_sha256,
  CASE WHEN event_no % 89 = 3 THEN NULL WHEN event_no % 89 = 6 THEN 'raw/missing/' || event_id || '.json' ELSE s3_key END AS s3_key,
  received_us, 1 AS delivery_no
FROM built_envelopes""")
view("envelopes", ("first_envelopes",), """
SELECT * FROM first_envelopes
UNION ALL
SELECT * REPLACE (received_us + 30000000 AS received_us, 2 AS delivery_no) FROM first_envelopes WHERE event_no % 31 = 4
UNION ALL
SELECT event_id, event_no, correlation_id, payload_mode, payload_inline, payload_sha256, s3_key,
  received_us + CASE WHEN event_no % 89 = 6 THEN 90000000 ELSE 10000000 END, 3
FROM built_envelopes WHERE (event_no % 89 = 6 AND event_no % 3 = 0) OR (event_no % 89 = 5 AND event_no % 2 = 0)""")

view("objects", ("built_envelopes",), """
SELECT s3_key AS key, payload AS content FROM built_envelopes WHERE payload_mode = 'S3'""")

view("resolved", ("envelopes", "objects"), """
SELECT e.*, CASE WHEN e.payload_mode = 'INLINE' THEN
      CASE WHEN e.payload_inline IS NULL THEN 'missing_payload' END
    WHEN e.payload_mode = 'S3' THEN
      CASE WHEN e.s3_key IS NULL THEN 'missing_s3_key' WHEN o.key IS NULL THEN 'storage_fetch_failed' END
    ELSE 'invalid_payload_mode' END AS fetch_error,
  CASE WHEN e.payload_mode = 'INLINE' THEN e.payload_inline WHEN e.payload_mode = 'S3' THEN o.content END AS payload
FROM envelopes e LEFT JOIN objects o ON e.payload_mode = 'S3' AND e.s3_key = o.key""")

view("parsed", ("resolved",), """
SELECT r.* EXCLUDE (sound, typed, ts), CASE WHEN fetch_error IS NULL THEN sha256(payload) = payload_sha256 END AS hash_ok,
  CASE WHEN fetch_error IS NULL AND sha256(payload) = payload_sha256 THEN typed END AS parse_ok,
  CASE WHEN typed THEN regexp_extract_all(left(payload, 2000), '"(?i:user_id)":"([^"]*)"', 1)[-1] END AS p_user_id,
  CASE WHEN typed THEN TRY_CAST(payload->>'$.amount' AS DOUBLE) END AS p_amount,
  CASE WHEN typed THEN payload->>'$.currency' END AS p_currency,
  CASE WHEN typed THEN payload->>'$.merchant' END AS p_merchant,
  CASE WHEN typed THEN epoch_us(ts) END AS p_us,
  CASE WHEN typed THEN CAST(len(json_keys(payload->'$.metadata')) AS INTEGER) END AS p_metadata_keys
FROM (SELECT *, CASE WHEN NOT sound THEN false ELSE json_type(payload) = 'OBJECT'
        AND coalesce(json_type(payload, '$.event_id') = 'VARCHAR', true)
        AND coalesce(isfinite(TRY_CAST(payload->>'$.amount' AS DOUBLE)), true)
        AND coalesce(json_type(payload, '$.amount') IN ('DOUBLE', 'BIGINT', 'UBIGINT'), true) AND ts IS NOT NULL END AS typed
      FROM (SELECT *, CASE WHEN sound THEN TRY_CAST(payload->>'$.timestamp' AS TIMESTAMPTZ) END AS ts
            FROM (SELECT *, fetch_error IS NULL AND sha256(payload) = payload_sha256 AND json_valid(payload) AS sound
                  FROM resolved) x) y) r""")

view("csv_rows", ("txn_m",), """
SELECT event_no,
  CASE WHEN event_no % 37 = 0 THEN 'bad' ELSE CAST(CAST(floor((us - 1704067200000000) / 1000000) AS BIGINT) AS VARCHAR)
    || CASE WHEN event_no % 3 = 0 THEN '.75' ELSE '' END END AS TransactionDT,
  CASE WHEN event_no % 41 = 0 THEN 'n/a' WHEN event_no % 43 = 0 THEN '-5.00' ELSE CAST(amount AS VARCHAR) END AS TransactionAmt,
  CASE WHEN event_no % 47 = 0 THEN '' ELSE substring(user_id, 2, 20) END AS card1,
  product_code AS ProductCD, card_network AS card4, email_domain AS P_emaildomain,
  CASE WHEN event_no % 53 = 0 THEN '' ELSE label END AS isFraud
FROM txn_m""")
