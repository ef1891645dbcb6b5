"""Idempotent sinks and the CSV source."""

import os
import tempfile

from pyspark.sql import functions as F

from riskline.operators import ingest as I
from riskline.operators.sinks import append_if_absent


def test_append_if_absent_is_idempotent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="riskline-sink-"), "events")
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "event_id string, t long")
    assert append_if_absent(spark, batch, path, "event_id", ["t"]) == 2
    assert append_if_absent(spark, batch, path, "event_id", ["t"]) == 0
    rows = {r["event_id"]: r["t"] for r in spark.read.parquet(path).collect()}
    assert rows == {"a": 1, "b": 3}        # first writer by t


def test_csv_wrong_field_count_is_rejected(spark):
    d = tempfile.mkdtemp(prefix="riskline-csv-")
    with open(os.path.join(d, "t.csv"), "w") as fh:
        fh.write("TransactionDT,TransactionAmt,card1,ProductCD,card4,P_emaildomain,isFraud\n")
        fh.write("86400,12.50,1001,W,visa,gmail.com,1\n")
        fh.write("86401,bad,,C,mastercard,,0\n")
        fh.write("86402,3.00,1002,x,W,visa,gmail.com,0\n")       # one field too many
    good, bad = I.read_transactions_csv(spark, d)
    assert good.count() == 2 and bad.select(*bad.columns).collect().__len__() == 1
    ev = {r["user_id"]: r for r in I.map_csv_rows(good, spark, F.lit(0)).collect()}
    assert ev["1001"]["merchant"] == "Amazon Marketplace" and ev["1001"]["is_fraud"] == "1"
    assert ev["unknown"]["amount"] == 1.0 and ev["unknown"]["merchant"] == "Walmart"
    assert ev["1001"]["us"] == 1_704_067_200_000_000 + 86400 * 1_000_000


def test_validation_order(spark):
    rows = [("", 0.0, "", "", None, 20)]
    df = spark.createDataFrame(rows, "user_id string, amount double, currency string, "
                                     "merchant string, us long, metadata_keys int")
    e = I.validate(df, F.lit(0)).first()["error"]
    assert (e["field"], e["code"]) == ("user_id", "MISSING_FIELD")


def test_payload_objects_round_trip(spark):
    from riskline.operators.sinks import read_payload_objects, write_payload_objects

    root = tempfile.mkdtemp(prefix="riskline-objects-")
    env = spark.createDataFrame(
        [("S3", "raw/2024-01-02/e1.json", "big-1"), ("INLINE", None, "small")],
        "payload_mode string, s3_key string, payload string")
    write_payload_objects(env, root)
    got = {r["key"]: r["content"] for r in read_payload_objects(spark, root).collect()}
    assert got == {"raw/2024-01-02/e1.json": "big-1"}
    # a later batch keeps the objects of the first; the same batch again adds nothing
    later = spark.createDataFrame(
        [("S3", "raw/2024-01-02/e1.json", "big-1"), ("S3", "raw/2024-01-03/e2.json", "big-2")],
        "payload_mode string, s3_key string, payload string")
    for _ in range(2):
        write_payload_objects(later, root)
    rows = read_payload_objects(spark, root).collect()
    assert sorted(r["key"] for r in rows) == ["raw/2024-01-02/e1.json", "raw/2024-01-03/e2.json"]


def test_encoder_artifact_round_trip(spark):
    from riskline.operators import encode as EN

    train = spark.createDataFrame(
        [("USD", "W", "visa", "Walmart", "g.com"), ("XMR", "C", "visa", "Target", "")],
        "currency string, product_code string, card_network string, merchant string, "
        "email_domain string")
    path = tempfile.mkdtemp(prefix="riskline-enc-")
    EN.save_encoder(EN.fit_vocab(train), EN.fit_frequencies(train), path, tau=0.87)
    art = EN.load_encoder(spark, path)
    vocab, freq = art["vocab"], art["frequency"]
    assert art["tau"] == 0.87 and art["columns"].count() == len(EN.NUMERIC) + vocab.count() + len(EN.FREQ)
    assert sorted(r["value"] for r in vocab.filter("column = 'currency'").collect()) == \
        ["usd", "xmr"]
    assert {r["value"]: r["freq"] for r in freq.filter("column = 'merchant'").collect()} == \
        {"walmart": 0.5, "target": 0.5}


def test_request_to_event_and_default_ids(spark):
    req = spark.createDataFrame(
        [("e1", "u", 1.0, "USD", "m", 5, {"a": "b"}), ("", "u", 1.0, "USD", "m", 5, {}),
         ("e3", "u", 1.0, "USD", "m", None, None)],
        "event_id string, user_id string, amount double, currency string, merchant string, "
        "transaction_us long, metadata map<string,string>")
    out = {r["event_id"]: r for r in I.request_to_event(req).collect()}
    assert out["e1"]["metadata_json"] == '{"a":"b"}' and out["e1"]["invalid_argument"] is None
    assert out[""]["invalid_argument"] == "event_id is required"
    assert out[""]["metadata_json"] is None
    assert out["e3"]["invalid_argument"] == "transaction_time is required"
    p = spark.createDataFrame([("", "", "{}")], "event_id string, correlation_id string, "
                                               "payload string")
    r = I.default_ids(p).first()
    assert r["event_id"] == r["correlation_id"] and len(r["event_id"]) == 64


def test_body_types_and_times(spark):
    ok = '"user_id":"u","currency":"USD","merchant":"m"'
    bodies = {
        "sound": '{%s,"amount":5,"timestamp":"2024-01-01T00:00:01Z"}' % ok,
        "nanos": '{%s,"amount":5.5,"timestamp":"2024-01-01T00:00:01.123456789Z"}' % ok,
        "offset": '{%s,"amount":5,"timestamp":"2024-01-01T02:00:01+02:00"}' % ok,
        "no_time": '{%s,"amount":5}' % ok, "null_amount": '{%s,"amount":null}' % ok,
        "text_amount": '{%s,"amount":"5"}' % ok, "number_user": '{"user_id":7}',
        "bad_time": '{%s,"amount":5,"timestamp":"yesterday"}' % ok, "list": "[]", "broken": "{"}
    df = spark.createDataFrame(list(bodies.items()), "event_id string, payload string")
    got = {r["event_id"]: r for r in I.parse_events(df).collect()}
    assert {k for k, r in got.items() if r["parse_ok"]} == {"sound", "nanos", "offset", "no_time", "null_amount"}
    second = 1_704_067_201_000_000
    assert (got["sound"]["p_us"], got["nanos"]["p_us"], got["offset"]["p_us"]) == (
        second, second + 123_456, second)
    assert got["no_time"]["p_us"] is None and got["null_amount"]["p_amount"] is None


def test_csv_by_name(spark):
    path = tempfile.mkdtemp(prefix="riskline-csv-")
    with open(f"{path}/a.csv", "w") as f:
        f.write("V9,isFraud,TransactionAmt,TransactionID,TransactionDT\n1,1,5.5,77,10\n1,0,6,78\n,0,7,79,20\n")
    good, bad = I.read_transactions_csv(spark, path)
    rows = good.collect()
    assert good.columns == list(I.CSV_COLUMNS)
    assert [(r["TransactionAmt"], r["TransactionDT"], r["isFraud"], r["card4"]) for r in rows] == [
        ("5.5", "10", "1", ""), ("7", "20", "0", "")]
    assert bad.count() == 1


def test_replayed_batch_replaces_its_rows(spark):
    from riskline.streaming.queries import write_batch

    path = tempfile.mkdtemp(prefix="riskline-batches-")
    for batch_id in (0, 1, 1, 0):
        write_batch(spark.range(3).withColumnRenamed("id", "x"), path, batch_id)
    assert spark.read.parquet(path).count() == 6


def test_redelivered_envelopes_are_stored_once(spark):
    """Five copies of a sound envelope: one event, no velocity flag; an amount beyond the
    store's range is quarantined and stops nothing."""
    import hashlib

    from riskline.config import RulesConfig
    from riskline.plans.pipeline import process_batch

    def env(eid, body, us, no):
        return (eid, "c", "INLINE", body, hashlib.sha256(body.encode()).hexdigest(), None, us, no)

    body = ('{"event_id":"%s","user_id":"u","amount":%s,"currency":"USD","merchant":"m",'
            '"timestamp":"2024-01-01T00:00:00Z"}')
    t0 = 1_704_067_200_000_000
    rows = [env("e1", body % ("e1", "5"), t0 + i * 1000, i) for i in range(5)]
    rows += [env("big", body % ("big", "1e17"), t0, 1), env("e2", body % ("e2", "7"), t0 + 10, 1)]
    df = spark.createDataFrame(rows, "event_id string, correlation_id string, payload_mode string, "
                                     "payload_inline string, payload_sha256 string, s3_key string, "
                                     "received_us long, delivery_no int")
    objects = spark.createDataFrame([], "key string, content string")
    cfg = RulesConfig(velocity_window_seconds=60, velocity_max_count=3)
    out = process_batch(df, objects, None, cfg, spark.range(1).selectExpr(f"{t0 + 10**7}").scalar())
    assert sorted(r["event_id"] for r in out["events"].collect()) == ["e1", "e2"]
    assert out["flags"].count() == 0
    got = {r["event_id"]: (r["status"], r["reason"]) for r in out["outcome"].collect()}
    assert got == {"e1": ("success", None), "e2": ("success", None), "big": ("failed", "constraint_violation")}
