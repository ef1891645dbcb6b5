"""Offline training data: S6 labelled scan, P20 label extraction, M1 feature export,
M4 / W7 temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.operators.ordinal import global_ordinal, part_count
from riskline.session import written

LABEL_KEY = "is_fraud_ground_truth"


def _is_json_string(v: Column, key: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, f"$.{key}", "variant")) == "STRING"


def meta_string(metadata_json: str, key: str) -> Column:
    """A metadata value only when it is a JSON string; numbers, null or missing -> ''."""
    v = F.try_parse_json(F.col(metadata_json))
    return F.when(_is_json_string(v, key), F.variant_get(v, f"$.{key}", "string")) \
        .otherwise(F.lit(""))


def labelled_label(metadata_json: str = "metadata_json") -> Column:
    """P20: the label as text, null for an event without one: the string value when it is a
    non-empty JSON string, else "0" (Q6; ``->> IS NOT NULL``, so a numeric 1 passes)."""
    v = F.try_parse_json(F.col(metadata_json))
    raw = F.try_variant_get(v, f"$.{LABEL_KEY}", "string")
    text = F.when(_is_json_string(v, LABEL_KEY) & (raw != ""), raw).otherwise(F.lit("0"))
    return F.when(raw.isNotNull(), text)


def labelled_events(events: DataFrame, metadata_json: str = "metadata_json") -> DataFrame:
    """S6 + P20: events whose metadata has a non-null ground-truth label, and the label."""
    return events.withColumn("gt_label", labelled_label(metadata_json)).filter("gt_label IS NOT NULL")


def feature_export(events: DataFrame, features_fn, metadata_json: str = "metadata_json"
                   ) -> DataFrame:
    """M1: the 12 raw features of every labelled event, categoricals read from metadata,
    plus the label. Features see all events (labelled or not) as history.

    Label and categoricals are read before the windows and carried through them as narrow
    columns, so the features need no join back to the events."""
    label = labelled_label(metadata_json)
    cats = ("product_code", "card_network", "email_domain")
    narrow = events.select(
        *[c for c in events.columns if c not in (*cats, metadata_json, "label")],
        *[meta_string(metadata_json, c).alias(c) for c in cats], label.alias("label"))
    return features_fn(narrow).filter("label IS NOT NULL")


def temporal_split(df: DataFrame, order_cols: list[str] | None = None,
                   train: float = 0.70, val: float = 0.85) -> DataFrame:
    """M4: 70 / 15 / 15 by position in time order, boundaries ``int(n * f)``."""
    order_cols = order_cols or ["us", "event_id"]
    # The range partitioning samples its input before it reads it: write the input once
    # instead of computing the features twice.
    rows = written(df, "split-input")
    o = global_ordinal(rows, order_cols, "_rn", part_count(rows.sparkSession, rows.count()))
    n = o.agg(F.count(F.lit(1))).scalar()
    return o.withColumn(
        "split",
        F.when(F.col("_rn") < F.floor(n * F.lit(train)).cast("bigint"), F.lit("train"))
         .when(F.col("_rn") < F.floor(n * F.lit(val)).cast("bigint"), F.lit("val"))
         .otherwise(F.lit("test"))).drop("_rn")


def split_summary(split: DataFrame, label: str = "label") -> DataFrame:
    """Sizes and positive rates per split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg((F.col(label) == "1").cast("double")), 6).alias("pos_rate"))
