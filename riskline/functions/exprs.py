"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros(ts: Column | str) -> Column:
    """Zone-free microseconds since the epoch (equals DuckDB ``epoch_us``)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", _epoch(), col.cast("timestamp_ntz"))


def from_micros(us: Column | str) -> Column:
    """Microseconds since the epoch -> zone-free timestamp."""
    col = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", col, _epoch())


def go_quote(s: Column) -> Column:
    """Go's ``%q`` for printable text: wrap in double quotes, escape ``\\`` and ``"``."""
    escaped = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def fixed2(value: Column) -> Column:
    """``%.2f`` text of a money value already held as DECIMAL(18,2)."""
    return value.cast("decimal(18,2)").cast("string")


def fixed4(value: Column) -> Column:
    """``%.4f`` text via a DECIMAL(20,4) cast (no binary rounding surprises)."""
    return F.round(value, 4).cast("decimal(20,4)").cast("string")


def flag_id(event_id: Column, rule_name: Column) -> Column:
    """Deterministic, retry-safe flag id: sha256(event_id | rule_name)."""
    return F.sha2(F.concat_ws("|", event_id, rule_name), 256)


def byte_cut(text: Column, n: int) -> Column:
    """At most the first ``n`` bytes of UTF-8 text, without a character cut in half."""
    whole = F.octet_length(text) <= n
    cut = F.substring(text.cast("binary"), 1, n)
    # drop the bytes of an incomplete last character (at most three)
    valid = F.coalesce(*[F.try_validate_utf8(F.substring(text.cast("binary"), 1, n - k).cast("string"))
                         for k in range(4)], cut.cast("string"))
    return F.when(whole, text).otherwise(valid)
