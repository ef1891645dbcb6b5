"""Key -> (Spark query, DuckDB oracle SQL) registry behind ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    fn: QueryFn
    oracle: str | None      # None: no SQL form (state, ML, randomness) -> rows-only check
    doc: str


REGISTRY: dict[str, Entry] = {}


def register(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, oracle, (fn.__doc__ or "").strip())
        return fn

    return deco
