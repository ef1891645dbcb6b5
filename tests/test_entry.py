"""Driver contract."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.columns == ["merchant", "flag_count"]
    assert len(df.collect()) > 0


def test_oracle_keys_are_query_keys():
    m = _entry_module()
    assert set(m.oracle_sql()) <= set(m.queries())
