"""The driver contract: entry() smoke, and every registered query against its
DuckDB twin on the smallest driver tables (row count + exact value hash)."""

import importlib.util
import os

import pytest

from tessera.catalog import QUERIES
from tessera.checks.compare import compare_one, duck_connection

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


ENTRY = _entry_module()
NAMES = sorted(QUERIES)  # the corpus operators have tests of their own


def test_entry_smoke(spark, small_sf):
    df = ENTRY.entry(spark)
    assert df.columns == ["country", "city", "attribution_channel", "month", "new", "retained",
                          "reactivated", "churned"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.fixture(scope="module")
def duck(small_sf):
    return duck_connection(small_sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, small_sf, duck, name):
    sql = ENTRY.oracle_sql().get(name)
    if sql is None:
        assert ENTRY.queries()[name](spark, small_sf).count() >= 0
        return
    r = compare_one(spark, duck, name, ENTRY.queries()[name], sql, small_sf)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact"], r
