"""Every registered query beside its SQL at the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import compare
from stargrain.plans.catalogue import ORACLES, QUERIES
from stargrain.plans.catalogue.base import TABLES


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    result, _ = compare(spark, con, name, sf_dir)
    assert result.startswith("ok"), result


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["tanggal", "nama_hari"]
