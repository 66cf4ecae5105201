"""Every registered query against its DuckDB twin (sf0.001; the driver runs sf0.01)."""
import pytest

from check_oracle import compare, duck
from conftest import SF001
from reviewops.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    info = compare(spark, con, name, QUERIES[name], ORACLE[name], SF001)
    assert info["status"] == "ok", info


def test_every_query_runs_and_has_stable_schema(spark):
    for name in sorted(set(QUERIES) - set(ORACLE)):
        df = QUERIES[name](spark, SF001)
        assert df.count() >= 0
        assert df.columns == QUERIES[name](spark, SF001).columns


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
