"""Every registered query against its DuckDB oracle SQL (sf0.001 here; the
driver runs the same comparison at sf0.01), plus the entry contract."""

import pytest

from tests.oracle import compare_frames, duck, type_mismatches

SF = "/root/testdata/sf0.001"


def _keys():
    import geoframe.plans  # noqa: F401
    from geoframe.plans.registry import QUERIES
    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    from geoframe.plans.registry import ORACLE_SQL, QUERIES
    sdf = QUERIES[key](spark, SF)
    got = sdf.toPandas()
    assert key in ORACLE_SQL, f"{key} has no oracle SQL"
    rel = con.sql(ORACLE_SQL[key])
    assert not type_mismatches(sdf.schema, rel)
    ok, msg = compare_frames(got, rel.df())
    assert ok, msg


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
