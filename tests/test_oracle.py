"""Every registered query with an oracle must equal its DuckDB SQL on the fixture."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SQLS = E.oracle_sql()
SLOW = {"boosted_model"}  # 200 rounds, about 1,400 jobs one after the other: compared by tests/oracle_compare.py
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(SQLS) - SLOW))
def test_matches_duckdb(spark, con, name):
    problems, _ = compare(spark, con, name, QUERIES[name], SQLS[name], SF)
    assert not problems, problems


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"pitch_type", "n_pitches", "strike_rate"}
