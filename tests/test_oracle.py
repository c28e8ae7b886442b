"""Every registered query equals its DuckDB oracle at sf0.001 (the driver's check)."""

import pytest

import __spark_entry__ as E
from planmart import oracle, schemas
from planmart.operators import marts, quality
from planmart.plans.registry import QUERIES as REGISTERED
from planmart.verify import compare, duckdb_connection

# The queries of the training-data operators have tests of their own.
QUERIES = {k: v for k, v in E.queries().items() if k in REGISTERED}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(REGISTERED) <= set(ORACLE)


def test_the_oracle_states_the_same_contract():
    for name in ("VALID_STATES", "VALID_NETWORK_TYPES", "VALID_METAL_LEVELS", "METAL_ORDER", "MIN_PLAN_YEAR",
                 "DM1_ID", "DM2_ID", "DM3_ID", "DM1_TABLE", "DM2_TABLE", "DM3_TABLE"):
        assert getattr(oracle, name) == getattr(schemas, name)
    assert oracle.PLAN_RULES == quality.PLAN_RULES and oracle.COST_RULE == quality.COST_RULE
    assert oracle.DEFAULT_SNAPSHOT == marts.DEFAULT_SNAPSHOT
    assert oracle._DEDUP == ", ".join(f"{c} DESC NULLS LAST" if d else f"{c} NULLS LAST" for c, d in quality.DEDUP_ORDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    ok, msg = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_individual_deductible" in df.columns
