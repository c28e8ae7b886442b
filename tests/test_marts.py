"""Marts: active filter, conditional counts, distinct counts and invariants."""

import contextlib
import io
import uuid

import pytest

from planmart.operators import marts as M
from planmart.operators import quality as Q
from planmart.operators.enrich import build_silver
from planmart.schemas import DM1_SCHEMA, DM2_SCHEMA, DM3_SCHEMA
from planmart.sources import commits as C
from planmart.sources.fixtures import fixture_costs, fixture_plans
from tests.helpers import cost, costs_df, plan, plans_df


def _silver(spark, plans, costs):
    return build_silver(plans_df(spark, plans), costs_df(spark, costs))


def test_null_covered_counts_zero_and_none_is_a_value(spark):
    s = _silver(spark, [plan("A"), plan("B"), plan("C")],
                [cost("A", covered=None, exclusions="None"), cost("B", covered=0, exclusions=None),
                 cost("C", covered=1, exclusions="None")])
    r = M.dm3_competitiveness(s).collect()[0]
    assert (r.num_plans, r.num_excluded, r.distinct_exclusions) == (3, 1, 1)


def test_inactive_excluded_from_marts(spark):
    s = _silver(spark, [plan("A"), plan("B", active=0)], [cost("A"), cost("B")])
    assert M.dm1_affordability(s).collect()[0].num_plans == 1


def test_marts_sum_to_active_silver_and_contracts(spark, sf_small):
    s = build_silver(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    active = M.active(s).count()
    d1, d2, d3 = M.dm1_affordability(s), M.dm2_market(s), M.dm3_competitiveness(s)
    for d in (d1, d2, d3):
        assert d.groupBy().sum("num_plans").collect()[0][0] == active
    assert (d1.count(), d2.count(), d3.count()) == (224, 473, 897)
    for d, schema in ((d1, DM1_SCHEMA), (d2, DM2_SCHEMA), (d3, DM3_SCHEMA)):
        assert [(f.name, f.dataType) for f in d.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def test_mart_volumes(spark):
    s = _silver(spark, [plan("A"), plan("B", network="PPO")], [cost("A"), cost("B", category="Benefit_2")])
    v = {r.datamart: r.lignes for r in M.mart_volumes(
        M.dm1_affordability(s), M.dm2_market(s), M.dm3_competitiveness(s)).collect()}
    assert v == {"datamart_affordability": 1, "datamart_market_structure": 2, "datamart_competitiveness": 2}


def test_ordered_marts(spark):
    s = _silver(spark, [plan("A", state="TX"), plan("B", state="CA", network="PPO"), plan("C", state="CA"),
                        plan("D", state="CA", issuer="Issuer_02")],
                [cost("A"), cost("B"), cost("C"), cost("D")])
    d1 = [(r.StateCode, r.MetalLevel) for r in M.dm1_affordability(s, ordered=True).collect()]
    assert d1 == sorted(d1)
    d2 = [(r.StateCode, r.NetworkType, r.IssuerName) for r in M.dm2_market(s, ordered=True).collect()]
    assert d2 == [("CA", "HMO", "Issuer_01"), ("CA", "HMO", "Issuer_02"), ("CA", "PPO", "Issuer_01"),
                  ("TX", "HMO", "Issuer_01")]


def test_unique_plan_ids_form_matches_distinct(spark, sf_small):
    s = build_silver(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    assert M.plan_ids_unique(Q.clean_costs(fixture_costs(spark, sf_small)))
    for build in (M.dm1_affordability, M.dm2_market, M.dm3_competitiveness):
        a, b = build(s), build(s, unique_plan_ids=True)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_duplicate_cost_rows_are_detected(spark):
    s = _silver(spark, [plan("A"), plan("B")], [cost("A"), cost("A", category="Benefit_2"), cost("B")])
    assert not M.plan_ids_unique(costs_df(spark, [cost("A"), cost("A", category="Benefit_2"), cost("B")]))
    # Fan-out: averages weigh both cost rows, the plan is counted once.
    assert M.dm1_affordability(s).collect()[0].num_plans == 2


BUILDERS = {M.DM1_TABLE: M.dm1_affordability, M.DM2_TABLE: M.dm2_market, M.DM3_TABLE: M.dm3_competitiveness}


def _same_rows(a, b):
    assert [(f.name, f.dataType) for f in a.schema.fields] == [(f.name, f.dataType) for f in b.schema.fields]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("table", BUILDERS)
def test_roll_up_of_cells_equals_the_mart(spark, sf_small, table):
    s = build_silver(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    _same_rows(M.roll_up(M.mart_cells(s), table, "2024-02-01"), BUILDERS[table](s, "2024-02-01"))


@pytest.mark.parametrize("table", BUILDERS)
def test_cells_of_one_mart(spark, sf_small, table):
    s = build_silver(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    cells, mart = M.mart_cells(s, table), BUILDERS[table](s)
    _same_rows(M.roll_up(cells, table), mart)
    assert set(M.MART_KEYS[table]) <= set(cells.columns) and len(cells.columns) < len(M.mart_cells(s).columns)
    assert table != M.DM1_TABLE or cells.count() == mart.count()  # no finer than its mart
    nulls = _silver(spark, [plan("A", metal="Gold"), plan("B", county="x", active=None), plan("C", issuer="I")],
                    [cost("A", exclusions=None), cost("B"), cost("C", category=None, covered=None)])
    for rows in (nulls, nulls.where("StateCode = 'none'")):
        _same_rows(M.roll_up(M.mart_cells(rows, table), table), BUILDERS[table](rows))


def test_store_reads_the_sources_once_for_the_marts(spark, sf_small, monkeypatch):
    from planmart.plans import store as S

    reads = []
    monkeypatch.setattr(S, "fixture_costs", lambda *a: reads.append(a) or fixture_costs(*a))
    s = S.Store(spark, sf_small, uuid.uuid4().hex)
    assert s.unique_plan_ids() and s.cells(M.DM1_TABLE).count() == s.mart(M.DM1_TABLE).count()
    assert len(reads) == 1
    C.delete(spark, s.root)


@pytest.mark.parametrize("table", BUILDERS)
def test_roll_up_of_nulls_ties_and_nothing(spark, table):
    plans = [plan("A", county="x"), plan("B", county="x", metal="Silver"), plan("C", metal="Bronze", active=None),
             plan("D", active=0, network="PPO"), plan("E", county="y", issuer=" Issuer_01 "), plan("F", state="TX")]
    costs = [cost("A", exclusions=None), cost("B", covered=None, hsa=1), cost("C"), cost("D", covered=0),
             cost("E", category=None, covered=0, ded="0", oop="0.01"), cost("F", exclusions="None", hsa=None)]
    for s in (_silver(spark, plans, costs), _silver(spark, plans, []).where("StateCode = 'none'")):
        _same_rows(M.roll_up(M.mart_cells(s), table), BUILDERS[table](s))


@pytest.mark.parametrize("table", BUILDERS)
def test_roll_up_has_hash_aggregates_without_expand(spark, sf_small, table):
    s = build_silver(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    cells = spark.createDataFrame([], M.mart_cells(s).schema)
    for df in (M.roll_up(cells, table), M.mart_cells(spark.createDataFrame([], s.schema))):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        assert "Expand" not in out.getvalue() and "SortAggregate" not in out.getvalue()
