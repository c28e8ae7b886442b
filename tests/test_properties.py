"""Property tests on random small inputs (NULLs, duplicates, skewed keys)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from planmart.operators import marts as M
from planmart.operators import quality as Q
from planmart.operators.enrich import enrich, join_plans_costs
from tests.helpers import cost, costs_df, plan, plans_df

ids = st.sampled_from(["P1", "P2", "P3", "P4", None])
plan_rows = st.lists(st.tuples(
    ids,
    st.sampled_from(["CA", "TX", "ZZ", None]),
    st.sampled_from(["HMO", "PPO", "FFS", None]),
    st.sampled_from(["Gold", "Silver", "Titanium"]),
    st.sampled_from([2019, 2022, 2024, None]),
    st.sampled_from(["Issuer_1", " ", None]),
    st.sampled_from([0, 1]),
), min_size=1, max_size=14)
cost_rows = st.lists(st.tuples(
    st.sampled_from(["P1", "P2", "P3", "P4"]),
    st.sampled_from(["0", "100", "100", "250", None]),
    st.sampled_from(["50", "500", None]),
), min_size=1, max_size=10)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _plans(spark, rows):
    return plans_df(spark, [plan(pid, state=s, network=n, metal=m, year=y, issuer=i, active=a)
                            for pid, s, n, m, y, i, a in rows])


@SETTINGS
@given(rows=plan_rows)
def test_funnel_accounts_for_every_row(spark, rows):
    df = _plans(spark, rows)
    f = sorted((r.rule_no, r.rejected, r.remaining) for r in Q.plan_funnel(df).collect())
    assert f[-1][2] == Q.clean_plans(df).count()
    assert sum(r[1] for r in f) + f[-1][2] == len(rows)


@SETTINGS
@given(prow=plan_rows, crow=cost_rows)
def test_ranks_and_counts_by_brute_force(spark, prow, crow):
    # Unvalidated plans (NULL states and deductibles included); costs may fan out.
    p = Q.deduplicate_plans(_plans(spark, prow))
    c = costs_df(spark, [cost(pid, ded=d, oop=o) for pid, d, o in crow])
    rows = enrich(join_plans_costs(p, c)).collect()
    key = lambda v: (v is not None, v or 0)
    for r in rows:
        state = [x for x in rows if x.StateCode == r.StateCode]
        deds = [x.IndividualDeductible for x in state]
        assert r.rank_deductible_state == 1 + sum(key(d) < key(r.IndividualDeductible) for d in deds)
        assert r.plan_count_state == len(state)
        assert r.plan_count_state_network == sum(x.NetworkType == r.NetworkType for x in state)
    assert len(rows) == join_plans_costs(p, c).count()


@SETTINGS
@given(prow=plan_rows, crow=cost_rows)
def test_marts_partition_active_silver(spark, prow, crow):
    s = enrich(join_plans_costs(Q.clean_plans(_plans(spark, prow)), Q.clean_costs(
        costs_df(spark, [cost(pid, ded=d, oop=o) for pid, d, o in crow]).dropDuplicates(["PlanID"]))))
    active = M.active(s).count()
    for mart in (M.dm1_affordability(s), M.dm2_market(s), M.dm3_competitiveness(s)):
        assert (mart.groupBy().sum("num_plans").collect()[0][0] or 0) == active
