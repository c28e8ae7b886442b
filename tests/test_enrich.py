"""Silver join and enrichment against hand-computed rows (and, in test_oracle, DuckDB windows)."""

from bisect import bisect_left
from decimal import Decimal

from pyspark.sql import functions as F

from planmart.operators import quality as Q
from planmart.operators.enrich import build_silver, enrich, join_plans_costs, with_network_share, with_rank
from planmart.plans.store import store
from planmart.schemas import COSTS_SCHEMA, PLANS_SCHEMA, SILVER_SCHEMA
from planmart.sources.fixtures import fixture_costs, fixture_plans
from tests.helpers import cost, costs_df, plan, plans_df


def test_rank_ties_and_gaps(spark):
    p = plans_df(spark, [plan(f"P{i}") for i in range(4)])
    c = costs_df(spark, [cost("P0", ded="100"), cost("P1", ded="100"), cost("P2", ded="100"), cost("P3", ded="900")])
    ranks = sorted(r.rank_deductible_state for r in build_silver(p, c).collect())
    assert ranks == [1, 1, 1, 4]


def test_unmatched_rows_vanish(spark):
    p = plans_df(spark, [plan("A"), plan("B")])
    c = costs_df(spark, [cost("B"), cost("C")])
    assert [r.PlanID for r in join_plans_costs(p, c).collect()] == ["B"]


def test_inactive_plans_count_in_windows(spark):
    p = plans_df(spark, [plan("A", active=1, network="HMO"), plan("B", active=0, network="PPO")])
    c = costs_df(spark, [cost("A", ded="100", oop="1000"), cost("B", ded="300", oop="1000")])
    rows = {r.PlanID: r for r in build_silver(p, c).collect()}
    assert rows["A"].plan_count_state == 2
    assert rows["A"].avg_deductible_state == Decimal("200.000000")
    assert rows["A"].pct_network_type_in_state == 50.0
    assert rows["B"].rank_deductible_state == 2
    assert rows["A"].affordability_score == 400.0


def _derived(rows):
    return sorted((r.PlanID, r.rank_deductible_state, r.avg_deductible_state, r.plan_count_state, r.plan_count_state_network,
                   r.pct_network_type_in_state, r.avg_oop_max_state_metal) for r in rows)


def test_hand_computed_rows(spark):
    p = plans_df(spark, [plan("A", network="HMO", metal="Gold"), plan("B", network="HMO", metal="Silver"),
                         plan("C", network="PPO", metal="Gold"), plan("T", state="TX")])
    c = costs_df(spark, [cost("A", ded="99.99", oop="1000"), cost("B", ded="100.00", oop="2000"),
                         cost("C", ded="100.00", oop="4001"), cost("T", ded="0", oop="10")])
    third = Decimal("99.996667")
    assert _derived(build_silver(p, c).collect()) == [
        ("A", 1, third, 3, 2, 66.67, Decimal("2500.500000")), ("B", 2, third, 3, 2, 66.67, Decimal("2000.000000")),
        ("C", 2, third, 3, 1, 33.33, Decimal("2500.500000")), ("T", 1, Decimal("0.000000"), 1, 1, 100.0, Decimal("10.000000"))]


def _rank(values):
    key = lambda v: (v is not None, v or 0)
    return [1 + sum(key(o) < key(v) for o in values) for v in values]


def test_rank_with_nulls_and_null_states(spark):
    # Unvalidated input: NULL states form one state, NULL deductibles come first.
    states, deds = [None, "CA", "TX"], [None, "0", "5", "99.99", "100", "100.01", "205"]
    rows = [(f"P{i:02}", states[i % 3], deds[(i * i) % 7]) for i in range(40)]
    p = plans_df(spark, [plan(i, state=s) for i, s, _ in rows])
    c = costs_df(spark, [cost(i, ded=d) for i, _, d in rows])
    got = {r.PlanID: r.rank_deductible_state for r in build_silver(p, c).collect()}
    for s in states:
        own = [(i, None if d is None else Decimal(d)) for i, st, d in rows if st == s]
        assert [got[i] for i, _ in own] == _rank([d for _, d in own])


def test_hot_state_and_hot_deductible(spark):
    n = 3000
    p = spark.range(n).selectExpr("concat('P', id) AS PlanID", "IF(id % 3 < 2, 'CA', 'NY') AS StateCode")
    rest = {f.name: f.dataType for f in PLANS_SCHEMA.fields}
    for name, kind in rest.items():
        if name not in p.columns:
            p = p.withColumn(name, F.lit("HMO" if name == "NetworkType" else "Gold" if name == "MetalLevel" else None).cast(kind))
    c = spark.range(n).selectExpr("concat('P', id) AS PlanID", "CAST(IF(id % 2 = 0, 500, id) AS DECIMAL(10,2)) AS IndividualDeductible")
    for f in COSTS_SCHEMA.fields:
        if f.name not in c.columns:
            c = c.withColumn(f.name, F.lit(None).cast(f.dataType))
    got = build_silver(p, c).select("StateCode", "IndividualDeductible", "rank_deductible_state").collect()
    for s in ("CA", "NY"):
        own = sorted((r.IndividualDeductible, r.rank_deductible_state) for r in got if r.StateCode == s)
        values = [v for v, _ in own]
        assert len(own) == n * (2 if s == "CA" else 1) // 3
        assert [k for _, k in own] == [bisect_left(values, v) + 1 for v in values]


def test_silver_contract(spark, sf_small):
    s = build_silver(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    assert s.count() == 1149
    assert [(f.name, f.dataType) for f in s.schema.fields] == [(f.name, f.dataType) for f in SILVER_SCHEMA.fields]


def test_network_share_is_that_of_silver(spark, sf_small):
    j = join_plans_costs(Q.clean_plans(fixture_plans(spark, sf_small)), Q.clean_costs(fixture_costs(spark, sf_small)))
    cols = ["PlanID", "pct_network_type_in_state"]
    a, b = with_network_share(j).select(cols), enrich(j).select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_buckets_are_ranked_by_counts(spark):
    deds = [50, 50, 50, 7, 99, None, 50, 200, 250, 300, 300, None, 12, 50]
    states = ["CA", None, "CA", "CA", "CA", "CA", "TX", "CA", "CA", None, "TX", "TX", "", "CA"]
    p = plans_df(spark, [plan(f"P{i}", state=s or "") for i, s in enumerate(states)]).withColumn(
        "StateCode", F.when(F.col("PlanID").isin([f"P{i}" for i, s in enumerate(states) if s is None]), None).otherwise(F.col("StateCode")))
    c = costs_df(spark, [cost(f"P{i}", ded=None if d is None else str(d)) for i, d in enumerate(deds)])
    joined = join_plans_costs(p, c)
    groups = {s: [d for d, t in zip(deds, states) if t == s] for s in set(states)}
    want = {f"P{i}": _rank(groups[s])[[k for k, t in enumerate(states) if t == s].index(i)] for i, s in enumerate(states)}
    for hot_rows in (0, 1, 3, 1000):  # every bucket is hot, some are, none is
        got = with_rank(joined, hot_rows=hot_rows)
        assert got.columns == [*joined.columns, "rank_deductible_state"]
        assert {r.PlanID: r.rank_deductible_state for r in got.collect()} == want


def test_rows_cross_the_network_once_for_the_rank(spark, sf_small):
    joined = store(spark, sf_small).joined()
    plan_text = with_rank(joined)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan_text.splitlines() if "Window" in line and "rank(" in line]
    assert len(wide) == 1 and "_s" in wide[0] and "_b" in wide[0]
