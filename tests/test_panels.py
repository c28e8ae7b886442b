"""Dashboard panels: selection semantics, extremes, display order, pivots."""

from planmart.operators import marts as M
from planmart.operators.enrich import build_silver
from planmart.functions import lenient_double
from planmart.plans import panels as P
from tests.helpers import cost, costs_df, plan, plans_df

STATES = ["AK", "AL", "AZ", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL"]


def _marts(spark):
    plans, costs = [], []
    for i, st in enumerate(STATES):
        for j, metal in enumerate(["Bronze", "Gold"]):
            pid = f"P{i}_{j}"
            plans.append(plan(pid, state=st, metal=metal, network=["HMO", "PPO"][j]))
            costs.append(cost(pid, ded=str(100 * (i + 1) + j), hsa=j))
    s = build_silver(plans_df(spark, plans), costs_df(spark, costs))
    d1, d2, d3 = M.dm1_affordability(s), M.dm2_market(s), M.dm3_competitiveness(s)
    return (P.panel_frame(d1, P.DM1_NUMERIC, False), P.panel_frame(d2, P.DM2_NUMERIC, False),
            P.panel_frame(d3, P.DM3_NUMERIC, False))


def test_default_selection_is_first_ten_states(spark):
    d1, d2, d3 = _marts(spark)
    f1, f2, f3 = P.apply_selection(d1, d2, d3)
    assert sorted({r.statecode for r in f1.collect()}) == STATES[:10]
    assert f2.count() == 20 and f3.count() == 20


def test_empty_selection_gives_no_rows(spark):
    d1, d2, d3 = _marts(spark)
    f1, f2, f3 = P.apply_selection(d1, d2, d3, P.Selection(states=[]))
    assert f1.count() == f2.count() == f3.count() == 0


def test_mart3_ignores_network_filter(spark):
    d1, d2, d3 = _marts(spark)
    f1, f2, f3 = P.apply_selection(d1, d2, d3, P.Selection(networks=["HMO"]))
    assert {r.networktype for r in f2.collect()} == {"HMO"}
    assert {r.networktype for r in f3.collect()} == {"HMO", "PPO"}


def test_extremes_overlap_when_few_states(spark):
    d1, d2, d3 = _marts(spark)
    f1, _, _ = P.apply_selection(d1, d2, d3)
    ext = P.state_extremes(f1).collect()
    assert len(ext) == 20
    assert {r.statecode for r in ext if r.category == "Moins chers"} == {r.statecode for r in ext if r.category == "Plus chers"}


def test_metal_display_order_and_facets(spark):
    d1, d2, d3 = _marts(spark)
    assert [r.metallevel for r in P.metal_ded_oop(d1).collect()] == ["Bronze", "Gold"]
    f = P.facets(d1, d2).collect()
    states = [r.value for r in sorted((r for r in f if r.facet == "state"), key=lambda r: r.position)]
    assert states == STATES
    assert sum(r.is_default for r in f if r.facet == "state") == 10


def test_pivot_fills_gaps(spark):
    d1, d2, d3 = _marts(spark)
    m = {r.statecode: r for r in P.state_network_matrix(d2).collect()}
    assert m["AK"].EPO == 0.0 and m["AK"].HMO == 100.0 and m["AK"].PPO == 101.0


def test_hsa_half_even(spark):
    d1, d2, d3 = _marts(spark)
    r = {x.metallevel: x.pct_hsa for x in P.hsa_pct(d3).collect()}
    assert r == {"Bronze": 0.0, "Gold": 100.0}


def test_exclusions_of_any_category_are_kept(spark):
    rows = [("AK", "Benefit_1", 0), ("AL", "Dental | Vision", 0), ("AL", "Benefit_1", 1), ("AZ", "Ambulatory Care", 0)]
    s = build_silver(plans_df(spark, [plan(f"P{i}", state=st) for i, (st, _, _) in enumerate(rows)]),
                     costs_df(spark, [cost(f"P{i}", category=c, covered=k) for i, (_, c, k) in enumerate(rows)]))
    d3 = P.panel_frame(M.dm3_competitiveness(s), P.DM3_NUMERIC, False)
    m = P.exclusion_matrix(d3)
    assert m.columns == ["statecode", "benefitcategory", "num_excluded"]
    excluded = {("AK", "Benefit_1"), ("AL", "Dental | Vision"), ("AZ", "Ambulatory Care")}
    assert sorted(map(tuple, m.collect())) == [(s, c, int((s, c) in excluded)) for s in ("AK", "AL", "AZ")
                                               for c in ("Ambulatory Care", "Benefit_1", "Dental | Vision")]
    none = P.exclusion_matrix(d3.limit(0))
    assert none.schema == m.schema and none.count() == 0


def test_lenient_numbers(spark):
    good = {"1e3": 1000.0, " 7 ": 7.0, ".5": 0.5, "5.": 5.0, "+3": 3.0, "-.5e-2": -0.005, "\t8\n": 8.0, "inf": float("inf"),
            "-Infinity": -float("inf"), "0": 0.0}
    bad = ["1d", "2.5F", "0x1p3", "0x10", "1_000", "1e", "e1", "", "  ", "1,000", "True", "+ 3", "1e400", "nan", "NaN", "1 2", ".",
           "Unlimited", None]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string").select("t", lenient_double("t").alias("v"))
    assert {r.t: r.v for r in df.collect()} == good | dict.fromkeys(bad)
