"""Validation rules R1-R7 on hand-made rows (FIXTURES.md section 3) and the funnel."""

from planmart.operators import quality as Q
from planmart.schemas import PLANS_SCHEMA
from planmart.sources.fixtures import fixture_costs, fixture_plans
from tests.helpers import cost, costs_df, plan, plans_df


def ids(df):
    return sorted(r.PlanID for r in df.select("PlanID").collect())


def test_null_key_rejected(spark):
    df = plans_df(spark, [plan(None), plan("P1")])
    assert ids(Q.clean_plans(df)) == ["P1"]


def test_dedup_happens_before_validity(spark):
    # The preferred duplicate (latest year) has an invalid state: both rows go.
    df = plans_df(spark, [plan("P1", state="ZZ", year=2024), plan("P1", state="CA", year=2023), plan("P2")])
    assert ids(Q.clean_plans(df)) == ["P2"]


def test_dedup_is_deterministic(spark):
    df = plans_df(spark, [plan("P1", metal="Silver", year=2023), plan("P1", metal="Bronze", year=2023)])
    row = Q.clean_plans(df).collect()[0]
    assert row.MetalLevel == "Bronze"


def test_dedup_against_brute_force(spark):
    rows = [plan("A"), plan("B", year=2021), plan("B", year=2024, state=None), plan("B", year=2024, state="TX"),
            plan("C", year=None), plan("C", year=2020), plan("D"), plan("D"), plan(None, year=2022), plan(None, year=2024),
            plan("")] + [plan("HOT", year=2020 + i % 4, issuer=f"Issuer_{i % 7}") for i in range(40)]

    def order(row):
        named = dict(zip(PLANS_SCHEMA.fieldNames(), row, strict=True))
        return [(named[c] is None, 0 if named[c] is None else -named[c] if d else named[c]) for c, d in Q.DEDUP_ORDER]

    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    want = {(*min(g, key=order), len(g)) for g in groups.values()}
    got = Q.deduplicate_plans(plans_df(spark, rows), with_counts=True).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_dedup_folds_crowded_keys_first(spark):
    rows = [plan("HOT", year=2020 + i % 4, issuer=f"Issuer_{i % 7}") for i in range(40)] + [plan("A"), plan("A", year=2024)]
    rows += [plan(None, year=2020 + i % 3) for i in range(9)]
    got = [sorted(map(tuple, Q.deduplicate_plans(plans_df(spark, rows), True, hot_rows=n).collect()), key=str) for n in (5, 1000)]
    assert got[0] == got[1]
    assert {(r[0], r[-2], r[-1]) for r in got[0]} == {("HOT", 2023, 40), ("A", 2024, 2), (None, 2022, 9)}


def test_dedup_sorts_after_the_exchange_only(spark):
    df = Q.deduplicate_plans(plans_df(spark, [plan("A"), plan("A", year=2024), plan("B")]))
    assert ids(df) == ["A", "B"]
    df = Q.deduplicate_plans(plans_df(spark, [plan("A"), plan("A", year=2024), plan("B")]))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above, below = final.split("REPARTITION_BY_COL", 1)
    assert "SortAggregate" in above and "Sort" not in below


def test_dedup_of_no_rows(spark):
    assert Q.deduplicate_plans(plans_df(spark, [])).count() == 0
    assert [(r.rejected, r.remaining) for r in Q.plan_funnel(plans_df(spark, [])).collect()][1:] == [(0, None)] * 5


def test_domain_rules_reject_null_and_case(spark):
    rows = [plan("S1", state=None), plan("S2", state="ca"), plan("N1", network=None), plan("N2", network="hmo"),
            plan("M1", metal=None), plan("M2", metal="gold"), plan("OK")]
    assert ids(Q.clean_plans(plans_df(spark, rows))) == ["OK"]


def test_blank_issuer_rejected(spark):
    rows = [plan("I1", issuer=None), plan("I2", issuer=""), plan("I3", issuer="   "), plan("OK", issuer=" A ")]
    assert ids(Q.clean_plans(plans_df(spark, rows))) == ["OK"]


def test_plan_year_floor(spark):
    rows = [plan("Y2019", year=2019), plan("Y2020", year=2020), plan("YNULL", year=None)]
    assert ids(Q.clean_plans(plans_df(spark, rows))) == ["Y2020"]


def test_cost_rule(spark):
    rows = [cost("ZERO", ded="0", oop="500"), cost("EQ", ded="700", oop="700"), cost("GT", ded="800", oop="700"),
            cost("OOP0", ded="0", oop="0"), cost("NULLD", ded=None), cost("NULLO", oop=None)]
    assert ids(Q.clean_costs(costs_df(spark, rows))) == ["EQ", "ZERO"]


def test_funnel_charges_first_failed_rule(spark):
    rows = [plan(None), plan("D", year=2023), plan("D", year=2022), plan("S", state="ZZ", year=2019),
            plan("N", network="FFS"), plan("I", issuer=" "), plan("M", metal="Titanium"), plan("Y", year=2019),
            plan("OK")]
    f = {r.rule_no: (r.rejected, r.remaining) for r in Q.plan_funnel(plans_df(spark, rows)).collect()}
    assert f == {1: (2, 7), 2: (1, 6), 4: (1, 5), 5: (1, 4), 6: (1, 3), 7: (1, 2)}


def test_costs_of_crowded_orders(spark, tmp_path):
    lines = [(1, 1 + i % 5, 3 + i % 4, 500.0 + i) for i in range(60)] + [(2, 4, 9, 77.5), (2, 8, 2, 60.0), (None, 6, 1, 9.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    got = [sorted(map(tuple, fixture_costs(spark, str(tmp_path), hot_rows=n).collect()), key=str) for n in (5, 1000)]
    assert got[0] == got[1]
    assert [(r[0], int(r[1])) for r in got[0]] == [("PL00000001", 500), ("PL00000002", 60), (None, 9)]


def test_funnel_matches_fixture_counts(spark, sf_small):
    f = {r.rule_no: r.rejected for r in Q.plan_funnel(fixture_plans(spark, sf_small)).collect()}
    assert f == {1: 5, 2: 16, 4: 42, 5: 1, 6: 2, 7: 223}
    c = Q.cost_funnel(fixture_costs(spark, sf_small)).collect()[0]
    assert c.rejected + c.remaining == 1473
    assert Q.clean_plans(fixture_plans(spark, sf_small)).count() == 1211
