"""Paged reads: concatenated pages equal the full order; edge cases."""

import pytest

from planmart.operators.paging import envelope
from planmart.plans import serving as S
from tests.helpers import cost, costs_df, plan, plans_df
from planmart.operators import marts as M
from planmart.operators.enrich import build_silver


@pytest.fixture(scope="module")
def dm2(spark):
    states = ["CA", "TX", "NY"]
    plans = [plan(f"P{i}", state=states[i % 3], issuer=f"Issuer_{i % 4}", network=["HMO", "PPO"][i % 2])
             for i in range(40)]
    costs = [cost(f"P{i}", ded=str(100 + i)) for i in range(40)]
    return M.dm2_market(build_silver(plans_df(spark, plans), costs_df(spark, costs)))


def test_pages_cover_full_order(spark, dm2):
    total = dm2.count()
    rows = []
    for p in range(1, 5):
        rows += [(r.StateCode, r.NetworkType, r.IssuerName) for r in S.market_page(dm2, page_no=p, page_size=4).collect()]
    full = [(r.StateCode, r.NetworkType, r.IssuerName) for r in dm2.orderBy(*S.dm2_page_order()).collect()]
    assert rows == full[: len(rows)] and len(set(rows)) == len(rows) == min(total, 16)


def test_envelope_columns(spark, dm2):
    r = S.market_page(dm2, page_no=1, page_size=5).collect()[0]
    total = dm2.count()
    assert (r.page, r.page_size, r.total, r.total_pages) == (1, 5, total, -(-total // 5))


def test_past_end_page_is_empty_but_total_is_known(spark, dm2):
    assert S.market_page(dm2, page_no=50, page_size=10).count() == 0
    s = envelope(dm2, S.dm2_page_order(), {}, page_no=50, page_size=10).collect()[0]
    total = dm2.count()
    assert (s.total, s.total_pages, s.n_items, s["items"]) == (total, -(-total // 10), 0, [])


def test_envelope_holds_the_page_in_order(spark, dm2):
    rows = [tuple(r)[:len(dm2.columns)] for r in S.market_page(dm2, page_no=2, page_size=4).collect()]
    s = envelope(dm2, S.dm2_page_order(), {}, page_no=2, page_size=4).collect()[0]
    assert [tuple(r) for r in s["items"]] == rows and s.n_items == 4


def test_filters(spark, dm2):
    assert S.market_page(dm2, state="").count() == 0                     # '' is a real value
    assert S.market_page(dm2, state=None, page_size=200).count() == dm2.count()  # None: no filter
    assert S.market_page(dm2, state="ca").count() == 0                   # case-sensitive
    assert {r.StateCode for r in S.market_page(dm2, state="CA", page_size=200).collect()} == {"CA"}


def test_bounds(spark, dm2):
    with pytest.raises(ValueError):
        S.market_page(dm2, page_no=0)
    with pytest.raises(ValueError):
        S.market_page(dm2, page_size=201)
