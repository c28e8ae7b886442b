"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle shares nothing with the Spark operators but the fixture SQL text
(the inputs) and the column names of the contracts; rules, domains and orders
are stated here again (a test compares them). Averages are recomputed with integer
arithmetic, because DuckDB averages decimals as DOUBLE while Spark keeps
exact decimals rounded HALF_UP: for a sum ``S`` in units of ``10^-a`` over
``n`` values, the mean in units of ``10^-(a+k)`` rounded half up is
``(2*S*10^k + n) // (2*n)``. Values are non-negative throughout.
"""

from __future__ import annotations

from decimal import Decimal

from .schemas import COST_COLUMNS, PLAN_COLUMNS, SILVER_COLUMNS
from .sources.fixtures import COSTS_SQL, PLANS_SQL

# Fixed values of the contract.
VALID_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY",
    "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND",
    "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
]
VALID_NETWORK_TYPES = ["HMO", "PPO", "EPO", "POS"]
VALID_METAL_LEVELS = ["Bronze", "Silver", "Gold", "Platinum", "Catastrophic"]
METAL_ORDER = ["Catastrophic", "Bronze", "Silver", "Gold", "Platinum"]
MIN_PLAN_YEAR = 2020
PLAN_RULES = [(1, "PlanID unique/non-null"), (2, "StateCode valid"), (4, "NetworkType valid"), (5, "IssuerName non-empty"),
              (6, "MetalLevel valid"), (7, "PlanYear >= 2020")]
COST_RULE = (3, "cost validity")
DM1_ID, DM2_ID, DM3_ID = "DM1_AFFORDABILITY", "DM2_MARKET_STRUCTURE", "DM3_COMPETITIVENESS"
DM1_TABLE, DM2_TABLE, DM3_TABLE = "datamart_affordability", "datamart_market_structure", "datamart_competitiveness"
DEFAULT_SNAPSHOT = "2024-01-15"
_DEDUP = ("PlanYear DESC NULLS LAST, MetalLevel NULLS LAST, NetworkType NULLS LAST, StateCode NULLS LAST, "
          "IssuerName NULLS LAST, IsActive NULLS LAST, PlanType NULLS LAST, MarketCoverage NULLS LAST, "
          "IssuerID NULLS LAST, CountyName NULLS LAST, PlanName NULLS LAST")


# -- integer rounding helpers (SQL text) -------------------------------------
def _mean_units(s: str, n: str, shift: int) -> str:
    """round_half_up(S * 10^shift / n); NULL when n = 0."""
    return f"((2 * ({s}) * {10 ** shift} + ({n})) // (2 * NULLIF({n}, 0)))"


def _reround(m: str, drop: int) -> str:
    """Drop ``drop`` decimal digits of a non-negative integer, half up."""
    return f"((({m}) + {5 * 10 ** (drop - 1)}) // {10 ** drop})"


def _dec(i: str, scale: int, precision: int) -> str:
    unit = Decimal(1).scaleb(-scale)
    return (f"CAST(CAST({i} AS DECIMAL(18,0)) * CAST('{unit:f}' AS DECIMAL({scale + 1},{scale}))"
            f" AS DECIMAL({precision},{scale}))")


def _dbl(i: str, scale: int) -> str:
    return f"(CAST({i} AS DOUBLE) / {10 ** scale})"


def _units(col: str, scale: int) -> str:
    return f"CAST({col} * {10 ** scale} AS BIGINT)"


def _round_avg(col: str, in_scale: int, places: int, precision: int) -> str:
    """ROUND(AVG(col), places) as Spark computes it (mean at in_scale+4 first)."""
    m = _mean_units(f"sum({_units(col, in_scale)})", f"count({col})", 4)
    return _dec(_reround(m, in_scale + 4 - places), places, precision)


def _mean_double(col: str, in_scale: int) -> str:
    """CAST(AVG(col) AS DOUBLE) for a decimal column (mean at in_scale+4)."""
    m = _mean_units(f"sum({_units(col, in_scale)})", f"count({col})", 4)
    return _dbl(m, in_scale + 4)


def _pct(num: str, den: str, precision: int = 7) -> str:
    """ROUND(num * 100.0 / NULLIF(den, 0), 2) as an exact decimal."""
    return _dec(_mean_units(num, den, 4), 2, precision)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# -- the pipeline up to the marts ------------------------------------------------
_RULES = {
    2: f"StateCode IN {_in(VALID_STATES)}",
    4: f"NetworkType IN {_in(VALID_NETWORK_TYPES)}",
    5: "IssuerName IS NOT NULL AND trim(IssuerName) <> ''",
    6: f"MetalLevel IN {_in(VALID_METAL_LEVELS)}",
    7: f"PlanYear >= {MIN_PLAN_YEAR}",
}
_COST_RULE = ("IndividualDeductible >= 0 AND IndividualOutOfPocketMax > 0 "
              "AND IndividualDeductible <= IndividualOutOfPocketMax")
_PLAN_COLS = ", ".join(PLAN_COLUMNS)
_COST_ONLY = ", ".join(f"c.{c}" for c in COST_COLUMNS[1:])
_BASE_COLS = ", ".join(PLAN_COLUMNS + COST_COLUMNS[1:])

SOURCES = f"""plans AS ({PLANS_SQL.format(orders="orders")}),
costs AS ({COSTS_SQL.format(lineitem="lineitem")})"""

CLEAN = f"""clean_plans AS (
  SELECT {_PLAN_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY PlanID ORDER BY {_DEDUP}) AS _rn FROM plans WHERE PlanID IS NOT NULL) z
  WHERE _rn = 1 AND {' AND '.join(f'({r})' for r in _RULES.values())}),
clean_costs AS (SELECT * FROM costs WHERE {_COST_RULE}),
joined AS (SELECT p.*, {_COST_ONLY} FROM clean_plans p JOIN clean_costs c ON p.PlanID = c.PlanID)"""

_AVG_DED_STATE = _dec(_mean_units("_sd", "_nd", 4), 6, 14)
SILVER = f"""win AS (
  SELECT *,
    CAST(rank() OVER (PARTITION BY StateCode ORDER BY IndividualDeductible ASC NULLS FIRST) AS BIGINT) AS rank_deductible_state,
    sum({_units('IndividualDeductible', 2)}) OVER (PARTITION BY StateCode) AS _sd,
    count(IndividualDeductible) OVER (PARTITION BY StateCode) AS _nd,
    count(PlanID) OVER (PARTITION BY StateCode) AS plan_count_state,
    count(PlanID) OVER (PARTITION BY StateCode, NetworkType) AS plan_count_state_network,
    sum({_units('IndividualOutOfPocketMax', 2)}) OVER (PARTITION BY StateCode, MetalLevel) AS _so,
    count(IndividualOutOfPocketMax) OVER (PARTITION BY StateCode, MetalLevel) AS _no
  FROM joined),
silver AS (
  SELECT {_BASE_COLS}, rank_deductible_state,
    {_AVG_DED_STATE} AS avg_deductible_state,
    CAST(CAST(IndividualDeductible AS DECIMAL(15,6)) - {_AVG_DED_STATE} AS DECIMAL(15,6)) AS diff_from_avg_state_deductible,
    CAST(plan_count_state AS BIGINT) AS plan_count_state,
    CAST(plan_count_state_network AS BIGINT) AS plan_count_state_network,
    {_dbl(_mean_units('plan_count_state_network', 'plan_count_state', 4), 2)} AS pct_network_type_in_state,
    {_dec(_mean_units('_so', '_no', 4), 6, 14)} AS avg_oop_max_state_metal,
    CAST(IndividualDeductible + IndividualOutOfPocketMax * CAST(0.3 AS DECIMAL(2,1)) AS DOUBLE) AS affordability_score,
    {_mean_units('plan_count_state_network', 'plan_count_state', 4)} AS _pct_h
  FROM win)"""

_SCORE_H = _reround(_mean_units(
    "sum(CAST(IndividualDeductible * 1000 AS BIGINT) + CAST(IndividualOutOfPocketMax * 300 AS BIGINT))",
    "count(IndividualDeductible + IndividualOutOfPocketMax)", 4), 5)

MARTS = f"""dm1 AS (
  SELECT StateCode, MetalLevel, CAST(count(DISTINCT PlanID) AS BIGINT) AS num_plans,
    {_round_avg('IndividualDeductible', 2, 2, 11)} AS avg_individual_deductible,
    {_round_avg('FamilyDeductible', 2, 2, 11)} AS avg_family_deductible,
    {_round_avg('IndividualOutOfPocketMax', 2, 2, 11)} AS avg_individual_oop_max,
    {_round_avg('FamilyOutOfPocketMax', 2, 2, 11)} AS avg_family_oop_max,
    CAST(min(IndividualDeductible) AS DECIMAL(11,2)) AS min_deductible,
    CAST(max(IndividualDeductible) AS DECIMAL(11,2)) AS max_deductible,
    {_dbl(_SCORE_H, 2)} AS avg_affordability_score,
    '{DEFAULT_SNAPSHOT}' AS snapshot_date, '{DM1_ID}' AS datamart_id,
    {_SCORE_H} AS _score_h
  FROM silver WHERE IsActive = 1 GROUP BY StateCode, MetalLevel),
dm2 AS (
  SELECT StateCode, NetworkType, IssuerName, CAST(count(DISTINCT PlanID) AS BIGINT) AS num_plans,
    CAST(count(DISTINCT MetalLevel) AS BIGINT) AS metal_diversity,
    {_dbl(_reround(_mean_units('sum(_pct_h)', 'count(_pct_h)', 4), 4), 2)} AS network_share_pct,
    {_round_avg('IndividualDeductible', 2, 2, 11)} AS avg_deductible,
    CAST(count(DISTINCT CountyName) AS BIGINT) AS county_coverage,
    '{DEFAULT_SNAPSHOT}' AS snapshot_date, '{DM2_ID}' AS datamart_id
  FROM silver WHERE IsActive = 1 GROUP BY StateCode, NetworkType, IssuerName HAVING count(DISTINCT PlanID) > 0),
dm3 AS (
  SELECT StateCode, MetalLevel, NetworkType, BenefitCategory, CAST(count(DISTINCT PlanID) AS BIGINT) AS num_plans,
    {_round_avg('CopayPrimaryCare', 2, 2, 11)} AS avg_copay_primary,
    {_round_avg('CopaySpecialist', 2, 2, 11)} AS avg_copay_specialist,
    {_round_avg('CopayER', 2, 2, 11)} AS avg_copay_er,
    {_round_avg('CopayGenericDrug', 2, 2, 11)} AS avg_copay_generic,
    {_round_avg('CoinsuranceRate', 2, 4, 8)} AS avg_coinsurance_rate,
    CAST(sum(CASE WHEN BenefitCovered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_excluded,
    CAST(sum(CASE WHEN HSAEligible = 1 THEN 1 ELSE 0 END) AS BIGINT) AS num_hsa_eligible,
    CAST(count(DISTINCT Exclusions) AS BIGINT) AS distinct_exclusions,
    '{DEFAULT_SNAPSHOT}' AS snapshot_date, '{DM3_ID}' AS datamart_id
  FROM silver WHERE IsActive = 1 GROUP BY StateCode, MetalLevel, NetworkType, BenefitCategory)"""

DM1_COLS = ("StateCode, MetalLevel, num_plans, avg_individual_deductible, avg_family_deductible, "
            "avg_individual_oop_max, avg_family_oop_max, min_deductible, max_deductible, "
            "avg_affordability_score, snapshot_date, datamart_id")

# Panel frames (lower-case names; exact decimals for roll-ups) and the default selection.
PANELS = f"""p1 AS (SELECT StateCode AS statecode, MetalLevel AS metallevel, * EXCLUDE (StateCode, MetalLevel) FROM dm1),
p2 AS (SELECT StateCode AS statecode, NetworkType AS networktype, IssuerName AS issuername,
              * EXCLUDE (StateCode, NetworkType, IssuerName) FROM dm2),
p3 AS (SELECT StateCode AS statecode, MetalLevel AS metallevel, NetworkType AS networktype,
              BenefitCategory AS benefitcategory, * EXCLUDE (StateCode, MetalLevel, NetworkType, BenefitCategory) FROM dm3),
def_states AS (SELECT statecode FROM (SELECT DISTINCT statecode FROM p1 WHERE statecode IS NOT NULL) ORDER BY statecode LIMIT 10),
def_metals AS (SELECT DISTINCT metallevel FROM p1 WHERE metallevel IN {_in(METAL_ORDER)}),
def_networks AS (SELECT DISTINCT networktype FROM p2 WHERE networktype IS NOT NULL),
f1 AS (SELECT * FROM p1 WHERE statecode IN (SELECT statecode FROM def_states) AND metallevel IN (SELECT metallevel FROM def_metals)),
f2 AS (SELECT * FROM p2 WHERE statecode IN (SELECT statecode FROM def_states) AND networktype IN (SELECT networktype FROM def_networks)),
f3 AS (SELECT * FROM p3 WHERE statecode IN (SELECT statecode FROM def_states) AND metallevel IN (SELECT metallevel FROM def_metals))"""

_METAL_POS = "list_position([" + ", ".join(f"'{m}'" for m in METAL_ORDER) + "], metallevel)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _marts_sql(select: str) -> str:
    return _with(SOURCES, CLEAN, SILVER, MARTS) + select


def _panel_sql(select: str) -> str:
    return _with(SOURCES, CLEAN, SILVER, MARTS, PANELS) + select


def _dm1_double_cols(prefix: str = "") -> str:
    nums = ["avg_individual_deductible", "avg_family_deductible", "avg_individual_oop_max",
            "avg_family_oop_max", "min_deductible", "max_deductible"]
    return ", ".join(f"CAST({prefix}{c} AS DOUBLE) AS {c}" for c in nums)


def _funnel_plans() -> str:
    fail = " ".join(f"WHEN NOT coalesce({r}, false) THEN {no}" for no, r in _RULES.items())
    counts = ", ".join(f"count(*) FILTER (WHERE PlanID IS NOT NULL AND failed = {no}) AS r{no}" for no in _RULES)
    rows = " UNION ALL ".join(f"SELECT {no} AS rule_no, '{name}' AS rule, r{no} AS rejected, total FROM c"
                              for no, name in PLAN_RULES)
    return _with(SOURCES, f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY PlanID ORDER BY {_DEDUP}) AS _rn,
         count(*) OVER (PARTITION BY PlanID) AS _rows FROM plans),
k AS (SELECT *, CASE WHEN PlanID IS NULL THEN 1 {fail} END AS failed FROM ranked WHERE _rn = 1),
c AS (SELECT sum(_rows) AS total, sum(CASE WHEN PlanID IS NULL THEN _rows ELSE _rows - 1 END) AS r1, {counts} FROM k)""") + f"""
SELECT CAST(rule_no AS INTEGER) AS rule_no, rule, CAST(rejected AS BIGINT) AS rejected,
       CAST(total - sum(rejected) OVER (ORDER BY rule_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS remaining
FROM ({rows}) t"""


def _funnel_costs() -> str:
    no, name = COST_RULE
    return _with(SOURCES) + f"""SELECT CAST({no} AS INTEGER) AS rule_no, '{name}' AS rule,
  CAST(count(*) FILTER (WHERE NOT coalesce({_COST_RULE}, false)) AS BIGINT) AS rejected,
  CAST(count(*) FILTER (WHERE coalesce({_COST_RULE}, false)) AS BIGINT) AS remaining FROM costs"""


def _page(mart: str, cols: str, order: str, where: str, page_no: int, size: int) -> str:
    return _marts_sql(f"""SELECT {cols}, {page_no} AS page, {size} AS page_size,
  (SELECT CAST(count(*) AS BIGINT) FROM {mart} {where}) AS total,
  CAST(ceil((SELECT count(*) FROM {mart} {where}) / {size}.0) AS BIGINT) AS total_pages
FROM {mart} {where} ORDER BY {order} LIMIT {size} OFFSET {(page_no - 1) * size}""")


_DM2_COLS = ("StateCode, NetworkType, IssuerName, num_plans, metal_diversity, network_share_pct, avg_deductible, "
             "county_coverage, snapshot_date, datamart_id")
_DM3_COLS = ("StateCode, MetalLevel, NetworkType, BenefitCategory, num_plans, avg_copay_primary, avg_copay_specialist, "
             "avg_copay_er, avg_copay_generic, avg_coinsurance_rate, num_excluded, num_hsa_eligible, "
             "distinct_exclusions, snapshot_date, datamart_id")
_DM1_ORDER = "snapshot_date DESC NULLS FIRST, StateCode ASC NULLS LAST, MetalLevel ASC NULLS LAST"
_DM2_ORDER = ("num_plans DESC NULLS FIRST, StateCode ASC NULLS LAST, NetworkType ASC NULLS LAST, "
              "IssuerName ASC NULLS LAST")
_DM3_ORDER = ("avg_copay_primary ASC NULLS LAST, StateCode ASC NULLS LAST, MetalLevel ASC NULLS LAST, "
              "NetworkType ASC NULLS LAST, BenefitCategory ASC NULLS LAST")

def _m2(col: str, alias: str, precision: int = 12) -> str:
    """Second-level ROUND(AVG(mart cents), 2)."""
    return f"{_round_avg(col, 2, 2, precision)} AS {alias}"


def _m4(col: str, alias: str, precision: int = 9) -> str:
    """Second-level ROUND(AVG(mart rate with 4 places), 4)."""
    return f"{_round_avg(col, 4, 4, precision)} AS {alias}"


def _pivot_mean(col: str, key: str, value: str) -> str:
    s = f"sum(CASE WHEN {key} = '{value}' THEN {_units(col, 2)} END)"
    n = f"count(CASE WHEN {key} = '{value}' THEN {col} END)"
    return f"coalesce({_dbl(_mean_units(s, n, 4), 6)}, 0.0) AS {value}"


def _half_even_tenths(num: str, den: str) -> str:
    q = f"(({num}) * 1000 // NULLIF({den}, 0))"
    r = f"(({num}) * 1000 - {q} * ({den}))"
    return (f"({q} + CASE WHEN 2 * {r} > ({den}) THEN 1 "
            f"WHEN 2 * {r} = ({den}) AND {q} % 2 = 1 THEN 1 ELSE 0 END)")


def oracle_sql() -> dict[str, str]:
    silver_cols = ", ".join(SILVER_COLUMNS)
    q: dict[str, str] = {}
    q["src_plan_count"] = _with(SOURCES) + "SELECT CAST(count(*) AS BIGINT) AS total_plans FROM plans"
    q["src_metal_counts"] = _with(SOURCES) + "SELECT MetalLevel, CAST(count(*) AS BIGINT) AS nb FROM plans GROUP BY MetalLevel"
    q["src_top_benefits"] = _with(SOURCES) + ("SELECT BenefitCategory, CAST(count(*) AS BIGINT) AS nb FROM costs "
                                              "GROUP BY BenefitCategory ORDER BY nb DESC, BenefitCategory ASC NULLS LAST LIMIT 5")
    q["src_plan_sample"] = _with(SOURCES) + (
        f"SELECT * FROM plans ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in PLAN_COLUMNS)} LIMIT 5")
    q["dq_funnel_plans"] = _funnel_plans()
    q["dq_funnel_costs"] = _funnel_costs()
    q["clean_plans"] = _with(SOURCES, CLEAN) + "SELECT * FROM clean_plans"
    q["clean_costs"] = _with(SOURCES, CLEAN) + "SELECT * FROM clean_costs"
    q["silver_joined"] = _with(SOURCES, CLEAN) + "SELECT * FROM joined"
    q["silver_enriched"] = _with(SOURCES, CLEAN, SILVER) + f"SELECT {silver_cols} FROM silver"
    q["dm1_affordability"] = _marts_sql(f"SELECT {DM1_COLS} FROM dm1")
    q["dm2_market"] = _marts_sql("SELECT * FROM dm2")
    q["dm3_competitiveness"] = _marts_sql("SELECT * FROM dm3")
    q["mart_volumes"] = _marts_sql(
        f"SELECT '{DM1_TABLE}' AS datamart, CAST(count(*) AS BIGINT) AS lignes FROM dm1 UNION ALL "
        f"SELECT '{DM2_TABLE}', CAST(count(*) AS BIGINT) FROM dm2 UNION ALL "
        f"SELECT '{DM3_TABLE}', CAST(count(*) AS BIGINT) FROM dm3")
    # Reports
    q["q01_metal_profile"] = _marts_sql(f"""SELECT MetalLevel, CAST(count(*) AS BIGINT) AS nb_etats,
  {_m2('avg_individual_deductible', 'franchise_moy')}, {_m2('avg_individual_oop_max', 'oop_max_moy')},
  {_dec(_reround(_mean_units('sum(_score_h)', 'count(_score_h)', 4), 4), 2, 12)} AS score_accessibilite
FROM dm1 GROUP BY MetalLevel""")
    state_costs = (f"SELECT StateCode, {_m2('avg_individual_deductible', 'franchise_moy')}, "
                   f"{_m2('avg_individual_oop_max', 'oop_max_moy')}, CAST(sum(num_plans) AS BIGINT) AS total_plans "
                   f"FROM dm1 GROUP BY StateCode")
    q["q02_costliest_states"] = _marts_sql(f"{state_costs} ORDER BY franchise_moy DESC, StateCode LIMIT 5")
    q["q03_cheapest_states"] = _marts_sql(f"{state_costs} ORDER BY franchise_moy ASC, StateCode LIMIT 5")
    q["q04_deductible_spread"] = _marts_sql("""SELECT MetalLevel, CAST(min(min_deductible) AS DECIMAL(12,2)) AS deductible_min,
  CAST(max(max_deductible) AS DECIMAL(12,2)) AS deductible_max,
  CAST(max(max_deductible) - min(min_deductible) AS DECIMAL(13,2)) AS ecart FROM dm1 GROUP BY MetalLevel""")
    q["q05_network_share"] = _marts_sql(f"""SELECT NetworkType, CAST(sum(num_plans) AS BIGINT) AS total_plans,
  {_pct('sum(num_plans)', '(SELECT sum(num_plans) FROM dm2)')} AS pourcentage FROM dm2 GROUP BY NetworkType""")
    q["q06_top_issuers"] = _marts_sql(f"""SELECT IssuerName, CAST(sum(num_plans) AS BIGINT) AS total_plans,
  CAST(count(DISTINCT StateCode) AS BIGINT) AS nb_etats,
  {_dec(_reround(_mean_units('sum(metal_diversity)', 'count(metal_diversity)', 4), 3), 1, 10)} AS diversite_metal
FROM dm2 GROUP BY IssuerName ORDER BY total_plans DESC, IssuerName LIMIT 10""")
    q["q07_state_competition"] = _marts_sql(f"""SELECT StateCode, CAST(count(DISTINCT IssuerName) AS BIGINT) AS nb_assureurs,
  CAST(sum(num_plans) AS BIGINT) AS total_plans, {_m2('avg_deductible', 'franchise_moy')}
FROM dm2 GROUP BY StateCode ORDER BY nb_assureurs DESC, StateCode LIMIT 10""")
    q["q08_network_coverage"] = _marts_sql(f"""SELECT NetworkType, CAST(count(DISTINCT StateCode) AS BIGINT) AS nb_etats,
  CAST(sum(county_coverage) AS BIGINT) AS total_counties, {_m2('avg_deductible', 'franchise_moy')}
FROM dm2 GROUP BY NetworkType""")
    q["q09_copays_by_metal"] = _marts_sql(f"""SELECT MetalLevel, {_m2('avg_copay_primary', 'copay_generaliste')},
  {_m2('avg_copay_specialist', 'copay_specialiste')}, {_m2('avg_copay_er', 'copay_urgences')},
  {_m2('avg_copay_generic', 'copay_medicament')}, {_m4('avg_coinsurance_rate', 'taux_coassurance')}
FROM dm3 GROUP BY MetalLevel""")
    q["q10_exclusion_rate"] = _marts_sql(f"""SELECT BenefitCategory, CAST(sum(num_excluded) AS BIGINT) AS total_exclusions,
  CAST(sum(num_plans) AS BIGINT) AS total_plans, {_pct('sum(num_excluded)', 'sum(num_plans)')} AS taux_exclusion_pct
FROM dm3 GROUP BY BenefitCategory""")
    q["q11_hsa_rate"] = _marts_sql(f"""SELECT MetalLevel, NetworkType, CAST(sum(num_hsa_eligible) AS BIGINT) AS hsa_eligible,
  CAST(sum(num_plans) AS BIGINT) AS total, {_pct('sum(num_hsa_eligible)', 'sum(num_plans)')} AS pct_hsa
FROM dm3 GROUP BY MetalLevel, NetworkType ORDER BY pct_hsa DESC NULLS FIRST, MetalLevel, NetworkType LIMIT 10""")
    q["q12_hmo_vs_ppo"] = _marts_sql(f"""SELECT NetworkType, {_m2('avg_copay_primary', 'copay_generaliste')},
  {_m2('avg_copay_specialist', 'copay_specialiste')}, {_m2('avg_copay_er', 'copay_urgences')},
  {_m4('avg_coinsurance_rate', 'taux_coassurance')}, CAST(sum(num_excluded) AS BIGINT) AS total_exclusions
FROM dm3 WHERE NetworkType IN ('HMO', 'PPO') GROUP BY NetworkType""")
    # Serving
    q["svc_affordability_page"] = _page("dm1", DM1_COLS, _DM1_ORDER, "", 1, 10)
    q["svc_affordability_page_ny_silver"] = _page(
        "dm1", DM1_COLS, _DM1_ORDER, "WHERE StateCode = 'NY' AND MetalLevel = 'Silver'", 1, 20)
    q["svc_affordability_page_past_end"] = _page("dm1", DM1_COLS, _DM1_ORDER, "", 99, 10)
    q["svc_market_page"] = _page("dm2", _DM2_COLS, _DM2_ORDER, "", 1, 10)
    q["svc_market_page_tx_ppo"] = _page("dm2", _DM2_COLS, _DM2_ORDER,
                                        "WHERE StateCode = 'TX' AND NetworkType = 'PPO'", 2, 5)
    q["svc_competitiveness_page"] = _page("dm3", _DM3_COLS, _DM3_ORDER, "", 1, 10)
    q["svc_competitiveness_page_gold_hmo"] = _page(
        "dm3", _DM3_COLS, _DM3_ORDER, "WHERE MetalLevel = 'Gold' AND NetworkType = 'HMO'", 1, 10)
    q["svc_affordability_stats"] = _marts_sql(f"""SELECT MetalLevel AS metallevel, CAST(count(*) AS BIGINT) AS num_state_groups,
  {_m2('avg_individual_deductible', 'overall_avg_deductible')}, {_m2('avg_individual_oop_max', 'overall_avg_oop_max')},
  CAST(min(avg_individual_deductible) AS DECIMAL(12,2)) AS lowest_avg_deductible,
  CAST(max(avg_individual_deductible) AS DECIMAL(12,2)) AS highest_avg_deductible
FROM dm1 GROUP BY MetalLevel""")
    q["svc_network_distribution"] = _marts_sql(f"""SELECT NetworkType AS networktype, CAST(sum(num_plans) AS BIGINT) AS total_plans,
  CAST(count(DISTINCT IssuerName) AS BIGINT) AS unique_issuers, CAST(count(DISTINCT StateCode) AS BIGINT) AS state_coverage,
  {_m2('avg_deductible', 'avg_deductible')} FROM dm2 GROUP BY NetworkType""")
    q["svc_copay_summary"] = _marts_sql(f"""SELECT MetalLevel AS metallevel, {_m2('avg_copay_primary', 'avg_copay_primary')},
  {_m2('avg_copay_specialist', 'avg_copay_specialist')}, {_m2('avg_copay_er', 'avg_copay_er')},
  {_m2('avg_copay_generic', 'avg_copay_generic')}, {_m4('avg_coinsurance_rate', 'avg_coinsurance_rate')},
  CAST(sum(num_excluded) AS BIGINT) AS total_exclusions, CAST(sum(num_hsa_eligible) AS BIGINT) AS total_hsa_eligible
FROM dm3 GROUP BY MetalLevel""")
    # Panels
    p1_double = (f"statecode, metallevel, num_plans, {_dm1_double_cols()}, avg_affordability_score, "
                 "snapshot_date, datamart_id")
    p2_double = ("statecode, networktype, issuername, num_plans, metal_diversity, network_share_pct, "
                 "CAST(avg_deductible AS DOUBLE) AS avg_deductible, county_coverage, snapshot_date, datamart_id")
    dm3_nums = ["avg_copay_primary", "avg_copay_specialist", "avg_copay_er", "avg_copay_generic", "avg_coinsurance_rate"]
    p3_double = ("statecode, metallevel, networktype, benefitcategory, num_plans, "
                 + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in dm3_nums)
                 + ", num_excluded, num_hsa_eligible, distinct_exclusions, snapshot_date, datamart_id")
    q["panel_load"] = _panel_sql(f"SELECT {p1_double} FROM p1")
    q["panel_load_dm2"] = _panel_sql(f"SELECT {p2_double} FROM p2")
    q["panel_load_dm3"] = _panel_sql(f"SELECT {p3_double} FROM p3")
    q["raw_panel_rows"] = _panel_sql(f"SELECT {p1_double} FROM f1")
    q["raw_panel_rows_dm2"] = _panel_sql(f"SELECT {p2_double} FROM f2")
    q["raw_panel_rows_dm3"] = _panel_sql(f"SELECT {p3_double} FROM f3")
    q["panel_facets"] = _panel_sql(f"""SELECT facet, CAST(row_number() OVER (PARTITION BY facet ORDER BY k) AS INTEGER) AS position,
  value, (facet <> 'state' OR row_number() OVER (PARTITION BY facet ORDER BY k) <= 10) AS is_default FROM (
  SELECT DISTINCT 'state' AS facet, statecode AS value, statecode AS k FROM p1 WHERE statecode IS NOT NULL
  UNION ALL SELECT DISTINCT 'metal', metallevel, lpad(CAST({_METAL_POS} AS VARCHAR), 3, '0') FROM p1
    WHERE metallevel IN {_in(METAL_ORDER)}
  UNION ALL SELECT DISTINCT 'network', networktype, networktype FROM p2 WHERE networktype IS NOT NULL) t""")
    q["panel_kpis"] = _panel_sql(f"""SELECT (SELECT CAST(coalesce(sum(num_plans), 0) AS BIGINT) FROM f2) AS total_plans,
  CAST(count(DISTINCT statecode) AS BIGINT) AS n_states,
  (SELECT CAST(count(DISTINCT issuername) AS BIGINT) FROM f2) AS n_issuers,
  {_mean_double('avg_individual_deductible', 2)} AS avg_deductible,
  {_mean_double('avg_individual_oop_max', 2)} AS avg_oop FROM f1""")
    q["panel_state_deductible"] = _panel_sql(
        f"SELECT statecode, {_mean_double('avg_individual_deductible', 2)} AS avg_individual_deductible FROM f1 GROUP BY statecode")
    q["panel_metal_ded_oop"] = _panel_sql(f"""SELECT * FROM (SELECT metallevel,
  {_mean_double('avg_individual_deductible', 2)} AS avg_individual_deductible,
  {_mean_double('avg_individual_oop_max', 2)} AS avg_individual_oop_max
FROM f1 WHERE metallevel IN {_in(METAL_ORDER)} GROUP BY metallevel) t
WHERE avg_individual_deductible IS NOT NULL AND avg_individual_oop_max IS NOT NULL""")
    q["panel_score_box"] = _panel_sql(f"""SELECT metallevel, CAST(count(avg_affordability_score) AS BIGINT) AS n,
  min(avg_affordability_score) AS min, quantile_cont(avg_affordability_score, 0.25) AS q1,
  quantile_cont(avg_affordability_score, 0.5) AS median, quantile_cont(avg_affordability_score, 0.75) AS q3,
  max(avg_affordability_score) AS max
FROM f1 WHERE metallevel IN {_in(METAL_ORDER)} GROUP BY metallevel HAVING count(avg_affordability_score) > 0""")
    ded_sum = f"sum({_units('avg_individual_deductible', 2)})"
    by_state = (f"SELECT statecode, {_mean_units(ded_sum, 'count(avg_individual_deductible)', 4)} AS m "
                "FROM f1 GROUP BY statecode")
    q["panel_state_extremes"] = _panel_sql(f"""SELECT statecode, {_dbl('m', 6)} AS avg_individual_deductible, category FROM (
  (SELECT *, 'Moins chers' AS category FROM ({by_state}) s ORDER BY m ASC NULLS LAST, statecode ASC LIMIT 10)
  UNION ALL
  (SELECT *, 'Plus chers' AS category FROM ({by_state}) s ORDER BY m DESC NULLS LAST, statecode DESC LIMIT 10)) t""")
    q["panel_network_plans"] = _panel_sql(f"""SELECT networktype, CAST(sum(num_plans) AS BIGINT) AS num_plans,
  {_pct('sum(num_plans)', '(SELECT sum(num_plans) FROM f2)')} AS share_pct FROM f2 GROUP BY networktype""")
    q["panel_network_diversity"] = _panel_sql("""SELECT networktype, CAST(sum(num_plans) AS BIGINT) AS total_plans,
  CAST(sum(metal_diversity) AS DOUBLE) / count(metal_diversity) AS avg_diversity,
  CAST(sum(county_coverage) AS DOUBLE) / count(county_coverage) AS avg_counties FROM f2 GROUP BY networktype""")
    q["panel_top15_issuers"] = _panel_sql("""SELECT issuername, CAST(sum(num_plans) AS BIGINT) AS num_plans FROM f2
GROUP BY issuername ORDER BY num_plans DESC, issuername LIMIT 15""")
    nets = sorted(VALID_NETWORK_TYPES)
    q["panel_state_network_matrix"] = _panel_sql(
        "SELECT statecode, " + ", ".join(_pivot_mean("avg_deductible", "networktype", n) for n in nets)
        + " FROM f2 GROUP BY statecode")
    q["panel_copays"] = _panel_sql(f"""SELECT * FROM (SELECT metallevel,
  {', '.join(f"{_mean_double(c, 2)} AS {c}" for c in dm3_nums[:4])}
FROM f3 WHERE metallevel IN {_in(METAL_ORDER)} GROUP BY metallevel) t
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in dm3_nums[:4])}""")
    q["panel_coinsurance"] = _panel_sql(
        f"SELECT metallevel, networktype, {_mean_double('avg_coinsurance_rate', 4)} AS avg_coinsurance_rate "
        "FROM f3 GROUP BY metallevel, networktype")
    q["panel_hsa_pct"] = _panel_sql(f"""SELECT * FROM (SELECT metallevel, CAST(sum(num_plans) AS BIGINT) AS total,
  CAST(sum(num_hsa_eligible) AS BIGINT) AS hsa,
  {_dbl(_half_even_tenths('sum(num_hsa_eligible)', 'sum(num_plans)'), 1)} AS pct_hsa
FROM f3 WHERE metallevel IN {_in(METAL_ORDER)} GROUP BY metallevel) t WHERE pct_hsa IS NOT NULL""")
    # the categories that occur, not a list
    q["panel_exclusion_matrix"] = _panel_sql("""SELECT s.statecode, c.benefitcategory,
  CAST(coalesce((SELECT sum(num_excluded) FROM f3 WHERE f3.statecode = s.statecode AND f3.benefitcategory = c.benefitcategory), 0)
       AS BIGINT) AS num_excluded
FROM (SELECT DISTINCT statecode FROM f3 WHERE benefitcategory IS NOT NULL) s,
     (SELECT DISTINCT benefitcategory FROM f3 WHERE benefitcategory IS NOT NULL) c""")
    q["panel_plans_by_metal"] = _panel_sql(f"""SELECT metallevel, CAST(sum(num_plans) AS BIGINT) AS num_plans
FROM p1 WHERE metallevel IN {_in(METAL_ORDER)} GROUP BY metallevel""")
    q["panel_state_scatter"] = _panel_sql(f"""SELECT statecode, {_mean_double('avg_individual_deductible', 2)} AS deductible,
  {_mean_double('avg_individual_oop_max', 2)} AS oop, CAST(sum(num_plans) AS BIGINT) AS plans FROM p1 GROUP BY statecode""")
    plan_cols = ", ".join(PLAN_COLUMNS)
    dated = lambda d, where: f"SELECT {plan_cols}, '{d}' AS snapshot_date FROM plans WHERE {where}"
    q["io_snapshot_roundtrip"] = _with(SOURCES) + (
        f"{dated(DEFAULT_SNAPSHOT, 'IsActive = 1')} UNION ALL {dated('2024-01-16', 'PlanYear >= 2022')}")
    q["io_snapshot_failed_rerun"] = _with(SOURCES) + (
        f"{dated(DEFAULT_SNAPSHOT, 'IsActive = 1')} UNION ALL {dated('2024-01-16', 'true')}")
    q["io_snapshot_empty_rerun"] = _with(SOURCES) + dated("2024-01-16", "IsActive = 1")
    q["io_catalog_table"] = _with(SOURCES, CLEAN, SILVER) + (
        f"SELECT {silver_cols}, '{DEFAULT_SNAPSHOT}' AS snapshot_date FROM silver")
    q["io_csv_source"] = _with(SOURCES) + f"SELECT {plan_cols} FROM plans"
    q["io_csv_quarantine"] = _with(SOURCES) + f"""SELECT * FROM (
SELECT {plan_cols}, CAST(NULL AS VARCHAR) AS line FROM numbered WHERE k NOT IN (7, 8) UNION ALL
SELECT {", ".join(f"NULL AS {c}" for c in PLAN_COLUMNS)},
  CASE WHEN k = 7 THEN PlanID || ',short' ELSE PlanID || '{"," * (len(PLAN_COLUMNS) - 1)}year' END FROM numbered WHERE k IN (7, 8))"""
    q["io_csv_quarantine"] = q["io_csv_quarantine"].replace(
        "SELECT * FROM (", ", numbered AS (SELECT *, coalesce(CAST(substr(PlanID, 3, 8) AS INTEGER), 0) % 50 AS k FROM plans) SELECT * FROM (", 1)
    q["io_pipeline_dm1"] = q["dm1_affordability"]
    q["io_pipeline_dm2"] = q["dm2_market"]
    q["io_pipeline_dm3"] = q["dm3_competitiveness"]
    q["io_pipeline_silver"] = q["silver_enriched"]
    q["io_row_counts"] = _marts_sql(" UNION ALL ".join(
        f"SELECT '{name}' AS dataset, CAST(count(*) AS BIGINT) AS n_rows FROM {table}" for name, table in (
            ("bronze_plans", "plans"), ("bronze_costs", "costs"), ("silver", "silver"), (DM1_TABLE, "dm1"), (DM2_TABLE, "dm2"),
            (DM3_TABLE, "dm3"))))
    q["io_pipeline_funnel"] = f"SELECT * FROM ({q['dq_funnel_plans']}) UNION ALL SELECT * FROM ({q['dq_funnel_costs']})"
    for n, order in ((1, "StateCode, MetalLevel"), (2, "StateCode, NetworkType, num_plans DESC, IssuerName"),
                     (3, "StateCode, MetalLevel, NetworkType, BenefitCategory")):
        cols = DM1_COLS if n == 1 else "*"
        q[f"dm{n}_ordered"] = _marts_sql(
            f"SELECT {cols}, CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS position FROM dm{n}")
    chosen = "WHERE statecode IN ('CA', 'NY', 'TX')"
    metals = "AND metallevel IN ('Gold', 'Silver')"
    q["raw_panel_chosen"] = _panel_sql(f"SELECT {p1_double} FROM p1 {chosen} {metals}")
    q["raw_panel_chosen_dm2"] = _panel_sql(f"SELECT {p2_double} FROM p2 {chosen} AND networktype = 'HMO'")
    q["raw_panel_chosen_dm3"] = _panel_sql(f"SELECT {p3_double} FROM p3 {chosen} {metals}")
    q["raw_panel_none_chosen"] = _panel_sql(f"SELECT {p1_double} FROM p1 WHERE false")
    q["panel_lenient_limits"] = _with(SOURCES) + (
        """SELECT PlanID, limit_text,
  CASE WHEN regexp_full_match(trim(limit_text), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
       THEN CAST(trim(limit_text) AS DOUBLE) END AS limit_value
FROM (SELECT PlanID, CASE CAST(CopayPrimaryCare AS INTEGER) % 12
    WHEN 0 THEN l WHEN 1 THEN ' ' || l || ' ' WHEN 2 THEN '-' || l || '.5' WHEN 3 THEN l || 'e3' WHEN 4 THEN '+0' || l || '.'
    WHEN 5 THEN l || 'd' WHEN 6 THEN l || '.5F' WHEN 7 THEN '0x' || l || 'p3' WHEN 8 THEN l || '_0' WHEN 9 THEN '1,' || l
    WHEN 10 THEN l || 'e' ELSE l || ' 0' END AS limit_text FROM (SELECT *, QuantitativeLimit AS l FROM costs))""")
    for key, page_no in (("svc_affordability_page_envelope", 2), ("svc_affordability_page_envelope_past_end", 99)):
        q[key] = _marts_sql(f"""SELECT {page_no} AS page, 10 AS page_size, (SELECT CAST(count(*) AS BIGINT) FROM dm1) AS total,
  CAST(ceil((SELECT count(*) FROM dm1) / 10.0) AS BIGINT) AS total_pages, CAST(count(*) AS BIGINT) AS n_items,
  coalesce(string_agg(StateCode || '/' || MetalLevel, ',' ORDER BY rn), '') AS item_keys
FROM (SELECT *, row_number() OVER (ORDER BY {_DM1_ORDER}) AS rn FROM dm1) WHERE rn > {(page_no - 1) * 10} AND rn <= {page_no * 10}""")
    return q
