"""Table contracts (explicit StructTypes) and the fixed value domains.

Column names are canonical CamelCase for source and silver columns; marts add
snake_case measures. Every type here is the output contract checked by tests.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's domains for right results;
# they are stated plainly, in their natural order.
# ---------------------------------------------------------------------------
VALID_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT",
    "VA", "WA", "WV", "WI", "WY", "DC",
]
VALID_NETWORK_TYPES = ["HMO", "PPO", "EPO", "POS"]
VALID_METAL_LEVELS = ["Bronze", "Silver", "Gold", "Platinum", "Catastrophic"]
MIN_PLAN_YEAR = 2020
# Display order of metal levels on the dashboard panels.
METAL_ORDER = ["Catastrophic", "Bronze", "Silver", "Gold", "Platinum"]
# Mart identifiers and serving table names (fixed contract names, as are all column names below).
DM1_ID, DM2_ID, DM3_ID = "DM1_AFFORDABILITY", "DM2_MARKET_STRUCTURE", "DM3_COMPETITIVENESS"
DM1_TABLE, DM2_TABLE, DM3_TABLE = "datamart_affordability", "datamart_market_structure", "datamart_competitiveness"
# Tags of the two halves of the state-extremes panel.
CHEAPEST_TAG, PRICIEST_TAG = "Moins chers", "Plus chers"
# Serving page bounds.
DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE = 20, 200
# Number of states preselected on the dashboard.
DEFAULT_STATE_SELECTION = 10

DEC_MONEY = T.DecimalType(10, 2)
DEC_RATE = T.DecimalType(5, 2)

PLANS_SCHEMA = T.StructType([
    T.StructField("PlanID", T.StringType()),
    T.StructField("IssuerName", T.StringType()),
    T.StructField("IssuerID", T.StringType()),
    T.StructField("PlanName", T.StringType()),
    T.StructField("PlanType", T.StringType()),
    T.StructField("NetworkType", T.StringType()),
    T.StructField("MetalLevel", T.StringType()),
    T.StructField("StateCode", T.StringType()),
    T.StructField("CountyName", T.StringType()),
    T.StructField("MarketCoverage", T.StringType()),
    T.StructField("IsActive", T.IntegerType()),
    T.StructField("PlanYear", T.IntegerType()),
])

COSTS_SCHEMA = T.StructType([
    T.StructField("PlanID", T.StringType()),
    T.StructField("IndividualDeductible", DEC_MONEY),
    T.StructField("FamilyDeductible", DEC_MONEY),
    T.StructField("IndividualOutOfPocketMax", DEC_MONEY),
    T.StructField("FamilyOutOfPocketMax", DEC_MONEY),
    T.StructField("CopayPrimaryCare", DEC_MONEY),
    T.StructField("CopaySpecialist", DEC_MONEY),
    T.StructField("CopayER", DEC_MONEY),
    T.StructField("CopayGenericDrug", DEC_MONEY),
    T.StructField("CoinsuranceRate", DEC_RATE),
    T.StructField("HSAEligible", T.IntegerType()),
    T.StructField("BenefitCategory", T.StringType()),
    T.StructField("BenefitCovered", T.IntegerType()),
    T.StructField("QuantitativeLimit", T.StringType()),
    T.StructField("LimitUnit", T.StringType()),
    T.StructField("Exclusions", T.StringType()),
])

PLAN_COLUMNS = PLANS_SCHEMA.fieldNames()
COST_COLUMNS = COSTS_SCHEMA.fieldNames()

DERIVED_SILVER = T.StructType([
    T.StructField("rank_deductible_state", T.LongType()),
    T.StructField("avg_deductible_state", T.DecimalType(14, 6)),
    T.StructField("diff_from_avg_state_deductible", T.DecimalType(15, 6)),
    T.StructField("plan_count_state", T.LongType()),
    T.StructField("plan_count_state_network", T.LongType()),
    T.StructField("pct_network_type_in_state", T.DoubleType()),
    T.StructField("avg_oop_max_state_metal", T.DecimalType(14, 6)),
    T.StructField("affordability_score", T.DoubleType()),
])

SILVER_COLUMNS = PLAN_COLUMNS + COST_COLUMNS[1:] + DERIVED_SILVER.fieldNames()


def with_snapshot(schema: T.StructType) -> T.StructType:
    """Schema of a dated snapshot: the partition label is a string, never inferred."""
    return T.StructType(list(schema.fields) + [T.StructField("snapshot_date", T.StringType())])

SILVER_SCHEMA = T.StructType(list(PLANS_SCHEMA.fields) + list(COSTS_SCHEMA.fields[1:]) + list(DERIVED_SILVER.fields))

_D11_2 = T.DecimalType(11, 2)
_TAGS = [T.StructField("snapshot_date", T.StringType()), T.StructField("datamart_id", T.StringType())]

DM1_SCHEMA = T.StructType(
    [T.StructField("StateCode", T.StringType()), T.StructField("MetalLevel", T.StringType()),
     T.StructField("num_plans", T.LongType())]
    + [T.StructField(c, _D11_2) for c in ("avg_individual_deductible", "avg_family_deductible",
                                          "avg_individual_oop_max", "avg_family_oop_max",
                                          "min_deductible", "max_deductible")]
    + [T.StructField("avg_affordability_score", T.DoubleType())] + _TAGS)

DM2_SCHEMA = T.StructType(
    [T.StructField("StateCode", T.StringType()), T.StructField("NetworkType", T.StringType()),
     T.StructField("IssuerName", T.StringType()), T.StructField("num_plans", T.LongType()),
     T.StructField("metal_diversity", T.LongType()), T.StructField("network_share_pct", T.DoubleType()),
     T.StructField("avg_deductible", _D11_2), T.StructField("county_coverage", T.LongType())] + _TAGS)

DM3_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("StateCode", "MetalLevel", "NetworkType", "BenefitCategory")]
    + [T.StructField("num_plans", T.LongType())]
    + [T.StructField(c, _D11_2) for c in ("avg_copay_primary", "avg_copay_specialist", "avg_copay_er",
                                          "avg_copay_generic")]
    + [T.StructField("avg_coinsurance_rate", T.DecimalType(8, 4))]
    + [T.StructField(c, T.LongType()) for c in ("num_excluded", "num_hsa_eligible", "distinct_exclusions")]
    + _TAGS)


def without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])
