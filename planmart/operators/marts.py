"""Gold marts DM1-DM3 over silver rows, plus their volume report.

Marts 1 and 3 need row-level columns only, so they may read the plain join of
plans and costs; mart 2 needs one derived column, the network share.

All three keep active plans only (the silver windows ran before this filter,
so shares and ranks include inactive plans - kept on purpose). Each mart is a
single ``groupBy().agg()``: Spark combines the plain aggregates map-side and
rewrites the COUNT(DISTINCT ...) measures into one Expand + two-level
aggregate. With ``unique_plan_ids`` (checked by ``plan_ids_unique``) the
plan count is a plain count, so only small-domain distinct measures remain
and every mart combines map-side. The ORDER BY of the source job is
presentational (it is lost on the JDBC write) and is applied only when
``ordered=True``.

Where plan ids are unique, each mart also rolls up from cells (``mart_cells``):
sums, counts, minima and maxima at the grain of the mart's keys and distinct
measures. Cells of one mart are bounded by its own domains, so the rows fold
map-side and little is shuffled; cells that serve all three marts at once are
nearly as many as the rows. Callers store the cells of each mart, from a scan
of the columns it needs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical_position, decimal_avg, rounded_avg
from ..schemas import (
    DEC_MONEY,
    DEC_RATE,
    DM1_ID,
    DM1_TABLE,
    DM2_ID,
    DM2_TABLE,
    DM3_ID,
    DM3_TABLE,
    VALID_METAL_LEVELS,
)

DEFAULT_SNAPSHOT = "2024-01-15"

DM1_KEYS = ["StateCode", "MetalLevel"]
DM2_KEYS = ["StateCode", "NetworkType", "IssuerName"]
DM3_KEYS = ["StateCode", "MetalLevel", "NetworkType", "BenefitCategory"]
MART_KEYS = {DM1_TABLE: DM1_KEYS, DM2_TABLE: DM2_KEYS, DM3_TABLE: DM3_KEYS}
# Presentation order of each mart: (column, descending).
MART_ORDERS = {
    DM1_TABLE: [(c, False) for c in DM1_KEYS],
    DM2_TABLE: [("StateCode", False), ("NetworkType", False), ("num_plans", True), ("IssuerName", False)],
    DM3_TABLE: [(c, False) for c in DM3_KEYS],
}


def plan_ids_unique(costs: DataFrame) -> bool:
    """True when no PlanID occurs twice in ``costs``: validated costs, the join or silver (one job over that column).

    Plans are de-duplicated, so only repeated cost rows can repeat a PlanID
    in silver. When this holds, COUNT(DISTINCT PlanID) equals COUNT(PlanID) in
    every group, and the marts can drop that distinct measure: without it each
    mart combines map-side into domain-sized groups instead of shuffling
    every active row by (group, PlanID).
    """
    return costs.groupBy("PlanID").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()


def _num_plans(unique_plan_ids: bool) -> Column:
    return (F.count("PlanID") if unique_plan_ids else F.countDistinct("PlanID")).alias("num_plans")


def active(silver: DataFrame) -> DataFrame:
    """active plans only."""
    return silver.where(F.col("IsActive") == 1)


def _tag(df: DataFrame, snapshot_date: str, mart_id: str) -> DataFrame:
    """Constant snapshot and mart tags."""
    return df.withColumns({"snapshot_date": F.lit(snapshot_date), "datamart_id": F.lit(mart_id)})


def _count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): 0 (not NULL) when nothing matches."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _score() -> Column:
    return F.col("IndividualDeductible") + F.col("IndividualOutOfPocketMax") * F.lit(Decimal("0.3"))


def _order(table: str) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c, descending in MART_ORDERS[table]]


def with_position(mart: DataFrame, table: str) -> DataFrame:
    """Each row's place in the presentation order, whose columns end in the mart's key.

    One window over the whole mart, which the domains of its keys bound; the
    place doesn't rest on the order in which partitions are read.
    """
    place = F.row_number().over(Window.orderBy(*_order(table)))
    return mart.withColumn("position", place.cast("bigint")).orderBy("position")


def dm1_affordability(silver: DataFrame, snapshot_date: str = DEFAULT_SNAPSHOT, ordered: bool = False,
                      unique_plan_ids: bool = False) -> DataFrame:
    """DM1: deductibles, out-of-pocket maxima and affordability by state and metal."""
    df = active(silver).groupBy(*DM1_KEYS).agg(
        _num_plans(unique_plan_ids),
        rounded_avg("IndividualDeductible", 2).alias("avg_individual_deductible"),
        rounded_avg("FamilyDeductible", 2).alias("avg_family_deductible"),
        rounded_avg("IndividualOutOfPocketMax", 2).alias("avg_individual_oop_max"),
        rounded_avg("FamilyOutOfPocketMax", 2).alias("avg_family_oop_max"),
        F.round(F.min("IndividualDeductible"), 2).alias("min_deductible"),
        F.round(F.max("IndividualDeductible"), 2).alias("max_deductible"),
        # Mean of the exact decimal score, then double (the column's contract).
        F.round(F.avg(_score()), 2).cast("double").alias("avg_affordability_score"),
    )
    if ordered:
        df = df.orderBy(*_order(DM1_TABLE))
    return _tag(df, snapshot_date, DM1_ID)


def dm2_market(silver: DataFrame, snapshot_date: str = DEFAULT_SNAPSHOT, ordered: bool = False,
               unique_plan_ids: bool = False) -> DataFrame:
    """DM2: plans, metal diversity, network share and county coverage per issuer."""
    # The share is a 2-decimal constant per (state, network); averaging its
    # exact decimal keeps the mean exact.
    share = F.col("pct_network_type_in_state").cast("decimal(5,2)")
    df = (
        active(silver).groupBy(*DM2_KEYS).agg(
            _num_plans(unique_plan_ids),
            F.countDistinct("MetalLevel").alias("metal_diversity"),
            F.round(F.avg(share), 2).cast("double").alias("network_share_pct"),
            rounded_avg("IndividualDeductible", 2).alias("avg_deductible"),
            F.countDistinct("CountyName").alias("county_coverage"),
        )
        .where(F.col("num_plans") > 0)  # HAVING COUNT(DISTINCT PlanID) > 0
    )
    if ordered:
        df = df.orderBy(*_order(DM2_TABLE))
    return _tag(df, snapshot_date, DM2_ID)


def dm3_competitiveness(silver: DataFrame, snapshot_date: str = DEFAULT_SNAPSHOT, ordered: bool = False,
                        unique_plan_ids: bool = False) -> DataFrame:
    """DM3: copays, coinsurance, exclusions and HSA eligibility per benefit cell."""
    df = active(silver).groupBy(*DM3_KEYS).agg(
        _num_plans(unique_plan_ids),
        rounded_avg("CopayPrimaryCare", 2).alias("avg_copay_primary"),
        rounded_avg("CopaySpecialist", 2).alias("avg_copay_specialist"),
        rounded_avg("CopayER", 2).alias("avg_copay_er"),
        rounded_avg("CopayGenericDrug", 2).alias("avg_copay_generic"),
        rounded_avg("CoinsuranceRate", 4).alias("avg_coinsurance_rate"),
        _count_if(F.col("BenefitCovered") == 0).alias("num_excluded"),
        _count_if(F.col("HSAEligible") == 1).alias("num_hsa_eligible"),
        F.countDistinct("Exclusions").alias("distinct_exclusions"),
    )
    if ordered:
        df = df.orderBy(*_order(DM3_TABLE))
    return _tag(df, snapshot_date, DM3_ID)


# Cells: the keys of all marts, and the columns whose distinct values two of them count.
CELL_KEYS = ["StateCode", "MetalLevel", "NetworkType", "IssuerName", "BenefitCategory", "CountyName", "Exclusions"]
SHARE_TYPE = T.DecimalType(5, 2)
# Averaged measure -> type of its values; each has a sum ``s_`` and a count ``n_`` in a cell.
CELL_MEANS = {
    "IndividualDeductible": DEC_MONEY, "FamilyDeductible": DEC_MONEY,
    "IndividualOutOfPocketMax": DEC_MONEY, "FamilyOutOfPocketMax": DEC_MONEY,
    "CopayPrimaryCare": DEC_MONEY, "CopaySpecialist": DEC_MONEY, "CopayER": DEC_MONEY, "CopayGenericDrug": DEC_MONEY,
    "CoinsuranceRate": DEC_RATE,
}
CELL_OTHERS = ["min_deductible", "max_deductible", "num_excluded", "num_hsa_eligible"]
# Cells of one mart: its keys and distinct measures, averaged measures, other measures.
MART_CELLS = {
    DM1_TABLE: (DM1_KEYS,
                ["IndividualDeductible", "FamilyDeductible", "IndividualOutOfPocketMax", "FamilyOutOfPocketMax", "score"],
                ["min_deductible", "max_deductible"]),
    DM2_TABLE: ([*DM2_KEYS, "MetalLevel", "CountyName"], ["share", "IndividualDeductible"], []),
    DM3_TABLE: ([*DM3_KEYS, "Exclusions"],
                ["CopayPrimaryCare", "CopaySpecialist", "CopayER", "CopayGenericDrug", "CoinsuranceRate"],
                ["num_excluded", "num_hsa_eligible"]),
}


def mart_cells(silver: DataFrame, table: str | None = None) -> DataFrame:
    """Mergeable parts of one mart (of all three without ``table``) per cell of active plans, one map-side-combined
    aggregate.

    Every buffer has a fixed width, so it is a hash aggregate. There are never
    more cells than rows, and no more than the product of the domains; those of
    one mart are far fewer, and only mart 2 needs the network share. Sums
    and counts add up exactly, so any roll-up equals the mart over the rows,
    provided that no PlanID repeats (``plan_ids_unique``).
    """
    keys, means, others = MART_CELLS[table] if table else (CELL_KEYS, [*CELL_MEANS, "score", "share"], CELL_OTHERS)
    derived = {"score": _score, "share": lambda: F.col("pct_network_type_in_state").cast(SHARE_TYPE)}
    parts = {name: derived[name]() if name in derived else F.col(name) for name in means}
    sums = [agg for name, c in parts.items() for agg in (F.sum(c).alias(f"s_{name}"), F.count(c).alias(f"n_{name}"))]
    measures = {
        "min_deductible": F.min("IndividualDeductible"), "max_deductible": F.max("IndividualDeductible"),
        "num_excluded": _count_if(F.col("BenefitCovered") == 0), "num_hsa_eligible": _count_if(F.col("HSAEligible") == 1)}
    return active(silver).groupBy(*keys).agg(
        F.count("PlanID").alias("num_plans"), *sums, *[measures[name].alias(name) for name in others])


def _mean(name: str, places: int, kind: T.DecimalType | None = None) -> Column:
    mean = decimal_avg(F.sum(f"s_{name}"), F.sum(f"n_{name}"), kind or CELL_MEANS[name])
    return F.round(mean, places)


def _score_type(cells: DataFrame) -> T.DecimalType:
    """Type of one score, from the type of its sum (ten digits wider)."""
    total = cells.schema["s_score"].dataType
    return T.DecimalType(total.precision - 10, total.scale)


def roll_up(cells: DataFrame, table: str, snapshot_date: str = DEFAULT_SNAPSHOT) -> DataFrame:
    """One of the three marts from its ``mart_cells`` (or those of all): the same rows as from silver with unique plan ids.

    At most one distinct measure is left per mart (counties, exclusions), so
    there is no Expand; metals come from the fixed list of rule R6 and are a
    bitmap of as many bits.
    """
    plans = F.sum("num_plans").alias("num_plans")
    if table == DM1_TABLE:
        df = cells.groupBy(*DM1_KEYS).agg(
            plans,
            _mean("IndividualDeductible", 2).alias("avg_individual_deductible"),
            _mean("FamilyDeductible", 2).alias("avg_family_deductible"),
            _mean("IndividualOutOfPocketMax", 2).alias("avg_individual_oop_max"),
            _mean("FamilyOutOfPocketMax", 2).alias("avg_family_oop_max"),
            F.round(F.min("min_deductible"), 2).alias("min_deductible"),
            F.round(F.max("max_deductible"), 2).alias("max_deductible"),
            _mean("score", 2, _score_type(cells)).cast("double").alias("avg_affordability_score"),
        )
        return _tag(df, snapshot_date, DM1_ID)
    if table == DM2_TABLE:
        metal = canonical_position("MetalLevel", VALID_METAL_LEVELS).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), metal)
        df = cells.withColumn("_metal", bit).groupBy(*DM2_KEYS).agg(
            plans,
            F.coalesce(F.bit_count(F.bit_or("_metal")), F.lit(0)).cast("bigint").alias("metal_diversity"),
            _mean("share", 2, SHARE_TYPE).cast("double").alias("network_share_pct"),
            _mean("IndividualDeductible", 2).alias("avg_deductible"),
            F.countDistinct("CountyName").alias("county_coverage"),
        ).where(F.col("num_plans") > 0)
        return _tag(df, snapshot_date, DM2_ID)
    df = cells.groupBy(*DM3_KEYS).agg(
        plans,
        _mean("CopayPrimaryCare", 2).alias("avg_copay_primary"),
        _mean("CopaySpecialist", 2).alias("avg_copay_specialist"),
        _mean("CopayER", 2).alias("avg_copay_er"),
        _mean("CopayGenericDrug", 2).alias("avg_copay_generic"),
        _mean("CoinsuranceRate", 4).alias("avg_coinsurance_rate"),
        F.sum("num_excluded").alias("num_excluded"),
        F.sum("num_hsa_eligible").alias("num_hsa_eligible"),
        F.countDistinct("Exclusions").alias("distinct_exclusions"),
    )
    return _tag(df, snapshot_date, DM3_ID)


def mart_volumes(dm1: DataFrame, dm2: DataFrame, dm3: DataFrame) -> DataFrame:
    """(datamart, lignes) row counts of the three marts."""
    parts = [
        m.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("datamart"), "lignes")
        for name, m in ((DM1_TABLE, dm1), (DM2_TABLE, dm2), (DM3_TABLE, dm3))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
