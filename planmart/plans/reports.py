"""Report queries: source checks (S13), mart volumes and Q1-Q12 over the marts.

The marts are small (bounded by state x metal x network x issuer x category
domains), so these are cheap; they stay DataFrames so a caller can write or
page them like any other result. Top-N reports order by the measure and then
by the group key, so ties are resolved the same way on every run.
Percentages are exact decimals, as in the serving database's NUMERIC.

The output column names are the reports' fixed contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import percent, rounded_avg


def _money_mean(col: str, alias: str) -> F.Column:
    """Second-level mean of a mart mean: unweighted, rounded to cents."""
    return rounded_avg(col, 2).alias(alias)


# -- S13: source checks ------------------------------------------------------
def src_plan_count(plans: DataFrame) -> DataFrame:
    return plans.agg(F.count(F.lit(1)).alias("total_plans"))


def src_metal_counts(plans: DataFrame) -> DataFrame:
    return (plans.groupBy("MetalLevel").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col("MetalLevel").asc_nulls_last()))


def src_top_benefits(costs: DataFrame, n: int = 5) -> DataFrame:
    return (costs.groupBy("BenefitCategory").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col("BenefitCategory").asc_nulls_last()).limit(n))


def src_plan_sample(plans: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` plans by key (a deterministic stand-in for ``LIMIT 5``)."""
    order = [F.col(c).asc_nulls_last() for c in plans.columns]
    return plans.orderBy(*order).limit(n)


# -- DM1 reports ---------------------------------------------------------------
def q01_metal_profile(dm1: DataFrame) -> DataFrame:
    """Mean deductible, out-of-pocket max and score per metal level."""
    return (
        dm1.groupBy("MetalLevel").agg(
            F.count(F.lit(1)).alias("nb_etats"),
            _money_mean("avg_individual_deductible", "franchise_moy"),
            _money_mean("avg_individual_oop_max", "oop_max_moy"),
            # The score is a double of a 2-decimal value; NUMERIC mean as in SQL.
            F.round(F.avg(F.col("avg_affordability_score").cast("decimal(11,2)")), 2)
            .alias("score_accessibilite"),
        )
        .orderBy(F.col("franchise_moy").desc(), "MetalLevel")
    )


def _state_costs(dm1: DataFrame) -> DataFrame:
    return dm1.groupBy("StateCode").agg(
        _money_mean("avg_individual_deductible", "franchise_moy"),
        _money_mean("avg_individual_oop_max", "oop_max_moy"),
        F.sum("num_plans").alias("total_plans"),
    )


def q02_costliest_states(dm1: DataFrame, n: int = 5) -> DataFrame:
    return _state_costs(dm1).orderBy(F.col("franchise_moy").desc(), "StateCode").limit(n)


def q03_cheapest_states(dm1: DataFrame, n: int = 5) -> DataFrame:
    return _state_costs(dm1).orderBy(F.col("franchise_moy").asc(), "StateCode").limit(n)


def q04_deductible_spread(dm1: DataFrame) -> DataFrame:
    return (
        dm1.groupBy("MetalLevel").agg(
            F.round(F.min("min_deductible"), 2).alias("deductible_min"),
            F.round(F.max("max_deductible"), 2).alias("deductible_max"),
            F.round(F.max("max_deductible") - F.min("min_deductible"), 2).alias("ecart"),
        )
        .orderBy(F.col("ecart").desc(), "MetalLevel")
    )


# -- DM2 reports ---------------------------------------------------------------
def q05_network_share(dm2: DataFrame) -> DataFrame:
    """Plans per network and share of the grand total (scalar subquery)."""
    grand_total = dm2.select(F.sum("num_plans")).scalar()
    return (
        dm2.groupBy("NetworkType").agg(F.sum("num_plans").alias("total_plans"))
        .withColumn("pourcentage", percent(F.col("total_plans"), grand_total, 2))
        .orderBy(F.col("total_plans").desc(), "NetworkType")
    )


def q06_top_issuers(dm2: DataFrame, n: int = 10) -> DataFrame:
    return (
        dm2.groupBy("IssuerName").agg(
            F.sum("num_plans").alias("total_plans"),
            F.countDistinct("StateCode").alias("nb_etats"),
            F.round(F.avg(F.col("metal_diversity").cast("decimal(20,0)")), 1).cast("decimal(10,1)")
            .alias("diversite_metal"),
        )
        .orderBy(F.col("total_plans").desc(), "IssuerName").limit(n)
    )


def q07_state_competition(dm2: DataFrame, n: int = 10) -> DataFrame:
    return (
        dm2.groupBy("StateCode").agg(
            F.countDistinct("IssuerName").alias("nb_assureurs"),
            F.sum("num_plans").alias("total_plans"),
            _money_mean("avg_deductible", "franchise_moy"),
        )
        .orderBy(F.col("nb_assureurs").desc(), "StateCode").limit(n)
    )


def q08_network_coverage(dm2: DataFrame) -> DataFrame:
    """Counties summed over (network, issuer) groups: a county counts once per group."""
    return (
        dm2.groupBy("NetworkType").agg(
            F.countDistinct("StateCode").alias("nb_etats"),
            F.sum("county_coverage").alias("total_counties"),
            _money_mean("avg_deductible", "franchise_moy"),
        )
        .orderBy(F.col("total_counties").desc(), "NetworkType")
    )


# -- DM3 reports ---------------------------------------------------------------
def q09_copays_by_metal(dm3: DataFrame) -> DataFrame:
    return (
        dm3.groupBy("MetalLevel").agg(
            _money_mean("avg_copay_primary", "copay_generaliste"),
            _money_mean("avg_copay_specialist", "copay_specialiste"),
            _money_mean("avg_copay_er", "copay_urgences"),
            _money_mean("avg_copay_generic", "copay_medicament"),
            rounded_avg("avg_coinsurance_rate", 4).alias("taux_coassurance"),
        )
        .orderBy(F.col("copay_generaliste").desc(), "MetalLevel")
    )


def q10_exclusion_rate(dm3: DataFrame) -> DataFrame:
    return (
        dm3.groupBy("BenefitCategory").agg(
            F.sum("num_excluded").alias("total_exclusions"),
            F.sum("num_plans").alias("total_plans"),
        )
        .withColumn("taux_exclusion_pct", percent(F.col("total_exclusions"), F.col("total_plans"), 2))
        .orderBy(F.col("total_exclusions").desc(), "BenefitCategory")
    )


def q11_hsa_rate(dm3: DataFrame, n: int = 10) -> DataFrame:
    return (
        dm3.groupBy("MetalLevel", "NetworkType").agg(
            F.sum("num_hsa_eligible").alias("hsa_eligible"),
            F.sum("num_plans").alias("total"),
        )
        .withColumn("pct_hsa", percent(F.col("hsa_eligible"), F.col("total"), 2))
        # NULL (no plans) first in a descending order, as the serving database does.
        .orderBy(F.col("pct_hsa").desc_nulls_first(), "MetalLevel", "NetworkType").limit(n)
    )


def q12_hmo_vs_ppo(dm3: DataFrame, networks: tuple[str, ...] = ("HMO", "PPO")) -> DataFrame:
    return (
        dm3.where(F.col("NetworkType").isin(list(networks)))
        .groupBy("NetworkType").agg(
            _money_mean("avg_copay_primary", "copay_generaliste"),
            _money_mean("avg_copay_specialist", "copay_specialiste"),
            _money_mean("avg_copay_er", "copay_urgences"),
            rounded_avg("avg_coinsurance_rate", 4).alias("taux_coassurance"),
            F.sum("num_excluded").alias("total_exclusions"),
        )
    )
