"""Serving reads over the marts: paged filtered endpoints and national roll-ups.

Orders follow the serving database: NULLs first in descending and last in
ascending order; each order is completed with the mart's group key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rounded_avg
from ..operators.marts import DM1_KEYS, DM2_KEYS, DM3_KEYS
from ..operators.paging import envelope, page
from ..schemas import DEFAULT_PAGE_SIZE



def _order(first, keys):
    return [first] + [F.col(k).asc_nulls_last() for k in keys]


def dm1_page_order():
    return _order(F.col("snapshot_date").desc_nulls_first(), DM1_KEYS)


def dm2_page_order():
    return _order(F.col("num_plans").desc_nulls_first(), DM2_KEYS)


def dm3_page_order():
    return _order(F.col("avg_copay_primary").asc_nulls_last(), DM3_KEYS)


def affordability_page(dm1: DataFrame, state: str | None = None, metal_level: str | None = None,
                       page_no: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    return page(dm1, dm1_page_order(), {"StateCode": state, "MetalLevel": metal_level}, page_no, page_size)


def affordability_envelope(dm1: DataFrame, state: str | None = None, metal_level: str | None = None,
                           page_no: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """What the endpoint returns: the page's numbers and its items, also past the end."""
    return envelope(dm1, dm1_page_order(), {"StateCode": state, "MetalLevel": metal_level}, page_no, page_size)


def market_page(dm2: DataFrame, state: str | None = None, network_type: str | None = None,
                issuer: str | None = None, page_no: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    filters = {"StateCode": state, "NetworkType": network_type, "IssuerName": issuer}
    return page(dm2, dm2_page_order(), filters, page_no, page_size)


def competitiveness_page(dm3: DataFrame, state: str | None = None, metal_level: str | None = None,
                         network_type: str | None = None, benefit_category: str | None = None,
                         page_no: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    filters = {"StateCode": state, "MetalLevel": metal_level, "NetworkType": network_type,
               "BenefitCategory": benefit_category}
    return page(dm3, dm3_page_order(), filters, page_no, page_size)


def affordability_stats(dm1: DataFrame) -> DataFrame:
    """Per metal: state groups, mean/lowest/highest state-level mean deductible."""
    return (
        dm1.groupBy(F.col("MetalLevel").alias("metallevel")).agg(
            F.count(F.lit(1)).alias("num_state_groups"),
            rounded_avg("avg_individual_deductible", 2).alias("overall_avg_deductible"),
            rounded_avg("avg_individual_oop_max", 2).alias("overall_avg_oop_max"),
            F.round(F.min("avg_individual_deductible"), 2).alias("lowest_avg_deductible"),
            F.round(F.max("avg_individual_deductible"), 2).alias("highest_avg_deductible"),
        )
        .orderBy(F.col("overall_avg_deductible").asc_nulls_last(), "metallevel")
    )


def network_distribution(dm2: DataFrame) -> DataFrame:
    """Per network: plans, distinct issuers and states, mean issuer-level deductible."""
    return (
        dm2.groupBy(F.col("NetworkType").alias("networktype")).agg(
            F.sum("num_plans").alias("total_plans"),
            F.countDistinct("IssuerName").alias("unique_issuers"),
            F.countDistinct("StateCode").alias("state_coverage"),
            rounded_avg("avg_deductible", 2).alias("avg_deductible"),
        )
        .orderBy(F.col("total_plans").desc_nulls_first(), "networktype")
    )


def copay_summary(dm3: DataFrame) -> DataFrame:
    """Per metal: mean copays and coinsurance, total exclusions and HSA-eligible plans."""
    return (
        dm3.groupBy(F.col("MetalLevel").alias("metallevel")).agg(
            rounded_avg("avg_copay_primary", 2).alias("avg_copay_primary"),
            rounded_avg("avg_copay_specialist", 2).alias("avg_copay_specialist"),
            rounded_avg("avg_copay_er", 2).alias("avg_copay_er"),
            rounded_avg("avg_copay_generic", 2).alias("avg_copay_generic"),
            rounded_avg("avg_coinsurance_rate", 4).alias("avg_coinsurance_rate"),
            F.sum("num_excluded").alias("total_exclusions"),
            F.sum("num_hsa_eligible").alias("total_hsa_eligible"),
        )
        .orderBy(F.col("avg_copay_primary").asc_nulls_last(), "metallevel")
    )
