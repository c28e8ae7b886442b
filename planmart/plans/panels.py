"""Dashboard panels as DataFrames: facets, the default selection, KPIs and the
roll-ups behind each chart.

The dashboard lower-cases mart columns and casts measures leniently to
floats (``panel_frame(as_double=True)``, used for raw-row views). Roll-ups
aggregate the exact decimals instead and cast only their result to double, so
a mean does not depend on the order rows are summed in.

Selection semantics: marts 1 and 3 are filtered by state and metal, mart 2 by
state and network (mart 3 is *not* filtered by network); an empty selection
gives no rows; the default selection is the first 10 states in sort order, all
metals present (in display order) and all networks present.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical_position, isin_or_false, lenient_double, percent
from ..schemas import CHEAPEST_TAG, DEFAULT_STATE_SELECTION, METAL_ORDER, PRICIEST_TAG, VALID_NETWORK_TYPES

# Fixed names: measures of the marts' contract that the panels read as floats.
DM1_NUMERIC = ["avg_individual_deductible", "avg_family_deductible", "avg_individual_oop_max",
               "avg_family_oop_max", "min_deductible", "max_deductible"]
DM2_NUMERIC = ["avg_deductible"]
DM3_NUMERIC = ["avg_copay_primary", "avg_copay_specialist", "avg_copay_er", "avg_copay_generic",
               "avg_coinsurance_rate"]


def panel_frame(mart: DataFrame, numeric: Sequence[str], as_double: bool = True) -> DataFrame:
    """P6 + P7: lower-case column names; optionally numbers as double, lenient where they are text."""
    df = mart.toDF(*[c.lower() for c in mart.columns])
    if as_double:
        text = {c for c, kind in df.dtypes if kind == "string"}
        df = df.withColumns({c: lenient_double(c) if c in text else F.col(c).cast("double") for c in numeric if c in df.columns})
    return df


@dataclass(frozen=True)
class Selection:
    """Multi-select filters; None means the dashboard's default."""
    states: Sequence[str] | None = None
    metals: Sequence[str] | None = None
    networks: Sequence[str] | None = None


def _distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def default_states(dm1p: DataFrame, n: int = DEFAULT_STATE_SELECTION) -> DataFrame:
    """The first ``n`` states in sort order (at most ``n`` rows)."""
    return _distinct_sorted(dm1p, "statecode").orderBy("statecode").limit(n)


def _keep(df: DataFrame, col: str, chosen: Sequence[str] | None, default: DataFrame | None) -> DataFrame:
    if chosen is not None:
        return df.where(isin_or_false(col, chosen))
    if default is None:
        return df
    # Facet lists are tiny (bounded by the state/metal/network domains).
    return df.join(F.broadcast(default), on=col, how="left_semi")


def apply_selection(dm1p: DataFrame, dm2p: DataFrame, dm3p: DataFrame,
                    sel: Selection = Selection()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """filtered marts 1, 2 and 3."""
    states = default_states(dm1p) if sel.states is None else None
    metals = (_distinct_sorted(dm1p, "metallevel").where(F.col("metallevel").isin(METAL_ORDER))
              if sel.metals is None else None)
    networks = _distinct_sorted(dm2p, "networktype") if sel.networks is None else None
    dm1f = _keep(_keep(dm1p, "statecode", sel.states, states), "metallevel", sel.metals, metals)
    dm2f = _keep(_keep(dm2p, "statecode", sel.states, states), "networktype", sel.networks, networks)
    dm3f = _keep(_keep(dm3p, "statecode", sel.states, states), "metallevel", sel.metals, metals)
    return dm1f, dm2f, dm3f


def facets(dm1p: DataFrame, dm2p: DataFrame, n_default: int = DEFAULT_STATE_SELECTION) -> DataFrame:
    """(facet, position, value, is_default) for states, metals and networks."""
    states = _distinct_sorted(dm1p, "statecode").select(
        F.lit("state").alias("facet"), F.col("statecode").alias("value"), F.col("statecode").alias("_k"))
    metals = (_distinct_sorted(dm1p, "metallevel").where(F.col("metallevel").isin(METAL_ORDER))
              .select(F.lit("metal").alias("facet"), F.col("metallevel").alias("value"),
                      F.lpad(canonical_position("metallevel", METAL_ORDER).cast("string"), 3, "0").alias("_k")))
    networks = _distinct_sorted(dm2p, "networktype").select(
        F.lit("network").alias("facet"), F.col("networktype").alias("value"), F.col("networktype").alias("_k"))
    pos = F.row_number().over(Window.partitionBy("facet").orderBy("_k"))
    return (
        states.unionByName(metals).unionByName(networks)
        .select("facet", pos.cast("int").alias("position"), "value")
        .withColumn("is_default", (F.col("facet") != "state") | (F.col("position") <= n_default))
    )


def _mean(col: str, alias: str | None = None) -> Column:
    """Exact decimal mean of a mart measure, as a double."""
    return F.avg(col).cast("double").alias(alias or col)


def _in_metal_order(df: DataFrame) -> DataFrame:
    """Canonical metal order, absent metals and rows with a null measure dropped."""
    return (df.where(F.col("metallevel").isin(METAL_ORDER)).na.drop(how="any")
            .orderBy(canonical_position("metallevel", METAL_ORDER)))


def kpis(dm1f: DataFrame, dm2f: DataFrame) -> DataFrame:
    """Total plans, states, issuers, mean deductible and mean out-of-pocket max."""
    # Both mart-2 numbers come from one scalar subquery (one pass over dm2f).
    m2 = dm2f.select(F.struct(
        F.coalesce(F.sum("num_plans"), F.lit(0)).cast("bigint").alias("total_plans"),
        F.countDistinct("issuername").alias("n_issuers"))).scalar()
    return dm1f.agg(
        F.countDistinct("statecode").alias("n_states"),
        _mean("avg_individual_deductible", "avg_deductible"),
        _mean("avg_individual_oop_max", "avg_oop"),
    ).select(m2["total_plans"].alias("total_plans"), "n_states", m2["n_issuers"].alias("n_issuers"),
             "avg_deductible", "avg_oop")


def state_deductible(dm1f: DataFrame) -> DataFrame:
    """Chart 1: mean of state-level deductibles per state."""
    return dm1f.groupBy("statecode").agg(_mean("avg_individual_deductible"))


def metal_ded_oop(dm1f: DataFrame) -> DataFrame:
    """Chart 2: mean deductible and out-of-pocket max per metal, display order."""
    return _in_metal_order(dm1f.groupBy("metallevel").agg(
        _mean("avg_individual_deductible"), _mean("avg_individual_oop_max")))


def score_box(dm1f: DataFrame) -> DataFrame:
    """Chart 3: five-number summary of the affordability score per metal.

    Quartiles are linear between closest ranks (exact ``percentile``).
    """
    s = F.col("avg_affordability_score")
    q = F.percentile(s, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return _in_metal_order(
        dm1f.groupBy("metallevel").agg(
            F.count(s).alias("n"), F.min(s).alias("min"), q.alias("_q"), F.max(s).alias("max"))
        .select("metallevel", "n", "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                F.col("_q")[2].alias("q3"), "max"))


def state_extremes(dm1f: DataFrame, n: int = 10) -> DataFrame:
    """Chart 4: ``n`` cheapest and ``n`` costliest states; the halves may overlap."""
    by_state = dm1f.groupBy("statecode").agg(F.avg("avg_individual_deductible").alias("_avg"))
    cheap = by_state.orderBy(F.col("_avg").asc_nulls_last(), F.col("statecode").asc()).limit(n) \
        .withColumn("category", F.lit(CHEAPEST_TAG))
    dear = by_state.orderBy(F.col("_avg").desc_nulls_last(), F.col("statecode").desc()).limit(n) \
        .withColumn("category", F.lit(PRICIEST_TAG))
    return cheap.unionByName(dear).select(
        "statecode", F.col("_avg").cast("double").alias("avg_individual_deductible"), "category")


def network_plans(dm2f: DataFrame) -> DataFrame:
    """Chart 5: plans per network and share of the selection's plans."""
    total = dm2f.select(F.sum("num_plans")).scalar()
    return (dm2f.groupBy("networktype").agg(F.sum("num_plans").alias("num_plans"))
            .withColumn("share_pct", percent(F.col("num_plans"), total, 2)))


def network_diversity(dm2f: DataFrame) -> DataFrame:
    """Chart 6: per network total plans, mean metal diversity, mean county coverage."""
    return dm2f.groupBy("networktype").agg(
        F.sum("num_plans").alias("total_plans"),
        F.avg("metal_diversity").alias("avg_diversity"),
        F.avg("county_coverage").alias("avg_counties"),
    )


def top_issuers(dm2f: DataFrame, n: int = 15) -> DataFrame:
    """Chart 7: top ``n`` issuers by plans (ties by name)."""
    return (dm2f.groupBy("issuername").agg(F.sum("num_plans").alias("num_plans"))
            .orderBy(F.col("num_plans").desc(), "issuername").limit(n))


def state_network_matrix(dm2f: DataFrame, networks: Sequence[str] = tuple(sorted(VALID_NETWORK_TYPES))) -> DataFrame:
    """Chart 8: state x network mean deductible, gaps as 0 (explicit pivot values)."""
    wide = dm2f.groupBy("statecode").pivot("networktype", list(networks)).agg(F.avg("avg_deductible"))
    return wide.select("statecode", *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in networks])


def copays(dm3f: DataFrame) -> DataFrame:
    """Chart 9: mean copays per metal, display order."""
    return _in_metal_order(dm3f.groupBy("metallevel").agg(
        _mean("avg_copay_primary"), _mean("avg_copay_specialist"),
        _mean("avg_copay_er"), _mean("avg_copay_generic")))


def coinsurance(dm3f: DataFrame) -> DataFrame:
    """Chart 10: mean coinsurance per metal and network."""
    return dm3f.groupBy("metallevel", "networktype").agg(_mean("avg_coinsurance_rate"))


def hsa_pct(dm3f: DataFrame) -> DataFrame:
    """Chart 11: HSA-eligible share per metal, one decimal, half-even."""
    sums = dm3f.groupBy("metallevel").agg(F.sum("num_plans").alias("total"), F.sum("num_hsa_eligible").alias("hsa"))
    ratio = F.col("hsa").cast("decimal(20,0)") * 100 / F.nullif(F.col("total"), F.lit(0)).cast("decimal(20,0)")
    return _in_metal_order(sums.withColumn("pct_hsa", F.bround(ratio, 1).cast("double")))


def exclusion_matrix(dm3f: DataFrame) -> DataFrame:
    """Chart 12: excluded count of every state and benefit category that occur, gaps as 0.

    No rule bounds the categories, so the matrix is a long grid with a fixed
    schema: each state meets the array of categories found, a scalar subquery,
    and the grid takes the sums that exist. Nothing is collected, and chart
    clients lay the rows out by their two keys.
    """
    cells = dm3f.where(F.col("benefitcategory").isNotNull())
    found = cells.select(F.array_sort(F.collect_set("benefitcategory"))).scalar()
    grid = cells.select("statecode").distinct().select("statecode", F.explode(found).alias("benefitcategory"))
    sums = cells.groupBy("statecode", "benefitcategory").agg(F.sum("num_excluded").alias("_sum"))
    return grid.join(sums, ["statecode", "benefitcategory"], "left").select(
        "statecode", "benefitcategory", F.coalesce("_sum", F.lit(0)).cast("bigint").alias("num_excluded"))


def plans_by_metal(dm1p: DataFrame) -> DataFrame:
    """Overview: plans per metal over the whole mart, display order."""
    return _in_metal_order(dm1p.groupBy("metallevel").agg(F.sum("num_plans").alias("num_plans")))


def state_scatter(dm1p: DataFrame) -> DataFrame:
    """Overview: per state mean deductible, mean out-of-pocket max and plans."""
    return dm1p.groupBy("statecode").agg(
        _mean("avg_individual_deductible", "deductible"),
        _mean("avg_individual_oop_max", "oop"),
        F.sum("num_plans").alias("plans"),
    )
