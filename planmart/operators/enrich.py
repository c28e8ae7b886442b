"""Silver layer: inner join of validated plans and costs, then eight derived
columns (state rank and averages, counts, network share, affordability score).

The source job computes these with windows per state: at most 51 busy tasks,
and a state holding a third of all rows lands in one task. Here they come from
map-side-combined aggregates that are joined back, one path at every size:

* W2-W5 (averages and counts per state / state+network / state+metal) from one
  aggregate at (state, network, metal) grain. Rules R2/R4/R6 bound it to
  51 x 4 x 5 = 1,020 rows, so it is broadcast.
* W1 (``rank`` by deductible within state) by prefix: rows are dealt by
  (state, bucket of ``BUCKET`` money units) and ranked there; a table of the
  rows in lower buckets of the state, with one row per bucket, raises these
  ranks. Rows, that table and the window share one exchange and one sort, so
  rows cross the network once. A bucket that holds many rows (a deductible that
  a third of all plans have) never meets in one task: its ranks come from the
  counts of its at most 10,000 cent values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import affordability_score_exact, decimal_avg
from ..schemas import DEC_MONEY, SILVER_COLUMNS

STATE, NETWORK, METAL = "StateCode", "NetworkType", "MetalLevel"
DED, OOP = "IndividualDeductible", "IndividualOutOfPocketMax"
BUCKET = 100
HOT_ROWS = 1_000_000  # more rows in one bucket don't meet in one task


def join_plans_costs(plans: DataFrame, costs: DataFrame) -> DataFrame:
    """Inner equi-join on PlanID (unmatched rows on either side vanish)."""
    return plans.join(costs, on="PlanID", how="inner")


def _network_share() -> Column:
    """P4 from the counts of a network and of its state."""
    return F.round(F.col("plan_count_state_network") * 100.0 / F.col("plan_count_state"), 2)


def group_stats(joined: DataFrame) -> DataFrame:
    """W2-W5 per (state, network, metal) cell from one map-side-combined aggregate."""
    cells = joined.groupBy(STATE, NETWORK, METAL).agg(
        F.sum(DED).alias("_sd"), F.count(DED).alias("_nd"),
        F.sum(OOP).alias("_so"), F.count(OOP).alias("_no"),
        F.count("PlanID").alias("_np"),
    )
    by_state = Window.partitionBy(STATE)
    by_state_net = Window.partitionBy(STATE, NETWORK)
    by_state_metal = Window.partitionBy(STATE, METAL)
    return cells.select(
        STATE, NETWORK, METAL,
        decimal_avg(F.sum("_sd").over(by_state), F.sum("_nd").over(by_state), DEC_MONEY).alias("avg_deductible_state"),
        F.sum("_np").over(by_state).alias("plan_count_state"),
        F.sum("_np").over(by_state_net).alias("plan_count_state_network"),
        decimal_avg(F.sum("_so").over(by_state_metal), F.sum("_no").over(by_state_metal), DEC_MONEY)
        .alias("avg_oop_max_state_metal"),
    )


def network_shares(joined: DataFrame) -> DataFrame:
    """P4 per (state, network): at most 204 rows of validated plans."""
    counts = joined.groupBy(STATE, NETWORK).agg(F.count("PlanID").alias("plan_count_state_network"))
    return (counts.withColumn("plan_count_state", F.sum("plan_count_state_network").over(Window.partitionBy(STATE)))
            .select(STATE, NETWORK, _network_share().alias("pct_network_type_in_state")))


def with_network_share(joined: DataFrame) -> DataFrame:
    """Join output plus P4, all that mart 2 needs of silver."""
    return _null_safe_join(joined, F.broadcast(network_shares(joined)), [STATE, NETWORK])


def _running(keys: list[str], order: Column) -> Column:
    """Sum of ``_c`` over the rows before this one."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_c").over(before), F.lit(0))


def with_rank(joined: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join output plus the rank by deductible within the state; NULL deductibles sort first, as in ``rank()``.

    Ranks are taken inside buckets and raised by the rows in lower buckets of
    the state. Buckets with more than ``hot_rows`` rows are ranked by counts
    instead; their table has one row per ``hot_rows`` rows at most, so it is
    broadcast.
    """
    rows = joined.withColumns({
        "_s": F.coalesce(F.concat(F.lit("="), STATE), F.lit("")),  # keys without nulls: one exchange for join and window
        "_b": F.coalesce(F.floor(F.col(DED) / BUCKET).cast("bigint"), F.lit(-(1 << 62)))})
    counts = rows.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    lower = counts.select("_s", "_b", _running(["_s"], F.col("_b")).alias("_lower"), (F.col("_c") > hot_rows).alias("_hot"))
    hot = F.broadcast(lower.where("_hot").select("_s", "_b", "_lower"))
    inside = Window.partitionBy("_s", "_b").orderBy(F.col(DED).asc_nulls_first())
    rank = (F.col("_lower") + F.col("_rank")).cast("bigint").alias("rank_deductible_state")
    even = rows.join(lower.where(~F.col("_hot")), ["_s", "_b"]).withColumn("_rank", F.rank().over(inside))
    values = rows.join(hot, ["_s", "_b"]).groupBy("_s", "_b", "_lower", DED).agg(F.count(F.lit(1)).alias("_c"))
    values = values.select("_s", DED, "_lower", (_running(["_s", "_b"], F.col(DED).asc_nulls_first()) + 1).alias("_rank"))
    of_hot = _null_safe_join(rows.join(hot.select("_s", "_b"), ["_s", "_b"], "left_semi"), values, ["_s", DED])
    return even.select(*joined.columns, rank).unionByName(of_hot.select(*joined.columns, rank))


def _null_safe_join(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    renamed = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    cond = [big[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys]
    return big.join(renamed, on=cond, how="inner").drop(*[f"_k_{k}" for k in keys])


def enrich(joined: DataFrame) -> DataFrame:
    """Silver rows: join output + the eight derived columns, in contract order.

    Statistics run over every joined row (inactive plans included), as in the
    source job; the active filter comes later, in the marts. ``joined`` is
    read three times (cells, buckets, rows), so callers pass a stored table:
    the pipeline and the registry write the join once as Parquet, and each
    read is pruned to its columns.
    """
    out = _null_safe_join(with_rank(joined), F.broadcast(group_stats(joined)), [STATE, NETWORK, METAL])
    return out.withColumns({
        "diff_from_avg_state_deductible": F.col(DED) - F.col("avg_deductible_state"),
        "pct_network_type_in_state": _network_share(),
        # Exact decimal, then double: the same value on every run and engine.
        "affordability_score": affordability_score_exact(DED, OOP).cast("double"),
    }).select(*SILVER_COLUMNS)


def build_silver(clean_plans_df: DataFrame, clean_costs_df: DataFrame) -> DataFrame:
    return enrich(join_plans_costs(clean_plans_df, clean_costs_df))
